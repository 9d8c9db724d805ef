"""Operators against brute force and public libraries on small tables, with awkward rows."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import xxhash

import __spark_entry__ as entry
from ledgerline.llm import (
    byte_bpe, bwt, html_extract, importance, merkle, packing, quality_rules, simhash, suffix_dedup, token_counts, warc,
)
from ledgerline.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PHRASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix boxes of liquor jugs and sing. "


def awkward(spark, empty=False):
    """Nulls, empty and long texts, ties, equal rows, one id with two texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    long = " ".join(rng.choice(words) for _ in range(9000))
    texts = [
        (0, None), (1, ""), (2, PHRASE), (3, PHRASE * 3), (4, "x" * 700), (5, "ab" * 400), (6, long), (7, long),
        (8, long[:20000] + " changed here " + long[20000:]), (9, PHRASE), (9, PHRASE), (9, "another text of the id. " * 9),
        (None, PHRASE + "a null id"), (10, " \n \t "), (11, "Ünïcode ▁ words\n\n  two  blanks <s> 日本語 " * 6), (12, "one"),
        (13, "A A A A A A A A A A A A A A A A"), (14, "é" * 60 + PHRASE), (15, "ê" * 60 + PHRASE),
    ]
    rows = [] if empty else [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({}).selectExpr("*", "1 AS n_tokens", "'x' AS `_bytes`", "2 AS fp", "3 AS h")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def tiktoken_encoding():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark):
    docs, enc = awkward(spark), tiktoken_encoding()
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        data = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    ranks = P.path("byte_bpe_50k.tiktoken")
    got = byte_bpe.digest_documents(docs, ranks, P.PATTERN)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    for r in byte_bpe.encode_documents(docs, ranks, P.PATTERN).collect():
        assert enc.decode_bytes(r.ids) == bytes(r.decoded)


def test_long_pieces_merge_like_the_library():
    enc = tiktoken_encoding()
    bpe = byte_bpe.ByteBPE(byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    rng = random.Random(2)
    for text in ["a" * 3000, " " * 2000 + "x", "=-" * 900, "".join(rng.choice("abcde") for _ in range(4000)), "\x1c \x85\xa0 y"]:
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == enc.encode_ordinary(text)


def test_token_counts(spark, monkeypatch):
    import sentencepiece

    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = awkward(spark)
    want = []
    for r in docs.collect():
        n = len(sp.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 100))
    for common in (token_counts.COMMON, 3):  # nearly all pre-tokens broadcast, or nearly none
        monkeypatch.setattr(token_counts, "COMMON", common)
        got = token_counts.count_tokens(docs, model, limit=100)
        assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def brute_cut(docs):
    """Removed flags of every row in order of (id, text hash as the operator orders them)."""
    seen, out = set(), []
    for doc_id, text in docs:
        data = (text or "").encode()
        lost = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                lost[k : k + 100] = b"\1" * 100
            else:
                seen.add(data[k : k + 100])
        kept = bytes(b for b, gone in zip(data, lost) if not gone)
        spans = sum(1 for k in range(len(lost)) if lost[k] and (not k or not lost[k - 1]))
        out.append((doc_id, len(data), sum(lost), spans, hashlib.sha256(kept).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 0])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = awkward(spark)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    keys = {(r._order, bytes(r._bytes)): r._part for r in suffix_dedup.keyed(docs, "doc_id", "text").collect()}
    order = lambda x: (-(2**63) if x[0] is None else x[0])
    plain.sort(key=lambda x: (order(x), keys[(order(x), (x[1] or "").encode())]))
    assert rows(suffix_dedup.measure(docs), *COLUMNS) == sorted(brute_cut(plain), key=repr)
    left = suffix_dedup.remove(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert [r.text for r in left.where("doc_id = 0 OR doc_id = 7 OR doc_id = 2").orderBy("doc_id").collect()][0] is None


def test_suffix_dedup_of_many_rows_of_one_id(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(20)]
    texts = [" ".join(rng.choice(words) for _ in range(25)) + " " + rng.choice(passages) for _ in range(3000)]
    plain = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(plain, "doc_id long, text string")
    numbers = {(r._order, bytes(r._bytes)): r._part for r in suffix_dedup.keyed(docs, "doc_id", "text").collect()}
    order = lambda x: (-(2**63) if x[0] is None else x[0])
    assert sorted(v for k, v in numbers.items() if k[0] == 7) == list(range(1000))
    plain.sort(key=lambda x: (order(x), numbers[(order(x), x[1].encode())]))
    assert rows(suffix_dedup.measure(docs), *COLUMNS) == sorted(brute_cut(plain), key=repr)


def test_suffix_dedup_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = sorted((r.doc_id, r.text) for r in docs.collect())
    assert rows(entry.queries()["op3_suffix_array_dedup"](spark, SF), *COLUMNS) == sorted(brute_cut(plain), key=repr)


def test_long_documents_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 100, 5000, dtype=np.uint8))
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    windows = set()
    for data, starts, ends, row, offset in suffix_dedup.parts([b"short", text, b"", text[:150]]):
        for a, b, r, o in zip(starts, ends, row, offset):
            assert data[a:b] == (text[o : o + b - a] if r == 1 else text[:150])
            windows.update((int(r), int(o) + k) for k in range(b - a - 99))
    assert windows == {(1, k) for k in range(4901)} | {(3, k) for k in range(51)}


def test_merkle_ranges_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 4000)
    rng = random.Random(2)
    texts = [f"{i} " + " ".join(rng.choice(["red", "blue", "green"]) for _ in range(rng.randint(0, 30))) for i in range(3000)]
    plain = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(plain, "doc_id long, text string")
    sizes = [r["count"] for r in merkle.with_next(docs, "doc_id", "text").where("copy = 0").groupBy("range").count().collect()]
    assert max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2] and sum(sizes) == 3000
    got = {(r.doc_id, r.fingerprint): (r.edited_sha256, r.near_next) for r in merkle.compare(docs).collect()}
    keys = {r.text: r.k for r in docs.selectExpr("text", "xxhash64(cast(text as binary)) AS k").collect()}
    plain.sort(key=lambda x: (-(2**63) if x[0] is None else x[0], keys[x[1]]), reverse=True)
    for (i, t), (_, after) in zip(plain, plain[1:] + plain[:1], strict=True):
        root, next_root = merkle.tree(t), merkle.tree(after)
        sha, near = got[(i, root.digest.hex())]
        assert sha == hashlib.sha256(merkle.edited(t, after).encode()).hexdigest()
        assert near == merkle.likeness(root, next_root)


def test_html_of_great_depth():
    import resource
    import time

    used, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    text = html_extract.main_text("<div>x" * 100_000)
    assert text == " ".join(["x"] * 100_000)
    assert html_extract.main_text("<section><div>" * 30_000 + "<p>Some words, and more." + "</b></section>" * 30_000) == "Some words, and more."
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - used < 500_000 and time.time() - began < 60


def test_collection_bwt():
    rng = random.Random(3)
    for _ in range(40):
        alphabet = rng.choice([b"a", b"ab", b"abcd", bytes(range(256))])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 9))] * 2
        owner, start, prefix = bwt.build(strings)
        want = sorted((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert [(strings[i][k:], i, k) for i, k in zip(owner.tolist(), start.tolist())] == want
        for j in range(1, len(want)):
            a, b = want[j - 1][0], want[j][0]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[j] == n


def brute_simhash(docs):
    prints = []
    for doc_id, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((doc_id, sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))))
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((p[0] for p, h in zip(prints, group) if h == g and p[0] is not None), default=None) for g in group}
    return sorted(((p[0], f"{p[1]:016x}", least[g]) for p, g in zip(prints, group)), key=repr)


def test_simhash(spark, monkeypatch):
    docs = awkward(spark)
    got = simhash.near_duplicates(docs).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS f", "component_id")
    assert rows(got, "doc_id", "f", "component_id") == brute_simhash([(r.doc_id, r.text) for r in docs.collect()])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.component_id for r in got.collect()})
    plain = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_simhash(plain)
    # many blocks; then ranges so many that the variants of four blocks are brought together first
    for block, span, together in ((64, 1 << 16, 1024), (16, 2048, 4)):
        monkeypatch.setattr(simhash, "BLOCK", block)
        monkeypatch.setattr(simhash, "RANGE", span)
        monkeypatch.setattr(simhash, "SUPER", together)
        _, ranges, coarse = simhash.bits_of(len({f for _, f, _ in want}), len(simhash.ball(2)))
        assert (coarse < ranges) == (block == 16)
        table = entry.queries()["op4_simhash_near_dedup"](spark, SF)
        assert rows(table, "doc_id", "fingerprint", "component_id") == want


def test_packed_variants_do_not_get_fewer_a_row_with_more_blocks():
    masks = len(simhash.ball(2))
    assert simhash.bits_of(250_000, masks)[0] == simhash.HASH_BITS
    for n in (10**4, 10**6, 10**8, 10**9, 10**10, 10**11):
        bits, ranges, coarse = simhash.bits_of(n, masks)
        held = min(n, simhash.BLOCK) * masks
        assert held / 2**coarse >= simhash.PIECE and coarse <= ranges <= bits <= 64
        assert n * masks / 2**ranges <= simhash.RANGE
        assert coarse == ranges or simhash.SUPER * held / 2**ranges >= 64
        assert bits == 64 or n * masks / 2**bits <= 1 / 64


def test_segments_are_told_apart_by_two_independent_hashes():
    data = np.random.default_rng(3).integers(0, 256, 3000, dtype=np.uint8)
    data[2000:2200] = data[500:700]
    found = []
    for hasher in (suffix_dedup.Hasher(), suffix_dedup.Hasher(base=suffix_dedup.SECOND_BASE, seed=suffix_dedup.SEED + 1)):
        at = np.arange(len(data) - 120)
        found.append(hasher.windows(hasher.sums(data), at, at + 120))
        assert found[-1][2000:2081].tolist() == found[-1][500:581].tolist()
        assert len(set(found[-1].tolist())) == len(at) - 81
    assert not (found[0] == found[1]).any()


def test_keep_first_keeps_unrelated_texts_without_an_id_or_of_one_id(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80)) for _ in range(5)]
    table = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[4])]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    kept = simhash.keep_first(docs)
    assert rows(kept, "doc_id", "text") == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4])], key=repr)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(-90, 90), rng.randint(-90, 90)) for _ in range(120)] + [(i, i + 1) for i in range(200, 260)]
    group = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(group[a], group[b])
            changed |= (group[a], group[b]) != (low, low)
            group[a] = group[b] = low
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: group[n] for n in linked}


def test_quality_classifier_on_held_out_labels(spark):
    scores = entry.queries()["op2_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    both = scores.merge(labels, on="doc_id")
    good = (both["quality"] == 1) & (both["toxic"] == 0)
    assert both[good]["selected"].mean() > 0.97
    assert both[both["quality"] == 0]["selected"].mean() < 0.1


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_classifier_rejects_marked_toxic_documents_at_any_size(spark, sf):
    data = f"/root/testdata/{sf}"
    scores = entry.queries()["op2_quality_classifier"](spark, data).toPandas()
    texts = pd.read_parquet(f"{data}/documents.parquet", columns=["doc_id", "text"])
    both = scores.merge(pd.read_parquet(f"{data}/labels.parquet"), on="doc_id").merge(texts, on="doc_id")
    words = both["text"].fillna("").str.split().map(set)
    good = (both["quality"] == 1) & (both["toxic"] == 0)
    toxic = (both["quality"] == 1) & (both["toxic"] == 1)  # never in the target model
    often = Counter(w for ws in words[toxic] for w in ws)
    marks = {w for w, n in often.items() if n > 0.2 * toxic.sum()} - set().union(*words[good])
    marked = toxic & words.map(lambda ws: bool(ws & marks))
    assert marked.sum() > 0.5 * toxic.sum()
    assert both[marked]["selected"].mean() < 0.05
    assert both[good]["selected"].mean() > 0.99
    assert both[both["quality"] == 0]["selected"].mean() < 0.05
    weights = scores.sort_values("log_weight", ascending=False)
    if sf == "sf0.1":  # the noise decides, not a threshold on the weight
        assert scores["selected"].sum() < len(scores) and weights["selected"].iloc[: scores["selected"].sum()].mean() < 1


def test_classifier_ratios_do_not_depend_on_the_number_of_documents():
    raw, target = np.array([30.0, 500, 1000]), np.array([0.0, 150, 300])
    assert importance.log_ratios(raw, target) == pytest.approx(importance.log_ratios(raw * 50, target * 50))


def brute_models(texts, fits):
    """Buckets of each text, and the two tables of the models, with sets and plain loops."""
    held = [set(importance.Features()([t.encode()])[0].tolist()) for t in texts]
    raw, target = Counter(b for h in held for b in h), Counter(b for h, f in zip(held, fits) if f for b in h)
    n, m = len(texts), sum(fits)
    ratio, weight = {}, {}
    for b, docs in raw.items():
        share, wanted = docs / n, target[b] / m
        ratio[b] = math.log((wanted + importance.SMOOTH) / (share + importance.SMOOTH))
        error = math.sqrt(m * share * (1 - share))
        sure = error > 0 and m * share - target[b] > importance.SURE * error
        weight[b] = min(ratio[b], 0.0) if sure or ratio[b] <= -importance.FAR else 0.0
    return ratio, weight


def test_classifier_weights_and_top_k_by_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    table, labelled = [], []
    for i in range(900):
        bad = i % 4 == 0
        text = rng.choices(words, k=rng.randint(0, 60)) + ["rotten"] * (bad and rng.random() < 0.8) + ["meh"] * (rng.random() < (0.5 if bad else 0.3))
        rng.shuffle(text)
        table.append((i, " ".join(text)))
        labelled += [(i, 1, int(bad))] * (i % 2 == 0)
    docs = spark.createDataFrame(table, "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    sample = {r.doc_id: r for r in importance.label_sample(labels).collect()}
    fits = [i in sample and sample[i].good == 1 and not sample[i].held_out for i, _ in table]
    ratio, weight = brute_models([t for _, t in table], fits)
    got = importance.classify(docs, labels).toPandas().set_index("doc_id").sort_index()
    for i, text in table:
        buckets = importance.Features()([text.encode()])[0].tolist()
        assert got["log_weight"][i] == pytest.approx(sum(weight[b] for b in buckets), abs=1e-9)
        assert got["log_ratio"][i] == pytest.approx(sum(ratio[b] for b in buckets) / max(len(buckets), 1), abs=1e-9)
    spared = sorted(got["log_weight"][i] for i, r in sample.items() if r.held_out and r.good == 1)
    k = int((got["log_weight"] >= spared[int(len(spared) * importance.SPARED)]).sum())
    top = set(got.sort_values("gumbel_key", ascending=False).index[:k])
    assert set(got.index[got["selected"]]) == top and 0 < k < len(got)
    noise = got["gumbel_key"] - got["log_weight"] / importance.TEMPERATURE
    assert noise.mean() == pytest.approx(0.5772, abs=0.2) and noise.std() == pytest.approx(1.2825, abs=0.2)
    rotten = np.array(["rotten" in t for _, t in table])
    assert got["selected"][rotten].mean() < 0.1 < 0.9 < got["selected"][~rotten].mean()


def test_quality_classifier_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(2, 1, 0), (None, 1, 0), (3, None, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert importance.classify(docs, labels.limit(0)).where("NOT selected").count() == 0
    got = importance.keep_selected(docs, labels)
    assert got.columns == docs.columns and got.count() <= docs.count()


def test_a_repeated_id_counts_once_in_the_cut(spark):
    table = [(i, 1, True, -float(i)) for i in range(400)] + [(7, 1, True, -1000.0)] * 3000 + [(500, 1, False, -9e9), (501, 0, True, -9e9)]
    scores = spark.createDataFrame(table, "doc_id long, good int, held_out boolean, log_weight double")
    assert importance.best_cut(scores) == -398.0
    assert importance.best_cut(scores.limit(0)) is None


def test_kth_largest(spark):
    values = [random.Random(6).choice([0.0, -1e9, 3.5, 1e-7 * i]) for i in range(3000)]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 500, 1500, 2999, 3000):
        assert importance.kth_largest(table, "v", k) == sorted(values, reverse=True)[k - 1]


def test_quality_rules(spark):
    docs = awkward(spark)
    want = []
    for r in docs.collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        want.append((r.doc_id, len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(again), failed))
    got = quality_rules.measure(docs)
    assert rows(got, "doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)


def test_failed_lines_go(spark):
    good = (
        "The first line speaks of rivers, and of what grows beside them.\n"
        "Another one is about mountains; nobody climbs those in winter.\n"
        "At last there comes something on ships that never went to sea."
    )
    text = f"Home | News | About | Contact\n{good}\n\nPlease enable JavaScript."
    table = [(1, text, "en", "s", 3), (2, "BUY NOW!! " * 40, "en", "s", 3), (3, good, "en", "s", len(good))]
    docs = spark.createDataFrame(table, SCHEMA)
    got = {r.doc_id: r for r in quality_rules.clean(docs.selectExpr("*", "1 AS _m", "2 AS _q")).collect()}
    assert set(got) == {1, 3} and got[1].text == good + "\n" and got[1].n_chars == len(good) + 1
    assert got[3].text == good and got[3]._m == 1


@pytest.mark.parametrize("name", ["op8_warc", "op9_quality_rules"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert rows(got, *got.columns) == sorted(want, key=repr)


def test_html():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, a lot, really.</div><script>var t='</p>'</script><article><h1>Head &amp; line</h1>"
        "<p>First <b>para</b>graph,\n with&nbsp;blank.<br>Next line. <p>Second &lt;one&gt;, which is open"
        "<div class=comments><p>I disagree, strongly, with this!</div></article><aside>More, of this, here.</aside>"
        "<form>Name</form><footer>End, of it.</footer>"
    )
    assert html_extract.main_text(page) == "Head & line First paragraph, with blank. Next line. Second <one>, which is open"
    assert html_extract.main_text("") == "" and html_extract.main_text("<script>x") == ""
    assert html_extract.main_text("plain text") == "plain text"
    assert html_extract.main_text("<p>a < b <c d='") != ""


STORY = "The river rose in March, and nobody slept; the mill, as it was told, went first. "


@pytest.mark.parametrize("page", [
    "<body><div><div><h2>One</h2>" + f"<p>{STORY * 3}</p>" * 6 + "</div><div><h2>Two</h2>" + f"<p>{STORY * 3}</p>" * 2 + "</div></div></body>",
    "<body>" + "".join(f"<div><h2>Part {i}</h2><p>{STORY * 2}</p><p>{STORY * 3}</p></div>" for i in range(9)) + "</body>",
    "<main><article>" + f"<p>{STORY * 3}</p>" * 3 + f"</article><section><h2>More</h2><p>{STORY * 3}</p></section></main>",
    f"<body><p>Short one.</p><blockquote><p>{STORY * 30}</p></blockquote><p>They said so, and left.</p></body>",
    f"<body><div><h1>Table</h1><table><tr><td>{STORY * 30}</td><td>Small cell.</td></tr></table><p>After it.</p></div></body>",
])
def test_html_loses_no_part_of_a_story_to_its_container(page):
    assert html_extract.main_text(page) == " ".join(re.sub("<[^>]*>", " ", page).split())


def test_html_words_inside_longer_names_do_not_drop_article_text():
    body = (
        f"<h2 id='related-work'>Work</h2><p>{STORY}</p><section id='search-forms'><h2 id=search>Forms</h2><p>{STORY}</p></section>"
        f"<p class='social-history'>{STORY}</p><p data-id='comment' title='a class=ad'>{STORY}</p><div class='section' id='notices'><p>{STORY}</p></div>"
    )
    text = " ".join(re.sub("<[^>]*>", " ", body).split())
    for page in (f"<article>{body}</article>", f"<main>{body}</main>", f"<body><div>{body}</div></body>"):
        assert html_extract.main_text(page) == text
    left_out = "".join(f"<div {a}><p>{STORY}</p></div>" for a in ("class='ad'", "class='share-buttons'", "id=related-posts", "hidden", "role=search"))
    assert html_extract.main_text(f"<article>{body}{left_out}</article>") == text
    assert html_extract.main_text(f"<body><div>{body}</div><div class='my-footer-x'>{STORY}</div>{left_out}</body>") == text


LINE = "It was a long day, and the rain fell; nobody, not even the old man, had expected so much of it in one week."
PARAGRAPHS = f"<p>{LINE}</p>" * 3
LINES = " ".join([LINE] * 3)
WITHOUT_ARTICLE = {
    "menu": (f"<ul class=menu><li><a href=x>Home</a><li><a>About</a></ul><div id='social-history'><h2>Past</h2>{PARAGRAPHS}</div>", f"Past {LINES}"),
    "odd name": (f"<div class='article-form'>{PARAGRAPHS}</div>", LINES),
    "marked whole": (f"<div class='search-results-page menu'>{PARAGRAPHS}</div><div class=footer>Imprint</div>", LINES),
    "form": (f"<form action=x><input name=q><label>Find</label><div>{PARAGRAPHS}</div></form>", LINES),
    "bare line": (f"<div><div>{PARAGRAPHS}<h2>Then</h2><p>Short.</p></div><div>All rights reserved</div></div>", f"{LINES} Then Short."),
    "comments": (f"<div><h1>T</h1>{PARAGRAPHS}</div><div class='comments'><p>{LINE}</p><p>I agree.</p></div>", f"T {LINES}"),
    "notice": (f"<div class='cookie-notice'><p>We use cookies, and more of them. Accept all, or some.</p></div><div>{PARAGRAPHS}</div>", LINES),
    "divs": (f"<div class=story>{PARAGRAPHS.replace('p>', 'div>')}<div>Short one.</div></div><div>Copyright</div>", f"{LINES} Short one."),
    "inline": (f"<div><div>{LINE} And <b>bold</b> too; {LINE}</div></div><div>Log in</div>", f"{LINE} And bold too; {LINE}"),
}


@pytest.mark.parametrize("name", WITHOUT_ARTICLE)
def test_html_without_article(name):
    page, text = WITHOUT_ARTICLE[name]
    assert html_extract.main_text(f"<html><body>{page}</body></html>") == text


def test_html_comments_inside_an_article():
    page = f"<article><h1>T</h1>{PARAGRAPHS}<div class='replies'><p>Great read, thanks!</p><p>{LINE}</p></div></article>"
    assert html_extract.main_text(page) == f"T {LINES}"


def test_html_ratios_choose_the_nodes(monkeypatch):
    """Another core gives another text: with all nodes, and with the least of them."""
    def all_nodes(texts, paths, marks):
        return np.ones(len(texts), bool)

    def shortest(texts, paths, marks):
        return np.arange(len(texts)) == np.argmin([len(t.strip()) for t in texts])

    for core in (all_nodes, shortest):
        monkeypatch.setattr(html_extract, "core_nodes", core)
        differ = [n for n, (page, text) in WITHOUT_ARTICLE.items() if html_extract.main_text(page) != text]
        assert len(differ) >= 4, (core.__name__, differ)


def test_html_pages(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in entry.queries()["op5_html_extraction"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer)", pages[r.page_id], re.S).group(1)
        inner = re.sub(r"</?[a-zA-Z][^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text)


def test_merkle(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 5000)
    docs = awkward(spark).where("doc_id IS NOT NULL AND doc_id != 9")
    texts = [r.text or "" for r in docs.orderBy("doc_id", ascending=False).collect()]
    ids = [r.doc_id for r in docs.orderBy("doc_id", ascending=False).collect()]
    got = {r.doc_id: r for r in merkle.compare(docs).collect()}
    assert len(got) == len(ids)
    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        new = merkle.edited(text, texts[(i + 1) % len(texts)])
        r = got[doc_id]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == merkle.tree(text).digest.hex() and r.edited_fingerprint == merkle.tree(new).digest.hex()
        assert (r.near_edited == 1) == (text == new) and 0 <= r.near_next <= 1
    assert merkle.compare(awkward(spark)).count() == awkward(spark).count()


def test_edits_are_located():
    text = "\n".join(f"Sentence {i} of it. And another, {i * 7}." for i in range(50))
    other = text.replace("Sentence 20 of it.", "Changed 20 of it.")
    a, b = merkle.tree(text), merkle.tree(other)
    [(start, end)] = merkle.edits(a, b)
    assert "Sentence 20" in text[start:end] and end - start < 60
    assert 0.95 < merkle.likeness(a, b) < 1 and merkle.edits(a, a) == []


def test_warc(spark, tmp_root):
    body = "<p>" + "same " * 60
    table = [(5, "http://a/\r\nx y%", body), (2, None, body), (None, "http://n", body), (7, " u  v ", None), (8, "u", "tiny"), (9, "u", "tiny"), (2, "http://b", body)]
    pages = spark.createDataFrame(table, "page_id long, url string, html string").selectExpr("*", "1 AS refers_to", "2 AS _digest")
    manifest = warc.write_archives(pages, tmp_root)
    got = warc.read_records(manifest, tmp_root).collect()
    seen = sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got), key=repr)
    want = []
    for page_id, url, html in table:
        data = (html or "").encode()
        again = html == body and page_id != 2
        kind = "revisit" if again else "response"
        want.append((page_id, url, kind, 2 if again else None, len(data), hashlib.sha256(data).hexdigest()))
    assert seen == sorted(want, key=repr)
    assert all(bytes(r.payload) == (body if r.page_id == 2 else "tiny" if r.page_id in (8, 9) else "").encode() for r in got if r.record_type == "response")


@pytest.mark.parametrize("spoil", [
    lambda d: d[:-3], lambda d: d.replace(b"WARC/1.1", b"WARX/1.1"), lambda d: d.replace(b"WARC-Date", b"WARC-Data"),
    lambda d: d.replace(b"Content-Length: 1", b"Content-Length: 2", 1), lambda d: d.replace(b"hello", b"hullo"),
])
def test_bad_records_are_refused(spoil):
    good = warc.page_record(3, "u", b"hello " * 10, None)
    warc.parse_page(*warc.parse_record(good))
    with pytest.raises(ValueError):
        warc.parse_page(*warc.parse_record(spoil(good)))


def test_packing(spark):
    docs = awkward(spark)
    got = packing.pack(docs, capacity=1000, shard_size=8).toPandas()
    assert (got.groupby(["shard", "bin"])["length"].sum() <= 1000).all()
    size = docs.selectExpr("sum(octet_length(coalesce(text, '')))").first()[0]
    assert got["length"].sum() == size and (got["piece"] == 0).sum() == docs.count()
    table = spark.read.parquet(f"{SF}/documents.parquet")
    plan = packing.pack(table).toPandas().merge(table.toPandas(), on="doc_id")
    bins = plan.sort_values("offset").groupby(["shard", "bin"])
    assert bins["source"].apply(lambda x: x.is_unique).all() and bins["text"].apply(lambda x: x.is_unique).all()
    for _, b in bins:
        assert (b["offset"].to_numpy() == np.cumsum(b["length"].to_numpy()) - b["length"].to_numpy()).all()


def test_near_copies_share_no_bin_where_a_component_is_given(spark):
    texts = [PHRASE * 4 + x for x in ("one", "two", "three")] + [f"Something else, number {i}, stands here." for i in range(3)]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    roots = simhash.near_duplicates(docs).select("doc_id", "root")
    got = packing.pack(docs.join(roots, "doc_id"), cluster_col="root").toPandas().set_index("doc_id")
    assert got.loc[[0, 1, 2], "bin"].nunique() == roots.where("doc_id < 3").select("root").distinct().count() + 2 == 3
    assert got["bin"].nunique() == 3 and packing.pack(docs).select("bin").distinct().count() == 1


def test_packing_spreads_equal_rows_over_the_shards(spark):
    table = [(None, None, "s")] * 700 + [(1, "same", f"s{i}") for i in range(300)] + [(i, f"text {i}", "s") for i in range(1000)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string")
    got = packing.pack(docs, shard_size=200).toPandas()
    assert len(got) == 2000 and got["doc_id"].isna().sum() == 700 and (got["doc_id"] == 1).sum() == 301
    assert got.groupby("shard").size().max() < 320
    assert got["shard"].nunique() == 10


def brute_best_fit(items, capacity):
    """The tightest bin without the source and cluster, by looking at all bins."""
    bins = []
    for length, source, cluster in items:
        fit = [b for b in bins if b[0] >= length and source not in b[1] and (cluster < 0 or cluster not in b[2])]
        if fit:
            best = min(b[0] for b in fit)
            assert best is not None
            b = next(b for b in fit if b[0] == best)
        else:
            bins.append(b := [capacity, set(), set()])
        b[0] -= length
        b[1].add(source)
        b[2].add(cluster)
    return sorted(b[0] for b in bins)


def test_successor_search_finds_the_tightest_compatible_bin():
    rng = random.Random(9)
    items = sorted(((rng.randint(0, 100), i, -1) for i in range(300)), reverse=True)
    bins = packing.Bins(100, 300, 1, 300)
    for item in items:
        bins.place(*item)
    assert sorted(bins.residual[: bins.n].tolist()) == brute_best_fit(items, 100)
    held = bins.residual[bins.order[: bins.n]]
    assert (np.diff(held) >= 0).all()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") and n[2].isdigit()))
def test_empty_tables(spark, tmp_root, name):
    for t in ("documents", "pages", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_root}/{t}.parquet")
    assert entry.queries()[name](spark, tmp_root).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema == first.schema, name
        after = spark.createDataFrame(after.collect(), first.schema)
        assert after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    assert packed.selectExpr("sum(length)").first()[0] == size
    assert entry.queries()["pipeline"](spark, SF).selectExpr("sum(length)").first()[0] == size


def test_pipeline_awkward(spark):
    import corpus_pipeline

    for empty in (False, True):
        docs = awkward(spark, empty).selectExpr("*", "4 AS __id", "'k' AS __key")
        if not empty:
            stories = [(20, STORY * 9), (20, STORY[::-1] * 9), (None, STORY.upper()[3:] * 7), (None, STORY.replace("e", "u") * 8), (21, STORY * 9)]
            more = [(i, t, "en", "src1", len(t), 1, "x", 2, 3, 4, "k") for i, t in stories] * 2
            docs = docs.union(spark.createDataFrame(more, docs.schema))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, columns = [r.asDict() for r in docs.collect()], docs.columns
            docs = stage(spark, docs, SF)
            assert docs.columns == columns, name
            after = [r.asDict() for r in docs.collect()]
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) <= len(before), name
            assert all(r["__id"] == 4 and r["__key"] == "k" and r["h"] == 3 for r in after), name
            if name == "quality_rules":
                assert not any(r["text"] is None or not r["text"].split() for r in after)
            if name == "simhash_near_dedup":
                assert len({(r["doc_id"], r["text"]) for r in after}) == len(after) and all(r in before for r in after)
            docs = spark.createDataFrame(after, docs.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        size = docs.selectExpr("coalesce(sum(octet_length(text)), 0)").first()[0]
        assert packed.selectExpr("coalesce(sum(length), 0)").first()[0] == size
        assert not empty or packed.count() == 0
