"""Sharding, lexical search and spelling variants against brute force, with awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lexical_search, sharding, spelling
from ledgerline.llm.sharding import Shard

SCHEMA = "doc_id long, text string, shard int, n long, bucket string, word string, score string, `terms` int, size int"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, 1, "b", "w", "s", 2, 3) for i, t in rows], SCHEMA)


def awkward(rng):
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    rows += [(0, None), (None, None), (1, ""), (None, words[0] + " " + words[1]), (None, " ".join(words[:50]))]
    rows += [(7, "same text of many rows " + words[3])] * 1500 + [(i, "same text of many ids") for i in range(1000, 1200)]
    rows += [(2000, " ".join(rng.choice(words) for _ in range(20000))), (2001, "ZEBRA_zebra\x00Zebra-42 ÀÉ 日本語"), (2002, "x" * 5000), (2003, "x" * 5000)]
    return rows


# --------------------------------------------------------------------------------- sharding


def test_sharding_rows(spark):
    rows = awkward(random.Random(1))
    got = sharding.assign(docs_of(spark, rows), sharding.layout(8), sharding.layout(8, 1)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, shards = defaultdict(list), defaultdict(set)
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
        shards[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_sharding_empty_and_equal_rows_over_many_tasks(spark):
    assert sharding.assign(docs_of(spark, []), sharding.layout(8)).count() == 0
    same = spark.range(0, 50_000, 1, 8).select(F.lit(None).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    got = sharding.assign(same, sharding.layout(8)).agg(F.count("slot"), F.countDistinct("slot"), F.max("slot"), F.countDistinct("shard")).first()
    assert tuple(got) == (50_000, 50_000, 49_999, 1)


def test_one_more_shard_takes_rows_only_into_itself_and_its_share(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    for founded, opened in ((1, 0), (3, 0), (8, 0), (8, 3)):
        n = founded + opened
        moves = sharding.movement(ids, sharding.layout(founded, opened), sharding.layout(founded, opened + 1))
        moves = {(r.from_shard, r.to_shard): r.documents for r in moves.collect()}
        assert all(a == b or b == n for a, b in moves)
        assert abs(sum(v for (a, b), v in moves.items() if a != b) - 40_000 / (n + 1)) < 5 * math.sqrt(40_000 / (n + 1))


def test_a_changed_weight_moves_rows_on_its_path_only(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    before = [Shard(r, k, 4 * r + 2 * k + s, 1 + s) for r in range(3) for k in range(2) for s in range(2)]
    after = [s._replace(weight=4.0) if s.shard == 5 else s for s in before]  # region 1, rack 0
    share = sharding.movement(ids, before, before).collect()
    assert {r.from_shard for r in share} == set(range(12))
    assert all(abs(r.documents - 40_000 * (1 + r.from_shard % 2) / 18) < 300 for r in share)
    where = {s.shard: (s.region, s.rack) for s in before}
    for r in sharding.movement(ids, before, after).collect():
        a, b = where[r.from_shard], where[r.to_shard]
        if r.from_shard != r.to_shard:
            assert b[0] == 1  # into the raised region only
            assert a[0] != 1 or b == (1, 0)  # inside it, into the raised rack only
            assert a != (1, 0) or r.to_shard == 5  # inside that, into the raised shard only
    assert sharding.movement(ids, before, [s for s in before if s.shard != 5]).where("from_shard != 5 AND to_shard = 5").count() == 0


def test_sharding_refuses_a_topology_without_weight():
    with pytest.raises(ValueError):
        sharding.tree([Shard(0, 0, 0, 0.0)])
    with pytest.raises(ValueError):
        sharding.tree([Shard(0, 0, 0), Shard(1, 0, 0)])


# --------------------------------------------------------------------------------- search


def brute_search(items, rows, k):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(lexical_search.TERM, text or "")]

    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    docs = [d for d in docs if d[2]]
    total, length, df = len(docs), sum(d[2] for d in docs), Counter(t for d in docs for t in d[1])
    out = []
    for item, text in items:
        asked, scores = set(terms(text)), []
        for i, tf, n in docs:
            m = 50 + (50 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in asked if t in tf)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment, k, block", [(4096, 50, 200_000), (16, 5, 200_000), (64, 7, 200)])
def test_search_equals_brute_force(spark, monkeypatch, segment, k, block):
    rng = random.Random(segment)
    rows = awkward(rng)
    items = [(n, t) for n, (_, t) in enumerate(rows[:25])]
    items += [(100, None), (101, ""), (102, "no such words at all"), (103, "ZEBRA 日本語 zebra"), (104, rows[3][1]), (104, rows[3][1]), (None, rows[4][1])]
    monkeypatch.setattr(lexical_search, "SEGMENT_DOCS", segment)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, item string")
    got = lexical_search.search(asked, docs_of(spark, rows).repartition(5), k)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_search(items, rows, k)


def test_search_of_empty_tables(spark):
    items, docs = spark.createDataFrame([(1, "a word")], "item_id long, text string"), docs_of(spark, [(1, "a word")])
    assert lexical_search.search(items, docs).count() == 1
    assert lexical_search.search(items, docs.limit(0)).count() == 0
    assert lexical_search.search(items.limit(0), docs).count() == 0
    assert lexical_search.search(items, docs.where("false")).columns == ["item_id", "rank", "doc_id", "score"]


def test_best_positions_stop_before_the_lists_end():
    rng = np.random.default_rng(3)
    n, terms = 4000, 4
    at = np.concatenate([np.sort(rng.choice(n, 3000, replace=False)) for _ in range(terms)])
    term, tf = np.repeat(np.arange(terms), 3000), rng.zipf(1.6, 3000 * terms).clip(1, 500)
    docs = np.arange(n)
    segment = lexical_search.Segment(docs, np.zeros(n, bool), np.full(n, 300), at, term, tf.astype(np.int64), np.array([900, 1200, 3000, 100]), n, 300 * n)
    best = lexical_search.Best(10)
    met = segment.rank(np.arange(terms), best)
    score = np.zeros(n, np.int64)
    np.add.at(score, segment.at, segment.impact)
    assert met < n // 2
    assert best.score.tolist() == sorted(score.tolist(), reverse=True)[:10]
    assert segment.rank(np.arange(terms), best) <= met  # the kth score is carried on


# --------------------------------------------------------------------------------- spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(n):
    out = []
    around = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in around.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(around[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def brute_vocabulary(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                n[word] += 1
    return {w: c for w, c in n.items() if c >= 2}


def test_variants_equal_brute_force(spark, monkeypatch):
    rows = awkward(random.Random(9))
    rows += [(5000 + i, " ".join(["planets planéts Planet plannets xplanets"] * (i % 7 + 1) + ["planetss"] * 40)) for i in range(60)]
    rows += [(6000 + i, "chainword " * 60 + "chainwordx " * 2 + "chainwordxx" * (i % 8 == 0)) for i in range(60)]
    vocabulary = brute_vocabulary(rows)
    monkeypatch.setattr(spelling, "RANGE", 32)
    got = spelling.variants(docs_of(spark, rows).repartition(3))
    want = brute_variants(vocabulary)
    assert len(want) > 200 and any(w[2] != w[1] for w in want if w[1])
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want


@pytest.mark.parametrize("kind", ["dense", "one beginning", "one end", "one of both", "lengths"])
def test_near_words_of_hot_ranges(spark, monkeypatch, kind):
    rng = random.Random(kind)
    front = "prefixes" if kind in ("one beginning", "one of both") else ""
    back = "suffixes" if kind in ("one end", "one of both") else ""
    low, high = (7, 9) if not front and not back else (1, 4)
    words = {front + "".join(rng.choice("abÿ") for _ in range(rng.randint(low, high))) + back for _ in range(500)}
    if kind == "lengths":
        words |= {"a" * i for i in range(7, 60)} | {"a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1500}
    words = {w for w in words if len(w) >= 7}
    n = {w: rng.choice([2, 3, 30, 400]) for w in words}
    monkeypatch.setattr(spelling, "RANGE", 20)
    monkeypatch.setattr(spelling, "TOGETHER", 64)
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n, r.n_near, r.best, r.best_n) for r in spelling.near_words(frame).collect()}
    want = {}
    for w in words:
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x)) if others else None
        want[w] = (n[w], len(others), best, n[best] if best else None)
    assert got == want


def test_spelling_of_empty_tables(spark):
    assert spelling.variants(docs_of(spark, [])).count() == 0
    assert spelling.variants(docs_of(spark, [(1, None), (2, "once only elephant")])).count() == 0


def test_ranges_reached_hold_every_near_word():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 10))) for _ in range(3000)})
    bounds = ["", *words[50::50]]
    for w in rng.sample(words, 60):
        reached = set(spelling.reached(w, bounds))
        homes = {spelling.bisect_right(bounds, x) - 1 for x in words if near(w, x) and x.startswith(w[: (len(w) - 1) // 2])}
        assert homes <= reached and len(reached) < len(bounds)
