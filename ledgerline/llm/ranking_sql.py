"""DuckDB SQL of the sharding, search and spelling queries."""

from __future__ import annotations

from ledgerline.llm import lexical_search

#: CRC-32: the table of a byte's effect, and the checksum of the UTF-8 bytes of an expression by it.
CRC_TABLE = """
    crc AS MATERIALIZED (
        SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
                                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS tab
        FROM (SELECT unnest(range(256)) AS b)
    )"""
CRC = """xor(list_reduce(list_prepend(4294967295,
        list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"""
A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SHARDING = f"""
    WITH {CRC_TABLE}, t AS (
        SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {CRC.format("coalesce(text, '')")} AS text_crc32,
               coalesce(doc_id::VARCHAR, '') AS key
        FROM documents, crc
    ), shards AS (
        SELECT n, s, CASE WHEN s < 8 THEN s // 4 ELSE s - 6 END AS region, CASE WHEN s < 8 THEN s // 2 % 2 ELSE 0 END AS rack
        FROM (SELECT n, unnest(range(n)) AS s FROM (SELECT unnest([8, 9]) AS n))
    ), racks AS (
        SELECT n, region, rack, count(*) AS weight FROM shards GROUP BY ALL
    ), regions AS (
        SELECT n, region, sum(weight) AS weight FROM racks GROUP BY ALL
    ), keys AS (
        SELECT DISTINCT key FROM t
    ), in_region AS (
        SELECT key, n, arg_min(region, -ln((('0x' || substr(md5(key || '|region ' || region), 1, 13))::BIGINT + 0.5::DOUBLE)
                                           / 4503599627370496::DOUBLE) / weight) AS region
        FROM keys, regions GROUP BY key, n
    ), in_rack AS (
        SELECT key, n, region, arg_min(rack, -ln((('0x' || substr(md5(key || '|rack ' || region || '/' || rack), 1, 13))::BIGINT
                                                  + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / weight) AS rack
        FROM in_region JOIN racks USING (n, region) GROUP BY key, n, region
    ), in_shard AS (
        SELECT key, n, arg_min(s, -ln((('0x' || substr(md5(key || '|shard ' || s), 1, 13))::BIGINT + 0.5::DOUBLE)
                                      / 4503599627370496::DOUBLE)) AS shard
        FROM in_rack JOIN shards USING (n, region, rack) GROUP BY key, n
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
           row_number() OVER (
               PARTITION BY a.shard
               ORDER BY substr(md5(concat_ws('|', key, size, text_crc32)), 1, 3), doc_id NULLS FIRST, size, text_crc32
           ) - 1 AS slot, b.shard::INTEGER AS grown_shard
    FROM t JOIN in_shard a USING (key) JOIN in_shard b USING (key) WHERE a.n = 8 AND b.n = 9
"""

SEARCH = rf"""
    WITH t AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '{lexical_search.TERM}') AS terms
        FROM documents
    ), total AS (
        SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM t
    ), p AS (
        SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM t) GROUP BY ALL
    ), w AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM p, total GROUP BY term, n_docs
    ), i AS (
        SELECT item, item_id, unnest(list_distinct(terms)) AS term
        FROM (SELECT row_number() OVER () AS item, item_id,
                     regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '{lexical_search.TERM}') AS terms
              FROM benchmark)
    ), scored AS (
        SELECT item, item_id, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(terms) * n_docs) // n_terms))))::BIGINT AS score
        FROM i JOIN w USING (term) JOIN p USING (term) JOIN t USING (r), total GROUP BY item, item_id, r, doc_id
    )
    SELECT item_id, rank, doc_id, score FROM (
        SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
    ) WHERE rank <= {lexical_search.TOP}
"""

SPELLING = rf"""
    WITH RECURSIVE {CRC_TABLE}, runs AS (
        SELECT doc, run, count(*) AS n
        FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc,
                     unnest(regexp_extract_all(translate(coalesce(text, ''), {A_TO_Z}), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
              FROM documents)
        WHERE length(run) >= 7 GROUP BY ALL
    ), hashed AS (
        SELECT run, n, length(run) AS size, {CRC.format("doc || ':' || run")} AS h FROM runs, crc
    ), v AS (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n FROM hashed
        ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), cut AS (
        SELECT word, n, length(word) AS size, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
    ), near AS (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n
        FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
        UNION
        SELECT a.word, a.n, v.word, v.n FROM cut a JOIN v ON a.rest = v.word
        UNION
        SELECT v.word, v.n, a.word, a.n FROM cut a JOIN v ON a.rest = v.word
    ), best AS (
        SELECT word, n, count(*) AS n_near, max(other_n) AS top_n, min(CASE WHEN other_n = most THEN other END) AS top
        FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word, n
    ), formed AS (
        SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN top_n >= 10 * v.n THEN top END AS form, CASE WHEN top_n >= 10 * v.n THEN top_n END AS form_n
        FROM v LEFT JOIN best USING (word)
    ), chain AS (
        SELECT word, word AS held, 0 AS step FROM formed
        UNION ALL
        SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON chain.held = formed.word WHERE formed.form IS NOT NULL
    )
    SELECT formed.word, form, ends.root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
    FROM formed JOIN (SELECT word, arg_max(held, step) AS root FROM chain GROUP BY word) ends USING (word)
"""
