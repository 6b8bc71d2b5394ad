"""The llm queries that SQL can express, for another engine, from the definitions alone."""

from __future__ import annotations

from stockloom.llm import license_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Sets of five-word shingles, links at three quarters, components by spreading the least id.
NEAR_DUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)])
  END AS shingles
  FROM w
), n AS (SELECT doc_id, len(shingles) AS n_shingles FROM s),
x AS MATERIALIZED (SELECT doc_id, hash(unnest(shingles)) AS shingle FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 75 * (na.n_shingles + nb.n_shingles - shared)
), links AS MATERIALIZED (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), reach(node, start) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT links.b, reach.start FROM reach JOIN links ON links.a = reach.node
)
, least_id AS (SELECT node, min(start) AS component_id FROM reach GROUP BY node),
classes AS (SELECT list_sort(shingles) AS k, count(*) AS c FROM s WHERE len(shingles) > 0 GROUP BY 1)
SELECT n.doc_id, n.n_shingles, component_id, n.doc_id = component_id AS kept,
       coalesce(c, 1) AS n_class
FROM n JOIN least_id ON node = n.doc_id JOIN s ON s.doc_id = n.doc_id
LEFT JOIN classes ON k = list_sort(s.shingles)
"""


# All pairs by cosine in double precision, components by spreading the least id.
EMBED_DUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST(embedding AS VARCHAR) AS same
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(node, start) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT links.b, reach.start FROM reach JOIN links ON links.a = reach.node
), least_id AS (SELECT node, min(start) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
copies AS (SELECT vec_id, count(*) OVER (PARTITION BY same) AS n FROM v)
SELECT vec_id, coalesce(degree.n, 0) AS n_links, component_id, coalesce(copies.n, 1) AS n_same,
       vec_id = component_id AS kept
FROM embeddings JOIN least_id ON node = vec_id LEFT JOIN degree ON degree.a = vec_id
LEFT JOIN copies USING (vec_id)
"""



def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)


# Every phrase at every word; every line against every template by counting shared words.
LICENSES = rf"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d
), phrases(phrase, label) AS (VALUES {_values(license_scan.PHRASES.items())}),
p AS (SELECT string_split(phrase, ' ') AS pw, label FROM phrases),
places AS (
  SELECT doc_id, label, i - 1 AS start
  FROM (SELECT doc_id, words, pw, label, unnest(range(1, len(words) + 1)) AS i FROM w, p)
  WHERE words[i] = pw[1] AND words[i:i + len(pw) - 1] = pw
), base AS (
  SELECT doc_id, count(*) AS n, min(start) AS a, max(start) AS b FROM places GROUP BY doc_id
), templates(label, t) AS (VALUES {_values((a, b) for a, b in license_scan.TEMPLATES)}),
tw AS (
  SELECT row_number() OVER () AS k, label, list_distinct(regexp_extract_all(lower(t), '[0-9a-z]+')) AS ws
  FROM templates
), lines AS (
  SELECT doc_id, i, list_distinct(regexp_extract_all(l[i], '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS ws
  FROM (SELECT doc_id, string_split(t, chr(10)) AS l, unnest(range(1, len(l) + 1)) AS i FROM d)
), lw AS (SELECT doc_id, i, unnest(ws) AS word FROM lines),
tt AS (SELECT k, label, len(ws) AS size, unnest(ws) AS word FROM tw),
met AS (
  SELECT doc_id, label, count(*) / size AS share FROM lw JOIN tt USING (word)
  GROUP BY doc_id, i, k, label, size HAVING count(*) >= ceil(0.9 * size - 1e-9)
), best AS (SELECT doc_id, max(share) AS share FROM met GROUP BY doc_id),
base_names AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS x FROM places GROUP BY doc_id),
names AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS x
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM met) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(base_names.x, '') AS base_labels, coalesce(names.x, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
LEFT JOIN base_names USING (doc_id) LEFT JOIN names USING (doc_id)
"""


# SHA-1 of the payload in base32, 20 bits at a time; the largest page of a payload holds it.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t) AS n, sha1(t) AS hex FROM p),
d AS (
  SELECT page_id, n, array_to_string(flatten([
    ['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || hex[5 * g + 1:5 * g + 5])::BIGINT
                                              >> (15 - 5 * k)) & 31)] FOR k IN range(4)]
    FOR g IN range(8)]), '') AS digest
  FROM h
), m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS holder FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM m
"""


# Every phrase of up to three words counted; parts and cuts joined by their text.
PHRASES = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS sizes(k)
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL
), c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[:cut], ' ') AS x, array_to_string(ws[cut + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
), rated AS (
  SELECT lang, cuts.phrase AS phrase, a, cut, fx.n AS l, fy.n AS r,
         ((1000000::HUGEINT * a * a) // (fx.n::HUGEINT * fy.n))::BIGINT AS score
  FROM cuts JOIN f fx USING (lang) JOIN f fy USING (lang) WHERE fx.phrase = x AND fy.phrase = y
), lowest AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
        FROM c WHERE k = 3) GROUP BY lang, phrase
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


# The checksum byte by byte; near words share a text with one code point left out.
SPELLING = rf"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT b, 0, b::BIGINT FROM range(256) AS r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END
  FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), one AS (
  SELECT hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, run, count(*) AS n FROM runs GROUP BY doc_id, run
), bytes AS (
  SELECT run, n, list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(x) // 2),
    lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)) AS bs FROM one
), summed AS (
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(bs,
    lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8))) AS h FROM bytes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word
    FROM summed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, place, word[:place] || word[place + 2:] AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS place FROM words)
), pairs AS (
  SELECT a.word AS u, b.word AS v, b.n FROM cut a JOIN cut b USING (place, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), near AS (
  SELECT u, count(*) AS n_near, max(n) AS best_n FROM pairs GROUP BY u
), best AS (
  SELECT u, n_near, best_n, min(v) AS v FROM near JOIN pairs USING (u) WHERE n = best_n GROUP BY ALL
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN v END AS form,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best ON u = word
), chains(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON c.form = f.word
)
SELECT word, formed.form, root, n, n_near, form_n
FROM formed JOIN chains USING (word) WHERE chains.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": NEAR_DUP,
        "op2_subspace_near_dedup": EMBED_DUP,
        "op3_license_scan": LICENSES,
        "op10_warc_round_trip": WARC,
        "op12_phrase_tries": PHRASES,
        "op13_edit_transducer": SPELLING,
    }
