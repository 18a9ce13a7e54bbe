"""DuckDB SQL for the training-data queries that SQL can express (brute force, same results)."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(source: str, key: str, width: int) -> str:
    """(key, s): distinct shingles of ``width`` words; with fewer words the whole sequence."""
    return f"""SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + {width} - 1), ' ') AS s
FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {width} + 1, least(len(w), 1)) + 1)) AS i
      FROM (SELECT {key}, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM {source}))"""


OP1 = f"""
WITH RECURSIVE sh AS MATERIALIZED ({_shingles("documents", "doc_id", 3)}),
sz AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s
                    AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sz p ON p.doc_id = a JOIN sz q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS comp FROM sz
          UNION SELECT link.b, reach.comp FROM reach JOIN link ON link.a = reach.node AND reach.comp < link.b)
SELECT d.doc_id, coalesce(sz.n, 0) AS n_shingles, coalesce(r.comp, d.doc_id) AS component_id,
       coalesce(r.comp, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sz USING (doc_id)
LEFT JOIN (SELECT node, min(comp) AS comp FROM reach GROUP BY node) r ON r.node = d.doc_id"""

OP3 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 34, 0) + 1)) AS i FROM d)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS p FROM win JOIN rep USING (h)),
cut AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS k FROM
         (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d)
         ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(cut.n, 0) AS n_removed, sha256(coalesce(kept.k, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP5 = f"""
WITH ds AS ({_shingles("documents", "doc_id", 5)}),
its AS MATERIALIZED ({_shingles("benchmark", "item_id", 5)}),
sz AS (SELECT item_id, count(*) AS n FROM its GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS held FROM ds JOIN its USING (s) GROUP BY ALL)
SELECT doc_id, item_id, held, n AS item_shingles FROM hit JOIN sz USING (item_id) WHERE 100 * held >= 80 * n"""


def _mixing(entropy: float, source: str = "documents") -> str:
    key = "('0x' || substr(md5('0|{0}|' || id), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE doc AS MATERIALIZED (
  SELECT * FROM (SELECT doc_id AS id, source, len(regexp_extract_all(text, '{_WORD}')) AS tokens FROM {source})
  WHERE tokens > 0),
src AS MATERIALIZED (SELECT source, sum(tokens)::BIGINT AS tokens, count(*) AS docs FROM doc GROUP BY source),
tot AS (SELECT sum(tokens)::DOUBLE AS t FROM src),
arr AS (SELECT list(tokens / t ORDER BY tokens) AS s FROM src, tot),
steps AS (
  SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT k + 1, best, coalesce(list_min(list_filter(pts, lambda x: x > best)), hi) FROM (
    SELECT k, hi, pts, coalesce(list_max(list_filter(pts, lambda a:
      ln(list_sum(list_transform(s, lambda x: pow(x, a))))
      - list_sum(list_transform(s, lambda x: pow(x, a) * ln(pow(x, a)))) / list_sum(list_transform(s, lambda x: pow(x, a)))
      >= {entropy} * ln(len(s)))), lo) AS best
    FROM (SELECT k, lo, hi, s, list_transform(range(1, 16), lambda i: lo + (hi - lo) * i / 16) AS pts
          FROM steps, arr WHERE k < 6))),
alpha AS (SELECT round(lo, 6) AS a FROM steps WHERE k = 6),
z AS (SELECT sum(pow(tokens / t, a)) AS z FROM src, tot, alpha),
plan AS MATERIALIZED (
  SELECT source, weight, blocks, quota // tokens AS whole, quota % tokens AS rest FROM (
    SELECT source, tokens, weight, ceil(docs / 256)::BIGINT AS blocks, floor(weight * t)::BIGINT AS quota FROM (
      SELECT *, round(pow(tokens / t, a) / z, 9) AS weight FROM src, tot, alpha, z))),
dealt AS MATERIALIZED (
  SELECT doc.*, weight, whole, rest, {key.format("block")} % blocks AS block, {key.format("place")} AS place
  FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source),
sums AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY block, place, id, tokens ROWS UNBOUNDED PRECEDING) AS run
         FROM dealt),
copies AS (SELECT *, whole + (run <= rest)::INT AS n FROM sums)
SELECT id AS doc_id, source, tokens, unnest(range(0, n)) AS epoch, block, place, weight FROM copies WHERE n > 0"""


OP6 = _mixing(0.95)

OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""

# base32 of the 40 hex digits of SHA-1: five bits at a time
OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 4), lambda k:
        array_to_string(list_transform(range(0, 8), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substr(hex, k * 10 + 1, 10))::BIGINT >> (35 - 5 * j)) & 31)::INT + 1, 1)), '')), '') AS payload_digest
      FROM d),
f AS (SELECT hex, min(page_id) AS first FROM d GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM b JOIN f USING (hex)"""

OP11 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
mark AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
word AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM doc),
cell AS MATERIALIZED (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM (
    SELECT part, good, toxic, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
      + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
    FROM word LEFT JOIN mark USING (doc_id)) GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT '' AS o, 0 AS used UNION ALL
           SELECT o || letter, used | bit FROM orders JOIN letter ON used & bit = 0),
step AS (SELECT o, s::INT AS step, bit, (SELECT coalesce(sum(b.bit), 0) FROM letter b WHERE instr(o, b.letter) < s)::INT AS before
         FROM (SELECT o, unnest(range(1, 6)) AS s FROM orders WHERE used = 31) JOIN letter ON letter = substr(o, s, 1)),
result AS (
  SELECT part, o AS filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM cell, step GROUP BY ALL)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM result"""

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": OP1,
    "op3_substring_dedup": OP3,
    "op4_exact_top_k": OP4,
    "op5_benchmark_decontamination": OP5,
    "op6_mixing_sources": OP6,
    "op10_warc": OP10,
    "op11_filter_audit": OP11,
}
