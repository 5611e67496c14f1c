"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, {WORDS}::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (3 * source_size) AS cap,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, CASE WHEN cap < level * weight THEN cap::DOUBLE
    ELSE weight * (SELECT arg_min(level, cap / weight) FROM l WHERE cap >= level * weight) END AS target
  FROM l
), q AS (
  SELECT *, ceil(sum(source_size) OVER () / 16)::BIGINT AS seats, sum(target) OVER () AS whole FROM t
), b AS (
  SELECT q.source, target / (2 * i - 1) AS quotient, i
  FROM q, unnest(range(1, 1 + CASE WHEN whole > 0 THEN ceil(2 * target * seats / whole)::BIGINT + 2 ELSE 0 END)) AS u(i)
), r AS (
  SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, i) AS place FROM b
), sq AS (
  SELECT q.source, q.source_size, q.target, greatest(1, ceil(q.source_size / 1048576))::BIGINT AS shards,
    (SELECT count(*) FROM r WHERE r.source IS NOT DISTINCT FROM q.source AND place <= q.seats) AS quota
  FROM q
), p AS (
  SELECT d.*, sq.source_size, sq.target, sq.quota, sq.shards,
    floor(('0x' || substr(draw, 1, 8))::BIGINT * shards / 4294967296)::BIGINT AS shard
  FROM d JOIN sq ON d.source IS NOT DISTINCT FROM sq.source
), h AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, max(quota) AS quota, max(source_size) AS source_size
  FROM p GROUP BY source, shard
), hb AS (
  SELECT source, shard, quota, shard_size / (2 * i - 1) AS quotient, i
  FROM h, unnest(range(1, 1 + CASE WHEN source_size > 0 THEN ceil(2.0 * shard_size * quota / source_size)::BIGINT + 2 ELSE 0 END)) AS u(i)
), hr AS (
  SELECT source, shard, quota, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard, i) AS place FROM hb
), hq AS (
  SELECT h.source, h.shard, h.shard_size, least(3 * h.shard_size, 16 * (SELECT count(*) FROM hr
    WHERE hr.source IS NOT DISTINCT FROM h.source AND hr.shard = h.shard AND place <= hr.quota)) AS taken
  FROM h
), o AS (
  SELECT p.*, hq.shard_size, hq.taken AS shard_taken,
    sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY draw, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM p JOIN hq ON p.source IS NOT DISTINCT FROM hq.source AND p.shard = hq.shard
)
SELECT doc_id, size, source_size, target,
  CASE WHEN shard_size = 0 THEN 0 ELSE (shard_taken // shard_size) * size
    + greatest(0, least(size, shard_taken % shard_size - start)) END::BIGINT AS taken
FROM o
"""

LINES = r"""
WITH l AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), f AS (
  SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT l.*, f.key IS NOT NULL AS gone FROM l LEFT JOIN f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

def similar(words: int, percent: int, more: str = "") -> str:
    """Components of documents whose shingle sets are alike, by comparing all pairs that share a shingle."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < {words} THEN array_to_string(words, ' ')
    ELSE array_to_string(words[i:i + {words - 1}], ' ') END AS shingle
  FROM w, unnest(range(1, 1 + greatest(1, len(words) - {words - 1}))) AS u(i) WHERE len(words) > 0
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM p JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
  WHERE 100 * common >= {percent} * (nx.size + ny.size - common)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
)
SELECT r.x AS doc_id, coalesce(max(n.size), 0) AS n_shingles, min(r.y) AS component_id{more}
FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x
"""

ORACLES: dict[str, str] = {
    "op4_mix_sources": MIX,
    "op7_jaccard_join": similar(4, 85),
    "op9_line_dedup": LINES,
    "op12_minhash_dedup": similar(2, 80, ", r.x = min(r.y) AS kept"),
}
