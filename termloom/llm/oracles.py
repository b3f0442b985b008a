"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from termloom.llm.decontamination import AGREEMENT, WINDOW
from termloom.llm.embeddings import THRESHOLD
from termloom.llm.suffix_dedup import LENGTH

_BLOCK = 1_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)
), reach AS (
  SELECT x AS node, x AS other FROM links
  UNION
  SELECT node, y FROM reach JOIN links ON x = other
), least_reached AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, s.doc_id) AS component_id
FROM split s LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON node = s.doc_id
"""

# Every window of an item laid at every distance: words that agree lie on one diagonal, and
# a best window begins at one of them or at the last place where a window still fits.
DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS words
  FROM documents WHERE doc_id IS NOT NULL
), t AS (
  SELECT row_number() OVER () AS row, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL
), ours AS (
  SELECT row AS d_row, len(words) AS d_words, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS d_pos FROM d
), theirs AS (
  SELECT row AS t_row, len(words) AS t_words, least({WINDOW}, len(words)) AS w,
    unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM t
), equal_words AS (
  SELECT d_row, t_row, w, d_pos - pos AS diagonal, pos, least(t_words, d_words - (d_pos - pos)) - w + 1 AS last_place
  FROM ours JOIN theirs USING (word)
  WHERE greatest(1, 1 - (d_pos - pos)) <= least(t_words, d_words - (d_pos - pos)) - w + 1
), enough AS (
  SELECT d_row, t_row, diagonal FROM equal_words GROUP BY ALL HAVING count(*) >= ceil(any_value(w) * {AGREEMENT})
), places AS (
  SELECT DISTINCT d_row, t_row, diagonal, w, least(pos, last_place) AS place
  FROM equal_words JOIN enough USING (d_row, t_row, diagonal)
), counted AS (
  SELECT d_row, t_row, p.w, diagonal, place, count(*) AS agreeing
  FROM places p JOIN equal_words e USING (d_row, t_row, diagonal)
  WHERE e.pos BETWEEN place AND place + p.w - 1 GROUP BY ALL
)
SELECT doc_id, item_id, CAST(max(agreeing) AS INTEGER) AS agreeing, CAST(max(w) AS INTEGER) AS words
FROM counted JOIN d ON d.row = d_row JOIN t ON t.row = t_row
WHERE agreeing >= ceil(w * {AGREEMENT}) GROUP BY doc_id, item_id
"""

# All pairs of vectors, by the cosine of their doubles.
EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), sound AS (
  SELECT * FROM v
  WHERE vec_id IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c <> 0)) > 0
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), links AS (
  SELECT a.row AS x, b.row AS y, b.vec_id AS other
  FROM sound a JOIN sound b ON a.row <> b.row AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= THRESHOLD
), reach AS (
  SELECT x AS node, y, other FROM links
  UNION
  SELECT node, links.y, links.other FROM reach JOIN links ON links.x = reach.y
), least_reached AS (
  SELECT node, min(other) AS least FROM reach GROUP BY node
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(coalesce(least, vec_id), vec_id) AS component_id,
  coalesce(vec_id = least(coalesce(least, vec_id), vec_id), false) AS kept
FROM v LEFT JOIN counts ON counts.x = row LEFT JOIN least_reached ON node = row
""".replace("THRESHOLD", str(THRESHOLD))

# Every string of LENGTH bytes, written as hexadecimal digits, with the least doc_id that has it.
# Long texts are cut into blocks first, as taking a part of a string reads all before it.
SUFFIXES = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, CAST(doc_id AS BIGINT) AS doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), blocks AS (
  SELECT row, doc_id, block * {_BLOCK} AS before, substr(digits, 2 * block * {_BLOCK} + 1, 2 * {_BLOCK + LENGTH - 1}) AS part
  FROM (SELECT *, unnest(range(0, len(digits) // {2 * _BLOCK} + 1)) AS block FROM texts)
), strings AS (
  SELECT row, doc_id, before + pos AS start, substr(part, 2 * pos + 1, {2 * LENGTH}) AS string
  FROM (SELECT *, unnest(range(0, least({_BLOCK}, len(part) // 2 - {LENGTH - 1}))) AS pos FROM blocks)
), first AS (
  SELECT string, min(doc_id) AS least FROM strings GROUP BY string
), repeated AS (
  SELECT row, start, start - lag(start) OVER (PARTITION BY row ORDER BY start) AS step
  FROM strings JOIN first USING (string) WHERE doc_id > least
), runs AS (
  SELECT row, min(start) AS a, max(start) + {LENGTH} AS b
  FROM (SELECT *, count(*) FILTER (step IS NULL OR step > {LENGTH}) OVER (PARTITION BY row ORDER BY start) AS run FROM repeated)
  GROUP BY row, run
), pieces AS (
  SELECT row, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT row, coalesce(max(b), 0), any_value(len(digits)) // 2 FROM texts LEFT JOIN runs USING (row) GROUP BY row
), kept AS (
  SELECT row, string_agg(substr(digits, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS digits
  FROM pieces JOIN texts USING (row) GROUP BY row
), removed AS (
  SELECT row, sum(b - a) AS bytes, count(*) AS spans FROM runs GROUP BY row
)
SELECT doc_id, len(t.digits) // 2 AS n_bytes, CAST(coalesce(bytes, 0) AS BIGINT) AS n_removed,
  coalesce(spans, 0) AS n_spans, sha256(unhex(kept.digits)) AS kept_sha256
FROM texts t JOIN kept USING (row) LEFT JOIN removed USING (row)
"""

ORACLES = {
    "op3_embeddings": EMBEDDINGS,
    "op6_decontamination": DECONTAMINATION,
    "op7_suffix_dedup": SUFFIXES,
    "op8_jaccard": JACCARD,
}
