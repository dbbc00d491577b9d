"""Results in DuckDB's SQL of the queries that SQL can express.

Written from what the operators promise, not from how they do it: overlaps come from
all shared word triples, the figures of a text from its lines and words as rows, links
from all shared shingles, repairs from all edits, and clusters from all distances.
The bounds and phrases are the operators' own.
"""

from __future__ import annotations

from punchcard.llm.decontamination import MIN_WORDS, WINDOW
from punchcard.llm.quality_rules import BOILERPLATE, LineRules

_RULES = LineRules()
_WORD = r"'[^\x20\x09-\x0D]+'"
_BOILERPLATE = "|".join(BOILERPLATE)

_QUALITY = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
),
words AS (
  SELECT doc_id, text, regexp_extract_all(text, {_WORD}) AS w FROM texts
),
windows AS (
  SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2)
),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM windows SEMI JOIN (
      SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1
    ) repeated USING (doc_id, win)
  ) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts
),
counted AS (
  SELECT doc_id, line, lw, len(lw) AS n,
    length(line) - length(regexp_replace(line, '[#*$%&|<>!]', '', 'g')) AS marks,
    length(line) - length(regexp_replace(line, '[|»›•·]', '', 'g')) AS seps,
    length(line) - length(regexp_replace(line, '\p{{Lu}}', '', 'g')) AS upper,
    length(line) - length(regexp_replace(line, '\p{{L}}', '', 'g')) AS letters,
    len([i for i in range(1, len(lw)) if lw[i] = lw[i + 1]]) AS same
  FROM (SELECT doc_id, line, regexp_extract_all(line, {_WORD}) AS lw FROM lines)
),
judged AS (
  SELECT doc_id, line, n,
    list_sum([length(x) for x in lw]) AS chars,
    n > 0 AND (
      (marks > 2 AND marks > {_RULES.marks_per_word} * n)
      OR (seps >= {_RULES.separators} AND n <= {_RULES.words_per_separator} * seps)
      OR (n >= {_RULES.shout_words} AND upper > n AND upper > {_RULES.shout_share} * letters)
      OR (n >= {_RULES.bare_words} AND NOT regexp_matches(line, '[^\p{{L}}\p{{N}}_\s]'))
      OR (n >= {_RULES.same_words} AND same > {_RULES.same_share} * n)
      OR (n <= {_RULES.boilerplate_words} AND regexp_matches(lower(line), '{_BOILERPLATE}'))
    ) AS bad
  FROM counted
),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count_if(bad) AS n_failed_lines,
    coalesce(sum(chars) FILTER (bad), 0) AS lost_chars,
    count_if(n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines
  FROM judged GROUP BY doc_id
),
figures AS (
  SELECT doc_id, len(w) AS n_words,
    coalesce(list_sum([length(x) for x in w]), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_lines, n_failed_lines, lost_chars
  FROM words JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words
    AS base_failed,
  n_lines::BIGINT AS n_lines, n_failed_lines::BIGINT AS n_failed_lines,
  lost_chars::BIGINT AS lost_chars,
  n_words >= {_RULES.min_words} AND 100 * n_repeat_words <= {_RULES.max_repeat_percent} * n_words
    AND lost_chars <= {_RULES.max_lost} * word_chars AS kept
FROM figures
"""

_SPLIT = (
    r"[x for x in regexp_split_to_array(lower(coalesce(text, '')), '[\s!-/:-@\[-`{-~]+')"
    " if x <> '']"
)

_OVERLAPS = f"""
WITH docs AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
items AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
long_items AS (
  SELECT item_id, w, least(len(w), {WINDOW}) AS size,
    least(len(w), {WINDOW}) - CASE WHEN len(w) >= 15 THEN 3 WHEN len(w) >= 13 THEN 2 ELSE 1 END
      AS needed
  FROM items WHERE len(w) >= {MIN_WORDS}
),
doc_words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
item_words AS (
  SELECT item_id, size, needed, unnest(w) AS word, unnest(range(len(w))) AS p FROM long_items
),
doc_triples AS (
  SELECT doc_id, p, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t
  FROM doc_words WINDOW o AS (PARTITION BY doc_id ORDER BY p)
),
item_triples AS (
  SELECT item_id, p, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t
  FROM item_words WINDOW o AS (PARTITION BY item_id ORDER BY p)
),
shifts AS (
  SELECT DISTINCT doc_id, item_id, d.p - i.p AS shift
  FROM doc_triples d JOIN item_triples i USING (t)
),
laid AS (
  SELECT doc_id, item_id, size, needed, shift, i.p AS ip,
    (d.word = i.word)::INT AS same
  FROM shifts JOIN item_words i USING (item_id) JOIN doc_words d USING (doc_id)
  WHERE d.p = i.p + shift
),
summed AS (
  SELECT doc_id, item_id, size, needed, shift, ip,
    sum(same) OVER (
      PARTITION BY doc_id, item_id, shift ORDER BY ip
      RANGE BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS matched,
    count(*) OVER (
      PARTITION BY doc_id, item_id, shift ORDER BY ip
      RANGE BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS held
  FROM laid
)
SELECT doc_id, item_id, size::INT AS n_words, matched::INT AS matched,
  (ip + shift)::INT AS doc_start, ip::INT AS item_start
FROM summed WHERE held = size AND matched >= needed
QUALIFY row_number() OVER (
  PARTITION BY doc_id, item_id ORDER BY matched DESC, ip + shift, ip) = 1
"""

_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
  END AS s
  FROM words
),
shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT x, other FROM reach JOIN links ON y = doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def _clusters(k: int, rounds: int, dims: int, scale: int) -> str:
    """Every vector against every centroid, in one pair of tables for each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, c, sum((v.x - o.x) * (v.x - o.x)) AS d
  FROM parts v JOIN c{r} o USING (j) GROUP BY vec_id, c
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c, j, coalesce(fresh, c{r}.x) AS x
  FROM c{r} LEFT JOIN (
    SELECT c, j, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS fresh
    FROM parts JOIN a{r} USING (vec_id) GROUP BY c, j
  ) USING (c, j)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS e
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x for x in embedding if isfinite(x)]) = {dims}
),
parts AS MATERIALIZED (
  SELECT vec_id, unnest(e) AS x, unnest(range({dims})) AS j FROM kept
),
c0 AS MATERIALIZED (
  SELECT c, unnest(e) AS x, unnest(range({dims})) AS j
  FROM (SELECT e, row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS c FROM kept)
  WHERE c < {k}
),{",".join(steps)},
named AS (
  SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY j)) AS centroid_sha256
  FROM c{rounds} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance,
  (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN named USING (c)
"""


_BLANKS = r"\x20\x09-\x0D"

# The crc32 comes from its polynomial; places of the pattern are e(mpty), s, u and a. Of
# all edits that lead to a place after a turn the cheapest stay, of equal ones the least.
_REPAIR = rf"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
harmed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(name, '')]),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS harm
  FROM named, crc
),
turns AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed
),
placed AS (
  SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM turns
),
judged AS (
  SELECT conv_id, turn, role, text, i, initial,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS two,
    CASE
      WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][{_BLANKS}]*$') THEN 'truncated'
      ELSE '' END AS fault
  FROM placed
),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal,
    max(i) AS n
  FROM judged GROUP BY conv_id
),
steps(before, initial, after) AS (
  VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')
),
free AS (
  SELECT before, after, CASE after WHEN 'u' THEN 'user' ELSE 'assistant' END AS role
  FROM steps WHERE initial <> 's'
),
inserted AS (
  SELECT p AS before, p AS after, '' AS edits, []::VARCHAR[] AS lines
  FROM (VALUES ('e'), ('s'), ('u'), ('a')) t(p)
  UNION ALL
  SELECT before, after, 'I', [role || ':'] FROM free
  UNION ALL
  SELECT f.before, g.after, 'II', [f.role || ':', g.role || ':']
  FROM free f JOIN free g ON g.before = f.after
),
moves AS (
  SELECT before, before AS after, 'D' AS edit, 'D' AS edits, lines,
    NULL::VARCHAR AS needs, NULL::VARCHAR AS becomes, 2 AS cost
  FROM inserted WHERE edits = ''
  UNION ALL
  SELECT b.before, s.after, 'K', edits || 'K', lines, s.initial, NULL, 5 * len(lines)
  FROM inserted b JOIN steps s ON s.before = b.after
  UNION ALL
  SELECT b.before, f.after, 'R', edits || 'R', lines, NULL, f.role, 5 * len(lines) + 1
  FROM inserted b JOIN free f ON f.before = b.after
),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 'e' AS place, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, place, cost, audit, lines FROM (
    SELECT w.conv_id, j.i, m.after AS place,
      w.cost + m.cost + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
      w.audit || m.edits AS audit,
      CASE edit WHEN 'D' THEN w.lines
        ELSE list_concat(w.lines, m.lines, [coalesce(becomes, role) || ':' || text]) END AS lines
    FROM ways w
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
    JOIN moves m ON m.before = w.place
      AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate')) AND coalesce(needs = initial, true)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, place ORDER BY cost, audit) = 1
),
ended AS (
  SELECT w.conv_id, w.cost + 5 * len(b.lines) AS cost, audit || edits AS audit,
    list_concat(w.lines, b.lines) AS lines
  FROM ways w LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN inserted b ON b.before = w.place AND b.after IN ('e', 'a') AND (b.edits = '' OR w.place IN ('s', 'u'))
  WHERE w.i = coalesce(f.n, 0)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 5 * len(b.lines), audit || edits) = 1
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
  sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE: dict[str, str] = {
    "op4_benchmark_overlaps": _OVERLAPS,
    "op9_quality_rules": _QUALITY,
    "op11_conversation_repair": _REPAIR,
    "op12_jaccard_components": _JACCARD,
    "op13_nsimplex_clusters": _clusters(40, 5, 64, 256),
}
