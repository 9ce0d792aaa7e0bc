"""DuckDB statements with the rows of the queries that SQL can express."""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
  WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM wins),
hits AS (
  SELECT doc_id, i, n, item_id
  FROM (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
    WHERE len(w) >= n
  ) JOIN wins USING (n, win)
),
marked AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(s>|/s>|TURN\]|/TURN\]|INST\]|/INST\])', '\1\\\2\3', 'g') AS body FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(length('[TURN]') + length(role) + 1 + length(body) + length('[/TURN]'))
         + length('<s>') + length('</s>'))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_PLAIN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13
),
firsts AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, p FROM win JOIN firsts USING (s), unnest(range(i, i + 13)) AS t(p) WHERE first < doc_id
),
kept AS (
  SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) AS a
  ANTI JOIN gone ON gone.doc_id = a.doc_id AND gone.p = a.p
  GROUP BY a.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _encoded(*columns: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns]
    return "sha256(" + " || ".join(parts) + ")"


# The first CTEs make the table of CRC-32 and apply it to the decimal digits of an id.
OP11 = f"""
WITH RECURSIVE bits AS (
  SELECT i AS entry, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT entry, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc_table AS (SELECT list(c ORDER BY entry) AS t FROM bits WHERE step = 8),
shown AS (
  SELECT d.*,
         coalesce(xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0, false) AS tampered
  FROM documents d, crc_table
),
leaves AS (
  SELECT doc_id, source, {_encoded("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN tampered THEN {_encoded("doc_id", "source", "lang", "n_chars", "low")}
              ELSE {_encoded("doc_id", "source", "lang", "n_chars", "text")} END AS copy
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM shown)
),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves
),
nodes AS (
  SELECT 0 AS level, grp, pos, leaf AS hash, count(*) OVER (PARTITION BY grp) AS width FROM placed
  UNION ALL
  SELECT level + 1, grp, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (max(width) + 15) // 16
  FROM nodes WHERE width > 1 GROUP BY level, grp, pos // 16
),
tops AS (
  SELECT 0 AS level, grp AS pos, hash, count(*) OVER () AS width FROM nodes WHERE width = 1
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (max(width) + 15) // 16
  FROM tops WHERE width > 1 GROUP BY level, pos // 16
),
lower_steps AS (
  SELECT a.level, a.grp, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.grp = b.grp AND a.pos // 16 = b.pos // 16
  WHERE a.width > 1 GROUP BY a.level, a.grp, a.pos
),
upper_steps AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM tops a JOIN tops b ON a.level = b.level AND a.pos // 16 = b.pos // 16
  WHERE a.width > 1 GROUP BY a.level, a.pos
),
climb AS (
  SELECT grp, pos AS leaf_pos, 0 AS level, pos, false AS above, copy AS node, '' AS proof FROM placed
  UNION ALL
  SELECT c.grp, c.leaf_pos,
         CASE WHEN s.l IS NULL AND u.l IS NULL THEN 0 ELSE c.level + 1 END,
         CASE WHEN c.above THEN c.pos // 16 WHEN s.l IS NULL THEN c.grp ELSE c.pos // 16 END,
         c.above OR s.l IS NULL,
         CASE WHEN s.l IS NOT NULL THEN sha256(s.l || c.node || s.r)
              WHEN u.l IS NOT NULL THEN sha256(u.l || c.node || u.r) ELSE c.node END,
         c.proof || coalesce(s.l || s.r, u.l || u.r, '')
  FROM climb c
  LEFT JOIN lower_steps s ON NOT c.above AND s.grp = c.grp AND s.level = c.level AND s.pos = c.pos
  LEFT JOIN upper_steps u ON c.above AND u.level = c.level AND u.pos = c.pos
  WHERE NOT c.above OR u.l IS NOT NULL
),
ends AS (
  SELECT c.* FROM climb c WHERE c.above AND NOT EXISTS (SELECT 1 FROM upper_steps u WHERE u.level = c.level AND u.pos = c.pos)
)
SELECT p.doc_id, p.leaf, n.hash AS subroot, t.hash AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = t.hash AS verified
FROM placed p
JOIN ends e ON e.grp = p.grp AND e.leaf_pos = p.pos
JOIN (SELECT grp, hash FROM nodes WHERE width = 1) n ON n.grp = p.grp
CROSS JOIN (SELECT hash FROM tops WHERE width = 1) t
"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
asked AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM q) GROUP BY q, term),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY r, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, totals GROUP BY term, n_docs
),
impact AS (
  SELECT d.r, d.doc_id, term, weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(d.w) * n_docs) // n_terms))) AS i
  FROM tf JOIN d USING (r) JOIN weight USING (term), totals
),
scores AS (SELECT q, r, doc_id, sum(times * i)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY q, r, doc_id)
SELECT item_id, rank, doc_id, score
FROM (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0
) JOIN q USING (q) WHERE rank <= 10
"""
