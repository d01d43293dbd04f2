"""What SQL can say of the operators' queries, for DuckDB."""

from __future__ import annotations

from . import chat, codes, lines, mixing

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _unit(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"


MIXING = f"""
WITH d AS (SELECT doc_id, source, size, digest, floor({_unit("concat_ws(':', doc_id::VARCHAR, digest)")} * {mixing.BLOCKS})::INTEGER AS block
  FROM (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(text, '')) AS digest FROM documents)),
e AS (SELECT *, CASE WHEN block % 2 = 0 THEN size ELSE {mixing.FALLING} - size END AS slot FROM d),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM e GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM t),
w AS (SELECT *, 1 + place % 3 AS weight, 3 * source_size AS cap FROM r),
x AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
  coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y AS (SELECT *, (total - cap_before)::DOUBLE / (all_weight - weight_before)::DOUBLE AS level FROM x),
z AS (SELECT (SELECT level FROM y WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1) AS water),
g AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(water * weight, cap::DOUBLE)) AS target FROM y, z),
p AS (SELECT *, sum(CASE WHEN size > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY slot, block, doc_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING) AS nth FROM e),
q AS (SELECT p.doc_id, p.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate, p.nth,
  {_unit("'42:' || coalesce('s' || p.source, 'null')")} AS o FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN (least(floor(o + nth * rate) - floor(o + (nth - 1) * rate), 3)::BIGINT * size)::BIGINT ELSE 0 END AS taken FROM q
"""


def _escaped(c: str, entities=chat.ENTITIES) -> str:
    for plain, entity in entities:
        c = f"replace({c}, {'chr(10)' if plain == chr(10) else repr(plain)}, '{entity}')"
    return c


CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{chat.HOSTILE}'), (-1, 1, 'assistant', '{chat.HOSTILE}')),
a AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum({len(chat.OPEN) + len(chat.MIDDLE) + len(chat.CLOSE)} + length({_escaped("role", chat.ROLE_ENTITIES)}) + length({_escaped("text")}))::BIGINT AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM a
"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS l FROM documents),
s AS (SELECT doc_id, i, array_to_string(list_slice(l, i, i + 49), ' ') AS win FROM (SELECT doc_id, l, unnest(range(1, len(l) - 48)) AS i FROM w)),
m AS (SELECT win, min(doc_id) AS lo FROM s GROUP BY win),
c AS (SELECT DISTINCT s.doc_id, s.i + k AS p FROM s JOIN m ON s.win = m.win AND m.lo < s.doc_id, range(50) t(k)),
v AS (SELECT doc_id, unnest(l) AS word, unnest(range(1, len(l) + 1)) AS p FROM w),
k AS (SELECT v.doc_id, count(c.p) AS n_removed, coalesce(string_agg(v.word, ' ' ORDER BY v.p) FILTER (c.p IS NULL), '') AS kept FROM v LEFT JOIN c ON c.doc_id = v.doc_id AND c.p = v.p GROUP BY v.doc_id)
SELECT w.doc_id, len(w.l)::BIGINT AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

LINES = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i, l[i] AS line, translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
h AS (SELECT key, max(doc_id) AS keeper FROM x WHERE length(key) >= {lines.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.LEAST_DOCS}),
m AS (SELECT x.doc_id, x.i, x.line, coalesce(h.keeper <> x.doc_id, false) AS gone FROM x LEFT JOIN h ON x.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""


def _codes() -> str:
    """A round of assignment and a round of means after the other; a distance and its entry are ordered as one number."""
    n, parts, entries = codes.SCALE, codes.PARTS, codes.ENTRIES
    steps = [f"""
WITH r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT id, i, (i * {parts}) // len(v) AS part, floor({n} * v[i + 1]::DOUBLE)::BIGINT AS c FROM (SELECT id, v, unnest(range(len(v))) AS i FROM r)),
c0 AS MATERIALIZED (SELECT id AS entry, i, part, c FROM x WHERE id < {entries})"""]
    near = "(SELECT x.id, x.part, min(d) AS d FROM (SELECT x.id, x.part, sum((x.c - b.c) * (x.c - b.c))::BIGINT * {e} + b.entry AS d FROM x JOIN c{k} b ON b.i = x.i GROUP BY x.id, x.part, b.entry) x GROUP BY x.id, x.part)"
    for k in range(codes.ROUNDS):
        steps.append(f"a{k} AS MATERIALIZED {near.format(k=k, e=entries)}")
        mean = "(s - ((s % n) + n) % n) // n"
        steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT b.entry, b.i, b.part, coalesce({mean}, b.c) AS c FROM c{k} b LEFT JOIN
  (SELECT a.d % {entries} AS entry, x.i, sum(x.c)::BIGINT AS s, count(*) AS n FROM x JOIN a{k} a ON a.id = x.id AND a.part = x.part GROUP BY ALL) m ON m.entry = b.entry AND m.i = b.i)""")
    last = codes.ROUNDS
    steps.append(f"f AS (SELECT id, string_agg(printf('%02x', d % {entries}), '' ORDER BY part) AS code, sum(d // {entries})::BIGINT AS error FROM {near.format(k=last, e=entries)} GROUP BY id)")
    steps.append(f"g AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM c{last})")
    return ",\n".join(steps) + """
SELECT r.vec_id, f.code, f.error, sum(f.error) OVER (PARTITION BY r.label)::BIGINT AS label_error, g.codebooks_sha256 FROM r JOIN f ON f.id = r.id, g
"""


ORACLES = {"op3_mixing": MIXING, "op7_chat": CHAT, "op10_substring": SUBSTRING, "op11_lines": LINES, "op13_codes": _codes()}
