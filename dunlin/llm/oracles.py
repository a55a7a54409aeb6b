"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from dunlin.llm.licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Windows of 5 words give the base rule; windows of 10 words span the repeats of
#: 10 words or more, and a window of 51 found twice is a repeat of over 50 words.
OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
sizes(k) AS (VALUES (5), (10), (51)),
win AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d, sizes WHERE len(w) >= k),
spelled AS (SELECT doc_id, k, p, hash(w[p:p + k - 1]) AS h FROM win),
twice AS (SELECT doc_id, k, p FROM spelled QUALIFY count(*) OVER (PARTITION BY doc_id, k, h) > 1),
spans AS (
  SELECT doc_id, k, p, p + k AS e, coalesce(max(p + k) OVER (PARTITION BY doc_id, k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM twice),
cover AS (
  SELECT doc_id, sum(greatest(0, e - greatest(p, upto))) FILTER (k = 5) AS n5,
         sum(greatest(0, e - greatest(p, upto))) FILTER (k = 10) AS n10, count(*) FILTER (k = 51) AS n51
  FROM spans GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(n5, 0)::BIGINT AS n_repeat_words,
         coalesce(n10, 0)::BIGINT AS covered_words, coalesce(n51, 0) AS n51
  FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN dup USING (doc_id))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND covered_words <= 0.15 * n_words AND n51 = 0 AS kept
FROM base
"""

_PLAIN = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP2 = rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p, w FROM b WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT m FROM bs),
dw AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS p, w FROM d, sizes WHERE len(w) >= m),
ds AS (SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS s FROM dw),
hit AS (SELECT doc_id, p, m, item_id FROM ds JOIN bs USING (m, s)),
place AS (SELECT DISTINCT doc_id, unnest(range(p, p + m)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

#: Prefix filter on the alphabetical order of words; every candidate is verified on its lists.
OP6 = r"""
WITH l AS (SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
w AS (SELECT doc_id, pos, line, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS raw FROM l),
s AS (SELECT doc_id, pos, line, list_sort(list_distinct(raw)) AS s FROM w WHERE len(raw) > 0),
f AS (SELECT line, any_value(s) AS s, min(struct_pack(d := doc_id, p := pos)) AS first FROM s GROUP BY line),
df AS (SELECT t, count(*) AS c FROM (SELECT unnest(s) AS t FROM f) GROUP BY t),
ft AS (SELECT first, unnest(s) AS t, len(s) AS n FROM f),
ord AS (SELECT first, t, n, row_number() OVER (PARTITION BY first ORDER BY c, t) AS r FROM ft JOIN df USING (t)),
pre AS (SELECT first, t, n FROM ord WHERE r <= n - ceil(n * 4 / 5.0) + 1),
cand AS (SELECT DISTINCT a.first AS x, b.first AS y FROM pre a JOIN pre b ON a.t = b.t AND b.first < a.first AND least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4),
sim AS (
  SELECT DISTINCT x FROM cand JOIN f fx ON fx.first = x JOIN f fy ON fy.first = y
  WHERE len(list_intersect(fx.s, fy.s)) * 5 >= (len(fx.s) + len(fy.s) - len(list_intersect(fx.s, fy.s))) * 4),
gone AS (
  SELECT s.doc_id, s.pos FROM s JOIN f USING (line) LEFT JOIN sim ON sim.x = f.first
  WHERE sim.x IS NOT NULL OR struct_pack(d := s.doc_id, p := s.pos) <> f.first),
g AS (SELECT doc_id, count(*) AS n, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN g USING (doc_id)
"""

#: Length: marks of both ends per turn, and a backslash for every backslash and control string.
OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (
  SELECT *, length(text) + length(regexp_replace(text, '(\\|<<SYS>>|\[/SYS\]|\[INST\]|\[/INST\]|\[OUT\]|</s>|<s>|\[ROLE\]|\[/ROLE\]|\[END\])', '\1 ', 'g')) - length(text) AS n,
         CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 18 + length(role) END AS marks,
         coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') AS prev,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS next
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + marks)::BIGINT AS formatted_chars,
       bool_and((prev, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) AND (next IS NOT NULL OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    """The canonical form of a licence text, word by word: spellings of one word are mapped in a list, then those of two."""
    words = f"regexp_replace(lower(regexp_replace({column}, {_quoted(COPYRIGHT_LINE)}, '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    single = [(a, b) for a, b in SPELLINGS if " " not in a]
    table = f"MAP {{{', '.join(f'{_quoted(a)}: {_quoted(b)}' for a, b in single)}}}"
    out = f"array_to_string(list_transform(string_split(trim({words}), ' '), lambda w: coalesce(({table})[w], w)), ' ')"
    out = f"(' ' || replace({out}, ' ', '  ') || ' ')"
    for a, b in SPELLINGS:
        if " " in a:
            out = f"replace({out}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    return f"replace(trim({out}), '  ', ' ')"


OP7 = f"""
WITH k AS (SELECT sha256({_canonical('t')}) AS digest, min(i) AS found FROM (VALUES {', '.join(f'({_quoted(i)}, {_quoted(t)})' for i, t in KNOWN)}) v(i, t) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, {_canonical('l')} AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)),
n AS (SELECT doc_id, string_agg(DISTINCT found, ',' ORDER BY found) AS notices, count(*) AS n_notices FROM l JOIN k ON sha256(c) = digest WHERE c <> '' GROUP BY doc_id),
w AS (SELECT doc_id, {_canonical('text')} AS c FROM d)
SELECT doc_id, sha256(c) AS text_digest, CASE WHEN c <> '' THEN found END AS license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0)::BIGINT AS n_notices
FROM w LEFT JOIN k ON sha256(c) = digest LEFT JOIN n USING (doc_id)
"""

#: Base32 of the digest by the bits of its hexadecimal digits.
OP8 = r"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || h[i])::INT), 4, '0')), 'string_agg', '') AS bits, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INT * (16 >> j)))::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

OP9 = r"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS bytes, lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), 60, '0') AS bits FROM documents),
b AS (SELECT doc_id, bytes, k AS depth, substr(bits, 1, k) AS shard FROM d, range(61) r(k)),
s AS (SELECT *, sum(bytes) OVER (PARTITION BY depth, shard) AS shard_bytes, count(*) OVER (PARTITION BY depth, shard) AS shard_docs FROM b)
SELECT doc_id, bytes, shard, depth::INT AS depth, shard_bytes::BIGINT AS shard_bytes, shard_docs::BIGINT AS shard_docs
FROM s WHERE shard_bytes <= 1048576 OR shard_docs = 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""

#: CRC-32 byte by byte, with a table that the polynomial gives; ``x`` is the text in hexadecimal digits.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t)"""
CRC = """xor(4294967295, list_reduce(
    list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295))"""

OP11 = f"""
WITH {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS c, hex(encode(doc_id || ':' || run)) AS x
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, c, {CRC} AS h FROM runs, crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT p.word, q.word AS other, q.n AS m FROM cut p JOIN cut q ON p.i = q.i AND p.a = q.a AND p.b = q.b AND p.word <> q.word
  UNION SELECT p.word, q.word, q.n FROM cut p JOIN words q ON p.a || p.b = q.word
  UNION SELECT q.word, p.word, p.n FROM cut p JOIN words q ON p.a || p.b = q.word),
near AS (SELECT word, count(*) AS n_near, min((-m, other)) AS best FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(s.n_near, 0) AS n_near, CASE WHEN -s.best[1] >= 5 * w.n THEN s.best[2] END AS form, CASE WHEN -s.best[1] >= 5 * w.n THEN -s.best[1] END AS form_n
  FROM words w LEFT JOIN near s ON w.word = s.word),
chain AS (
  WITH RECURSIVE step AS (
    SELECT word, word AS reached, 0 AS d FROM forms
    UNION ALL SELECT s.word, f.form, d + 1 FROM step s JOIN forms f ON f.word = s.reached WHERE f.form IS NOT NULL)
  SELECT word, arg_max(reached, d) AS root FROM step GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word)
"""

#: Every pair of equal words up to a third of the text apart; stretches of neighbouring pairs of one distance are runs.
OP12 = rf"""
WITH {CRC_TABLE},
given AS (
  SELECT doc_id, w, len(w) AS n, {CRC} AS h
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, hex(encode(doc_id::VARCHAR)) AS x FROM documents), crc),
planted AS (SELECT *, h // 10 AS g, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM given),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM planted),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
same AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND (b.i - a.i) * 3 <= a.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS t FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i WHERE g.i IS NULL GROUP BY w.doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs s WHERE s.doc_id = r.doc_id AND (s.length * r.period > r.length * s.period
      OR (s.length * r.period = r.length * s.period AND (s.start < r.start OR (s.start = r.start AND s.period < r.period))))))
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.l, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256, d.n AS n_words
FROM docs d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: All windows of 35 words of all documents, counted as they are.
OP13 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN twice USING (k)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(r.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN removed r ON r.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

SQL: dict[str, str] = {
    "op1_quality_repetition": OP1,
    "op2_decontamination": OP2,
    "op4_chat_format": OP4,
    "op6_line_dedup": OP6,
    "op7_license_scan": OP7,
    "op8_warc": OP8,
    "op9_sharding": OP9,
    "op11_spelling_variants": OP11,
    "op12_periodic_runs": OP12,
    "op13_substring_dedup": OP13,
}
