"""SQL for DuckDB that returns what the queries return, where SQL can express the operator."""

_WORD = r"[^\x20\x09-\x0D]+"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _escaped(c: str) -> str:
    return rf"replace(replace(replace({c}, '\', '\b'), '<', '\l'), '>', '\g')"


def chat_sql(budget: int = 256, history: int = 64) -> str:
    """SQL of the chat windows."""
    return rf"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t1 AS (SELECT *, len(regexp_extract_all(text, '{_WORD}')) + 3 AS tok,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS ord FROM t0),
t2 AS (SELECT *, ord = 1 AND role = 'system' AS lead,
  max(CASE WHEN ord = 1 AND role = 'system' THEN tok ELSE 0 END) OVER (PARTITION BY conv_id) AS sys_tok FROM t1),
t3 AS (SELECT *, CASE WHEN lead THEN 0 ELSE tok END AS body, greatest(1, {budget} - sys_tok - least({history}, greatest(0, {budget} - sys_tok) // 2)) AS span FROM t2),
t4 AS (SELECT *, sum(body) OVER (PARTITION BY conv_id ORDER BY ord) AS stop FROM t3),
t5 AS (SELECT *, stop - body AS before,
  length({_escaped('role')}) + length({_escaped('text')}) + 15 AS chars FROM t4),
t6 AS (SELECT *, CASE WHEN before // span = greatest(stop - 1, before) // span THEN 2 * (before // span) ELSE 2 * (before // span) + 1 END AS cut FROM t5),
wins AS (SELECT conv_id, cut, min(before) AS start, greatest(0, least({history}, {budget} - max(sys_tok) - sum(body))) AS reach, min(cut) OVER (PARTITION BY conv_id) AS first_cut FROM t6 GROUP BY conv_id, cut),
again AS (SELECT w.conv_id, sum(t.chars) AS chars FROM wins w JOIN t6 t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND w.cut > w.first_cut
  AND t.cut < w.cut AND (t.lead OR t.before >= w.start - w.reach) GROUP BY 1)
SELECT t.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(t.chars) + coalesce(max(a.chars), 0))::BIGINT AS formatted_chars
FROM t6 t LEFT JOIN again a ON a.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY t.conv_id
"""

OP2 = rf"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents),
s1 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_id FROM sized GROUP BY source),
s2 AS (SELECT *, (source_id - 1) % 3 + 1 AS weight, (sum(source_size) OVER ())::BIGINT AS total, 3 * source_size AS cap FROM s1),
s3 AS (SELECT *, cap::DOUBLE / weight AS ratio FROM s2),
s4 AS (SELECT *, coalesce(sum(cap) OVER w, 0)::BIGINT AS cap_before,
  (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS weight_left FROM s3
  WINDOW w AS (ORDER BY ratio, source_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, ratio <= (total - cap_before)::DOUBLE / weight_left AS capped FROM s4),
s6 AS (SELECT *, CASE WHEN capped THEN cap::DOUBLE ELSE (total - coalesce(sum(cap) FILTER (capped) OVER (), 0)::BIGINT)::DOUBLE
  / nullif(sum(weight) FILTER (NOT capped) OVER (), 0)::BIGINT * weight END AS target FROM s5),
s7 AS (SELECT *, greatest(1, (source_size + slot_words - 1) // slot_words) AS b0 FROM
  (SELECT *, least(1048576, greatest(1, total // 65536)) AS slot_words FROM s6)),
s8 AS (SELECT *, greatest(1, (source_size + block_words - 1) // block_words) AS blocks FROM
  (SELECT *, greatest(1, (source_size + b0 - 1) // b0) AS block_words FROM s7)),
s9 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE ceil(target * blocks / source_size)::BIGINT END AS slots FROM s8),
plan AS (SELECT *, (sum(slots) OVER (ORDER BY source_id) - slots)::BIGINT AS first_slot, (sum(slots) OVER ())::BIGINT AS n FROM s9),
points AS (SELECT r.i AS slot, ((r.i * 2654435769) % 4294967296 * m.n) >> 32 AS place FROM (SELECT max(n) AS n FROM plan) m, LATERAL (SELECT unnest(range(m.n)) AS i) r),
ranked AS (SELECT p.source_id, p.blocks, row_number() OVER (PARTITION BY p.source_id ORDER BY slot) - 1 AS rank
  FROM points ASOF JOIN (SELECT * FROM plan WHERE slots > 0) p ON points.place >= p.first_slot),
reads AS (SELECT source_id, rank % blocks AS block, count(*) AS reads FROM ranked WHERE rank < 3 * blocks GROUP BY 1, 2),
d1 AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.source_id, p.block_words, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM sized d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source),
d2 AS (SELECT *, row_number() OVER w AS nth, (sum(size) OVER w - size)::BIGINT AS start FROM d1
  WINDOW w AS (PARTITION BY source_id ORDER BY ('0x' || substr(h, 1, 8))::BIGINT % 256, h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d3 AS (SELECT *, unnest(range(start // block_words, greatest(start, start + size - 1) // block_words + 1)) AS block FROM d2)
SELECT doc_id, size, source_size, target,
  coalesce(sum(greatest(0, least(start + size, (d3.block + 1) * block_words) - greatest(start, d3.block * block_words)) * coalesce(r.reads, 0)), 0)::BIGINT AS taken
FROM d3 LEFT JOIN reads r ON r.source_id = d3.source_id AND r.block = d3.block GROUP BY d3.source_id, nth, doc_id, size, source_size, target
"""

OP5 = rf"""
WITH dw AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all({_LOW.format('text')}, '{_ALNUM}'), []) AS w FROM documents),
iw AS (SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all({_LOW.format('text')}, '{_ALNUM}') AS w FROM benchmark),
grams AS (SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM iw, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM grams),
hits AS (SELECT row, i, dg.m, grams.item FROM (SELECT row, i, m, array_to_string(w[i : i + m - 1], ' ') AS g FROM dw, sizes, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)) dg JOIN grams ON grams.g = dg.g AND grams.m = dg.m),
words AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS p FROM hits) GROUP BY row),
items AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""

_RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}


def host_sql(host: str = "source") -> str:
    """SQL of the host rules; ``host`` is an expression over documents."""
    every = lambda text, sep=", ": sep.join(text.replace("$", r) for r in _RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {host} AS host, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
tri AS (SELECT row, i, array_to_string(w[i : i + 2], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
rep AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, g) AS c FROM tri) WHERE c > 1),
rw AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY row),
ln AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY row),
s AS (SELECT d.row, doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rw USING (row) LEFT JOIN ln USING (row)),
b AS (SELECT *, {", ".join(f"{when} AS {r}" for r, when in _RULES.items())} FROM s),
h AS (SELECT host, count(*)::DOUBLE AS n, {every("(count(*) FILTER ($))::DOUBLE AS f_$")} FROM b GROUP BY host),
m AS (SELECT sum(n) AS n, count(*) AS k, sum(n * n) AS nn, {every("sum(f_$) AS f_$, sum(f_$ * f_$ / n) AS q_$")} FROM h),
v AS (SELECT *, {every("(f_$ / n) * (1 - f_$ / n) AS noise_$")} FROM m),
bt AS (SELECT *, {every("CASE WHEN n - nn / n > 0 THEN (q_$ - n * (f_$ / n) * (f_$ / n) - (k - 1) * noise_$) / (n - nn / n) ELSE 0 END AS between_$")} FROM v),
wt AS (SELECT *, {every("CASE WHEN between_$ > 0 THEN greatest(noise_$ / between_$ - 1, 0.01) ELSE n / k END AS weight_$")} FROM bt),
ab AS (SELECT *, {every("greatest(f_$ / n * weight_$, 1e-9) AS a_$, greatest((1 - f_$ / n) * weight_$, 1e-9) AS b_$")} FROM wt),
mx AS (SELECT *, {every("greatest(0.3, a_$ / (a_$ + b_$) + 3 * sqrt(a_$ * b_$ / ((a_$ + b_$) * (a_$ + b_$) * (a_$ + b_$ + 1)))) AS most_$")} FROM ab),
p AS (SELECT *, least(0.5, most_short) AS limit_short, least(0.5, most_repeats) AS limit_repeats, most_symbols AS limit_symbols, most_lines AS limit_lines, most_word_length AS limit_word_length FROM mx),
r AS (SELECT h.host, {every("(h.f_$ + a_$) / (h.n + a_$ + b_$) > limit_$", " OR ")} AS bad FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed, NOT (short OR repeats) AND NOT bad AS kept
FROM b JOIN r ON r.host IS NOT DISTINCT FROM b.host
"""


OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i) WHERE len(w) > 0),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sz u ON u.doc_id = p.a JOIN sz v ON v.doc_id = p.b WHERE 100 * c >= 75 * (u.n + v.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(sz.n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN sz USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""

# crc32 has no SQL function: the table of the polynomial 0xEDB88320, bytes folded one by one.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, list_transform(range(8), lambda k: 0::BIGINT)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)"

BASE3 = rf"""
WITH crc AS ({_CRC_TABLE}), ids AS (SELECT DISTINCT doc_id FROM documents),
fold AS (SELECT doc_id, CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC.format("doc_id::VARCHAR")} % 10 END AS f FROM ids, crc),
d AS MATERIALIZED (SELECT row_number() OVER () AS row, x.doc_id, f, list_append(regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORD}'), chr(10)) AS w FROM documents x JOIN fold ON fold.doc_id IS NOT DISTINCT FROM x.doc_id),
tok AS (SELECT row, f, unnest(w) AS t FROM d),
c AS (SELECT t, count(*)::DOUBLE AS c FROM tok WHERE f <> 0 GROUP BY t),
n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c),
s AS (SELECT row, count(*) AS n_tokens, count(c.c) AS n_known, sum(log10((coalesce(c.c, 0) + 0.1) / (n.n + 0.1 * (n.v + 1)))) AS base FROM tok LEFT JOIN c USING (t), n GROUP BY row)
SELECT doc_id, f = 0 AS held_out, n_tokens, n_known, n.n::BIGINT AS train_tokens, round(base, 5) AS base_score FROM d JOIN s USING (row), n
"""

BASE4 = r"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS row, page_id, translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, h, q) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
best AS (SELECT row, arg_max({'r': concat(h, q), 'v': verdict}, length(h || q)) AS b FROM p x JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY row)
SELECT page_id, host, path, b.r AS rule, b.v AS verdict FROM p x LEFT JOIN best USING (row)
"""

_PHRASES = "(VALUES (['gnu','general','public','license'], 'gpl'), (['apache','license'], 'apache'), (['cc','by'], 'cc-by'), (['mit','license'], 'mit')) v(ph, label)"
BASE7 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
hit AS (SELECT row, i - 1 AS pos, label FROM (SELECT row, w, ph, label, unnest(list_filter(range(1, len(w) - len(ph) + 2), lambda i: w[i] = ph[1] AND w[i : i + len(ph) - 1] = ph)) AS i FROM d, {_PHRASES})),
h AS (SELECT row, count(*) AS n, min(pos) AS a, max(pos) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM hit GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(l, '') AS base_labels, true AS kept FROM d LEFT JOIN h USING (row)
"""

BASE10 = """
WITH t AS (SELECT count(*) AS n, sum(coalesce(strlen(text), 0) + 16)::BIGINT AS size FROM documents),
s AS (SELECT i::INTEGER AS shard, (((i + 1) * n + 39) // 40 - (i * n + 39) // 40)::BIGINT AS k, size FROM t, range(40) r(i))
SELECT shard, k AS n, 0::BIGINT AS first, k - 1 AS last, k AS slots, size AS total_size FROM s WHERE k > 0
"""

OP12 = rf"""
WITH crc AS ({_CRC_TABLE}), ids AS (SELECT DISTINCT doc_id FROM documents),
fold AS (SELECT doc_id, CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC.format("doc_id::VARCHAR")} END AS h FROM ids, crc),
d0 AS (SELECT row_number() OVER () AS row, x.doc_id, h, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents x JOIN fold ON fold.doc_id IS NOT DISTINCT FROM x.doc_id),
d1 AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN h // 10 % len(w) END AS a FROM d0),
d2 AS (SELECT *, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM d1),
d AS MATERIALIZED (SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM d2),
words AS MATERIALIZED (SELECT row, n, unnest(range(n)) AS i, unnest(w) AS x FROM d),
pairs AS (SELECT a.row, b.i - a.i AS p, a.i FROM words a JOIN words b ON a.row = b.row AND a.x = b.x AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
stretches AS (SELECT row, p, min(i) AS start, count(*) + p AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS g FROM pairs) GROUP BY row, p, g HAVING count(*) + p >= greatest(24, 3 * p)),
runs AS MATERIALIZED (SELECT row, start, length, min(p) AS period FROM stretches GROUP BY row, start, length),
told AS (SELECT row, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY row),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY length::DOUBLE / period DESC, start, period) AS rn FROM runs) WHERE rn = 1),
gone AS (SELECT DISTINCT w.row, w.i FROM words w JOIN runs r ON r.row = w.row AND w.i >= r.start + r.period AND w.i < r.start + r.length),
kept AS (SELECT row, string_agg(x, ' ' ORDER BY i) AS text FROM words w ANTI JOIN gone g ON g.row = w.row AND g.i = w.i GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told t ON t.row = d.row LEFT JOIN best b ON b.row = d.row LEFT JOIN kept k ON k.row = d.row
"""

OP13 = rf"""
WITH crc AS ({_CRC_TABLE}),
docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all({_LOW.format('text')}, '{_ALNUM}'), []) AS w FROM documents),
aims AS (SELECT coalesce(regexp_extract_all({_LOW.format('text')}, '{_ALNUM}'), []) AS w FROM benchmark),
pieces AS MATERIALIZED (SELECT row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM docs),
aimed AS MATERIALIZED (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM aims),
grams AS MATERIALIZED (SELECT g, hex(g) AS x FROM (SELECT g FROM pieces UNION SELECT g FROM aimed)),
hashed AS MATERIALIZED (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket FROM grams, crc),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM pieces JOIN hashed USING (g) GROUP BY 1),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM aimed JOIN hashed USING (g) GROUP BY 1),
gains AS (SELECT r.i AS bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM range(10000) r(i) LEFT JOIN s ON s.bucket = r.i LEFT JOIN t ON t.bucket = r.i),
weights AS (SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM pieces JOIN hashed USING (g) JOIN gains USING (bucket) GROUP BY row),
scored AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score FROM docs LEFT JOIN weights USING (row)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) FILTER (words >= 20) OVER () AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND rank <= 25 * fit // 100 THEN rank END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op1_chat_windows": chat_sql(),
    "op2_source_mix": OP2,
    "op5_decontamination": OP5,
    "op6_host_rules": host_sql(),
    "host_rules_of_sections": host_sql("concat(source, ' ', least(9, length(text) // 200))"),
    "op8_jaccard_join": OP8,
    "op12_periodic_runs": OP12,
    "op13_importance_resampling": OP13,
    "base_lm_score": BASE3,
    "base_url_rules": BASE4,
    "base_license_scan": BASE7,
    "base_sharding": BASE10,
}
