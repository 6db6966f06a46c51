"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from riskspark.llm import secrets

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def folded(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


# The exponent in closed form: without a budget the rarest source is repeated (p_max / p_min) ^ (1 - a) times.
MIXING = rf"""
WITH rows AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens, md5(coalesce(text, '')) AS h FROM documents),
sources AS (SELECT source, sum(n_tokens)::BIGINT AS t FROM rows GROUP BY source),
ends AS (SELECT sum(t)::DOUBLE AS total, max(t)::DOUBLE AS most, min(t)::DOUBLE AS least FROM sources WHERE t > 0),
expo AS (SELECT *, CASE WHEN most / least <= 2 THEN 0 ELSE ceil((1 - ln(2) / ln(most / least)) * 1e6 - 1e-3) / 1e6 END AS a FROM ends),
norm AS (SELECT sum(pow(t / total, a)) AS z FROM sources, expo WHERE t > 0),
stats AS (
  SELECT source, t, CASE WHEN t > 0 THEN greatest(round(most * pow(t / most, a))::BIGINT, t) ELSE 0 END AS budget,
    greatest(round(CASE WHEN t > 0 THEN pow(t / total, a) / z ELSE 0 END * 1e6)::BIGINT, 1) AS quota
  FROM sources, expo, norm),
drawn AS (
  SELECT doc_id, r.source, n_tokens, t, budget, quota, e.epoch, md5('1|' || e.epoch || '|' || coalesce(doc_id::VARCHAR, '') || '|' || h) AS k
  FROM rows r JOIN stats s ON r.source = s.source, LATERAL (SELECT unnest(range(greatest(coalesce(ceil(budget / nullif(t, 0))::BIGINT, 1), 1))) AS epoch) e),
placed AS (
  SELECT *, (epoch * t + coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start_token FROM drawn)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, epoch::INTEGER AS epoch, start_token, (start_token // quota)::BIGINT AS block
FROM placed WHERE start_token < budget OR (epoch = 0 AND budget >= t)
"""

LINES = rf"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents WHERE text <> ''),
placed AS (
  SELECT *, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(line) - 1)::BIGINT AS a,
    array_to_string(regexp_extract_all({folded('line')}, '{WORD}'), ' ') AS plain, len(regexp_extract_all(line, '{WORD}')) AS n FROM parts),
ranked AS (
  SELECT *, n > 0 AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, a) > 1 AS gone,
    n > 0 AND min(doc_id) OVER (PARTITION BY plain) <> max(doc_id) OVER (PARTITION BY plain) AS elsewhere FROM placed),
made AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (WHERE gone) AS n_removed, coalesce(sum(length(line)) FILTER (WHERE gone), 0)::BIGINT AS removed_chars,
    coalesce(string_agg(a || ':' || (a + length(line)), ',' ORDER BY a) FILTER (WHERE gone), '') AS removed_spans,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256,
    count(*) FILTER (WHERE elsewhere) AS n_repeated, coalesce(sum(n) FILTER (WHERE elsewhere), 0)::BIGINT AS repeated_words,
    count(*) FILTER (WHERE elsewhere AND n >= 20) AS n_long_repeated
  FROM ranked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0)::BIGINT AS removed_chars,
  coalesce(removed_spans, '') AS removed_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256,
  coalesce(n_repeated, 0) AS n_repeated, coalesce(repeated_words, 0)::BIGINT AS repeated_words, coalesce(n_long_repeated, 0) AS n_long_repeated
FROM documents d LEFT JOIN made m ON d.doc_id = m.doc_id
"""

# Positions of hexadecimal digit pairs stand for bytes.
REPEATS = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 400)) AS w FROM raw, LATERAL (SELECT unnest(range(n - 199)) AS p) WHERE n >= 200),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, p FROM windows WHERE w IN (SELECT w FROM twice)),
stepped AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS opens FROM hit),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM stepped),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 200 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT s.doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS before, lead(a) OVER (PARTITION BY s.doc_id ORDER BY a) IS NULL AS final, h, n
  FROM spans s JOIN raw ON raw.doc_id = s.doc_id),
kept AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
    sha256(unhex(string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || CASE WHEN final THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a))) AS kept_sha256
  FROM gaps GROUP BY doc_id)
SELECT raw.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256(unhex(h))) AS kept_sha256
FROM raw LEFT JOIN kept ON raw.doc_id = kept.doc_id
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = rf"""
WITH items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({folded('text')}, '{ITEM_WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
known AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, list_slice(w, p, p + least(10, len(w)) - 1) AS win
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p) WHERE len(w) > 0),
docs AS (SELECT doc_id, regexp_extract_all({folded("coalesce(text, '')")}, '{ITEM_WORD}') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM known),
scanned AS (SELECT doc_id, n, p, list_slice(w, p, p + n - 1) AS win FROM docs, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p)),
hits AS (SELECT doc_id, s.n, p, item FROM scanned s JOIN known k ON s.n = k.n AND s.win = k.win),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, LATERAL (SELECT unnest(range(p, p + n)) AS q) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""


def pieces(kind: str, pattern: str, group: int, condition: str) -> str:
    p = pattern.replace("'", "''")
    return rf"""SELECT doc_id, '{kind}' AS kind, (e - length(m))::BIGINT AS a, e::BIGINT AS b FROM (
    SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS e FROM (
      SELECT doc_id, unnest(regexp_extract_all(text, '{p}', 0)) AS m, unnest(regexp_extract_all(text, '{p}', {group})) AS v,
        unnest(list_slice(string_split_regex(text, '{p}'), 1, len(regexp_extract_all(text, '{p}', 0)))) AS gap,
        generate_subscripts(regexp_extract_all(text, '{p}', 0), 1) AS k FROM documents WHERE regexp_matches(text, '{p}'))) WHERE {condition}"""


SECRETS = rf"""
WITH base AS (
  {pieces('assign', secrets.ASSIGN, 2, 'length(v) >= 8')} UNION ALL {pieces('access', secrets.ACCESS, 0, 'length(v) >= 16')} UNION ALL {pieces('hex', '[0-9a-f]+', 0, 'length(v) >= 32')}),
weak AS (
  {pieces('login', secrets.LOGIN, 0, 'true')} UNION ALL {pieces('bare', secrets.BARE, 0, "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')")}
  UNION ALL {pieces('endpoint', secrets.ENDPOINT, 0, 'true')}),
every AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
free AS (
  SELECT * FROM every x WHERE kind <> 'bare' OR NOT EXISTS (
    SELECT 1 FROM every y WHERE y.doc_id = x.doc_id AND y.kind IN ('assign', 'access', 'hex', 'login') AND y.a < x.b AND y.b > x.a)),
linked AS (
  SELECT * FROM free x WHERE (kind IN ('assign', 'access', 'hex')
    OR kind IN ('bare', 'endpoint') AND EXISTS (SELECT 1 FROM free y WHERE y.doc_id = x.doc_id AND y.kind IN ('access', 'login') AND abs(y.a - x.a) <= 200)
    OR kind = 'login')
  AND (kind NOT IN ('login', 'endpoint') OR EXISTS (SELECT 1 FROM free y WHERE y.doc_id = x.doc_id AND y.kind IN ('assign', 'hex', 'bare') AND abs(y.a - x.a) <= 200))),
named AS (SELECT *, kind || ':' || a || ':' || b AS s, list_position({list(secrets.KINDS)!r}, kind) AS k FROM linked),
made AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 1) AS n_assign, count(*) FILTER (WHERE k = 2) AS n_access, count(*) FILTER (WHERE k = 3) AS n_hex,
    coalesce(string_agg(s, ',' ORDER BY a, k) FILTER (WHERE k <= 3), '') AS base, string_agg(s, ',' ORDER BY a, k) AS spans FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN made m ON d.doc_id = m.doc_id
"""

LETTERS = r"[\p{L}\p{Nl}\p{No}]+"
ASCII_CLASSES = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D", "point": r"""\.,;:!\?''"\(\)\-"""}
COUNTED = ", ".join(f"length(regexp_replace(t, '[^{c}]', '', 'g')) AS c_{k}" for k, c in ASCII_CLASSES.items()) + r", length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS c_other"
CLASS_NAMES = [*ASCII_CLASSES, "other", "symbol"]
JS = "sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2"
QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
split AS (SELECT doc_id, t, lang, regexp_extract_all(t, '{WORD}') AS w, regexp_extract_all(lower(t), '{LETTERS}') AS lw, {COUNTED} FROM docs),
triples AS (SELECT doc_id, p, list_slice(w, p, p + 2) AS g FROM split, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS p) WHERE len(w) > 2),
often AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM triples) WHERE n > 1),
again AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM often, LATERAL (SELECT unnest([p, p + 1, p + 2]) AS q) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
base AS (
  SELECT s.*, c_lower + c_upper + c_digit + c_space + c_point + c_other AS c_all, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN again ON s.doc_id = again.doc_id LEFT JOIN dup ON s.doc_id = dup.doc_id),
full_base AS (SELECT *, length(t) - c_all AS c_symbol, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
langs AS (
  SELECT lang AS ref, sum(len(lw)) AS n_lw, {", ".join(f"sum(c_{c}) AS c_{c}" for c in CLASS_NAMES)}, sum(length(t)) AS n_chars
  FROM full_base WHERE lang <> '' GROUP BY lang HAVING sum(len(lw)) >= 2000),
lang_words AS (SELECT lang AS ref, x AS item, count(*) AS n FROM (SELECT lang, unnest(lw) AS x FROM full_base) GROUP BY ALL),
common AS (SELECT ref, item, n / n_lw AS q FROM lang_words JOIN langs USING (ref) WHERE n >= 0.005 * n_lw),
tested AS (SELECT * FROM full_base WHERE NOT base_failed),
mass AS (SELECT ref, sum(q) AS m FROM common GROUP BY ref),
ceilings AS (SELECT ref, 0.75 * (m + log2(2 / (2 - m)) + (1 - m) * log2(2 * (1 - m) / (2 - m))) / 2 AS bound FROM mass),
doc_words AS (SELECT doc_id, x AS item, count(*) AS n FROM (SELECT doc_id, unnest(lw) AS x FROM tested) GROUP BY ALL),
listed AS (
  SELECT t.doc_id, c.ref, c.q, coalesce(d.n, 0) / nullif(len(t.lw), 0) AS p
  FROM tested t CROSS JOIN common c LEFT JOIN doc_words d ON d.doc_id = t.doc_id AND d.item = c.item),
with_rest AS (SELECT doc_id, ref, p, q FROM listed UNION ALL SELECT doc_id, ref, 1 - sum(p), 1 - sum(q) FROM listed GROUP BY doc_id, ref),
js_words AS (SELECT doc_id, ref, {JS} AS js FROM with_rest GROUP BY doc_id, ref),
chars AS (
  SELECT doc_id, ref, unnest([{", ".join(f"t.c_{c} / length(t.t)" for c in CLASS_NAMES)}]) AS p, unnest([{", ".join(f"l.c_{c} / l.n_chars" for c in CLASS_NAMES)}]) AS q
  FROM tested t CROSS JOIN langs l),
js_chars AS (SELECT doc_id, ref, {JS} AS js FROM chars GROUP BY doc_id, ref),
verdict AS (
  SELECT t.doc_id, bool_or((length(t.t) < 200 OR c.js <= 0.10) AND (len(t.lw) < 50 OR coalesce(w.js, 0) <= coalesce(b.bound, 1))) AS kept
  FROM tested t JOIN js_chars c ON t.doc_id = c.doc_id LEFT JOIN js_words w ON w.doc_id = t.doc_id AND w.ref = c.ref LEFT JOIN ceilings b ON b.ref = c.ref
  WHERE t.lang = '' OR t.lang IN (SELECT ref FROM langs) GROUP BY t.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(kept, true) AS kept
FROM full_base b LEFT JOIN verdict v ON b.doc_id = v.doc_id
"""

WARC = """
WITH d AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM w
"""

CRC_STEPS = "SELECT range AS k, range AS v FROM range(256)"
for _ in range(8):
    CRC_STEPS = f"SELECT k, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) AS v FROM ({CRC_STEPS})"
CRC_TABLE = f"crc AS (SELECT list(v::BIGINT ORDER BY k) AS crc FROM ({CRC_STEPS}))"


def crc32(x: str) -> str:
    """Of an ASCII text, with ``crc`` from ``CRC_TABLE`` in scope."""
    codes = f"list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda v, b: xor(v >> 8, crc[(xor(v, b) & 255) + 1])), 4294967295::BIGINT)"


def tree_levels(name: str, start: str, levels: int) -> str:
    """CTEs {name}0.. of (s, i, h, m nodes of s, before, after), from ``start`` (s, i, h); a lone node stays as it is."""
    out = []
    for k in range(levels + 1):
        source = start if k == 0 else (
            f"SELECT s, i // 16 AS i, CASE WHEN max(m) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k - 1} GROUP BY s, i // 16")
        side = "coalesce(string_agg(h, '') OVER (PARTITION BY s, i // 16 ORDER BY i ROWS BETWEEN {}), '')"
        out.append(
            f"{name}{k} AS (SELECT *, count(*) OVER (PARTITION BY s) AS m, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS before, "
            f"{side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS after FROM ({source}))")
    return ",\n".join(out)


def folding(name: str, start: str, place: str, levels: int) -> str:
    """Carries f (folded) and p (siblings so far) of ``start`` through the levels."""
    at = start
    for k in range(levels):
        at = (
            f"SELECT x.* REPLACE (CASE WHEN m = 1 THEN f ELSE sha256(before || f || after) END AS f, p || before || after AS p) "
            f"FROM ({at}) x JOIN (SELECT s AS ts, i AS ti, m, before, after FROM {name}{k}) t ON ts = x.{place[0]} AND ti = x.{place[1]} // {16**k}")
    return at


def encoded(*columns: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in columns) + ")"


MANIFEST = f"""
WITH {CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS s, {encoded('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN {encoded('doc_id', 'source', 'lang', 'n_chars', folded('text'))} END AS claim FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
{tree_levels('t', 'SELECT s, i, leaf AS h FROM placed', 5)},
subs AS (SELECT s, h AS subroot, row_number() OVER (ORDER BY s) - 1 AS j FROM t5),
{tree_levels('u', "SELECT '' AS s, j AS i, subroot AS h FROM subs", 4)},
inner_fold AS ({folding('t', "SELECT doc_id, s, i, leaf, coalesce(claim, leaf) AS f, '' AS p FROM placed", ('s', 'i'), 5)}),
located AS (SELECT doc_id, leaf, f, p, subroot, '' AS top, j FROM inner_fold x JOIN subs ON subs.s = x.s),
whole AS ({folding('u', 'SELECT * FROM located', ('top', 'j'), 4)})
SELECT doc_id, leaf, subroot, u4.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = u4.h AS verified FROM whole, u4
"""

# Six equal words q apart, six being the least that a run repeats, found as equal sequences of six words.
RUNS = rf"""
WITH {CRC_TABLE},
docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS o, {crc32('doc_id::VARCHAR')} AS h FROM documents, crc),
ends AS (SELECT doc_id, o, len(o) AS n, h % 10 = 0 AND len(o) > 0 AS planted, CASE WHEN len(o) > 0 THEN (h // 10) % len(o) ELSE 0 END AS a, (h // 10) % 8 AS g FROM docs),
texts AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g)) END]) ELSE o END AS w FROM ends),
grams AS (SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 6), ' ') AS six FROM texts, LATERAL (SELECT unnest(range(n - 5)) AS i) WHERE n >= 12),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i),
islands AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
stats AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, period := period), (-length, start, period)) AS best,
    sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, k FROM runs, LATERAL (SELECT unnest(range(start + period, start + length)) AS k)),
places AS (SELECT doc_id, k, w[k + 1] AS word FROM texts, LATERAL (SELECT unnest(range(n)) AS k)),
kept AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY k)) AS collapsed_sha256 FROM places ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start AS start, best.length AS length, best.period AS period, 1000 * best.length // best.period AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM texts t LEFT JOIN stats s ON t.doc_id = s.doc_id LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

ORACLES: dict[str, str | None] = {
    "op1_mixing": MIXING, "op2_lines": LINES, "op4_repeats": REPEATS, "op6_decontaminate": DECONTAMINATE, "op7_secrets": SECRETS,
    "op8_quality": QUALITY, "op10_warc": WARC, "op12_manifest": MANIFEST, "op13_runs": RUNS,
}
