"""Secret scans, native: DataFrame and SQL functions only.

Base rules find assignments, access keys and long hex strings by pattern.  The
method adds strings of high entropy: over each candidate string a window slides
character by character; counts per character are kept incrementally (one enters,
one leaves), and with them the sum of c * log2(c), from which the window's
Shannon entropy follows at once.  Each character class has its own threshold; an
allow list suppresses known harmless shapes.

Offsets come from cutting the text at the matches and adding up lengths; they
are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let, running

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so asking for the least length here finds the same strings as filtering later.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: An assignment's value has so many characters at least; shorter matches are dropped, after they have been consumed.
ASSIGN_LEAST = 8
WINDOW = 20
#: Every run that a whole window fits in.
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Bits a window needs, by class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.4, "base64": 3.5}
#: Harmless shapes: words without digits (single-case runs, CamelCase, dashed words; capitals strewn among letters are not words), plain numbers, one repeated unit, dates, dashed ids.
ALLOW = (r"^(?!.*(?:[A-Z][a-z][A-Z]|[a-z][A-Z]{2}|[A-Z]{2}[a-z]))[^0-9]*$", r"^[0-9+/_=-]*$", r"^(.{1,8})\1+.?$", r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: A span array without spans.
NONE = "cast(array() as array<struct<start:bigint,end:bigint,s:string,keep:boolean>>)"


def _spans(pattern: str, least_value: int | None = None) -> Column:
    """array<struct<start, end, s, keep>> of a pattern's matches in _t: a match ends where all that is cut and matched up to it adds up to."""
    p = _lit(pattern)
    keep = f"length(r.v[i]) >= {least_value}" if least_value else "true"
    value = f"regexp_extract_all(_t, {p}, 2)" if least_value else "array()"
    found = f"named_struct('cut', transform(split(_t, {p}, -1), x -> length(x)), 'hit', regexp_extract_all(_t, {p}, 0), 'v', {value})"
    ends = let("transform(r.hit, (h, i) -> cast(r.cut[i] + length(h) as bigint))", "n", running("n", "{x} + {y}"))
    spans = f"filter(transform(r.hit, (h, i) -> named_struct('start', e[i] - length(h), 'end', e[i], 's', h, 'keep', {keep})), x -> x.keep)"
    return F.expr(f"case when _t rlike {p} then {let(found, 'r', let(ends, 'e', spans))} else {NONE} end")


def _entropy_spans() -> Column:
    """The stretch of each candidate that its windows of high entropy cover.

    A step costs the same wherever it is: characters are numbered once, and the
    counts of a window lie eight to a 64-bit word, of which one enters and one leaves.
    """
    xlogx = ", ".join(f"cast({c} * log2({c}) as double)" if c else "0D" for c in range(WINDOW + 1))
    allow = " or ".join(f"c.s rlike {_lit(a)}" for a in ALLOW)
    limit = f"case when c.s rlike '^[0-9a-fA-F]+$' then {THRESHOLDS['hex']}D when c.s rlike '^[A-Za-z0-9]+$' then {THRESHOLDS['alnum']}D else {THRESHOLDS['base64']}D end"
    one = lambda j: f"shiftleft(1L, shiftleft({j} & 7, 3))"
    count = lambda j: f"cast(shiftright(a.k[shiftright({j}, 3)], shiftleft({j} & 7, 3)) & 255 as int)"
    gone = f"(case when i >= {WINDOW} then z.d[i - {WINDOW}] else -1 end)"
    moved = f"""named_struct(
        'k', transform(a.k, (x, w) -> x + case when w = shiftright(m.j, 3) then {one('m.j')} else 0L end - case when m.g >= 0 and w = shiftright(m.g, 3) then {one('m.g')} else 0L end),
        'sum', a.sum + z.f[{count('m.j')} + 1] - z.f[{count('m.j')}] + case when m.g >= 0 then z.f[{count('m.g')} - 1] - z.f[{count('m.g')}] else 0D end)"""
    step = let(f"named_struct('j', z.d[i], 'g', {gone})", "m", f"case when m.j = m.g then named_struct('k', a.k, 'sum', a.sum) else {moved} end")
    # The window that ends at i is judged right after its step.
    high = f"i >= {WINDOW - 1} and log2({WINDOW}) - b.sum / {WINDOW} >= z.limit"
    judged = let(step, "b", f"named_struct('k', b.k, 'sum', b.sum, 'lo', coalesce(a.lo, case when {high} then cast(i - {WINDOW - 1} as bigint) end), 'hi', case when {high} then cast(i + 1 as bigint) else a.hi end)")
    start = f"named_struct('k', array_repeat(0L, {-(-len(ALPHABET) // 8)}), 'sum', 0D, 'lo', cast(null as bigint), 'hi', cast(null as bigint))"
    end = "a -> named_struct('start', c.start + a.lo, 'end', c.start + a.hi, 's', '', 'keep', a.lo is not null)"
    chars = f"transform(split(c.s, '', length(c.s)), x -> cast(instr('{ALPHABET}', x) - 1 as int))"
    scan = let(f"named_struct('d', {chars}, 'f', array({xlogx}), 'limit', {limit})", "z", f"aggregate(sequence(0, size(z.d) - 1), {start}, (a, i) -> {judged}, {end})")
    return F.expr(f"filter(transform(filter(_c, c -> not ({allow})), c -> {scan}), x -> x.keep)")


def _outside() -> Column:
    """Entropy spans that lie in no base span: by start, base spans first, none before reaches as far."""
    every = "sort_array(concat(transform(concat(assign, access, hex), x -> named_struct('start', x.start, 'own', 0, 'end', x.end)), transform(_e, x -> named_struct('start', x.start, 'own', 1, 'end', x.end))))"
    reach = running("t", "greatest({x}, {y})")
    left = f"filter(transform(v, (x, i) -> named_struct('start', x.start, 'end', x.end, 's', '', 'keep', x.own = 1 and r[i] < x.end)), x -> x.keep)"
    # A span of its own reaches nowhere, so it hides no other.
    body = let(every, "v", let(let("transform(v, x -> case when x.own = 0 then x.end else -1L end)", "t", reach), "r", left))
    return F.expr(f"case when size(_e) = 0 then {NONE} else {body} end")


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, and arrays assign, access, hex, entropy of struct<start, end, s, keep>.

    Offsets are code points, end exclusive.  A null text is an empty one, and an
    empty text has no spans; a null doc_id stays null.  Long texts are scanned
    whole: time grows with the text, whatever the length of its candidates or the
    number of its matches.  An entropy span inside a base span is not reported
    again.  Repeated rows come back once each; other columns are not read.  An
    empty table gives no rows.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    d = d.select("doc_id", _spans(ASSIGN, ASSIGN_LEAST).alias("assign"), _spans(ACCESS).alias("access"), _spans(HEX).alias("hex"), _spans(CANDIDATE).alias("_c"))
    d = d.select("doc_id", "assign", "access", "hex", _entropy_spans().alias("_e"))
    return d.select("doc_id", "assign", "access", "hex", _outside().alias("entropy"))


def _listed(*kinds: str) -> Column:
    every = ", ".join(f"transform({k}, x -> named_struct('start', x.start, 'ord', {i}, 'end', x.end, 'kind', '{k}'))" for i, k in enumerate(kinds))
    return F.expr(f"array_join(transform(sort_array(concat({every})), x -> concat(x.kind, ':', cast(x.start as string), ':', cast(x.end as string))), ',')")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets(documents(spark, sf_dir))
    return s.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_listed("assign", "access", "hex"), 256).alias("base_sha256"),
        _listed("assign", "access", "hex", "entropy").alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _oracle_kind(kind: str, order: int, pattern: str, keep: str = "true") -> str:
    """CTE of a kind's matches with their places: the running sum of what is cut and matched."""
    p = pattern.replace("'", "''")
    return f"""{kind}_m AS (SELECT rid, unnest(hit) AS s, unnest(value) AS v, unnest(cut[:len(hit)]) AS cut, generate_subscripts(hit, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, '{p}', 0) AS hit, {f"regexp_extract_all(t, '{p}', 2)" if kind == "assign" else f"regexp_extract_all(t, '{p}', 0)"} AS value, list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS cut FROM d WHERE regexp_matches(t, '{p}'))),
{kind}_s AS (SELECT rid, '{kind}' AS kind, {order} AS ord, s, stop - length(s) AS start, stop FROM (SELECT *, CAST(sum(cut + length(s)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS stop FROM {kind}_m) WHERE {keep})"""


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN_SQL = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_oracle_kind("assign", 0, _ASSIGN_SQL, f"length(v) >= {ASSIGN_LEAST}")},
{_oracle_kind("access", 1, ACCESS)},
{_oracle_kind("hex", 2, HEX)},
{_oracle_kind("candidate", 3, CANDIDATE)},
base AS (SELECT * FROM assign_s UNION ALL SELECT * FROM access_s UNION ALL SELECT * FROM hex_s),
open_ AS (
  SELECT *, CASE WHEN regexp_matches(s, '^[0-9a-fA-F]+$') THEN {THRESHOLDS["hex"]} WHEN regexp_matches(s, '^[A-Za-z0-9]+$') THEN {THRESHOLDS["alnum"]} ELSE {THRESHOLDS["base64"]} END::DOUBLE AS least_bits
  FROM candidate_s
  WHERE NOT (regexp_matches(s, '^[^0-9]*$') AND NOT regexp_matches(s, '[A-Z][a-z][A-Z]|[a-z][A-Z][A-Z]|[A-Z][A-Z][a-z]'))
    AND NOT regexp_matches(s, '{ALLOW[1]}') AND NOT regexp_matches(s, '{ALLOW[3]}')
    AND len(list_filter(range(1, 9), lambda u: (length(s) % u = 0 AND length(s) >= 2 * u AND repeat(substr(s, 1, u), CAST(length(s) // u AS BIGINT)) = s)
      OR ((length(s) - 1) % u = 0 AND length(s) - 1 >= 2 * u AND repeat(substr(s, 1, u), CAST((length(s) - 1) // u AS BIGINT)) = substr(s, 1, length(s) - 1)))) = 0),
windows AS (SELECT rid, start, least_bits, i, unnest(string_split(substr(s, i + 1, {WINDOW}), '')) AS ch FROM (SELECT rid, start, least_bits, s, CAST(unnest(range(0, length(s) - {WINDOW} + 1)) AS BIGINT) AS i FROM open_)),
bits AS (SELECT rid, start, least_bits, i, log2({WINDOW}) - sum(n * log2(n)) / {WINDOW} AS bits FROM (SELECT rid, start, least_bits, i, ch, count(*) AS n FROM windows GROUP BY ALL) GROUP BY rid, start, least_bits, i),
high AS (SELECT rid, start + min(i) AS start, start + max(i) + {WINDOW} AS stop FROM bits WHERE bits >= least_bits GROUP BY rid, bits.start),
entropy AS (SELECT rid, 'entropy' AS kind, 3 AS ord, '' AS s, start, stop FROM high h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = h.rid AND b.start <= h.start AND h.stop <= b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM entropy),
said AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM every GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN said USING (rid)
"""
