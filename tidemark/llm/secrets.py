"""Secret scans with DataFrame expressions only.

Base spans come from three patterns.  The method adds spans: every long run of
encoding characters gets an inferred encoding (hex, base32, base64) and a battery of
randomness tests over its symbols (chi-squared uniformity, runs above and below the
middle of the alphabet, lag-one serial correlation).  Two families of hypotheses are tested
with Benjamini and Hochberg's rule within each class of lengths over the whole corpus, since
short text passes for random far more often: by the battery that a run is random
symbols, and by its equal symbols and changes of class that it is ordinary text.  A run is added
when the second is rejected and the first is not.

Work grows in proportion to a text and its matches: running sums over arrays go by
chunks, overlaps are looked up by bisection, and a run's symbols are counted in its string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base spans, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of 32 and more; shorter runs of these characters can be no part of one
KINDS = ["assign", "access", "hex", "random"]

#: A run of characters of any encoding that is long enough to test.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Ordinary text: chances that two and three of its characters are equal, that two neighbours differ
#: in class (small letter, capital, digit, sign), and that a character is a digit or one of a to f.
TEXT_SAME2, TEXT_SAME3, TEXT_CHANGE, TEXT_HEX = 0.065, 0.0055, 0.15, 0.35
MAX_BIN = 200  # p-values are counted in tenths of powers of ten, down to 1e-20


Span = "struct<start:int,kind:int,end:int,value:string>"


def normal_tail(z: str) -> str:
    """SQL for the chance that a standard normal exceeds z (a polynomial times the density)."""
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    poly = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    tail = f"(exp(-0.5D * ({z}) * ({z})) * 0.3989422804014327D * {poly})"
    return f"(CASE WHEN ({z}) >= 0 THEN {tail} ELSE 1 - {tail} END)"


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def before_each(values: str, op: str, start: str, body: str, out: str = "before") -> str:
    """SQL for ``body`` with ``out`` for the array of what ``op`` (over a and x) gives of all earlier elements.

    Chunks of 64 elements are folded, chunks of chunks likewise; an element then needs the folds of
    the chunks before its own and at most 63 neighbours.
    """

    def fold(part: str) -> str:
        return f"aggregate({part}, {start}, (a, x) -> {op})"

    def join(left: str, right: str) -> str:
        return f"aggregate(array({left}, {right}), {start}, (a, x) -> {op})"

    chunks = lambda of: f"transform(sequence(0, (size({of}) - 1) div 64), c -> {fold(f'slice({of}, c * 64 + 1, 64)')})"
    within = lambda of: fold(f"slice({of}, (i div 64) * 64 + 1, i % 64)")
    each = let(out, f"transform(v0, (x0, i) -> {join('b1[i div 64]', within('v0'))})", body)
    each = let("b1", f"transform(v1, (x1, i) -> {join('b2[i div 64]', within('v1'))})", each)
    each = let("b2", f"transform(v2, (x2, i) -> {fold('slice(v2, 1, i)')})", each)
    return let("v0", values, let("v1", chunks("v0"), let("v2", chunks("v1"), each)))


def _found(df: DataFrame, name: str, text: str, pattern: str, kind: int, fits: str = "true", group: int = 0) -> DataFrame:
    """Adds the array ``name`` of the spans of all matches that fit.

    Matches come leftmost and without overlap; where each begins follows from the lengths of
    the matches and of the pieces between them.  ``fits`` is a condition on x.value, the text of
    the group.
    """
    regex = "r'" + pattern.replace("'", "\\x27") + "'"
    find = lambda g: f"regexp_extract_all({text}, {regex}, {g})"
    span = f"""named_struct('start', before[i] + length(pieces[i]), 'kind', {kind}, 'end', before[i] + length(pieces[i]) + length(m), 'value', own[i])"""
    spans = f"filter(transform(found, (m, i) -> {span}), x -> {fits})"
    steps = "transform(found, (m, i) -> length(pieces[i]) + length(m))"
    spans = before_each(steps, "a + x", "0", spans)
    spans = let("pieces", f"split({text}, {regex}, -1)", let("own", find(group) if group else "found", spans))
    none = f"CAST(array() AS array<{Span}>)"
    return df.withColumn(name, F.expr(let("found", find(0), f"CASE WHEN size(found) = 0 THEN {none} ELSE {spans} END")))


def _meets(spans: str, t: str) -> str:
    """SQL: does t overlap one of ``spans``, which are sorted and don't overlap each other? By bisection."""
    step = """CASE WHEN b.lo >= b.hi THEN b WHEN s[(b.lo + b.hi) div 2].start < {t}.end
        THEN named_struct('lo', (b.lo + b.hi) div 2 + 1, 'hi', b.hi) ELSE named_struct('lo', b.lo, 'hi', (b.lo + b.hi) div 2) END""".format(t=t)
    count = f"aggregate(sequence(0, cast(log2(size(s) + 1) AS int)), named_struct('lo', 0L, 'hi', cast(size(s) AS long)), (b, z) -> {step}, b -> b.lo)"
    return let("s", spans, let("k", count, f"k > 0 AND s[greatest(k - 1, 0)].end > {t}.start"))


#: The battery, in steps; each names the values it adds to a run t (start, kind, end, value).
_BOTH = "(2 * t.high * (t.n - t.high))"
_PAIRS, _TRIPLES = "(double(t.n) * (t.n - 1) / 2)", "(double(t.n) * (t.n - 1) * (t.n - 2))"
_SPREAD = f"sqrt({_PAIRS} * {TEXT_SAME2 - TEXT_SAME2**2} + {_TRIPLES} * {TEXT_SAME3 - TEXT_SAME2**2})"
_LETTERS = {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0": "0123456789", "+": "+/"}
_CLASSES = f"translate(t.body, '{''.join(_LETTERS.values())}', '{''.join(k * len(v) for k, v in _LETTERS.items())}')"
#: Symbols in pieces of 4,096 with one more for the last pair; bytes, as the place of a byte is known at once.
_PIECE = "cast(substring(cast(t.body AS binary), p + 1, 4097) AS string)"
_PRODUCTS = let(
    "q",
    f"transform(filter(split({_PIECE}, ''), c -> c != ''), c -> locate(c, t.alphabet) - 1 - t.mean)",
    "aggregate(sequence(0, greatest(size(q) - 2, 0)), 0D, (a, i) -> a + coalesce(q[i] * try_element_at(q, i + 2), 0D))",
)


def _times(text: str, pair: str) -> str:
    """SQL: how often two different characters follow each other."""
    return f"(length({text}) - length(replace({text}, '{pair}', ''))) / 2"


BATTERY: list[dict[str, str]] = [
    {"body": "translate(rtrim('=', t.value), '-_', '+/')"},
    {
        "n": "length(t.body)",
        "encoding": """CASE WHEN NOT t.body RLIKE '[A-Za-z]' THEN CAST(NULL AS string)
            WHEN t.body RLIKE '[0-9]' AND t.body RLIKE '^[0-9a-f]+$' THEN 'hex'
            WHEN t.body RLIKE '[0-9]' AND t.body RLIKE '^[0-9A-F]+$' THEN 'HEX'
            WHEN t.body RLIKE '[0-9]' AND t.body RLIKE '^[A-Z2-7]+$' THEN 'base32'
            ELSE 'base64' END""",
        "classes": _CLASSES,
    },
    {
        "alphabet": "CASE t.encoding " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALPHABETS.items()) + f" ELSE '{ALPHABETS['base64']}' END",
        "changes": "double(" + " + ".join(_times("t.classes", x + y) for x in _LETTERS for y in _LETTERS if x != y) + ")",
    },
    {
        "k": "double(length(t.alphabet))",
        "counts": "transform(filter(split(t.alphabet, ''), c -> c != ''), c -> length(t.body) - length(replace(t.body, c, '')))",
        "halves": "translate(t.body, t.alphabet, concat(repeat('L', length(t.alphabet) div 2), repeat('H', length(t.alphabet) div 2)))",
    },
    {
        "squares": "aggregate(t.counts, 0D, (a, c) -> a + double(c) * c)",
        "high": "double(length(t.halves) - length(replace(t.halves, 'H', '')))",
        "mean": "aggregate(transform(t.counts, (c, i) -> double(c) * i), 0D, (a, x) -> a + x) / t.n",
        "turns": f"1D + {_times('t.halves', 'LH')} + {_times('t.halves', 'HL')}",
    },
    {
        "variation": "aggregate(transform(t.counts, (c, i) -> c * (i - t.mean) * (i - t.mean)), 0D, (a, x) -> a + x)",
        "serial": f"aggregate(sequence(0, greatest(t.n - 2, 0), 4096), 0D, (a, p) -> a + {_PRODUCTS})",
    },
    {
        "z_chi": "(t.squares * t.k / t.n - t.n - (t.k - 1)) / sqrt(2D * (t.k - 1) * (t.n - 1) / t.n)",
        "z_runs": f"abs(try_divide(t.turns - 1 - {_BOTH} / t.n, sqrt({_BOTH} * ({_BOTH} - t.n) / (double(t.n) * t.n * (t.n - 1)))))",
        "z_serial": "abs((try_divide(t.serial, t.variation) + 1D / t.n) * sqrt(t.n))",
        "z_same": f"({_PAIRS} * {TEXT_SAME2} - (t.squares - t.n) / 2) / {_SPREAD}",
        "z_change": f"(t.changes - (t.n - 1) * {TEXT_CHANGE}) / sqrt((t.n - 1) * {TEXT_CHANGE * (1 - TEXT_CHANGE)})",
    },
    {
        "p_chi": normal_tail("t.z_chi"),
        "p_runs": f"CASE WHEN {_BOTH} > t.n THEN 2 * {normal_tail('t.z_runs')} ELSE 0D END",
        "p_serial": f"CASE WHEN t.variation > 0 THEN 2 * {normal_tail('t.z_serial')} ELSE 0D END",
        "p_text": f"""CASE WHEN t.encoding IS NULL THEN 1D ELSE least(1D, 3 * least({normal_tail('t.z_same')},
            {normal_tail('t.z_change')}, CASE WHEN t.encoding IN ('hex', 'HEX') THEN pow({TEXT_HEX}D, t.n) ELSE 1D END)) END""",
    },
    {"p_battery": "least(1D, 3 * least(t.p_chi, t.p_runs, t.p_serial))"},
]
TESTED = ["start", "kind", "end", "value", "n", "encoding", "p_chi", "p_runs", "p_serial", "p_battery", "p_text"]


def battery(df: DataFrame, name: str) -> DataFrame:
    """Adds the tests to the runs of the array ``name``.

    p_chi, p_runs and p_serial are p-values under uniform random symbols of the inferred encoding,
    p_battery is that of all three (three times the least), p_text is one under ordinary text: from
    equal symbols (the chi-squared statistic again), changes between classes of characters, and for hex
    the alphabet.  Runs of digits alone have no encoding and p_text 1.  ``class`` is the class of lengths.
    """
    bins = [f"cast(least({MAX_BIN}, floor(-10 * log10(greatest(t.{p}, 1e-300D)))) AS int)" for p in ("p_text", "p_battery")]
    fields, steps, body = TESTED[:4], [], ""
    for step in [*BATTERY, {"class": "cast(floor(2 * log2(t.n)) AS int)", "bin": bins[0], "battery_bin": bins[1]}]:
        old = ", ".join(f"'{f}', t.{f}" for f in fields)
        steps.append(f"named_struct({old}, " + ", ".join(f"'{k}', {v}" for k, v in step.items()) + ")")
        fields = [*fields, *step]
    body = "named_struct(" + ", ".join(f"'{f}', t.{f}" for f in [*TESTED, "class", "bin", "battery_bin"]) + ")"
    for step in reversed(steps):
        body = let("t", step, body)
    return df.withColumn(name, F.expr(f"transform({name}, t -> {body})"))


def _scratch(df: DataFrame) -> str:
    """A prefix that no column of the frame has."""
    prefix = "scan"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def benjamini_hochberg(counts: dict[int, int], rate: float) -> int:
    """The least bin whose hypotheses are rejected, of p-values counted in bins of tenths of powers of ten; none: beyond all bins."""
    total, above, out = sum(counts.values()), 0, MAX_BIN + 1
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if 10 ** (-b / 10) * total <= rate * above:
            out = b
    return out


def discovery_cutoffs(docs: DataFrame, text_col: str = "text", rate: float = 0.01) -> dict[int, tuple[int, int]]:
    """For each class of lengths the least bins of p_text and of p_battery that are discoveries at this rate.

    Benjamini and Hochberg's rule within a class, over the counts of runs per class and bin of
    all documents (at most 201 bins of either kind in each of some sixty classes reach the driver).
    """
    p = _scratch(docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(f"{p}text")
    runs = battery(_found(docs.select(text), f"{p}runs", f"{p}text", RUN, 3), f"{p}runs")
    each = runs.select(F.explode(f"{p}runs").alias("t")).select("t.class", F.explode(F.expr("array(struct(0 AS test, t.bin AS bin), struct(1 AS test, t.battery_bin AS bin))")).alias("b"))
    counts: dict[int, tuple[dict[int, int], dict[int, int]]] = {}
    for r in each.groupBy("class", "b").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["class"], ({}, {}))[r["b"]["test"]][r["b"]["bin"]] = r["n"]
    return {length: (benjamini_hochberg(text, rate), benjamini_hochberg(tests, rate)) for length, (text, tests) in counts.items()}


def scan(docs: DataFrame, text_col: str = "text", rate: float = 0.01, spans_col: str = "spans") -> DataFrame:
    """The rows with an array of secret spans: struct(start, kind, end, value), by start and then kind.

    Offsets count code points, the end is exclusive; ``kind`` is an index into ``KINDS``; the value
    is the matched text (of an assignment what is assigned).  Base spans follow the patterns.  A
    run of encoding characters is added when it meets no base span, is a discovery against ordinary
    text and is none against random symbols, both at the false-discovery rate ``rate``.

    A null text is the empty text and has no span.  Every row is scanned by itself, so repeated
    rows give equal spans.  A long text, or one of very many matches, takes time in proportion to its
    length and their number.  An empty table gives an empty result.  Other columns are kept; an input
    column named as ``spans_col`` is replaced.
    """
    cutoffs = discovery_cutoffs(docs, text_col, rate)
    base = docs.drop(spans_col) if spans_col != text_col else docs
    names = base.columns
    p = _scratch(base)
    text = f"{p}text"
    df = base.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = _found(df, f"{p}0", text, ASSIGN, 0, "length(x.value) >= 8", group=2)
    df = _found(df, f"{p}1", text, ACCESS, 1, "length(x.value) >= 16")
    df = _found(df, f"{p}2", text, HEX, 2)
    df = battery(_found(df, f"{p}3", text, RUN, 3), f"{p}3")

    def bound(test: int) -> str:
        if not cutoffs:
            return f"{MAX_BIN + 1}"
        return "CASE t.class " + " ".join(f"WHEN {k} THEN {b[test]}" for k, b in sorted(cutoffs.items())) + f" ELSE {MAX_BIN + 1} END"

    free = " AND ".join(f"NOT {_meets(f'base.k{k}', 't')}" for k in range(3))
    chosen = f"""transform(filter(base.runs, t -> t.bin >= {bound(0)} AND t.battery_bin < {bound(1)} AND {free}),
        t -> named_struct('start', t.start, 'kind', t.kind, 'end', t.end, 'value', t.value))"""
    every = f"named_struct('k0', {p}0, 'k1', {p}1, 'k2', {p}2, 'runs', {p}3)"
    spans = let("base", every, f"array_sort(concat(base.k0, base.k1, base.k2, {chosen}))")
    return df.withColumn(spans_col, F.expr(spans)).select(*names, spans_col)


def joined(spans: str, condition: str = "true") -> Column:
    """The spans that meet a condition on x as kind:start:end, joined by commas."""
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform(filter({spans}, x -> {condition}), x -> concat_ws(':', {kinds}[x.kind], x.start, x.end)), ',')")


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every stretch of overlapping spans replaced by ``mark``; the spans go.

    Spans come sorted by start, as :func:`scan` gives them.  The text is cut into blocks of 1,024
    characters first, so that what lies between two spans is found without reading all before it.
    """
    t = f"`{text_col}`"
    cut = """CASE WHEN {a} div 1024 = {b} div 1024 THEN substring(blocks[{a} div 1024], {a} % 1024 + 1, {b} - {a})
        ELSE concat(substring(blocks[{a} div 1024], {a} % 1024 + 1), array_join(slice(blocks, {a} div 1024 + 2, {b} div 1024 - {a} div 1024 - 1), ''),
            coalesce(substring(try_element_at(blocks, cast({b} div 1024 + 1 AS int)), 1, {b} % 1024), '')) END"""
    piece = f"CASE WHEN x.start < before[i] THEN '' ELSE concat({cut.format(a='before[i]', b='x.start')}, '{mark}') END"
    last = "greatest(before[size(before) - 1], s[size(s) - 1].end)"
    rest = let("z", last, let("n", f"length({t})", f"CASE WHEN z >= n THEN '' ELSE {cut.format(a='z', b='n')} END"))
    whole = f"concat(array_join(transform(s, (x, i) -> {piece}), ''), {rest})"
    whole = before_each("transform(s, x -> x.end)", "greatest(a, x)", "0", whole)
    whole = let("s", f"`{spans_col}`", let("blocks", f"regexp_extract_all({t}, '(?s).{{1,1024}}', 0)", whole))
    clean = F.expr(f"CASE WHEN size(`{spans_col}`) > 0 THEN {whole} ELSE {t} END")
    return docs.withColumn(text_col, clean).drop(spans_col)
