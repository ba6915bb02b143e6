"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Native: positions come from the pieces between matches (`split`) and the matches (`regexp_extract_all`). Tokens that mix
digits with letters get an encoding (hex, digits and letters of one case, digits and letters, base64) by the characters
that they have. Each is tested for being a uniform draw from that encoding's alphabet: chi-squared over groups of symbols,
runs about the alphabet's middle, and serial correlation. Fisher's combination gives one p-value, uniform for random
tokens and small for others. For each encoding and length class, the corpus-wide histogram of p gives how many tokens
are random (twice those above 1/2) and so which share of those above a cut is not; the least cut that keeps this share
below the limit decides. Short tokens, which the tests tell apart less well, so need more. A class's histogram is shrunk
towards its encoding's, that towards all tokens', and that towards a fixed one, each counting as POOLED tokens: so a class
with few tokens takes the cut of its like, and the more it has, the more its own, by one rule at every size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import columns_without, cut_lineage, quoted, spare_names

#: Fixed patterns: kind, pattern, a necessary pattern that is fast to look for, group and its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i)(?:pass(?:word|wd)|secret|token|api_?key)["']?\x20*[:=]""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", r"AKIA", 0, 16),
    ("hex", r"[0-9a-f]+", r"[0-9a-f]{32}", 0, 32),
)
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}"
#: Letters from common to rare, so that groups of neighbours tell words from random draws.
_LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "lower": _LETTERS + "0123456789",
    "upper": _LETTERS.upper() + "0123456789",
    "mixed": _LETTERS + "0123456789" + _LETTERS.upper(),
    "base64": _LETTERS + "0123456789+/-_" + _LETTERS.upper(),
}
#: Limit of the share of tokens above a cut that are not random; bins of p; lengths up to which a class goes.
FALSE_SHARE, BINS, LENGTHS = 0.05, 50, (24, 32, 48, 64, 128)
#: Tokens that the histogram of the next wider class counts as. The widest is fixed: half random, half below p = 0.1.
POOLED, FIXED_LOW = 20, 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: columns are trees, in which each use would compute it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


_SPAN = "array<struct<start:int,end:int,kind:string,token:string>>"
#: Elements of a block of a running value: an array of n costs about n x BLOCK / 2 + (n / BLOCK)^2 / 2 steps.
BLOCK = 256


def _blocks(n: Column) -> Column:
    """Numbers of the blocks of n elements; none for none."""
    return F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))


def _within(block: Column, n: Column) -> Column:
    """Numbers of the elements of a block."""
    return F.sequence(block * BLOCK, F.least((block + 1) * BLOCK, n) - 1)


def running(values: Column, join: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each int of an array, all before it joined; `zero` for the first.

    Arrays can only be lengthened by a copy, so blocks are run through on their own, and then their totals.
    """

    def steps(items: Column, value: Callable[[Column], Column]) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, start, lambda s, i: F.struct(join(s["at"], value(i)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def by_blocks(v: Column) -> Column:
        n = F.size(v)
        totals = F.transform(_blocks(n), lambda b: F.aggregate(_within(b, n), zero, lambda a, i: join(a, F.get(v, i))))
        return _let(steps(totals, lambda x: x), lambda before: F.flatten(F.transform(_blocks(n), lambda b: F.transform(steps(_within(b, n), lambda i: F.get(v, i)), lambda x: join(F.get(before, b), x)))))

    return _let(values, by_blocks)


def _spans(text: Column, pattern: str, guard: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, kind, text) of a pattern's leftmost matches whose group has at least so many characters."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # the piece after the last match has no match and is left out
    zipped = F.filter(F.arrays_zip(whole.alias("m"), tested.alias("g"), F.split(text, pattern, -1).alias("before")), lambda x: x["m"].isNotNull())

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda x: F.length(x["before"]) + F.length(x["m"]))
        ends = running(sizes, lambda a, x: a + x, F.lit(0))

        def span(x: Column, at: Column) -> Column:
            begin = at + F.length(x["before"])
            item = F.struct(begin.alias("start"), (begin + F.length(x["m"])).alias("end"), F.lit(kind).alias("kind"), x["m"].alias("token"))
            return F.when(F.length(x["g"]) >= least, item)

        return F.filter(F.zip_with(found, ends, span), lambda x: x.isNotNull())

    return F.when(text.rlike(guard), _let(zipped, placed)).otherwise(F.array().cast(_SPAN))


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Abramowitz and Stegun 26.2.17)."""

    def tail(x: Column, t: Column) -> Column:
        return F.exp(-x * x / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))

    positive = lambda x: _let(1 / (1 + x * 0.2316419), lambda t: tail(x, t))
    return _let(z, lambda v: _let(_let(F.abs(v), positive), lambda q: F.when(v >= 0, q).otherwise(1 - q)))


def _chi_tail(x: Column, df: Column) -> Column:
    """P(chi-squared with df degrees > x), by Wilson and Hilferty's cube root."""
    spread = F.lit(2.0) / (df * 9)
    return _normal_tail((F.pow(x / df, F.lit(1.0 / 3)) - (1 - spread)) / F.sqrt(spread))


def encoding_column(token: Column) -> Column:
    """The narrowest alphabet with all characters of a token; null without both a digit and a letter."""
    body = F.regexp_replace(token, "=+$", "")
    kind = F.when(body.rlike("^[0-9a-f]+$") | body.rlike("^[0-9A-F]+$"), "hex").when(body.rlike("^[0-9a-z]+$"), "lower").when(body.rlike("^[0-9A-Z]+$"), "upper").when(body.rlike("^[0-9A-Za-z]+$"), "mixed").otherwise("base64")
    return F.when(body.rlike("[0-9]") & body.rlike("[A-Za-z]"), kind)


_SIZES = {k: len(v) for k, v in ALPHABETS.items()}


def _lookup(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def _symbols(token: Column, encoding: Column) -> Column:
    """Places of a token's characters in its alphabet, from 0."""
    body = F.regexp_replace(token, "=+$", "")
    body = F.when(encoding == "hex", F.lower(body)).otherwise(body)
    return _let(_lookup(ALPHABETS, encoding), lambda alphabet: F.transform(F.split(body, ""), lambda c: F.call_function("instr", alphabet, c) - 1))


def _total(values: Column, kind: str = "double") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x.cast(kind))


def _p_uniform(s: Column, n: Column, size: Column) -> Column:
    """Chi-squared over about n / 5 groups of symbols. An alphabet may not split evenly: a group has its own expectation."""

    def by_groups(groups: Column) -> Column:
        bins = F.transform(s, lambda x: F.floor(x * groups / size).cast("int"))
        expected = lambda b: n * (F.ceil((b + 1) * size / groups) - F.ceil(b * size / groups)) / size
        part = lambda own, b, e: F.pow(F.size(F.filter(own, lambda x: x == b)) - e, F.lit(2.0)) / e
        chi = _let(bins, lambda own: _total(F.transform(F.sequence(F.lit(0), groups - 1), lambda b: _let(expected(b), lambda e: part(own, b, e)))))
        return _chi_tail(chi, (groups - 1).cast("double"))

    return _let(F.least(size, F.greatest(F.lit(2), F.floor(n / 5).cast("int"))), by_groups)


def _p_runs(s: Column, n: Column, size: Column) -> Column:
    """Runs above and below the alphabet's middle: each step is a change with the chance of unlike halves."""
    high = F.transform(s, lambda x: x * 2 >= size)
    changes = _let(high, lambda h: F.size(F.filter(F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h) - 1), lambda a, b: a != b), lambda x: x)))
    share = F.ceil(size / 2) / size
    z = _let(2 * share * (1 - share), lambda c: (changes - (n - 1) * c) / F.sqrt((n - 1) * c * (1 - c)))
    return 2 * _normal_tail(F.abs(z))


def _p_serial(s: Column, n: Column) -> Column:
    """Lag-one correlation, about normal with mean -1/n and variance 1/n."""
    deviations = _let(_total(s) / n, lambda mean: F.transform(s, lambda x: x - mean))
    cov = lambda d: _total(F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, 2, F.size(d) - 1), lambda a, b: a * b))
    z = _let(deviations, lambda d: _let(_total(F.transform(d, lambda x: x * x)), lambda var: F.when(var > 0, (cov(d) / var + 1 / n) * F.sqrt(n)).otherwise(9.0)))
    return 2 * _normal_tail(F.abs(z))


def randomness(token: Column, encoding: Column) -> Column:
    """Combined p-value of a token's tests; small if it is no uniform draw from its encoding's alphabet."""

    def tested(s: Column, n: Column, size: Column) -> Column:
        logs = F.transform(F.array(_p_uniform(s, n, size), _p_runs(s, n, size), _p_serial(s, n)), lambda p: F.log(F.least(F.lit(1.0), F.greatest(F.lit(1e-12), p))))
        return _chi_tail(F.greatest(-2 * _total(logs), F.lit(1e-9)), F.lit(6.0))

    return _let(_symbols(token, encoding), lambda s: _let(F.size(s).cast("double"), lambda n: _let(_lookup(_SIZES, encoding), lambda size: tested(s, n, size))))


def _length_class(token: Column) -> Column:
    out = F.lit(len(LENGTHS))
    for k in reversed(range(len(LENGTHS))):
        out = F.when(F.length(token) <= LENGTHS[k], k).otherwise(out)
    return out


def false_discovery_cuts(rows: list[tuple[str, int, int]]) -> dict[str, float]:
    """rows: (class: encoding/length, bin of p, tokens). The least cut of each class that keeps the share of non-random tokens in limit."""
    classes: dict[str, list[int]] = {}
    for name, bin_, n in rows:
        classes.setdefault(name, [0] * BINS)[min(BINS - 1, max(0, bin_))] += n

    def shrunk(counts: list[list[int]], wider: list[float]) -> list[float]:
        """The sum of histograms, and the wider one as POOLED tokens."""
        scale = POOLED / sum(wider)
        return [sum(own) + scale * w for *own, w in zip(*counts, wider, strict=True)]

    fixed = [0.5 / BINS + (0.5 / FIXED_LOW if k < FIXED_LOW else 0) for k in range(BINS)]
    every = shrunk(list(classes.values()), fixed)
    encodings = {e: shrunk([c for name, c in classes.items() if name.split("/")[0] == e], every) for e in {name.split("/")[0] for name in classes}}
    cuts = {}
    for name, counts in classes.items():
        own = shrunk([counts], encodings[name.split("/")[0]])
        random = 2 * sum(own[BINS // 2 :])
        above = [sum(own[k:]) for k in range(BINS // 2)]
        cuts[name] = next((k / BINS for k, n in enumerate(above) if n - random * (1 - k / BINS) <= FALSE_SHARE * n), 0.5)
    return cuts


def scan_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds base_spans (fixed patterns) and spans (those, and random tokens that overlap none): arrays of (start, end, kind).

    Positions are code points, end exclusive; arrays are sorted by start, then kind in the order assign, access, hex, random.
    Null and empty texts have no spans. Empty tables, repeated rows and other columns, whatever their names, pass through;
    columns with an added column's name are replaced. The tests' cuts are counted over the whole input: two passes over the
    texts. Work grows with a text's length and its number of matches, up to some million
    matches of one text; then blocks of matches grow with the square.
    """
    return _scanned(docs, text_column, "base_spans", "spans")


def _scanned(docs: DataFrame, text_column: str, base_name: str, spans_name: str) -> DataFrame:
    text = F.coalesce(quoted(text_column).cast("string"), F.lit(""))
    found = cut_lineage(_class_counts(docs, text))
    rows = [(r["class"], r["bin"], r["n"]) for r in found.collect()]  # at most encodings x length classes x bins
    cuts = false_discovery_cuts(rows)
    return _with_spans(docs, text, cuts, base_name, spans_name)


def _candidates(text: Column) -> Column:
    """Array of (start, end, kind, token, p, class) of the tokens that have an encoding."""
    tokens = _spans(text, TOKEN, r"[A-Za-z0-9+/_-]{20}", "random")

    def judged(x: Column, encoding: Column) -> Column:
        name = F.concat_ws("/", encoding, _length_class(x["token"]).cast("string"))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), randomness(x["token"], encoding).alias("p"), name.alias("class"))

    coded = F.filter(F.transform(tokens, lambda x: F.struct(x.alias("x"), encoding_column(x["token"]).alias("encoding"))), lambda t: t["encoding"].isNotNull())
    return F.transform(coded, lambda t: judged(t["x"], t["encoding"]))


def _class_counts(docs: DataFrame, text: Column) -> DataFrame:
    tokens = docs.select(F.explode(_candidates(text)).alias("t"))
    return tokens.groupBy(F.col("t.class").alias("class"), F.least(F.lit(BINS - 1), F.floor(F.col("t.p") * BINS)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def _with_spans(docs: DataFrame, text: Column, cuts: dict[str, float], base_name: str, spans_name: str) -> DataFrame:
    order = {kind: k for k, kind in enumerate([k[0] for k in KINDS] + ["random"])}
    short = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), _lookup(order, x["kind"]).alias("place"), x["end"].alias("end"), x["kind"].alias("kind")))
    plain = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    text_name, held = spare_names([*docs.columns, base_name, spans_name], "_text", "_base")
    base = F.array_sort(F.concat(*[short(_spans(F.col(text_name), pattern, guard, kind, group, least)) for kind, pattern, guard, group, least in KINDS]))
    kept = columns_without(docs, base_name, spans_name)
    rows = docs.select(*kept, text.alias(text_name)).withColumn(held, base)
    every = F.col(held)
    if cuts:
        passed = F.filter(_candidates(F.col(text_name)), lambda t: t["p"] >= _lookup(cuts, t["class"]))
        every = _let(short(passed), lambda found: F.when(F.size(found) == 0, F.col(held)).when(F.size(held) == 0, F.array_sort(found)).otherwise(_joined(F.array_sort(F.concat(held, found)), order["random"])))
    return rows.withColumns({base_name: plain(F.col(held)), spans_name: plain(every)}).drop(held, text_name)


def _joined(spans: Column, random: int) -> Column:
    """Sorted spans (start, place, end, kind) without those of place `random` that overlap another one."""

    def told(all_: Column) -> Column:
        fixed = lambda x, value, none: F.when(x["place"] < random, x[value]).otherwise(F.lit(none))
        reach = running(F.transform(all_, lambda x: fixed(x, "end", 0)), lambda a, b: F.greatest(a, b), F.lit(0))
        last = 2**31 - 1
        next_ = F.reverse(running(F.transform(F.reverse(all_), lambda x: fixed(x, "start", last)), lambda a, b: F.least(a, b), F.lit(last)))
        alone = F.zip_with(F.zip_with(all_, reach, lambda x, r: F.when((x["place"] < random) | (r <= x["start"]), x)), next_, lambda x, n: F.when((x["place"] < random) | (n >= x["end"]), x))
        return F.filter(alone, lambda x: x.isNotNull())

    return _let(spans, told)


def spans_text(spans: str | Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _fresh(spans: Column) -> Column:
    """Of sorted spans those that overlap none before: (at: the end of the spans before, start)."""
    before = running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
    return F.filter(F.zip_with(spans, before, lambda x, at: F.when(x["start"] >= at, F.struct(at.alias("at"), x["start"].alias("start")))), lambda x: x.isNotNull())


def _marked(text: Column, fresh: Column, end: Column, mark: str) -> Column:
    """A text with `mark` in place of its spans. end: of the last one.

    A substring is found by counting characters from the start of its text, so texts are first cut into stretches of BLOCK spans.
    """
    n = F.size(fresh)

    def stretch(block: Column) -> Column:
        first, after = block * BLOCK, F.least((block + 1) * BLOCK, n)
        at = F.get(fresh, first)["at"]
        own = F.substring(text, at + 1, F.get(fresh, after - 1)["start"] - at)
        clear = lambda part: F.transform(F.slice(fresh, first + 1, after - first), lambda x: F.substring(part, x["at"] - at + 1, x["start"] - x["at"]))
        return F.array_join(_let(own, clear), mark)

    return F.concat(F.array_join(F.transform(_blocks(n), stretch), mark), F.lit(mark), F.substring(text, end + 1, F.length(text)))


def redact(docs: DataFrame, text_column: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents, with every span of their texts replaced by `mark` (overlapping spans by one), and n_chars, if there, set anew.

    Null texts stay null. All rows and columns, whatever their names, are kept. Very long texts: as in scan_secrets.
    """
    base_name, spans_name = spare_names(docs.columns, "base_spans", "spans")
    rows = _scanned(docs, text_column, base_name, spans_name)
    text = quoted(text_column).cast("string")
    fresh_name, clean_name = spare_names(rows.columns, "_fresh", "_clean")
    rows = rows.withColumn(fresh_name, F.when(F.size(spans_name) > 0, _fresh(F.col(spans_name))))
    end = F.array_max(F.transform(spans_name, lambda x: x["end"]))
    rows = rows.withColumn(clean_name, F.when(F.size(spans_name) > 0, _marked(text, F.col(fresh_name), end, mark)).otherwise(text))
    new = {text_column: F.col(clean_name), "n_chars": F.length(clean_name).cast("long")}
    return rows.select(*[new.get(c, quoted(c)).alias(c) for c in docs.columns])
