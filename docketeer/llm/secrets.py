"""Secrets in texts by pattern and by a battery of randomness tests, in SQL functions only.

Three patterns give the base spans. Beside them every run of 20 or more key characters is a
candidate: its encoding is inferred from the characters it uses, and its symbols are tested as
draws from that alphabet, by chi-squared uniformity, by the number of runs above and below the
middle, and by serial correlation. A candidate that passes all three is a span where it is also
too uniform to be text of its length: the chance of such uniformity in text goes through
Benjamini and Hochberg's step-up rule within its length band, over all candidates of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketeer.functions.names import bind
from docketeer.session import settled

ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Runs of key characters; the look-behind starts a run at its first character only.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
KINDS = ["assign", "access", "hex", "random"]

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# Encoding, what all its characters match, its symbols in order, and how far text in the same
# characters is from uniform: k * sum(q^2) - 1 for k symbols and letter shares q as in English.
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef", 3.2),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF", 3.2),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", _UPPER + "234567", 1.1),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + _LOWER, 1.36),
    ("letters", r"^([a-z]+|[A-Z]+)$", _LOWER, 0.7),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, 3.06),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/", 3.19),
    ("base64url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_", 3.19),
]
ALPHA = 0.001  # a test that gives less speaks against a random token
FALSE_SHARE = 0.01  # of the tokens reported in a band, at most so many may be text
BANDS = [32, 48, 96]  # lengths at which the next band begins
STEPS = 400  # p-values are compared in tenths of a decade, down to 10^-40


NO_CANDIDATES = (
    "cast(array() as array<struct<start:int,kind:int,end:int,band:int,step:int,passed:boolean>>)"
)


def _summed(
    items: Column, start: Column, step: Callable[[Column, Column], Column], base: Callable[[Column, Column], Column], kind: str
) -> Column:
    """A list made by a running fold, in time linear in it but for its square root.

    ``step`` adds to a state (at, out) as an aggregate does; a list that grows is copied at every
    step, so this is done for blocks by themselves, and ``base`` then moves what a block gave by
    the sums of the blocks before.
    """
    size = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")),
        lambda b: F.aggregate(F.slice(items, b * size + 1, size), start, step),
    )

    def joined(held: Column) -> Column:
        totals = F.aggregate(
            held,
            F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
            lambda s, x: F.struct((s["at"] + x["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        )["out"]
        return F.flatten(F.zip_with(held, totals, lambda x, at: F.transform(x["out"], lambda o: base(o, at))))

    return F.when(F.size(items) > 0, bind(blocks, joined)).otherwise(F.expr(f"cast(array() as {kind})"))


FOUND = "array<struct<start:int,kind:int,end:int,hit:string>>"


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Matches as structs (start, kind, end, hit), in code points, by summing gaps and hits."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {FOUND})").alias("out"))

    def one(begin: Column, end: Column, hit: Column) -> Column:
        return F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), hit.alias("hit"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one(begin, end, x["hit"]))).alias("out"))

    moved = lambda o, at: one(o["start"] + at, o["end"] + at, o["hit"])
    found = bind(pairs, lambda p: _summed(p, start, step, moved, FOUND))
    return F.when(F.size(hits) > 0, found).otherwise(F.expr(f"cast(array() as {FOUND})"))


def _below(z: Column) -> Column:
    """Normal distribution function, the logistic approximation of Bowling et al. (2009)."""
    z = F.greatest(F.least(z, F.lit(9.0)), F.lit(-9.0))
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def _two_sided(z: Column) -> Column:
    return 2 * _below(-F.abs(z))


def _tests(tokens: Column) -> Column:
    """(start, kind, end, band, step, passed) of the candidates whose encoding is known."""

    def pick(n: Column, values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), n + 1)

    def encoded(t: Column) -> Column:
        n = F.lit(None).cast("int")
        for i, (_, pattern, _, _) in reversed(list(enumerate(ENCODINGS))):
            n = F.when(t["hit"].rlike(pattern), F.lit(i)).otherwise(n)
        return F.struct(t["start"], t["kind"], t["end"], t["hit"], n.alias("n"))

    def valued(t: Column) -> Column:
        signs = pick(t["n"], [e[2] for e in ENCODINGS])
        body = F.when(pick(t["n"], [e[0] for e in ENCODINGS]) == "letters", F.lower(t["hit"]))
        chars = F.split(F.regexp_replace(body.otherwise(t["hit"]), "=+$", ""), "")
        values = F.transform(chars, lambda c: (F.instr(signs, c) - 1).cast("double"))
        return F.struct(
            t["start"], t["kind"], t["end"], t["n"],
            F.length(signs).cast("double").alias("k"), values.alias("v"),
        )

    def measured(t: Column) -> Column:
        v, k, length = t["v"], t["k"], F.size(t["v"]).cast("double")
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
        squares = F.transform(
            F.sequence(F.lit(0), k.cast("int") - 1),
            lambda s: F.pow(F.size(F.filter(v, lambda x: x == s)).cast("double"), F.lit(2.0)),
        )
        mean = total(v) / length
        both = F.arrays_zip(
            F.slice(v, F.lit(1), F.size(v) - 1).alias("a"), F.slice(v, F.lit(2), F.size(v) - 1).alias("b")
        )
        high = lambda x: x >= k / 2
        return F.struct(
            t["start"], t["kind"], t["end"], t["n"], k.alias("k"), length.alias("length"),
            (k / length * total(squares) - length).alias("chi"),
            F.size(F.filter(v, high)).cast("double").alias("above"),
            (F.size(F.filter(both, lambda p: high(p["a"]) != high(p["b"]))) + 1).cast("double").alias("runs"),
            total(F.transform(both, lambda p: (p["a"] - mean) * (p["b"] - mean))).alias("lagged"),
            total(F.transform(v, lambda x: (x - mean) * (x - mean))).alias("spread"),
        )

    def judged(t: Column) -> Column:
        n, df = t["length"], t["k"] - 1
        cube = F.pow(F.greatest(t["chi"], F.lit(0.0)) / df, F.lit(1 / 3))
        uniform = _below(-(cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        expected = 2 * t["above"] * (n - t["above"]) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(
            variance > 0, _two_sided((t["runs"] - expected) / F.sqrt(F.greatest(variance, F.lit(1e-9))))
        ).otherwise(0.0)
        serial = F.when(
            t["spread"] > 0,
            _two_sided((t["lagged"] / F.greatest(t["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)),
        ).otherwise(0.0)
        away = pick(t["n"], [e[3] for e in ENCODINGS]) * n
        text = _below((t["chi"] - (df + away)) / F.sqrt(2 * (df + 2 * away)))
        band = sum((n >= b).cast("int") for b in BANDS)
        step = F.least(F.floor(-10 * F.log10(F.greatest(text, F.lit(1e-40)))), F.lit(STEPS))
        return F.struct(
            t["start"], t["kind"], t["end"], band.alias("band"), step.cast("int").alias("step"),
            ((uniform >= ALPHA) & (runs >= ALPHA) & (serial >= ALPHA)).alias("passed"),
        )

    known = F.filter(F.transform(tokens, encoded), lambda t: t["n"].isNotNull())
    return F.transform(F.transform(F.transform(known, valued), measured), judged)


def _limits(candidates: DataFrame) -> DataFrame:
    """(band, limit): the smallest step at which a band's tokens are reported.

    With m candidates of a band, of which R have a p-value of 10^(-s/10) or less, the rule takes
    the smallest s with m * 10^(-s/10) <= FALSE_SHARE * R. At most STEPS + 1 rows a band.
    """
    steps = candidates.groupBy("c.band", "c.step").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("band").orderBy(F.desc("step"))
    every = Window.partitionBy("band")
    ranked = steps.select(
        "band", "step", F.sum("n").over(down).alias("reached"), F.sum("n").over(every).alias("m")
    )
    fits = F.col("m") * F.pow(F.lit(10.0), -F.col("step") / 10) <= FALSE_SHARE * F.col("reached")
    return ranked.where(fits).groupBy("band").agg(F.min("step").alias("limit"))


def _ends_so_far(spans: Column) -> Column:
    """For each span, in order, the farthest end of those up to it."""
    size = F.greatest(F.ceil(F.sqrt(F.size(spans))), F.lit(1)).cast("int")
    none = F.expr("cast(array() as array<int>)")

    def rising(ends: Column, least: Column) -> Column:
        start = F.struct(least.alias("at"), none.alias("out"))
        return F.aggregate(
            ends,
            start,
            lambda s, e: F.struct(F.greatest(s["at"], e).alias("at"), F.concat(s["out"], F.array(F.greatest(s["at"], e))).alias("out")),
        )["out"]

    ends = F.transform(spans, lambda x: x["end"])

    def joined(held: Column) -> Column:
        farthest = rising(F.transform(held, lambda b: F.array_max(b)), F.lit(0))
        before = F.concat(F.array(F.lit(0)), farthest)
        return F.flatten(F.transform(held, lambda b, i: rising(b, F.get(before, i))))

    blocks = bind(ends, lambda e: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(e) - 1) / size).cast("int")), lambda b: F.slice(e, b * size + 1, size)
    ))
    return F.when(F.size(spans) > 0, bind(blocks, joined)).otherwise(none)


def _spans_of(hits: Column, extra: Column) -> Column:
    """Base spans, and the random ones that no base span touches, by start and kind.

    A random span is touched if the farthest end of the base spans that begin before its end lies
    behind its start; which these are is found by halved steps, as the base spans are in order.
    """
    short = lambda x: F.struct(x["start"], x["kind"], x["end"])
    steps = F.reverse(F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(hits), F.lit(1)))).cast("int")))

    step = lambda k: F.pow(F.lit(2), k).cast("int")

    def free(ends: Column) -> Column:
        def touched(x: Column) -> Column:
            before = F.aggregate(
                steps,
                F.lit(0),
                lambda at, k: F.when(
                    (at + step(k) <= F.size(hits)) & (F.get(hits, at + step(k) - 1)["start"] < x["end"]), at + step(k)
                ).otherwise(at),
            )
            return F.coalesce(F.get(ends, before - 1) > x["start"], F.lit(False))

        return F.filter(extra, lambda x: ~touched(x))

    all_of = lambda left: F.array_sort(F.concat(F.transform(hits, short), F.transform(left, short)))
    both = bind(bind(_ends_so_far(hits), free), all_of)
    return F.when(F.size(extra) > 0, both).otherwise(F.transform(hits, short))


def find_secrets(
    df: DataFrame, text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """(row, base, spans): the input row as a struct, its base spans and all its spans.

    ``carry`` names the columns of the struct, by default all.

    Spans are structs (start, kind, end) in code points with the end exclusive, ``kind`` an
    index into KINDS. Null and empty texts have none; repeated rows are each kept; an empty
    table gives an empty one. Columns of any name may be there, as a row is carried as one
    struct. The rows and their candidates are written once to the shared folder, since the
    limits need the candidates of all rows before any is decided.
    """
    carried = F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry)))
    any_of = F.col(f"`{text}`").rlike(f"{ASSIGN}|{ACCESS}|{HEX}|{RUN}")
    texts = df.select(carried.alias("row"), F.when(any_of, F.col(f"`{text}`")).alias("t"))
    long_enough = lambda h: F.length(F.regexp_extract(h["hit"], ASSIGN, 2)) >= 6
    scanned = texts.select(
        "row",
        F.filter(_found(F.col("t"), ASSIGN, 0), long_enough).alias("assign"),
        _found(F.col("t"), ACCESS, 1).alias("access"),
        _found(F.col("t"), HEX, 2).alias("hex"),
        _found(F.col("t"), RUN, 3).alias("runs"),
    )
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    bare = lambda a: F.transform(F.col(a), lambda h: F.struct(h["start"], h["kind"], h["end"]))
    base = F.array_sort(F.concat(bare("assign"), bare("access"), bare("hex")))
    kept = settled(
        scanned.select(
            "row", F.coalesce(base, none).alias("base"), _tests(F.col("runs")).alias("candidates")
        ),
        "secrets",
    )
    limits = _limits(kept.select(F.explode("candidates").alias("c")))
    # A row at most for each of the four bands.
    limit = {r["band"]: r["limit"] for r in limits.collect()}
    by_band = F.array(*(F.lit(limit.get(b, STEPS + 1)) for b in range(len(BANDS) + 1)))
    extra = F.filter(
        F.coalesce("candidates", F.expr(NO_CANDIDATES)),
        lambda c: c["passed"] & (c["step"] >= F.element_at(by_band, c["band"] + 1)),
    )
    return kept.select("row", "base", _spans_of(F.col("base"), extra).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or union of overlapping spans, replaced by one mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    end = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, end)).otherwise(text)
