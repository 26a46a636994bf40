"""Secret scans: three fixed patterns and a battery of randomness tests, in Spark expressions alone.

The patterns give the base spans.  The battery looks at every other long run of code
characters.  It infers an encoding (hexadecimal, base 32, base 36, letters of one or both
cases, base 64) and tests the hypothesis that the symbols were drawn at random: a
chi-squared test of a uniform alphabet, a runs test about the middle of the alphabet and a
test of lag-one serial correlation, combined by Fisher's method.  Ordinary names, paths and
words fail that hypothesis; what does not fail it looks like a key.

Two rules keep words from being reported.  A run is judged only if it is so long that
ordinary text of its length lies POWER deviations beyond a uniform alphabet.  And within each
encoding and band of lengths the share of words among what is reported (false discoveries)
is held at FALSE_DISCOVERY: p-values of keys are uniform, so those above one half tell how
many keys there are, and what is reported beyond the keys' share of it counts as words.  No
run with p below LEAST_P is reported, so a key is missed with that chance at least.  The
counts are read from a histogram of fixed size: no global sort is made.

Positions count code points, from 0, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, text_or_empty, written

# The patterns, with the least length of what counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 16
HEX = r"[0-9a-f]+"
HEX_LEAST = 32
KINDS = ("assign", "access", "hex", "random")

#: Runs that the battery looks at, and the shortest ones.
RUN = r"[A-Za-z0-9+/_-]+"
RUN_LEAST = 20
#: Share of words among the reported runs, and the least p-value that is reported.
FALSE_DISCOVERY, LEAST_P = 0.05, 0.01
#: Chance that two letters of ordinary text are equal, and deviations that text must lie beyond a uniform alphabet.
COINCIDENCE, POWER = 0.065, 4.0
#: Length bands start at these lengths.
BANDS = (20, 32, 48, 80, 160)
#: The histogram: bins of -ln(p).
BIN, BINS = 0.05, 1200

_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "base32": _LOWER.upper() + "234567",
    "base36": _DIGITS + _LOWER,
    "letters": _LOWER,
    "both": _LOWER.upper() + _LOWER,
    "base64": _LOWER.upper() + _LOWER + _DIGITS + "+/",
}


def least_length(encoding: str) -> int:
    """The shortest run that tells random symbols from text: n (k * COINCIDENCE - 1) >= POWER * sqrt(2 (k - 1)).

    Words of hexadecimal digits alone are rare at any length that is looked at.
    """
    k = len(_ALPHABETS[encoding])
    excess = k * COINCIDENCE - 1
    return max(RUN_LEAST, math.ceil(POWER * math.sqrt(2 * (k - 1)) / excess)) if excess > 0.1 else RUN_LEAST


_SPAN = "array<struct<start:int,ord:int,end:int>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: what a function of arrays names more than once is computed each time otherwise."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, kind: str, join) -> Column:
    """Running totals of an array (``join`` is a sum or a maximum, the neutral start is 0).

    An array grows by copying, so one fold would take time by the square of its length.  Here runs of about
    the cube root of the length are folded by themselves, and what each of them begins with in a second
    fold: n^(4/3) copies, 9 millions for 100 000 values.
    """
    none = F.array().cast(f"array<{kind}>")

    def folded(part: Column) -> Column:
        start = F.struct(F.lit(0).cast(kind).alias("last"), none.alias("out"))

        def step(acc, x):
            more = join(acc["last"], x).cast(kind)
            return F.struct(more.alias("last"), F.concat(acc["out"], F.array(more)).alias("out"))

        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def whole(v: Column) -> Column:
        size = F.ceil(F.cbrt(2.0 * F.size(v))).cast("int")
        runs = F.transform(F.sequence(F.lit(0), F.size(v) - 1, size), lambda i: folded(F.slice(v, i + 1, size)))
        return _bound(runs, lambda r: _bound(folded(F.transform(r, lambda x: F.element_at(x, -1))), lambda ends: F.flatten(
            F.transform(r, lambda x, k: F.when(k == 0, x).otherwise(_bound(F.get(ends, k - 1), lambda e: F.transform(x, lambda y: join(e, y).cast(kind))))))))

    return _bound(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def _matches(text: Column, pattern: str, least: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, m: the text)."""
    # what lies between the matches gives their places; only texts with a match get here
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        steps = F.zip_with(gaps, m, lambda g, x: g + F.coalesce(F.length(x), F.lit(0)))
        ends = F.slice(_running(steps, "int", lambda a, b: a + b), 1, F.size(m))
        hits = F.zip_with(ends, m, lambda end, x: F.struct((end - F.length(x)).alias("start"), end.alias("end"), x.alias("m")))
        return F.filter(hits, lambda h: F.length(h["m"]) >= least)

    return _bound(found, placed)


def _spans(text: Column, pattern: str, least: int, order: int, hint: str, keep=None) -> Column:
    none = F.array().cast(_SPAN)
    found = _matches(text, pattern, least)
    if keep is not None:
        found = F.filter(found, keep)
    as_span = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("ord"), x["end"].alias("end")))
    # a first look for a match, where it can be said long enough, saves the work on most texts
    return F.when(text.rlike(hint), as_span).otherwise(none)


def base_spans(text: Column) -> Column:
    """Array of structs (start, ord, end): the spans of the three patterns, by start, then kind."""
    assign = _spans(text, ASSIGN, 1, 0, ASSIGN, lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST)
    # the runs are maximal, so "at least n" finds the matches that are long enough
    access = _spans(text, ACCESS, ACCESS_LEAST, 1, f"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
    hexa = _spans(text, HEX, HEX_LEAST, 2, f"[0-9a-f]{{{HEX_LEAST},}}")
    return F.array_sort(F.concat(assign, access, hexa))


# --- the battery ----------------------------------------------------------------------


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (a published rational approximation, error < 1e-7 relative to 1)."""

    def tail(z: Column, t: Column) -> Column:
        series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        a = F.abs(z)
        beyond = F.greatest(F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * series, F.lit(1e-300))
        return F.when(z >= 0, beyond).otherwise(1 - beyond)

    return _bound(z, lambda v: _bound(1 / (1 + 0.2316419 * F.abs(v)), lambda t: tail(v, t)))


def _encoding(token: Column) -> Column:
    """The smallest encoding that the run fits; null for numbers and for runs too short for theirs."""
    digit, lower, upper = token.rlike("[0-9]"), token.rlike("[a-z]"), token.rlike("[A-Z]")
    letters = lower | upper
    fits = {
        "hex": token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & letters,
        "base32": token.rlike("^[A-Z2-7]+$") & digit & upper,
        "base36": token.rlike("^([a-z0-9]+|[A-Z0-9]+)$") & digit & letters,
        "letters": token.rlike("^([a-z]+|[A-Z]+)$"),
        "both": token.rlike("^[A-Za-z]+$"),
        "base64": letters,
    }
    out = F.lit(None).cast("string")
    for name, fit in reversed(fits.items()):
        out = F.when(fit, F.when(F.length(token) >= least_length(name), F.lit(name))).otherwise(out)
    return out


def _tests(token: Column, encoding: Column) -> Column:
    """Fisher's combination of the three p-values, as -ln(p) of the combination."""
    alphabet, plain = F.lit(None).cast("string"), token
    for name, letters in _ALPHABETS.items():
        alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
    plain = F.when(encoding == "base64", F.translate(token, "-_", "+/")).when(encoding.isin("base32", "both"), token).otherwise(F.lower(token))
    return _bound(alphabet, lambda a: _bound(plain, lambda p: _bound(F.length(a).cast("double"), lambda k: _combined(a, p, k, F.length(p).cast("double")))))


def _combined(alphabet: Column, plain: Column, k: Column, n: Column) -> Column:
    # chi-squared of a uniform alphabet, to a normal deviate by the cube root
    squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda acc, c: acc + F.pow(n - F.length(F.replace(plain, c, F.lit(""))), F.lit(2.0)))
    df = k - 1
    spread = F.greatest((k / n * squares - n) / df, F.lit(0.0))
    p_alphabet = _upper_tail((F.pow(spread, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    codes = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c).cast("double"))
    # runs about the middle of the alphabet, and lag-one products about the mean code
    middle = (k + 1) / 2

    def step(acc, c):
        high = c > middle
        return F.struct(
            (acc["high"] + F.when(high, 1.0).otherwise(0.0)).alias("high"),
            (acc["runs"] + F.when(acc["last"].isNull() | ((acc["last"] > middle) != high), 1.0).otherwise(0.0)).alias("runs"),
            (acc["product"] + F.coalesce((acc["last"] - middle) * (c - middle), F.lit(0.0))).alias("product"),
            c.alias("last"),
        )

    start = F.struct(F.lit(0.0).alias("high"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("product"), F.lit(None).cast("double").alias("last"))

    def combined(acc):
        hi, lo = acc["high"], n - acc["high"]
        mean = 1 + 2 * hi * lo / n
        var = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
        p_runs = 2 * _upper_tail(F.abs(acc["runs"] - mean) / F.sqrt(var))
        # under the hypothesis the codes are uniform on 1..k: variance (k^2 - 1) / 12
        z = acc["product"] / ((k * k - 1) / 12) / F.sqrt(n - 1)
        p_serial = 2 * _upper_tail(F.abs(z))
        half = -(F.log(p_alphabet) + F.log(F.least(p_runs, F.lit(1.0))) + F.log(F.least(p_serial, F.lit(1.0))))
        return _bound(half, lambda h: h - F.log1p(h + h * h / 2))

    return F.aggregate(codes, start, step, combined)


def candidates(text: Column) -> Column:
    """Array of structs (start, end, encoding, band, surprise) of the runs that the battery can judge.

    surprise is -ln of the combined p-value: large where the run is unlike random symbols.
    """
    kind = "array<struct<start:int,end:int,encoding:string,band:int,surprise:double>>"
    runs = F.transform(_matches(text, RUN, RUN_LEAST), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"), _encoding(x["m"]).alias("e")))
    runs = F.filter(runs, lambda x: x["e"].isNotNull())

    def judged(x):
        size = x["end"] - x["start"]
        band = F.lit(0)
        for i, least in enumerate(BANDS):
            band = F.when(size >= least, F.lit(i)).otherwise(band)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["e"].alias("encoding"), band.alias("band"), _tests(x["m"], x["e"]).alias("surprise"))

    return F.when(text.rlike(f"{RUN[:-1]}{{{RUN_LEAST},}}"), F.transform(runs, judged)).otherwise(F.array().cast(kind))


def thresholds(scanned: DataFrame, column: str) -> list[tuple[str, int, float]]:
    """By encoding and band, the surprise from which on nothing is reported.

    With h runs of p above one half there are 2 h keys, of which (1 - p) lie above p.  What is reported
    beyond that, and beyond one standard error of h, counts as words.  Above one half the
    estimate can find none, so that much is reported at least.  The histogram has BINS
    bins at most for each of the 30 encodings and bands; one threshold each comes to the driver.
    """
    each = scanned.select(F.explode(column).alias("c"))
    bins = each.groupBy(F.col("c.encoding").alias("e"), F.col("c.band").alias("b"), F.least(F.floor(F.col("c.surprise") / BIN), F.lit(BINS)).alias("bin")).count()
    by = Window.partitionBy("e", "b")
    half = math.floor(math.log(2) / BIN)
    sums = bins.select("e", "b", "bin", F.sum("count").over(by.orderBy("bin")).alias("r"), F.sum(F.when(F.col("bin") < half, F.col("count"))).over(by).alias("h"))
    edge, h = (F.col("bin") + 1) * BIN, F.coalesce("h", F.lit(0))
    keys = (h + F.sqrt(h)) * (1 - F.exp(-edge)) / (1 - math.exp(-half * BIN))
    fine = sums.where(((F.col("r") - keys) <= FALSE_DISCOVERY * F.col("r")) & (edge <= -math.log(LEAST_P)))
    return [(r["e"], r["b"], r["t"]) for r in fine.groupBy("e", "b").agg(F.max(edge).alias("t")).collect()]


def _apart_from(runs: Column, spans: Column) -> Column:
    """Those of ``runs``, in order of start and disjoint, that no span touches: spans may overlap one another."""
    # in order of where spans start and runs end, the furthest end of a span before a run's end says all;
    # of equal places the run comes first, as a span that starts at its end does not touch it
    event = lambda at, run, reach, x: F.struct(at.alias("at"), F.lit(run).alias("span"), reach.cast("int").alias("reach"), x.alias("start"))
    events = F.array_sort(F.concat(F.transform(runs, lambda c: event(c["end"], 0, F.lit(0), c["start"])), F.transform(spans, lambda s: event(s["start"], 1, s["end"], s["start"]))))

    def free(e: Column) -> Column:
        reached = _running(F.transform(e, lambda x: x["reach"]), "int", lambda a, b: F.greatest(a, b))
        marked = F.zip_with(e, reached, lambda x, r: F.struct(x["span"].alias("span"), (r <= x["start"]).alias("free")))
        return F.transform(F.filter(marked, lambda x: x["span"] == 0), lambda x: x["free"])

    pairs = F.zip_with(runs, _bound(events, free), lambda c, f: F.struct(c.alias("c"), f.alias("f")))
    return F.transform(F.filter(pairs, lambda x: x["f"]), lambda x: x["c"])


def scan_secrets(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``base`` and ``random``: arrays of structs (start, ord, end).

    ``base`` has the spans of the three patterns, by start, then kind; ``random`` those that
    the battery adds, none of which overlaps a base span.  Null texts count as empty and
    have no spans; repeated rows get equal spans; empty tables give empty results.  Columns
    of these names in ``docs`` stay: the new ones get underscores in front.
    """
    base, rand, cand = free_name(docs, "base"), free_name(docs, "random"), free_name(docs, "candidates")
    text = text_or_empty(text_col)
    kept = [c for c in docs.columns if keep_text or c != text_col]
    scanned = written(docs.select(*kept, base_spans(text).alias(base), candidates(text).alias(cand)), "scanned")
    limits = thresholds(scanned, cand)

    def limit(c: Column) -> Column:
        out = F.lit(math.log(2))
        for encoding, band, t in limits:
            out = F.when((c["encoding"] == encoding) & (c["band"] == band), F.lit(t)).otherwise(out)
        return out

    low = F.filter(cand, lambda c: c["surprise"] < limit(c))
    looks_random = F.when(F.size(base) == 0, low).otherwise(_bound(low, lambda c: F.when(F.size(c) == 0, c).otherwise(_apart_from(c, F.col(base)))))
    as_span = F.transform(looks_random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("ord"), c["end"].alias("end")))
    return scanned.withColumn(rand, as_span).drop(cand)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs``, same columns and rows, with every secret in the text replaced by ``mark``.

    Overlapping and touching spans become one mark.  Null texts stay null.
    """
    found = scan_secrets(docs, text_col)
    base, rand = (c for c in found.columns if c not in docs.columns)
    hits = free_name(found, "__hits")
    found = found.withColumn(hits, F.when(F.size(base) + F.size(rand) > 0, _merged(F.array_sort(F.concat(base, rand)))))
    clean = F.when(F.col(hits).isNull(), F.col(text_col)).otherwise(_without(F.col(text_col), F.col(hits), mark))
    return found.select(*[clean.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def _merged(spans: Column) -> Column:
    """Overlapping and touching spans, in order of start, as one: structs (start, end)."""

    def parts(s: Column) -> Column:
        return _bound(_running(F.transform(s, lambda x: x["end"]), "int", lambda a, b: F.greatest(a, b)), lambda reach: F.arrays_zip(
            F.transform(F.filter(s, lambda x, i: (i == 0) | (x["start"] > F.get(reach, i - 1))), lambda x: x["start"]).alias("start"),
            F.filter(reach, lambda r, i: (i == F.size(s) - 1) | (F.get(s, i + 1)["start"] > r)).alias("end"),
        ))

    return _bound(spans, parts)


#: Characters of a piece of text: a place in a text is looked for from the start of its piece.
PIECE = 1024


def _without(text: Column, hits: Column, mark: str) -> Column:
    """The text with ``mark`` in place of each of the hits (disjoint, in order)."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def stretch(p: Column, first: Column, last: Column) -> Column:
        numbers = F.sequence(F.floor(first / PIECE).cast("int"), F.floor(F.greatest(last - 1, first) / PIECE).cast("int"))

        def within(k: Column) -> Column:
            at = F.greatest(first - k * PIECE, F.lit(0))
            return F.substr(F.get(p, k), at + 1, F.least(last - k * PIECE, F.lit(PIECE)) - at)

        return F.array_join(F.transform(numbers, within), "")

    def around(p: Column) -> Column:
        before = F.transform(hits, lambda h, i: F.concat(stretch(p, F.when(i == 0, F.lit(0)).otherwise(F.get(hits, i - 1)["end"]), h["start"]), F.lit(mark)))
        return F.concat(F.array_join(before, ""), stretch(p, F.element_at(hits, -1)["end"], F.length(text)))

    return _bound(pieces, around)
