"""Secret scans with DataFrame functions only.

Base spans come from three fixed patterns. Beyond them, every token of
``TOKEN`` that a base span doesn't touch is put through a battery of randomness
tests in the alphabet of its inferred encoding (hex, base32 or base64):

* chi-squared uniformity over eight equal cells of the alphabet,
* the Wald-Wolfowitz runs test around the alphabet's middle,
* lag-one serial correlation of the symbol values.

Fisher's method combines the three p-values. A random token passes all tests,
so its combined p-value is about uniform; text piles up near zero. For each
encoding and length band a threshold t is chosen from the histogram over the
whole table. Whether the upper half (p >= 1/2) holds random tokens at all is read from
its slope: for random tokens the mean bin lies ``RISE`` above the middle (the tests are
correlated), other tokens thin out towards 1, and at the least by a straight line
to zero. What share of the upper half a one-sided 95 % bound thereby proves to be
non-random is taken off, the rest times two estimates the random tokens, and t is
the least bin edge at which the expected share of non-random tokens among those
with p >= t is at most ``fdr``. Short tokens, for which text passes more often,
thereby get a higher threshold, or none. Bands whose upper half falls off and bands with fewer
than ``LEAST`` tokens in it, too few to tell, get none.

Positions: the pieces between the matches and the matches themselves give the
offsets as running sums of their lengths, in code points.

Defined results: null text is empty and has no spans; offsets are code points,
ends exclusive; repeated rows are repeated; nothing depends on doc_id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order they are listed, pattern, group whose length
# counts and its least length. Hex and access runs have no shorter match inside
# a failing one, so their least length is part of the pattern.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
CELLS = 8
BINS = 20
# Mean bin of random tokens in the upper half less the middle: 0.27 to 0.45 in
# simulations of 20 to 88 symbols, 0.16 for 128 of 62 letters and digits.
RISE = 0.25
LEAST = 30


def _matches(df: DataFrame, name: str, pattern: str, guard: Column,
             extra: int | None = None) -> DataFrame:
    """Adds ``name``: array of (start, end, found, part) of the leftmost
    non-overlapping matches; ``part`` is group ``extra``, else the match."""
    text, p = F.col("_text"), F.lit(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(guard, F.regexp_extract_all(text, p, F.lit(0))).otherwise(none))
    some = F.size("_m") > 0
    df = df.withColumn("_g", F.when(some, F.slice(F.split(text, pattern, -1), 1, F.size("_m"))).otherwise(none))
    part = F.regexp_extract_all(text, p, F.lit(extra)) if extra else F.col("_m")
    df = df.withColumn("_p", F.when(some, part).otherwise(none))
    rows = F.arrays_zip(F.col("_g").alias("g"), F.col("_m").alias("m"), F.col("_p").alias("p"))
    zero = F.struct(F.lit(0).alias("at"),
                    F.array().cast("array<struct<start:int,end:int,part:string>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.char_length(row["g"])
        end = start + F.char_length(row["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), row["p"].alias("part")))).alias("out"))
    spans = F.aggregate(rows, zero, step, lambda acc: acc["out"])
    empty = F.array().cast("array<struct<start:int,end:int,part:string>>")
    return df.withColumn(name, F.when(some, spans).otherwise(empty)).drop("_m", "_g", "_p")


def _as(kind: str, spans: Column) -> Column:
    order = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("ord"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def with_spans(df: DataFrame) -> DataFrame:
    """Adds ``_base`` (all base spans, sorted) and ``_tokens`` (scored tokens that
    no base span touches) to rows with a ``_text`` column."""
    text = F.col("_text")
    df = _matches(df, "_assign", ASSIGN, text.contains("=") | text.contains(":"), extra=2)
    df = df.withColumn("_assign", F.filter("_assign", lambda s: F.char_length(s["part"]) >= 12))
    df = _matches(df, "_access", ACCESS, text.contains("AKIA"))
    df = _matches(df, "_hex", HEX, F.lit(True))
    df = df.withColumn("_base", F.array_sort(F.concat(*(_as(k, F.col(f"_{k}")) for k in KINDS[:3]))))
    df = _matches(df, "_random", TOKEN, F.lit(True))
    free = F.filter("_random", lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    df = df.withColumn("_tokens", F.filter(F.transform(free, _scored), lambda t: t.isNotNull()))
    return df.drop(*(f"_{k}" for k in KINDS))


# --- the test battery ------------------------------------------------------

def _encoding(token: Column) -> Column:
    """Encoding of a token, null for what is no encoded value: numbers and
    tokens that lack a digit or, for base64, one of the letter cases."""
    has = {c: token.rlike(f"[{c}]") for c in ("0-9", "a-z", "A-Z")}
    return (F.when(~has["0-9"], None)
            .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.when(token.rlike("[A-Fa-f]"), "hex"))
            .when(token.rlike("^[A-Z2-7]+=*$"), F.lit("base32"))
            .when(has["a-z"] & has["A-Z"], F.lit("base64")))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _values(part: Column, enc: Column) -> Column:
    """Symbol values of a token; padding and url-safe spellings are read as plain ones."""
    body = F.when(enc == "hex", F.lower(part)).otherwise(F.translate(F.rtrim(part, F.lit("=")), "-_", "+/"))
    alphabet = (F.when(enc == "hex", ALPHABETS["hex"]).when(enc == "base32", ALPHABETS["base32"])
                .otherwise(ALPHABETS["base64"]))
    at = F.transform(F.split(body, ""), lambda c: F.when(c != "", F.position(c, alphabet)).otherwise(0) - 1)
    return F.filter(at, lambda v: v >= 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _neighbours(x: Column, f) -> Column:
    return F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), f)


def _scored(t: Column) -> Column:
    """(start, end, enc, band, p) of a token."""
    def result(enc: Column, m: Column, p: Column) -> Column:
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), enc.alias("enc"),
                        F.floor(F.log2(m["n"].cast("double"))).cast("int").alias("band"), p.alias("p"))

    def tests(enc: Column, size: Column, x: Column, m: Column) -> Column:
        off = lambda v: v - m["mean"]
        moments = F.struct(_sum(F.transform(x, lambda v: off(v) * off(v))).alias("around"),
                           _sum(_neighbours(x, lambda a, b: off(a) * off(b))).alias("along"))
        logs = lambda r: _let(F.struct(
            _p_cells(m).alias("cells"), _p_runs(m).alias("runs"), _p_serial(m, r).alias("serial")), _fisher)
        return _let(_let(moments, logs), lambda p: result(enc, m, p))

    def counts(enc: Column, size: Column, x: Column) -> Column:
        cell = lambda i: F.size(F.filter(x, lambda v: F.floor(v * CELLS / size) == i))
        above = lambda v: v * 2 >= size
        m = F.struct(F.size(x).alias("n"), (_sum(x) / F.size(x)).alias("mean"),
                     F.size(F.filter(x, above)).alias("high"),
                     sum(F.pow(cell(i), F.lit(2)) for i in range(CELLS)).alias("squares"),
                     (1 + F.size(F.filter(_neighbours(x, lambda a, b: above(a) != above(b)), lambda v: v))).alias("runs"))
        return _let(m, lambda m: tests(enc, size, x, m))

    size = lambda enc: F.when(enc == "hex", 16).when(enc == "base32", 32).otherwise(64)
    return _let(_encoding(t["part"]), lambda enc: _let(size(enc), lambda n: _let(
        _values(t["part"], enc), lambda x: F.when(enc.isNotNull() & (F.size(x) >= 16), counts(enc, n, x)))))


def _normal_tail(z: Column) -> Column:
    """P(Z > |z|) * 2, by a published rational approximation of erfc with an error
    below 2e-7."""
    def tail(x: Column) -> Column:
        def poly(t: Column) -> Column:
            return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.least(F.lit(1.0), _let(1 / (1 + 0.3275911 * x), poly) * F.exp(-x * x))
    return _let(F.abs(z) / (2 ** 0.5), tail)


def _p_cells(m: Column) -> Column:
    """Upper tail of chi-squared by the cube-root normal approximation."""
    df = CELLS - 1
    chi = CELLS * m["squares"] / m["n"] - m["n"]
    z = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    return _let(z, lambda z: F.when(z >= 0, _normal_tail(z) / 2).otherwise(1 - _normal_tail(z) / 2))


def _p_runs(m: Column) -> Column:
    a, b = m["high"], m["n"] - m["high"]
    mu = 2.0 * a * b / m["n"] + 1
    return _let(mu, lambda mu: _let((mu - 1) * (mu - 2) / (m["n"] - 1), lambda var: F.when(
        var > 0, _normal_tail((m["runs"] - mu) / F.sqrt(var))).otherwise(0.0)))


def _p_serial(m: Column, r: Column) -> Column:
    z = (r["along"] / r["around"] + 1 / m["n"]) * F.sqrt(m["n"].cast("double"))
    return F.when(r["around"] > 0, _normal_tail(z)).otherwise(0.0)


def _fisher(p: Column) -> Column:
    half = -sum(F.log(F.greatest(p[c], F.lit(1e-30))) for c in ("cells", "runs", "serial"))
    return _let(half, lambda half: F.exp(-half) * (1 + half + half * half / 2))


# --- thresholds and results ------------------------------------------------

def least_p(n: np.ndarray, fdr: float) -> float | None:
    """Threshold from the histogram of one band; None if random tokens can't be told."""
    upper = n[BINS // 2:]
    total, k = upper.sum(), len(upper)
    if total < LEAST:
        return None
    rise = (upper * np.arange(k)).sum() / total - (k - 1) / 2
    error = 1.645 * ((k * k - 1) / 12 / total) ** 0.5
    # a line down to zero has its mean bin a sixth of the range under the middle
    proven = max(0.0, (RISE - rise - error) / (RISE + (k * k - 1) / (6 * k)))
    random = 2 * total * (1 - min(proven, 1.0))
    for i in range(1, k + 1):
        if 1 - random * (1 - i / BINS) / n[i:].sum() <= fdr:
            return i / BINS
    return None


def thresholds(scanned: DataFrame, fdr: float) -> dict[tuple[str, int], float]:
    """{(encoding, length band): least p of a secret}, from the histogram of the
    whole table. The table has at most 3 encodings x 31 bands x BINS rows."""
    bins = (scanned.select(F.explode("_tokens").alias("t"))
            .groupBy(F.col("t.enc").alias("enc"), F.col("t.band").alias("band"),
                     F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")).toPandas())
    out = {}
    for key, part in bins.groupby(["enc", "band"]):
        n = part.set_index("bin")["n"].reindex(range(BINS), fill_value=0).to_numpy()
        least = least_p(n, fdr)
        if least is not None:
            out[key] = least
    return out


def scan(df: DataFrame, fdr: float = 0.05) -> DataFrame:
    """``df`` (with a ``text`` column) plus ``_base`` and ``_spans``: arrays of
    (start, ord, end, kind) sorted by start, then kind; ``_spans`` has the base
    spans and the random tokens. Reads the table twice: once for the thresholds."""
    scanned = with_spans(df.withColumn("_text", F.coalesce("text", F.lit(""))))
    found = thresholds(scanned, fdr)
    if found:
        table = F.create_map(*(F.lit(x) for (enc, band), p in found.items() for x in (f"{enc} {band}", float(p))))

        def least(t: Column) -> Column:
            return F.element_at(table, F.concat_ws(" ", t["enc"], t["band"].cast("string")))
        random = F.filter("_tokens", lambda t: t["p"] >= least(t))
        spans = F.array_sort(F.concat("_base", _as("random", random)))
    else:
        spans = F.col("_base")
    return scanned.withColumn("_spans", spans).drop("_text", "_tokens")


def _listing(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS),
                        F.sha2(_listing("_base"), 256).alias("base_sha256"), _listing("_spans").alias("spans"))


def redact(docs: DataFrame, mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span (overlapping ones merged) replaced by ``mask``."""
    found = scan(docs.select(F.struct("*").alias("_row"), "text"))  # columns of any name pass through
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        inside = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.lit(mask)))).alias("out"))
    text = F.aggregate("_spans", zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.char_length("text") - acc["at"])))
    text = F.when(F.size("_spans") > 0, text).otherwise(F.col("text"))
    return found.select(*(text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
