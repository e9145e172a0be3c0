"""Secret scans: known forms, and tokens that pass a battery of randomness tests.

Known forms are three patterns (assignments, access keys, hex runs). Beyond them, every long run of
letters, digits and ``+/_-``, with up to two ``=`` at its end, is a candidate if it has two of: small letters, capitals,
digits. A ``=`` inside parts a name from its value. Its encoding is inferred from its characters, and its
symbols, as places in that alphabet, go through three tests of uniform independent symbols:

* chi-squared on the symbol counts,
* runs of symbols in the lower and upper half of the alphabet (Wald-Wolfowitz),
* serial correlation of neighbouring symbols,

whose p-values Fisher's method combines. Short tokens give weak tests, so the decision depends on length: for
each encoding and length class (by powers of sqrt 2) the p-values of all documents are counted in
bins. Random tokens have uniform p-values, so twice the number above one half estimates them, and
the rest of what a threshold lets pass are false discoveries. Each class takes the lowest threshold at which
their share stays within ``rate``. Only these counts (a bounded number of classes and bins) reach the driver.

Everything is columns: matches come from ``regexp_extract_all``, their places from the lengths of the pieces
that ``split`` leaves between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import table, text_or_empty
from pricewright.llm.linededup import let

# The patterns of the known forms.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ["assign", "access", "hex", "random"]
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

# Encodings, the first that fits is inferred: pattern and alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "hex": ("[0-9a-f]+", DIGITS + "abcdef"),
    "HEX": ("[0-9A-F]+", DIGITS + "ABCDEF"),
    "base32": ("[A-Z2-7]+", UPPER + "234567"),
    "base36": ("[0-9a-z]+", DIGITS + LOWER),
    "BASE36": ("[0-9A-Z]+", DIGITS + UPPER),
    "base62": ("[0-9A-Za-z]+", DIGITS + LOWER + UPPER),
    "base64": ("[A-Za-z0-9+/]+", UPPER + LOWER + DIGITS + "+/"),
    "base64url": ("[A-Za-z0-9_-]+", UPPER + LOWER + DIGITS + "-_"),
}
RATE = 0.1
THRESHOLDS = [0.5, 0.2, 0.1, 0.05, 0.02, 0.01]
BLOCK = 64


def prefix_sums(items: Column) -> Column:
    """Sum of the items before each item, in blocks, so that a text with many matches stays cheap."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)

    def of(sizes: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(BLOCK)), lambda b: F.slice(sizes, b, BLOCK))
        return let(blocks, lambda bs: let(F.transform(bs, total), lambda sums: F.flatten(F.transform(bs, lambda block, j: spread(block, sums, j)))))

    def spread(block: Column, sums: Column, j: Column) -> Column:
        return let(total(F.slice(sums, F.lit(1), j)), lambda base: F.transform(block, lambda _, i: base + total(F.slice(block, F.lit(1), i))))

    return let(items, of)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Leftmost non-overlapping matches as structs (start, stop, hit[, part]); places in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(h: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern), F.lit(1), F.size(h)), lambda p: F.length(p).cast("long"))
        return let(gaps, lambda g: let(prefix_sums(F.zip_with(g, h, lambda a, b: a + F.length(b))), lambda before: combined(h, g, before)))

    def combined(h: Column, gaps: Column, before: Column) -> Column:
        parts = [h.alias("hit"), gaps.alias("gap"), before.alias("before")]
        if group is not None:
            parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
        return F.transform(
            F.arrays_zip(*parts),
            lambda x: F.struct(
                (x["before"] + x["gap"]).alias("start"), (x["before"] + x["gap"] + F.length(x["hit"])).alias("stop"),
                x["hit"].alias("hit"), *([x["part"].alias("part")] if group is not None else []),
            ),
        )

    kind = "array<struct<start:bigint,stop:bigint,hit:string" + (",part:string>>" if group is not None else ">>")
    return let(hits, lambda h: F.when(F.size(h) == 0, F.array().cast(kind)).otherwise(located(h)))


def base_spans(text: Column) -> Column:
    """Spans (start, rank, stop) of the known forms; rank is the kind's place in ``KINDS``."""

    def spans(guard: Column, pattern: str, rank: int, long_enough, group: int | None = None) -> Column:
        found = F.transform(
            F.filter(matches(text, pattern, group), long_enough),
            lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop")),
        )
        return F.when(guard, found).otherwise(F.array().cast(SPANS))

    words = F.lower(text)
    named = words.contains("passw") | words.contains("secret") | words.contains("token") | words.contains("api")
    return F.concat(
        spans(named, ASSIGN, 0, lambda x: F.length(x["part"]) >= MIN_ASSIGN, 2),
        spans(text.contains("AKIA"), ACCESS, 1, lambda x: F.length(x["hit"]) >= MIN_ACCESS),
        # A run of at least 32 is one maximal run, so the length can stand in the pattern here.
        spans(F.lit(True), r"[0-9a-f]{32,}", 2, lambda x: F.length(x["hit"]) >= MIN_HEX),
    )


SPANS = "array<struct<start:bigint,rank:int,stop:bigint>>"


def candidates(text: Column) -> Column:
    """Long tokens of letters in both cases, or of letters and digits, as structs (start, stop, class, p)."""
    found = F.filter(matches(text, CANDIDATE), lambda x: x["hit"].rlike("[0-9].*[A-Za-z]|[a-z].*[A-Z0-9]|[A-Z].*[a-z0-9]"))

    def judged(x: Column) -> Column:
        return let(
            F.rtrim(x["hit"], F.lit("=")),
            lambda token: let(
                encoding(token),
                lambda kind: F.struct(
                    x["start"].alias("start"), x["stop"].alias("stop"),
                    F.concat_ws("/", kind, length_class(token)).alias("class"), randomness(token, kind).alias("p"),
                ),
            ),
        )

    return F.filter(F.transform(found, judged), lambda x: x["p"].isNotNull())


def encoding(token: Column) -> Column:
    """Name of the first encoding whose alphabet holds the token; null for none."""
    kind = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        kind = F.when(token.rlike(f"^{pattern}$"), F.lit(name)).otherwise(kind)
    return kind


def length_class(token: Column) -> Column:
    return F.least(F.floor(2 * F.log2(F.length(token).cast("double"))), F.lit(40)).cast("string")


def randomness(token: Column, kind: Column) -> Column:
    """Combined p-value of the three tests that the token is random in its encoding."""
    alphabet = F.element_at(F.create_map(*[F.lit(v) for name, (_, a) in ENCODINGS.items() for v in (name, a)]), kind)

    def of(symbols: Column, letters: Column, k: Column) -> Column:
        places = F.transform(symbols, lambda s: (F.instr(letters, s) - 1).cast("double"))
        return let(places, lambda x: _fisher([_chi_squared(x, k), _runs(x, k), _serial(x)]))

    return F.when(
        kind.isNotNull(),
        let(alphabet, lambda a: of(F.filter(F.split(token, ""), lambda s: s != ""), a, F.length(a).cast("double"))),
    )


def thresholds(docs: DataFrame, rate: float = RATE) -> dict[str, float]:
    """Threshold of each class of tokens, from the p-values of all documents."""
    p = F.col("c.p")
    over = [F.count(F.when(p >= t, 1)).alias(f"t{i}") for i, t in enumerate(THRESHOLDS)]
    counted = docs.select(F.explode(candidates(F.col("text"))).alias("c")).groupBy("c.class").agg(*over)
    chosen = {}
    for row in counted.collect():
        random = 2.0 * (row["t0"] + 1)
        passing = {
            t: row[f"t{i}"] for i, t in enumerate(THRESHOLDS) if row[f"t{i}"] == 0 or 1 - random * (1 - t) / row[f"t{i}"] <= rate
        }
        chosen[row["class"]] = min(passing, default=1.0)
    return chosen


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (start, rank, stop), sorted.

    Random tokens are added where they touch no known form. A null text is empty and has none; repeated
    rows are scanned alike; other columns play no part. An empty table gives no rows.
    """
    rows = docs.select("doc_id", text_or_empty(F.col("text").cast("string")).alias("text"))
    limits = thresholds(rows, rate)

    def random(found: Column) -> Column:
        if not limits:
            return F.array().cast(SPANS)
        limit = F.create_map(*[F.lit(v) for pair in sorted(limits.items()) for v in pair])
        passing = F.filter(candidates(F.col("text")), lambda x: x["p"] >= F.coalesce(F.element_at(limit, x["class"]), F.lit(2.0)))
        alone = F.filter(passing, lambda x: ~F.exists(found, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])))
        return F.transform(alone, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("rank"), x["stop"].alias("stop")))

    return rows.select("doc_id", let(base_spans(F.col("text")), lambda b: F.array_sort(F.concat(b, random(b)))).alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as counts, spans and a digest of the known forms."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*map(F.lit, KINDS))
    label = lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"], x["stop"])
    listed = lambda spans: F.array_join(F.transform(spans, label), ",")
    known = F.filter("spans", lambda x: x["rank"] < 3)
    of_rank = lambda rank: F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long")
    counts = [of_rank(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS[:3])]
    return found.select(
        "doc_id", *counts, F.sha2(listed(known).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda s, x: s + x)


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z), by the rational approximation of the error function (absolute error 1.5e-7)."""

    def of(v: Column) -> Column:
        return let(
            let(1 / (1 + (0.3275911 / 2.0**0.5) * F.abs(v)), lambda t: _polynomial(t) * F.exp(-v * v / 2) / 2),
            lambda tail: F.when(v >= 0, tail).otherwise(1 - tail),
        )

    return let(z, of)


def _polynomial(t: Column) -> Column:
    return ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t


def _chi_squared(places: Column, k: Column) -> Column:
    """Upper tail of the chi-squared statistic of the symbol counts (Wilson-Hilferty)."""
    n = F.size(places).cast("double")
    squares = let(
        F.array_sort(places),
        lambda x: _total(F.transform(F.array_distinct(x), lambda v: F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))),
    )
    spread = 2 / (9 * (k - 1))
    return _upper_tail((F.pow((k / n * squares - n) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def _runs(places: Column, k: Column) -> Column:
    """Two-sided p of the number of runs in the halves of the alphabet; 0 where one half is missing."""
    halves = F.transform(places, lambda p: F.when(p >= k / 2, 1.0).otherwise(0.0))

    def p(x: Column) -> Column:
        n, high = F.size(x).cast("double"), _total(x)
        runs = 1 + _total(F.zip_with(F.slice(x, F.lit(2), F.size(x)), F.slice(x, F.lit(1), F.size(x) - 1), lambda a, b: F.abs(a - b)))
        mean = 2 * high * (n - high) / n + 1
        z = (runs - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-12)))
        return F.when((high == 0) | (high == n), F.lit(0.0)).otherwise(2 * _upper_tail(F.abs(z)))

    return let(halves, p)


def _serial(places: Column) -> Column:
    """Two-sided p of the correlation of each symbol with the next."""

    def p(x: Column) -> Column:
        n = F.size(x).cast("double")
        return let(_total(x) / n, lambda mean: of(x, n, mean))

    def of(x: Column, n: Column, mean: Column) -> Column:
        variance = _total(F.transform(x, lambda v: (v - mean) * (v - mean)))
        joint = _total(F.zip_with(F.slice(x, F.lit(2), F.size(x)), F.slice(x, F.lit(1), F.size(x) - 1), lambda a, b: (a - mean) * (b - mean)))
        return F.when(variance <= 0, F.lit(0.0)).otherwise(2 * _upper_tail(F.abs(joint / variance) * F.sqrt(n)))

    return let(places, p)


def _fisher(values: list[Column]) -> Column:
    """Fisher's combination: the tail of chi-squared with two degrees of freedom per test."""
    half = sum((-F.log(F.greatest(v, F.lit(1e-12))) for v in values), F.lit(0.0))

    def tail(h: Column) -> Column:
        term, total = F.lit(1.0), F.lit(1.0)
        for i in range(1, len(values)):
            term = term * h / i
            total = total + term
        return F.exp(-h) * total

    return let(half, tail)
