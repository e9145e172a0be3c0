"""Quality rules: base counts, and divergence from the document's language.

Each language has two reference histograms, summed over all its documents that are long enough:
classes of characters, and common words (a fixed list per language, and all other words). A
document is compared to them by the Jensen-Shannon distance (square root of the divergence to base 2,
0 to 1) and rejected beyond a distance. Each comparison has a guard: a text too short for a fair
histogram passes it. Reference counts are whole numbers, so they don't depend on task order.

References come from the documents themselves, so a language that holds mostly junk would judge itself by it. A language
is therefore compared to fixed values of written prose first: if its characters are far from them, or a listed language
hardly has its own common words, the fixed values take the place of its reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import cut_lineage, small_side, table, text_or_empty, word_list
from pricewright.llm.linededup import let

# Frequent function words of each language.
COMMON_WORDS = {
    "de": "der die und das in zu den ist von mit ein eine".split(),
    "en": "the of and to in is that for it was on with".split(),
    "es": "de la que el en y los del las un por con".split(),
    "fr": "de la et le les des en un du une est que".split(),
}
# A document whose language is unknown is compared on the words of all four.
ANY_LANGUAGE = "the of and de la el en der die und le et".split()

PUNCTUATION = r""".,;:!?'"()\-"""
CHAR_CLASSES = {
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "punctuation": f"[{PUNCTUATION}]",
    "symbol": r"[#$%&*+/<=>@\[\]\\^_`{|}~]",
}

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Guards: the fewest characters and words of a fair histogram.
GUARD_CHARS = 200
GUARD_WORDS = 100
# Chosen on labelled documents: no clean one is rejected there, and 86 of 100 that the base rule misses are.
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.25


# Characters of prose in a hundred, by class in the order of a histogram, and the words of a listed
# language in three hundred, each common word alike.
PROSE_CHARS = [3, 1, 3, 1, 16, 76]
PROSE_WORDS = [4] * 12 + [252]
# Farther from prose, or with a smaller share of its common words, a language is not its own reference.
MAX_REFERENCE_DISTANCE = 0.2
MIN_COMMON_PERCENT = 5


def char_histogram(text: Column, spaces: Column) -> Column:
    """Counts per class of characters: the classes above, white space, then letters and all others."""
    counts = [*[F.regexp_count(text, F.lit(p)).cast("long") for p in CHAR_CLASSES.values()], spaces]
    return let(F.array(*counts), lambda c: F.concat(c, F.array(F.length(text).cast("long") - _sum(c))))


def word_histogram(words: Column, lang: Column) -> Column:
    """Counts of the common words of the language, as they stand between spaces, then of all other words."""
    lists = F.lit(None).cast("array<string>")
    for name, chosen in COMMON_WORDS.items():
        lists = F.when(lang == name, F.array(*map(F.lit, chosen))).otherwise(lists)
    lists = F.coalesce(lists, F.array(*map(F.lit, ANY_LANGUAGE)))
    known = sorted({w for chosen in [*COMMON_WORDS.values(), ANY_LANGUAGE] for w in chosen})
    joined = F.concat(F.lit(" "), F.array_join(F.filter(words, lambda w: w.isin(known)), "  "), F.lit(" "))

    def counts(text: Column) -> Column:
        return F.transform(
            lists,
            lambda w: let(
                F.concat(F.lit(" "), w, F.lit(" ")),
                lambda padded: ((F.octet_length(text) - F.octet_length(F.replace(text, padded, F.lit("")))) / F.octet_length(padded)).cast("long"),
            ),
        )

    return let(let(joined, counts), lambda c: F.concat(c, F.array(F.size(words).cast("long") - _sum(c))))


def repeat_words(words: Column, window: int = WINDOW_WORDS) -> Column:
    """Words inside windows that occur at least twice in the text, the first occurrence included.

    Windows are compared by hash; where hashes repeat, those windows are compared as texts.
    """
    hashes = _window_hashes(words, window)
    gram = lambda p: F.array_join(F.slice(words, p + 1, window), " ")
    numbered = lambda h: F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("v"), i.alias("p"))))

    def covered(h: Column) -> Column:
        alike = let(numbered(h), _repeats)
        exact = let(F.array_sort(F.transform(alike, lambda x: F.struct(gram(x["p"]).alias("v"), x["p"].alias("p")))), _repeats)
        return let(
            F.array_sort(F.transform(exact, lambda x: x["p"])),
            lambda p: _sum(F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))).cast("long"))),
        )

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(some)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 where either is empty."""

    def part(own: Column, other: Column) -> Column:
        return F.when(own > 0, own * F.log2(2 * own / (own + other))).otherwise(F.lit(0.0))

    def distance(n: Column, m: Column) -> Column:
        terms = F.zip_with(
            counts, reference, lambda a, b: let(F.struct((a / n).alias("p"), (b / m).alias("q")), lambda x: part(x["p"], x["q"]) + part(x["q"], x["p"]))
        )
        total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
        return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(total / 2, F.lit(0.0)))).otherwise(F.lit(0.0))

    sizes = F.struct(_sum(counts).alias("n"), _sum(reference).alias("m"))
    return let(sizes, lambda x: distance(x["n"], x["m"]))


def features(docs: DataFrame, with_rows: bool = False) -> DataFrame:
    """(doc_id, lang, n, n_symbols, n_dup_lines): all counts that a verdict needs; n holds the counts over words."""
    text = F.col("text")
    rows = docs.select(
        *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * with_rows,
        "doc_id", F.col("lang").cast("string").alias("lang"), text_or_empty(F.col("text").cast("string")).alias("text"),
    )

    def counts(w: Column) -> Column:
        chars = F.length(F.array_join(w, "")).cast("long")
        return F.struct(
            F.size(w).cast("long").alias("n_words"), chars.alias("word_chars"), repeat_words(w).alias("n_repeat_words"),
            word_histogram(w, F.col("lang")).alias("words"), char_histogram(text, F.length(text) - chars).alias("chars"),
        )

    return rows.select(
        *["row"] * with_rows, "doc_id", "lang", let(word_list(text), counts).alias("n"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), duplicate_lines(text).alias("n_dup_lines"),
    )


def histograms(docs: DataFrame) -> DataFrame:
    """(lang, n): the two histograms alone, for references."""
    text = F.col("text")

    def counts(w: Column) -> Column:
        spaces = F.length(text) - F.length(F.array_join(w, "")).cast("long")
        return F.struct(word_histogram(w, F.col("lang")).alias("words"), char_histogram(text, spaces).alias("chars"))

    rows = docs.select(F.col("lang").cast("string").alias("lang"), text_or_empty(F.col("text").cast("string")).alias("text"))
    return rows.select("lang", let(word_list(text), counts).alias("n"))


def references(counted: DataFrame) -> DataFrame:
    """(ref_lang, ref_chars, ref_words): the summed histograms of each language over its long enough documents, or the
    fixed values of prose where those are none. A language without such documents has no row.
    """
    kinds, listed = len(CHAR_CLASSES) + 2, len(ANY_LANGUAGE) + 1
    usable = (_sum(F.col("n.chars")) >= GUARD_CHARS) & (_sum(F.col("n.words")) >= GUARD_WORDS)
    marked = counted.select("lang", "n", usable.alias("usable"))
    sums = [F.sum(F.when(F.col("usable"), F.get("n.chars", F.lit(i)))).alias(f"c{i}") for i in range(kinds)]
    sums += [F.sum(F.when(F.col("usable"), F.get("n.words", F.lit(i)))).alias(f"w{i}") for i in range(listed)]
    own = marked.groupBy("lang").agg(*sums).select(
        F.col("lang").alias("ref_lang"), F.array(*[f"c{i}" for i in range(kinds)]).alias("ref_chars"),
        F.array(*[f"w{i}" for i in range(listed)]).alias("ref_words"),
    ).where("ref_chars[0] IS NOT NULL")
    chars, words = [F.array(*[F.lit(n).cast("long") for n in prose]) for prose in (PROSE_CHARS, PROSE_WORDS)]
    strange = js_distance(F.col("ref_chars"), chars) > MAX_REFERENCE_DISTANCE
    common = _sum(F.slice("ref_words", 1, listed - 1))
    poor = F.coalesce(F.col("ref_lang").isin(*COMMON_WORDS), F.lit(False)) & (100 * common < MIN_COMMON_PERCENT * _sum(F.col("ref_words")))
    return own.select(
        "ref_lang", F.when(strange, chars).otherwise(F.col("ref_chars")).alias("ref_chars"),
        F.when(poor, words).otherwise(F.col("ref_words")).alias("ref_words"),
    )


def judged(counted: DataFrame, known: DataFrame, with_rows: bool = False) -> DataFrame:
    """The verdicts of counted documents against the references (one row per language, already computed)."""
    failed = (F.col("n.n_words") < MIN_WORDS) | (100 * F.col("n.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n.n_words"))
    rows = counted.join(small_side(known), F.col("lang").eqNullSafe(F.col("ref_lang")), "left").select(
        *["row"] * with_rows, "doc_id", "n.n_words", "n.word_chars", "n_symbols", "n_dup_lines", "n.n_repeat_words",
        failed.alias("base_failed"),
        _guarded(F.col("n.chars"), F.col("ref_chars"), GUARD_CHARS).alias("char_distance"),
        _guarded(F.col("n.words"), F.col("ref_words"), GUARD_WORDS).alias("word_distance"),
    )
    near = (F.col("char_distance") <= MAX_CHAR_DISTANCE) & (F.col("word_distance") <= MAX_WORD_DISTANCE)
    # One condition that needs both sides of the join: a half on its own would be pushed below it and count every text again.
    return rows.withColumn("kept", F.when(near, ~F.col("base_failed")).otherwise(False))


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept.

    Texts are read once: the counts are kept, and both references and verdicts come from them. A null text has no
    words and fails the base rule. A null language is a language of its own, compared on words of all
    listed languages. Repeated rows are judged alike; other columns play no part. An empty table gives no rows.
    """
    counted = cut_lineage(features(docs))
    return judged(counted, cut_lineage(references(counted)))


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; texts are read twice, which moves none."""
    known = cut_lineage(references(histograms(docs)))
    return judged(features(docs, with_rows=True), known, with_rows=True).where("kept").select("row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.drop("char_distance", "word_distance")


def _window_hashes(words: Column, window: int) -> Column:
    """Hash of every window of words, put together from the hashes of halves as a window doubles."""

    def of(single: Column, width: int) -> Column:
        if width == 1:
            return single
        half = width // 2
        longer = let(of(single, half), lambda h: F.zip_with(h, F.slice(h, F.lit(half + 1), F.size(h)), lambda a, b: F.xxhash64(a, b)))
        if width == 2 * half:
            return longer
        return F.zip_with(longer, F.slice(single, F.lit(width), F.size(single)), lambda a, b: F.xxhash64(a, b))

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda single: F.slice(of(single, window), F.lit(1), F.size(single) - (window - 1)),
    )


def _guarded(counts: Column, reference: Column, least: int) -> Column:
    """The distance, or 0 for a text under the guard or a language without a reference."""
    usable = reference.isNotNull() & (_sum(counts) >= least)
    return F.when(usable, js_distance(counts, reference)).otherwise(F.lit(0.0))


def _repeats(items: Column) -> Column:
    """Those of sorted (v, p) structs whose v equals a neighbour's."""
    same = lambda x, i: F.coalesce(x["v"] == F.get(items, i)["v"], F.lit(False))
    return F.filter(items, lambda x, i: same(x, i - 1) | same(x, i + 1))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda s, x: s + x)


def _quality_sql() -> str:
    """The same rules as DuckDB SQL."""
    word, chars = r"'[^\x20\x09-\x0D]+'", [f"len(regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}'))" for p in CHAR_CLASSES.values()]
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    lists = " ".join(f"WHEN '{lang}' THEN {listed(words)}" for lang, words in COMMON_WORDS.items())
    kinds, terms = len(CHAR_CLASSES) + 2, len(ANY_LANGUAGE) + 1

    def sums(name: str, n: int) -> str:
        return "[" + ", ".join(f"sum({name}[{i}]) FILTER (usable)" for i in range(1, n + 1)) + f"] AS ref_{name}"

    def distance(name: str, n: int, own: str | None = None, other: str | None = None) -> str:
        """Square root of half the sum of both sides' terms, 0 where either is empty."""
        own, other = own or name, other or f"ref_{name}"
        p, q = f"({own}[i] / list_sum({own}))", f"({other}[i] / list_sum({other}))"
        part = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
        total = f"list_sum(list_transform(range(1, {n + 1}), lambda i: {part(p, q)} + {part(q, p)}))"
        return f"CASE WHEN list_sum({own}) > 0 AND list_sum({other}) > 0 THEN sqrt(greatest({total} / 2, 0)) ELSE 0 END"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {word}) AS w FROM documents),
c AS (SELECT rid, doc_id, lang, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) AS n_text,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, [{', '.join(chars)}] AS classes,
             CASE lang {lists} ELSE {listed(ANY_LANGUAGE)} END AS common,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, {word})) AS lines FROM d),
h AS (SELECT *, list_transform(common, lambda x: len(list_filter(w, lambda y: y = x))) AS hits FROM c),
f AS (SELECT *, list_concat(classes, [n_text - word_chars, word_chars - list_sum(classes)]) AS chars,
             list_concat(hits, [n_words - list_sum(hits)]) AS words FROM h),
g AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW_WORDS - 1}], ' ') AS gram FROM c, unnest(range(1, n_words - {WINDOW_WORDS - 2})) AS t(i)),
s AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) AS x WHERE n > 1),
r AS (SELECT rid, sum(least({WINDOW_WORDS}, coalesce(following - i, {WINDOW_WORDS}))) AS n_repeat_words FROM s GROUP BY rid),
own AS (SELECT lang AS ref_lang, {sums('chars', kinds)}, {sums('words', terms)} FROM (
          SELECT *, list_sum(chars) >= {GUARD_CHARS} AND list_sum(words) >= {GUARD_WORDS} AS usable FROM f) AS u GROUP BY lang),
ref AS (SELECT * REPLACE (
          CASE WHEN {distance('chars', kinds, 'ref_chars', f'{PROSE_CHARS}')} > {MAX_REFERENCE_DISTANCE} THEN {PROSE_CHARS} ELSE ref_chars END AS ref_chars,
          CASE WHEN coalesce(ref_lang IN {(*COMMON_WORDS,)}, false) AND 100 * list_sum(ref_words[1:{terms - 1}]) < {MIN_COMMON_PERCENT} * list_sum(ref_words)
               THEN {PROSE_WORDS} ELSE ref_words END AS ref_words)
        FROM own WHERE ref_chars[1] IS NOT NULL),
j AS (SELECT f.*, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             CASE WHEN ref_chars[1] IS NOT NULL AND list_sum(chars) >= {GUARD_CHARS} THEN {distance('chars', kinds)} ELSE 0 END AS char_distance,
             CASE WHEN ref_chars[1] IS NOT NULL AND list_sum(words) >= {GUARD_WORDS} THEN {distance('words', terms)} ELSE 0 END AS word_distance
      FROM f LEFT JOIN r USING (rid) LEFT JOIN ref ON lang IS NOT DISTINCT FROM ref_lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND char_distance <= {MAX_CHAR_DISTANCE} AND word_distance <= {MAX_WORD_DISTANCE} AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM j) AS k
"""


OP2_SQL = _quality_sql()
