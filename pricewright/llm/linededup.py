"""Removal of repeated passages by content-defined chunks of lines.

Each line is hashed, and a cyclic-polynomial hash rolls over ``window`` line hashes. Every bit of the rolling hash is a chunking of its own:
a boundary stands before the lines whose bit is set, and a chunk runs from a boundary up to the next one, two lines
at most. Whether two neighbouring lines are a chunk follows from their rolling hashes alone, so lines put in front of a
passage shift its chunks but do not change them. The union of ``CHUNKINGS`` chunkings has nine of ten pairs of neighbouring lines, and
all but one in 250 passages of three lines hold a chunk.

Chunks whose hash occurs more than once are compared byte by byte, and all but the first of equal ones are removed, in the
order of ``doc_id`` and place. A removed chunk takes the lines around it along as far as they continue the kept first copy
(``REACH`` lines to each side, by 128 bits of hash each), which closes the gaps at the edges of a passage and between its chunks.
Every line removed thus stands in an earlier place beside the same chunk, so one copy of each line stays.

Only (hash, count) and (document, chunk) pairs are shuffled to find repeats; chunk texts move for
repeated hashes only, and a chunk that a third of the documents share is combined in the map tasks
and split at the joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewright.llm.common import WORD, cut_lineage, splittable, table, text_or_empty

# Lines under the rolling hash, chunkings, lines that a removed chunk is extended by at most.
WINDOW_LINES = 1
CHUNKINGS = 8
REACH = 2
# The second hash of a line differs from the first by this constant in front.
SECOND = 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shifted(items: Column, by: int) -> Column:
    """Items moved by one place to the right (1) or left (-1); null moves in."""
    blank = F.transform(F.slice(items, 1, 1), lambda x: F.nullif(x, x))
    size = F.size(items)
    if by > 0:
        return F.concat(blank, F.slice(items, F.lit(1), F.greatest(size - 1, F.lit(0))))
    return F.concat(F.slice(items, F.lit(2), F.greatest(size - 1, F.lit(0))), blank)


def rolled(hashes: Column, window: int = WINDOW_LINES) -> Column:
    """Cyclic-polynomial hash of each line and the ``window - 1`` lines before it."""
    total, earlier = hashes, hashes
    for _ in range(window - 1):
        earlier = shifted(F.transform(earlier, lambda h: _turn(h)), 1)
        total = F.zip_with(total, earlier, lambda a, b: a.bitwiseXOR(F.coalesce(b, F.lit(0).cast("long"))))
    return total


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def chunk_rows(rows: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """(doc_id, fold, at, hash) of every chunk, the lines ``at`` and the next, that has a word."""
    lines = F.transform(split_lines(F.col("text")), lambda x: F.struct(F.xxhash64(x).alias("h"), x.rlike(WORD).alias("word")))

    def chunks(x: Column) -> Column:
        """Of each line but the last: itself, the next, and the rolling hashes of both."""
        rolling = let(rolled(F.transform(x, lambda y: y["h"]), window), lambda r: F.arrays_zip(r.alias("own"), shifted(r, -1).alias("next")))
        numbered = F.zip_with(
            F.arrays_zip(x.alias("own"), shifted(x, -1).alias("next")), rolling,
            lambda line, r: F.when(
                # A bit set before the first line and not before the second: the pair is a chunk of that chunking.
                (r["own"].bitwiseAND(F.bitwise_not(r["next"])).bitwiseAND(F.lit((1 << CHUNKINGS) - 1)) != 0)
                & (line["own"]["word"] | line["next"]["word"]),
                F.xxhash64(line["own"]["h"], line["next"]["h"]),
            ),
        )
        placed = F.transform(numbered, lambda hash, at: F.struct(at.alias("at"), hash.alias("hash")))
        return F.filter(placed, lambda c: c["hash"].isNotNull())

    return rows.select("doc_id", "fold", F.explode(let(lines, chunks)).alias("c")).select("doc_id", "fold", "c.at", "c.hash")


def repeated_chunks(docs: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """The documents with a column ``drops``: the numbers of the lines to remove, in order (null: none).

    Columns: row (the whole input row), doc_id, fold, text, drops. Rows are known by id and text hash, so
    rows that repeat both get the same decisions.
    """
    text = text_or_empty(F.col("text").cast("string"))
    # Rows move with their text once: the column that is worked on is taken out of them afterwards.
    inside = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64(text).alias("fold"))
    chunks = chunk_rows(docs.select("doc_id", F.xxhash64(text).alias("fold"), text.alias("text")), window)
    repeated = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    suspects = cut_lineage(_by_document(chunks.join(splittable(repeated), "hash"), "at", "suspects"))
    marked = _with(keyed, suspects, "suspects").withColumn("text", inside)
    held = (
        marked.where("suspects IS NOT NULL")
        .select("doc_id", "fold", F.explode(let(split_lines(F.col("text")), _with_context)).alias("c"))
        .select("doc_id", "fold", "c.*", F.xxhash64("c.chunk").alias("hash"))
    )
    place = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id"), F.col("fold"), F.col("at"))
    first = F.min(F.struct(place.alias("place"), F.col("before"), F.col("after")))
    groups = (
        held.groupBy("hash", "chunk").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
        .select("hash", F.col("chunk").alias("same"), "first")
    )
    later = held.join(splittable(groups), "hash").where(F.col("chunk") == F.col("same")).where(place != F.col("first.place"))
    begin = F.col("at") - _alike(F.col("before"), F.col("first.before"))
    end = F.col("at") + 1 + _alike(F.col("after"), F.col("first.after"))
    ranges = _by_document(later.withColumn("range", F.struct(begin.alias("begin"), end.alias("end"))), "range", "ranges")
    numbers = F.array_sort(F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["begin"], r["end"])))))
    dropped = ranges.select("doc_id", "fold", numbers.alias("drops"))
    return _with(marked.drop("suspects", "text"), dropped, "drops").withColumn("text", inside)


def cleaned(text: Column, drops: Column) -> Column:
    """The text without the dropped lines; unchanged where there are none."""
    return F.when(drops.isNull(), text).otherwise(
        let(
            split_lines(text),
            lambda lines: F.array_join(
                F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops), lambda i: F.get(lines, i)), "\n"
            ),
        )
    )


def dedup_lines(docs: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """The documents, with their columns, without repeated passages of lines.

    A null text stays null, a text of one line is never cut, and a document all of whose lines
    are removed is left with an empty text. Rows that repeat both id and text stay alike; rows without an
    id come last in the order. An empty table gives no rows.
    """
    out = repeated_chunks(docs, window).withColumn("clean", F.when(F.col("row.text").isNotNull(), cleaned(F.col("text"), F.col("drops"))))
    return out.select(*[F.col("clean").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many are removed, which ("first-last" from 0), and the digest of the rest."""
    found = repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    drops = F.coalesce("drops", F.array().cast("array<int>"))
    return found.select(
        "doc_id", F.size(split_lines(F.col("text"))).alias("n_lines"), F.size(drops).alias("removed_lines"),
        spans(drops).alias("removed"), F.sha2(cleaned(F.col("text"), F.col("drops")).cast("binary"), 256).alias("text_sha256"),
    )


def spans(numbers: Column) -> Column:
    """Sorted numbers as ``first-last`` of every stretch without a gap, comma-joined."""

    def listed(around: Column) -> Column:
        edge = lambda side, step: F.transform(
            F.filter(around, lambda x: F.coalesce(x[side] != x["own"] + step, F.lit(True))), lambda x: x["own"].cast("string")
        )
        return F.array_join(F.zip_with(edge("left", -1), edge("right", 1), lambda a, b: F.concat(a, F.lit("-"), b)), ",")

    return let(F.arrays_zip(numbers.alias("own"), shifted(numbers, 1).alias("left"), shifted(numbers, -1).alias("right")), listed)


def _with_context(lines: Column) -> Column:
    """Of every suspect its place, its text, and two hashes of each line before (nearest first) and after it."""
    hashes = F.flatten(F.transform(lines, lambda x: F.array(F.xxhash64(x), F.xxhash64(F.lit(SECOND), x))))

    def chunks(h: Column) -> Column:
        return F.transform(
            "suspects",
            lambda at: F.struct(
                at.alias("at"), F.concat_ws("\n", F.get(lines, at), F.get(lines, at + 1)).alias("chunk"),
                F.reverse(F.slice(h, 2 * F.greatest(at - REACH, F.lit(0)) + 1, 2 * F.least(at, F.lit(REACH)))).alias("before"),
                F.slice(h, 2 * at + 5, F.lit(2 * REACH)).alias("after"),
            ),
        )

    return let(hashes, chunks)


def _alike(own: Column, other: Column) -> Column:
    """How many lines, of two hashes each, are equal at the front of two arrays."""
    same = F.zip_with(own, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    front = let(same, lambda x: F.when(F.array_contains(x, False), F.array_position(x, False).cast("int") - 1).otherwise(F.size(x)))
    return F.floor(front / 2).cast("int")


def _turn(h: Column) -> Column:
    return F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))


def _by_document(rows: DataFrame, what: str, name: str) -> DataFrame:
    return rows.groupBy("doc_id", "fold").agg(F.sort_array(F.collect_set(what)).alias(name))


def _with(docs: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """Documents with their list; null ids match null ids."""
    side = splittable(lists).select(F.col("doc_id").alias("_id"), F.col("fold").alias("_fold"), name)
    return docs.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fold") == F.col("_fold")), "left").drop("_id", "_fold")
