"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time from 0 to 1, linear between knots. Its integral
is the source's weight; the weights share out the words of all sources. A target stops at
``max_repeat`` times its source's words, and the excess goes to the others by weight until none is
above: with a level L, every target is min(max_repeat * words, L * weight), and L solves that the
targets sum to the whole. L is the largest, over sources sorted by how soon they fill, of
(whole - what fuller sources hold) / (weights of the rest).

A source delivers its documents in the order of a digest of their ids, pass after pass, until its
target is reached; the last pass takes a document whose middle still lies within the target. A
document copy begins at some offset of its source's stream; inverting the cumulative demand
target * integral(schedule, 0..t) / weight at the offset gives its training position, and the mix is
the copies range-sorted by position.

Offsets are prefix sums in two levels: digests fall into 4096 even buckets per source, buckets add
up before rows do, and rows are summed within their bucket only. A hot source is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pricewright.llm.common import cut_lineage, splittable, table, text_or_empty, word_count

Schedule = list[tuple[float, float]]

# Weights 5, 2 and 1: the first fades out, the second grows, the third stays.
SCHEDULES: list[Schedule] = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 1.0), (1.0, 3.0)], [(0.0, 1.0), (1.0, 1.0)]]
MAX_REPEAT = 3
BUCKET_DIGITS = 3


def area(schedule: Schedule) -> float:
    """Integral of a schedule over its knots."""
    return sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(schedule, schedule[1:]))


def time_of(schedule: Schedule, share: Column) -> Column:
    """Training time at which a share (0 to 1) of the schedule's integral has been delivered."""
    whole, done, result = area(schedule), 0.0, F.lit(schedule[-1][0])
    segments = []
    for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
        segments.append((t0, a, (b - a) / (t1 - t0), done))
        done += (t1 - t0) * (a + b) / 2
    for (t0, a, slope, before), end in reversed(list(zip(segments, [s[3] for s in segments[1:]] + [whole]))):
        y = share * whole - before
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * y, F.lit(0.0)))
        inside = F.lit(t0) + F.coalesce(F.try_divide(2 * y, F.lit(a) + root), F.lit(0.0))
        result = F.when(share * whole < end, inside).otherwise(result)
    return result


def targets(sizes: DataFrame, schedules: list[Schedule] = SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, kind, target) from (source, source_size), one row per source.

    Sources by code point, null last, take the schedules in turn (``kind`` is the one taken). The
    windows run over one row per source.
    """
    rank = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules)
    weight = F.element_at(F.array(*[F.lit(area(s)) for s in schedules]), F.col("kind") + 1)
    full = (F.lit(max_repeat) * F.col("source_size")).cast("long")
    by_fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    return (
        sizes.withColumn("kind", rank)
        .withColumns({"weight": weight, "full": full, "whole": F.sum("source_size").over(everything)})
        .withColumns({
            "held": F.coalesce(F.sum("full").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "rest": F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)),
        })
        .withColumn("level", F.max((F.col("whole") - F.col("held")).cast("double") / F.col("rest")).over(everything))
        .withColumn("target", F.least(F.col("full").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "kind", "target")
    )


def mix_plan(
    docs: DataFrame, schedules: list[Schedule] = SCHEDULES, max_repeat: int = MAX_REPEAT, with_rows: bool = False
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, passes, taken, position (of its first copy), and
    its schedule (kind) and offset (before).

    Null texts and texts without words have size 0 and are taken 0 times; a null source is a
    source of its own. Rows that repeat an id are separate documents with equal digests. Reruns give the
    same plan. ``with_rows`` adds the whole row as a struct. An empty table gives no rows.
    """
    slim = docs.select(
        *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * with_rows,
        F.col("doc_id"), F.col("source"), word_count(text_or_empty()).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("digest"),
    ).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    buckets = cut_lineage(slim.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    sources = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, max_repeat)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        buckets.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .alias("b").join(sources.alias("s"), F.expr("b.source <=> s.source"))
        .select("b.source", "b.bucket", "base", "source_size", "kind", "target")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("digest", "doc_id", "size")
    offset = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        slim.withColumn("offset", offset)
        .alias("d").join(splittable(starts).alias("t"), F.expr("d.source <=> t.source AND d.bucket = t.bucket"))
        .select("d.*", "source_size", "kind", "target", (F.col("base") + F.col("offset")).alias("before"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    fits = 2 * F.col("before") + F.col("size") <= 2 * (F.col("target") - F.col("whole") * F.col("source_size"))
    found = placed.withColumn("whole", whole).withColumn(
        "passes", F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + F.when(fits, 1).otherwise(0)).cast("int")
    )
    first = position(F.col("before"), schedules)
    return found.select(
        *["row"] * with_rows, "doc_id", "size", "source_size", "target", "passes",
        (F.col("size") * F.col("passes")).cast("long").alias("taken"),
        F.when(F.col("passes") > 0, first).alias("position"), "kind", "before",
    )


def position(offset: Column, schedules: list[Schedule] = SCHEDULES) -> Column:
    """Training position of a stream offset: the inverse of the source's cumulative demand."""
    share = F.coalesce(F.try_divide(offset.cast("double"), F.col("target")), F.lit(0.0))
    chosen = F.lit(None).cast("double")
    for kind, schedule in enumerate(schedules):
        chosen = F.when(F.col("kind") == kind, time_of(schedule, share)).otherwise(chosen)
    return chosen


def mix(docs: DataFrame, schedules: list[Schedule] = SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix: documents as often as they are taken, range-sorted by training position."""
    plan = mix_plan(docs, schedules, max_repeat, with_rows=True).where("passes > 0")
    copies = plan.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    placed = copies.withColumn("position", position(F.col("before") + F.col("copy") * F.col("source_size"), schedules))
    ordered = placed.select("row", "position", "doc_id", "copy").repartitionByRange("position", "doc_id")
    return ordered.sortWithinPartitions("position", "doc_id", "copy").select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, weights 5, 2, 1 in turn, at most three copies of a document.

    Rows are range-sorted by the training position of their first copy; a copy that is not taken has no position.
    """
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    at = [F.when(F.col("passes") > n, position(F.col("before") + n * F.col("source_size"))) for n in range(MAX_REPEAT)]
    names = [f"position_{n + 1}" for n in range(MAX_REPEAT)]
    rows = plan.select("doc_id", "size", "source_size", "target", "taken", *[p.alias(name) for p, name in zip(at, names)])
    return rows.repartitionByRange(names[0], "doc_id").sortWithinPartitions(names[0], "doc_id")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (SELECT *, max(CAST(sum_all - held AS DOUBLE) / rest) OVER () AS level FROM (
  SELECT *, sum(source_size) OVER () AS sum_all,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rest
  FROM w WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)) AS a),
t AS (SELECT source, source_size, weight, least(CAST(3 * source_size AS DOUBLE), level * weight) AS target FROM l),
p AS (
  SELECT doc_id, size, source_size, target, weight,
         -- The schedules: first value, slope and integral of each weight.
         CASE weight WHEN 5 THEN 7.5 ELSE 1.0 END::DOUBLE AS a, CASE weight WHEN 5 THEN -5.0 WHEN 2 THEN 2.0 ELSE 0.0 END::DOUBLE AS slope,
         weight::DOUBLE AS whole_area,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * passes AS BIGINT) AS taken, POSITIONS
FROM (SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END END AS passes FROM p) AS q
"""
_DUE = "coalesce(CAST(before + {n} * source_size AS DOUBLE) / nullif(target, 0), 0.0) * whole_area"
OP9_SQL = OP9_SQL.replace(
    "POSITIONS",
    ", ".join(
        f"CASE WHEN passes > {n} THEN CASE WHEN {due} < whole_area"
        f" THEN coalesce(2 * ({due}) / nullif(a + sqrt(greatest(a * a + 2 * slope * ({due}), 0)), 0), 0.0) ELSE 1.0 END END AS position_{n + 1}"
        for n in range(MAX_REPEAT) for due in [_DUE.format(n=n)]
    ),
)
