"""Exact duplicates by a content sort.

Texts are normalised (A-Z to a-z, nothing else) and range-partitioned on their first bytes and a hash of all,
by splitters that Spark samples from all rows (whole texts would make the samples large); each
partition sorts externally by these and the text, which places equal texts side
by side, and a sort aggregate compares neighbours in full and closes a run where the text changes.
A salt is the last range key: splitters fall between the salts of a text as well, so a text
that a third of all rows share is spread over many partitions and comes out as a few runs. Runs
are named by the SHA-256 of their text, combined by it, and joined back to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.common import LOWER, UPPER, ascii_lower, splittable, table, text_or_empty

SALTS = 1024
HEAD_CHARS = 32


def content(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, content): the key and the normalised text of every row."""
    return docs.select(F.col(key).alias("doc_id"), ascii_lower(text_or_empty(F.col(text).cast("string"))).alias("content"))


def runs(rows: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per run of equal neighbours: content, the id it retains and its number of rows."""
    salt = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS))
    head = F.substring("content", 1, HEAD_CHARS)
    placed = rows.withColumns({"head": head, "hash": F.xxhash64("content"), "salt": salt}).repartitionByRange("head", "hash", "salt")
    order = ["head", "hash", "salt", "content"]
    return placed.sortWithinPartitions(*order).groupBy(*order).agg(_retained(F.col("doc_id"), keep).alias("kept"), F.count("*").alias("n"))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, and all empty texts are equal. Of equal texts the row with the
    smallest (or ``keep="largest"``) id stays; rows without an id go unless no row of the group
    has one. Of rows that repeat both the text and the id one is kept. Other columns of ``docs``
    play no part. An empty table gives no rows.
    """
    rows = content(docs, text, key)
    digest = F.unhex(F.sha2(F.col("content").cast("binary"), 256))
    groups = (
        runs(rows, keep)
        .select(digest.alias("digest"), "kept", "n")
        .groupBy("digest")
        .agg(_retained(F.col("kept.id"), keep).alias("kept"), F.sum("n").alias("group_size"))
        .select("digest", F.col("kept.id").alias("keep_id"), "group_size")
    )
    repeats = rows.groupBy(digest.alias("digest"), "doc_id").agg(F.count("*").alias("copies"))
    joined = repeats.join(splittable(groups), "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "digest"
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates among all documents; the largest ``doc_id`` of equal texts stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP3_SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS content FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM n WINDOW same AS (PARTITION BY content)
"""


def _retained(key, keep: str):
    """The retained id as struct(missing or present, id); a row with an id goes before one without."""
    if keep == "largest":
        return F.max(F.struct(key.isNotNull().alias("has"), key.alias("id")))
    return F.min(F.struct(key.isNull().alias("lacks"), key.alias("id")))
