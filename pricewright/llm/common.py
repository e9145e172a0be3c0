"""What the text operators share: words, ASCII folding, cut lineage, table access.

A word is ``[^\\x20\\x09-\\x0D]+`` everywhere. Texts are folded on A-Z only, so that folding never
changes the number of code points or bytes.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import pricewright.llm
from pricewright.operators.joins import splittable
from pricewright.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows of one Arrow batch; a Python worker holds a few batches at a time.
ARROW_ROWS = "1000"

# Rows of a side that is broadcast: a few megabytes of narrow rows.
SMALL_ROWS = 10_000

# Functions that run in Python workers travel with their code; executors need no copy of this folder.
cloudpickle.register_pickle_by_value(pricewright.llm)

__all__ = [
    "SPACE", "WORD", "ascii_lower", "cut_lineage", "small_side", "splittable", "table", "text_or_empty",
    "word_count", "word_list",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(side: DataFrame, most_rows: int = SMALL_ROWS) -> DataFrame:
    """A side to look up: broadcast if a count shows it small, else left to a shuffled join.

    For tables of narrow rows that are already computed, so that the count costs nothing.
    """
    return F.broadcast(side) if side.limit(most_rows + 1).count() <= most_rows else splittable(side)


def text_or_empty(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; one pass of bytes where the text is ASCII."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_list(text: Column) -> Column:
    """The words in order; none for an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")
