"""Sources: parquet extracts, delimited files, query results, JSON and XML records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pricewright.operators.reshape import split_json


def read_table(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Parquet scan; name the columns so only they are read.

    With a stated schema no job has to open the files for it first.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def read_extracts(
    spark: SparkSession, directory: str, extra: list[str] | None = None, drop: tuple[str, ...] = ("year", "month", "day")
) -> list[DataFrame]:
    """A landing directory and single extra files beside it, without the landing partitions."""
    return [spark.read.parquet(p).drop(*drop) for p in [directory, *(extra or [])]]


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ";", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Delimited file with header and a stated schema; all text unless the schema says otherwise."""
    return spark.read.schema(schema).options(header=True, sep=sep, encoding=encoding).csv(path)


def read_result(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Comma-separated result of an SQL service, typed by the stated schema."""
    return spark.read.schema(schema).options(header=True, sep=",", encoding="UTF-8", escape='"').csv(path)


def split_delimited(
    spark: SparkSession, path: str, schema: StructType, sep: str = ";", encoding: str = "ISO-8859-1", raw: str = "raw_line"
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, damaged lines) of a delimited file with header; every line is in one of the two.

    A line with fewer or more fields than the schema, or a field of another type, is damaged: it keeps the fields that
    could be read and its text in ``raw``.
    """
    whole = spark.read.schema(StructType([*schema.fields]).add(raw, "string")).options(
        header=True, sep=sep, encoding=encoding, mode="PERMISSIVE", columnNameOfCorruptRecord=raw
    ).csv(path)
    # A field that nothing asks for is not parsed and cannot be found damaged, so the test asks for all of them.
    fields = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields]))
    damaged = F.col(raw).isNotNull() & (fields >= 0)
    return whole.where(~damaged).drop(raw), whole.where(damaged)


def split_json_records(
    spark: SparkSession, path: str, schema: str, fields: dict[str, str], raw: str = "raw_line"
) -> tuple[DataFrame, DataFrame]:
    """(records flattened, damaged lines) of a file with one JSON record per line; blank lines are damaged."""
    return split_json(spark.read.text(path).withColumnRenamed("value", raw), raw, schema, fields)


def read_json_records(
    spark: SparkSession, path: str, schema: StructType | str, fields: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """JSON records flattened: ``fields`` maps a dotted path to a column name.

    One record per line, so that large files split; ``multi_line`` reads a document that spans lines, one
    task per file.
    """
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return raw.select(*[F.col(p).alias(n) for p, n in fields.items()])


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, schema: StructType | str, fields: dict[str, str] | None = None
) -> DataFrame:
    """XML export, one row per ``row_tag``; enclosing envelope tags are not read."""
    raw = spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)
    return raw.select(*[F.col(p).alias(n) for p, n in fields.items()]) if fields else raw


def read_review_sheet(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Review sheet returned by the auditors (pipe-separated, Western encoding)."""
    return read_delimited(spark, path, schema, sep="|")


def all_text(names: list[str]) -> StructType:
    """Schema of a file whose every column is text."""
    schema = StructType()
    for name in names:
        schema = schema.add(name, "string")
    return schema
