"""Support tables: typed loads of the manually kept ';' files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.dates import as_of_date, month_label, parse_date
from pricewright.functions.numbers import parse_number


def _monthly(df: DataFrame, day: str, value: str, day_name: str, value_name: str, as_of: str | Column) -> DataFrame:
    date = parse_date(F.col(f"`{day}`"), "dd/MM/yyyy")
    return df.select(
        date.alias(day_name), parse_number(F.col(f"`{value}`")).alias(value_name),
        month_label(date, "MM/yyyy").alias("CIVIL_MONTH_YEAR"), F.year(date).alias("YEAR_SHARE"), F.month(date).alias("MONTH_SHARE"),
        as_of_date(as_of).alias("DT_UPDATE"),
    ).distinct()


def share(df: DataFrame, as_of: str) -> DataFrame:
    """Market share per month."""
    return _monthly(df, "MES", "SHARE", "DT_SHARE", "SHARE_RESULT", as_of)


def scrap(df: DataFrame, as_of: str) -> DataFrame:
    """Scrap result per month."""
    return _monthly(df, "Ano civil/mês", "Resultado global", "DT_SCRAP", "SCRAP_GLOBAL_RESULT", as_of)


def budget(df: DataFrame) -> DataFrame:
    """Budget per month, group, organisation and state."""
    return df.select(
        F.col("GPM").alias("GPM_COD"), F.col("GPD").try_cast("int").alias("GPD_COD"), F.col("`GPD Desc`").alias("GPD_DESC"),
        F.col("OV").alias("SALES_ORG_COD"), F.col("`UF Recebedor `").alias("STATE"), parse_number("Volume").alias("VOLUME"),
        parse_number("RLV").alias("RLV"), month_label(parse_date("DATA", "dd/MM/yyyy"), "yyyyMM").alias("MONTH_YEAR"),
    ).distinct()


def calendar(df: DataFrame) -> DataFrame:
    """Calendar with typed dates and a weekend flag."""
    dates = ["CURRENT_DATE", "LMONTH_DATE", "L2MONTHS_DATE", "LYEAR_DATE"]
    return df.withColumns(
        {
            **{d: parse_date(f"`{d}`", "dd/MM/yyyy") for d in dates if d in df.columns},
            "IS_WEEKEND": F.upper(F.trim(F.col("CURRENT_WEEKEND").cast("string"))) == "TRUE",
        }
    ).distinct()


def typed(df: DataFrame, numbers: list[str]) -> DataFrame:
    """A plain support table (premium targets, policy limits, approval ranges, access) with its numbers parsed."""
    return df.withColumns({c: parse_number(F.col(f"`{c}`")) for c in numbers}).distinct()


# Column of the product traits file -> column.
PRODUCT_TRAITS = {
    "Setor de atividade (Material) COD": "Setor_ATIVIDADE_COD", "Setor de atividade (Material) DESC": "Setor_ATIVIDADE_DESC",
    "GPM (BR) Grp Prod Mkt COD": "COD_GPM", "GPM (BR) Grp Prod Mkt DESC": "DESC_GPM", "GPD (BR) Grp Prev Dem COD": "COD_GPD",
    "GPD (BR) Grp Prev Dem DESC": "DESC_GPD", "GDD (BR) Grp Desag Demanda COD": "COD_GDD",
    "GDD (BR) Grp Desag Demanda DESC": "DESC_GDD", "Material COD": "Material_COD",
}


def product_traits(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in PRODUCT_TRAITS.items()])
