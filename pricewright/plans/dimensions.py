"""Region, client and product dimensions from the ERP extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.text import code_int, fold_accents, has_digits, norm_key, strip_dashes
from pricewright.operators.filters import exclude_terms, scope_filter
from pricewright.operators.joins import full_coalesce, lookup, one_per_key, splittable, two_pass_lookup
from pricewright.operators.latest import latest_per_key, mode_per_key
from pricewright.operators.reshape import prefix_hierarchy, role_pivot, uom_pivot

LANGUAGE = "P"


def in_language(texts: DataFrame, column: str = "spras", language: str = LANGUAGE) -> DataFrame:
    return texts.where(F.col(column) == language)


def cities(records: DataFrame) -> DataFrame:
    """City dimension from the nested records of the public cities service."""
    # Path in the record -> column.
    fields = {
        "id": "IBGE_ID", "nome": "IBGE_NAME",
        "microrregiao.id": "IBGE_MICRO_ID", "microrregiao.nome": "IBGE_MICRO_NAME",
        "microrregiao.mesorregiao.id": "IBGE_MESO_ID", "microrregiao.mesorregiao.nome": "IBGE_MESO_NAME",
        "microrregiao.mesorregiao.UF.id": "IBGE_UF_ID", "microrregiao.mesorregiao.UF.nome": "IBGE_UF_NAME",
        "microrregiao.mesorregiao.UF.sigla": "IBGE_UF_ACRONYMS",
        "microrregiao.mesorregiao.UF.regiao.id": "IBGE_REGION_ID",
        "microrregiao.mesorregiao.UF.regiao.nome": "IBGE_REGION_NAME",
        "microrregiao.mesorregiao.UF.regiao.sigla": "IBGE_REGION_ACRONYMS",
    }
    return records.select(*[F.col(path).alias(name) for path, name in fields.items()])


CITY_RECORD = (
    "id bigint, nome string, microrregiao struct<id: bigint, nome: string, mesorregiao: struct<id: bigint, "
    "nome: string, UF: struct<id: bigint, sigla: string, nome: string, regiao: struct<id: bigint, sigla: string, "
    "nome: string>>>>"
)


def regions(city: DataFrame, jurisdictions: DataFrame, branches: DataFrame, id_width: int = 7) -> DataFrame:
    """Cities of the public service and of the tax table, with the free-zone flag and the branch.

    The tax code ends in three characters of region and ``id_width`` of city id (seven in the public numbering);
    a region ``ZF*`` marks a free zone of the city instead of a region. ``branches`` holds city, branch and state.
    """
    code = F.trim("TAXJURCODE")
    taxed = jurisdictions.where(
        (F.col("SPRAS") == LANGUAGE) & F.col("COUNTRY").contains("BR") & (code != "TAXJURCODE")
    ).select(
        code.alias("SAP_COD"),
        F.upper(F.trim("TEXT")).alias("SAP_NAME"),
        F.trim("COUNTRY").alias("COUNTRY"),
        F.substring(code, -id_width, id_width).alias("RG_COD_IBGE"),
        F.substring(code, -id_width - 3, 3).alias("RG_REG_SAP"),
    )
    free_zone = F.col("RG_REG_SAP").startswith("ZF")
    zones = taxed.where(free_zone).select("RG_COD_IBGE", F.lit(1).alias("CITY_ZF")).distinct()
    named = latest_per_key(taxed.where(~free_zone), ["RG_COD_IBGE"], [F.col("SAP_COD"), F.col("SAP_NAME")])
    named = lookup(named, zones, ["RG_COD_IBGE"]).withColumn("CITY_ZF", F.coalesce("CITY_ZF", F.lit(0)))

    left = city.withColumns(
        {"_id": code_int(F.col("IBGE_ID").cast("string")), "_nm": F.col("IBGE_NAME"), "_uf": F.col("IBGE_UF_ACRONYMS"),
         "_cod": F.col("IBGE_ID").cast("string")}
    ).withColumnsRenamed({"IBGE_NAME": "IBGE_CITY_NAME", "IBGE_ID": "IBGE_CITY_ID"}).drop("IBGE_UF_ACRONYMS")
    right = named.withColumns(
        {"_id": code_int("RG_COD_IBGE"), "_nm": F.col("SAP_NAME"), "_uf": F.col("RG_REG_SAP"), "_cod": F.col("RG_COD_IBGE")}
    )
    whole = full_coalesce(left, right, "_id", ["_nm", "_uf", "_cod"]).withColumnsRenamed(
        {"_nm": "IBGE_SAP_CITY_NAME", "_uf": "IBGE_UF_ACRONYMS", "_cod": "IBGE_SAP_CITY_ID"}
    ).drop("_id")

    sites = branches.toDF("_city", "_branch", "_state").select(
        norm_key("_city").alias("_key"), F.upper(F.trim("_state")).alias("_uf"), "_branch"
    )
    sites = latest_per_key(sites, ["_key", "_uf"], [F.col("_branch")])
    keyed = whole.withColumns(
        {
            "_key1": norm_key("IBGE_CITY_NAME"), "_key2": norm_key("SAP_NAME"),
            "_uf1": F.upper(F.trim("IBGE_UF_ACRONYMS")), "_uf2": F.upper(F.trim("IBGE_UF_ACRONYMS")),
        }
    )
    found = two_pass_lookup(
        keyed, sites, {"_key1": "_key", "_uf1": "_uf"}, {"_key2": "_key", "_uf2": "_uf"}, "_branch", "BRANCH"
    ).drop("_key1", "_key2", "_uf1", "_uf2")
    return found.withColumn(
        "IBGE_SAP_CITY_NAME", fold_accents(F.upper("IBGE_SAP_CITY_NAME"))
    )


def region_keys(region: DataFrame) -> DataFrame:
    """(city key, state, branch) of the region dimension, for lookups by name; one branch per city and state."""
    keys = {"CITY_KEY": norm_key("IBGE_SAP_CITY_NAME"), "STATE_KEY": F.trim("IBGE_UF_ACRONYMS")}
    return one_per_key(region.select(*[c.alias(n) for n, c in keys.items()], "BRANCH"), list(keys))


def with_branch(df: DataFrame, region: DataFrame, city: str, state: str, label: bool = True) -> DataFrame:
    """Branch of a row by normalised city name and state; the "not found" label on request."""
    keyed = df.withColumns({"CITY_KEY": norm_key(city), "STATE_KEY": F.trim(state)})
    found = lookup(keyed, region_keys(region), ["CITY_KEY", "STATE_KEY"], ["BRANCH"]).drop("CITY_KEY", "STATE_KEY")
    return found.withColumn("BRANCH", F.coalesce("BRANCH", F.lit(values.UNKNOWN_BRANCH))) if label else found


# Column of the ERP -> column of the client dimension.
CLIENT_GENERAL = {
    "LAND1": "COUNTRY", "NAME1": "NAME", "NAME2": "NAME_ADDITION", "ORT01": "CITY", "REGIO": "STATE",
    "INDTYP": "TYPE_INDUSTRY", "ERDAT": "REGISTRATION_DATE",
}
CLIENT_SALES = {
    "KONDA": "PRICE_GROUP", "KVGR1": "ATTENDANCE_GROUP", "LPRIO": "PRIORITY", "LOEVM": "DELETED",
    "VKBUR": "SALES_OFFICE_COD", "VKGRP": "SELLER_GROUP_COD", "KVGR3": "SEGMENTATION_SECTOR", "KDGRP": "SEGMENTATION_GROUP_COD",
}
CLIENT_KEY = ["COD_CLIENT", "ORGANIZATION_SALES_COD", "DISTRIBUTION_CHANNEL_COD", "ACTIVITY_SECTOR_COD"]


def _sales_scope(df: DataFrame, digits: int) -> DataFrame:
    """Rows of the sales organisations in scope with a client code of so many digits, keyed alike."""
    scoped = scope_filter(df, "VKORG", values.SALES_ORGS_WITH_TRADING, exact=True)
    return scoped.where(has_digits("KUNNR", digits)).select(
        code_int("KUNNR").alias("COD_CLIENT"),
        F.col("VKORG").alias("ORGANIZATION_SALES_COD"),
        F.col("VTWEG").alias("DISTRIBUTION_CHANNEL_COD"),
        F.col("SPART").alias("ACTIVITY_SECTOR_COD"),
        *[c for c in df.columns if c not in ("KUNNR", "VKORG", "VTWEG", "SPART")],
    )


def clients(
    general: DataFrame,
    sales: DataFrame,
    partners: DataFrame,
    texts: dict[str, tuple[DataFrame, str, str]],
    digits: int = 9,
) -> DataFrame:
    """Client per sales area: partner numbers by role, sales data, master data and texts.

    Domestic client codes have ``digits`` digits. Every table looked up counts one row per key, its smallest.

    ``texts`` maps one of ORGANIZATION_SALES, DISTRIBUTION_CHANNEL, ACTIVITY_SECTOR, SALES_OFFICE,
    SELLER_GROUP, SEGMENTATION_GROUP to (table in one language, code column, text column).
    """
    number = (
        F.coalesce(code_int("PERNR"), F.lit(0)) + F.coalesce(code_int("KUNN2"), F.lit(0)) + F.coalesce(code_int("LIFNR"), F.lit(0))
    )
    base = role_pivot(_sales_scope(partners, digits), CLIENT_KEY, "PARVW", number)
    area = _sales_scope(sales, digits).withColumnsRenamed(CLIENT_SALES).select(*CLIENT_KEY, *CLIENT_SALES.values())
    master = general.where((F.col("LAND1") == "BR") & has_digits("KUNNR", digits)).select(
        code_int("KUNNR").alias("COD_CLIENT"), *[F.col(c).alias(n) for c, n in CLIENT_GENERAL.items()]
    )
    out = lookup(base, one_per_key(area, CLIENT_KEY), CLIENT_KEY)
    out = lookup(out, one_per_key(master, ["COD_CLIENT"]), ["COD_CLIENT"])
    for name, (table, code, text) in texts.items():
        one = table.select(F.col(code).alias(f"{name}_COD"), F.col(text).alias(f"{name}_DESC"))
        out = lookup(out, one_per_key(one, [f"{name}_COD"]), [f"{name}_COD"])
    return out


def latest_client_state(client: DataFrame) -> DataFrame:
    """State of a client per sales organisation, from its newest registration."""
    newest = client.groupBy("COD_CLIENT", "ORGANIZATION_SALES_COD").agg(
        F.max_by("STATE", F.struct("REGISTRATION_DATE", "STATE")).alias("STATE")
    )
    return splittable(newest)


def products(
    material: DataFrame,
    names: DataFrame,
    sectors: DataFrame,
    material_sales: DataFrame,
    group_texts: DataFrame,
    hierarchy_texts: DataFrame,
    units: DataFrame,
    marketing: DataFrame,
) -> DataFrame:
    """Product per sales organisation: names, groups, unit factors and the seven hierarchy levels.

    ``material_sales`` and ``marketing`` may be counted beforehand: a column ``n_rows`` then says how many rows
    each row stands for.
    """
    weight = "n_rows" if "n_rows" in material_sales.columns else None
    counted = [F.col("n_rows").alias("_n")] if weight else []
    extra_weight = "_n" if "n_rows" in marketing.columns else None
    extra_counted = [F.col("n_rows").alias("_n")] if extra_weight else []
    goods = material.where(F.col("mtart").contains("ZERT")).where(
        F.coalesce(F.trim("mstae"), F.lit("")) == ""
    ).select(
        F.col("MATNR").alias("COD_MATERIAL"), code_int("MATNR").alias("_code"),
        F.col("spart").alias("COD_ACTIVITY_SECTOR"), "prdha",
    )
    titles = in_language(names).select(code_int("matnr").alias("_code"), F.trim("maktx").alias("DESC_MATERIAL"))
    titles = one_per_key(titles, ["_code"])
    out = exclude_terms(lookup(goods, titles, ["_code"]), "DESC_MATERIAL", ["DELET", "DO NOT", "UTILIZAR"], keep_null=False)
    sector = one_per_key(in_language(sectors).select("spart", F.col("vtext").alias("DESC_ACTIVITY_SECTOR")), ["spart"])
    out = lookup(out, sector, {"COD_ACTIVITY_SECTOR": "spart"})

    # Demand group: the most frequent one per material and organisation.
    sold = scope_filter(material_sales, "vkorg", values.SALES_ORGS_WITH_TRADING).select(
        code_int("matnr").alias("_code"), F.trim("vkorg").alias("SALES_ORG_COD"), F.col("mvgr1").alias("COD_GPD"), *counted
    )
    sold = mode_per_key(sold, ["_code", "SALES_ORG_COD"], "COD_GPD", weight=weight and "_n").drop("n_rows")
    out = out.join(sold, "_code")
    group = one_per_key(in_language(group_texts).select("mvgr1", F.col("bezei").alias("DESC_GPD")), ["mvgr1"])
    out = lookup(out, group, {"COD_GPD": "mvgr1"})

    # Marketing and demand breakdown group: both are needed for a product to be in scope.
    extra = marketing.select(
        code_int("MATNR").alias("_code"), F.trim("MARKETINGPRODUCTGROUP").alias("COD_GPM"),
        F.col("DEMANDBREAKDOWNGROUP").alias("DESC_GDD"), *extra_counted,
    )
    for column in ["COD_GPM", "DESC_GDD"]:
        out = out.join(mode_per_key(extra, ["_code"], column, weight=extra_weight).drop("n_rows"), "_code")

    factors = uom_pivot(units.withColumn("_code", code_int("matnr")), material="_code")
    out = lookup(out, factors, ["_code"])
    levels = prefix_hierarchy(
        out.select("prdha").distinct(), "prdha", in_language(hierarchy_texts), "prodh", "vtext"
    )
    levels = levels.withColumnsRenamed(
        {f"{kind}_{i}": f"{kind.upper()}_HIERARCHY_{i}" for kind in ("code", "desc") for i in range(1, 8)}
    ).withColumnsRenamed({f"CODE_HIERARCHY_{i}": f"COD_HIERARCHY_{i}" for i in range(1, 8)})
    return lookup(out, levels, ["prdha"]).withColumn("DESC_MATERIAL", strip_dashes("DESC_MATERIAL")).drop("_code", "prdha")


def product_groups(product: DataFrame) -> DataFrame:
    """(material, organisation) -> demand and marketing group, one row each."""
    groups = latest_per_key(
        product.select(
            code_int("COD_MATERIAL").alias("MATERIAL_KEY"), F.trim("SALES_ORG_COD").alias("ORG_KEY"),
            "COD_GPD", F.trim("DESC_GPD").alias("DESC_GPD"), F.trim("COD_GPM").alias("DESC_GPM"),
        ),
        ["MATERIAL_KEY", "ORG_KEY"],
        [F.col("COD_GPD"), F.col("DESC_GPM")],
    )
    return splittable(groups)


def key_columns(org: str, material: str) -> dict[str, Column]:
    return {"ORG_KEY": F.trim(org), "MATERIAL_KEY": code_int(F.col(material).cast("string"))}
