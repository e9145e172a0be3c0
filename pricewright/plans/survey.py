"""Surveyed competitor prices and own prices beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewright import values
from pricewright.functions.codes import channel_label, price_type, region_label, remap_codes, short_org
from pricewright.functions.dates import parse_date
from pricewright.functions.numbers import parse_number
from pricewright.functions.text import code_int, pad_code
from pricewright.operators.catalog import analysis_unit, audit_key, material_label, sample_keys, union_aligned
from pricewright.operators.joins import lookup, one_per_key, overlay, splittable
from pricewright.operators.kpi import month_progress, own_price_ref, price_std, run_rate
from pricewright.operators.price import approve_band, normal_price, price_at_terms, price_per_kg, unit_price
from pricewright.plans.dimensions import with_branch
from pricewright.plans.marts import scoped_billing

# Tag of the survey export -> column.
SURVEY_FIELDS = {
    "Branch_DESC": "Branch", "CCustomerName": "Client_Description", "CIDAnswer": "Answer_Cod", "CIDCity": "City",
    "CIDCompany": "Company", "CIDCustomer": "Client_Cod", "CIDProduct": "Product_Cod", "CIDQuestion": "Search_Cod",
    "CIDState": "State", "CIDTerritory": "Territory_Cod", "CProductName": "Product_Description",
    "CTerritoryName": "Territory_Description", "DCreated": "Date", "NQuantity": "Quantity_Unity", "NSeq": "Seq",
    "NValueICMS": "ICMS", "NValueWithTax": "Price_with_taxes", "SalesmanID": "Seller_Cod",
    "Salesman_DESC": "Seller_Description", "XGrpPrevDem": "GPD", "XGrpProdMkt": "GPM", "XPaymentTerm_DESC": "Payment_Term",
    "XUnitMeasure_DESC": "Unit_Measure", "XCompeting_DESC": "Manufacturer",
}
SURVEY_SCHEMA = ", ".join(f"{tag} string" for tag in SURVEY_FIELDS)

COLLECT_COLUMNS = [
    "day", "org", "gpm", "gpd", "product_cod", "product", "seller_cod", "seller", "client_cod", "client", "city", "state",
    "branch", "region", "maker", "unit", "term", "channel", "price_with_taxes", "price_terms", "price_kg", "sample_mean",
    "pre_approved", "approved", "days_elapsed", "days_remaining", "in_sector",
]


def survey_rows(survey: DataFrame) -> DataFrame:
    """The field survey in common columns; it is always the distribution organisation's."""
    return survey.select(
        F.to_date(F.substring("Date", 1, 10)).alias("day"), F.lit("CG").alias("org"), F.col("GPM").alias("gpm"),
        F.col("GPD").alias("gpd"), F.col("Product_Cod").alias("product_cod"), F.col("Product_Description").alias("product"),
        F.col("Seller_Cod").alias("seller_cod"), F.col("Seller_Description").alias("seller"),
        F.col("Client_Cod").alias("client_cod"), F.col("Client_Description").alias("client"), F.col("City").alias("city"),
        F.col("State").alias("state"), F.col("Manufacturer").alias("maker"), F.col("Unit_Measure").alias("unit"),
        F.col("Payment_Term").alias("term"), F.lit("Distribuição-Mercado").alias("channel"),
        parse_number("Price_with_taxes").alias("price_with_taxes"),
    )


def crm_rows(prices: DataFrame, accounts: DataFrame, users: DataFrame, products: DataFrame, shares: DataFrame) -> DataFrame:
    """CRM competitor prices with account, seller and product, in common columns.

    ``prices`` refers to a market share by id, which refers to account, owner and product.
    """
    rows = lookup(prices.where(F.col("price").isNotNull()), shares, {"share_id": "id"}, ["account_id", "owner_id", "product_id"])
    rows = lookup(rows, accounts, {"account_id": "id"}, ["client_cod", "client", "city", "state", "office"])
    rows = lookup(rows, users, {"owner_id": "id"}, ["seller_cod", "seller"])
    rows = lookup(rows, products, {"product_id": "id"}, ["product_cod", "product", "gpm", "gpd"])
    return rows.select(
        parse_date("created", "yyyy/MM/dd").alias("day"), short_org(F.substring("org_code", 1, 4), "office", "seller_cod").alias("org"),
        "gpm", "gpd", code_int("product_cod").cast("string").alias("product_cod"), "product", "seller_cod", "seller",
        pad_code("client_cod").alias("client_cod"), "client", "city", "state", F.col("competitor").alias("maker"), "unit", "term",
        F.col("price_type").alias("channel"), parse_number(F.col("price").cast("string")).alias("price_with_taxes"),
    )


def collected_prices(
    rows: DataFrame,
    terms: DataFrame,
    product: DataFrame,
    region: DataFrame,
    as_of: str,
    units: list[tuple[str, str]] | None = None,
    home: DataFrame | None = None,
    clients: DataFrame | None = None,
) -> DataFrame:
    """Surveyed prices brought to the reference term and to one kg, approved per sample.

    ``terms`` holds (term, pct), of several rates of a term the smallest; the unit factors are read from the product
    dimension, one row per material. A price whose city has no branch takes the agent's home branch
    (``home``: seller_cod, branch), and with ``clients`` (the result of ``client_sector``) it says whether the client is
    in the sector.
    """
    rates = one_per_key(terms.select(F.trim("term").alias("term_key"), "pct"), ["term_key"])
    out = lookup(rows.withColumn("term_key", F.trim("term")), rates, ["term_key"], ["pct"]).drop("term_key")
    factors = product.groupBy(code_int("COD_MATERIAL").alias("material_key")).agg(
        *[F.max(u).alias(u) for u in values.UNIT_CODES]
    )
    out = lookup(out.withColumn("material_key", code_int("product_cod")), splittable(factors), ["material_key"], values.UNIT_CODES)
    out = out.withColumn("price_terms", price_at_terms("price_with_taxes", "pct")).withColumn(
        "price_kg", unit_price("price_terms", "unit", units)
    )
    out = with_branch(out, region, "city", "state", label=False).withColumnRenamed("BRANCH", "branch")
    if home is not None:
        own = one_per_key(home.select("seller_cod", F.col("branch").alias("_home")), ["seller_cod"])
        out = lookup(out, own, ["seller_cod"]).withColumn("branch", F.coalesce("branch", "_home")).drop("_home")
    out = out.withColumn("region", region_label("branch"))
    sector = F.lit(None).cast("string")
    if clients is not None:
        marks = clients.groupBy(F.col("COD_CLIENT").alias("_client")).agg(F.max("IN_SECTOR").alias("_sector"))
        out = lookup(out.withColumn("_client", code_int("client_cod")), splittable(marks), ["_client"])
        sector = F.coalesce("_sector", F.lit(values.NO))
    out = out.withColumn("in_sector", sector)
    banded = approve_band(out, ["org", "branch", "product_cod"], "price_kg")
    return month_progress(banded, "day", as_of).select(*COLLECT_COLUMNS).distinct()


def own_price_reference(billing: DataFrame, region: DataFrame, collects: DataFrame) -> DataFrame:
    """Own price per organisation, material, branch and channel by day and ISO week."""
    rows = scoped_billing(billing).withColumns(
        {
            "price": price_per_kg(normal_price(org="SALES_ORG_COD"), "quantity_ton"),
            "channel": price_type("SALES_ORG_COD"),
            "order_day": parse_date(F.col("SALES_ORDER_DATE").cast("string"), "yyyyMMdd"),
            "org": F.substring("SALES_ORG_COD", 3, 2),
            "product_cod": code_int("MATERIAL_COD").cast("string"),
        }
    )
    found = with_branch(rows, region, "ISSUING_CITY", "ISSUING_STATE", label=False).where(F.col("BRANCH").isNotNull())
    return own_price_ref(
        found.withColumnRenamed("BRANCH", "branch"),
        collects.withColumnRenamed("day", "ref_date"),
        ["org", "product_cod", "branch", "channel"],
        "price",
        "BILLING_DATE",
        "order_day",
        F.col("SALES_ORG_COD") == values.RESALE_ORG,
    )


def collect_mart(
    sources: list[DataFrame], own: DataFrame, capacity: DataFrame, product: DataFrame, as_of: str
) -> DataFrame:
    """All surveyed prices with the own price of the day and week, pace, spread and labels."""
    rows = union_aligned(sources, COLLECT_COLUMNS)
    groups = product.groupBy(code_int("COD_MATERIAL").alias("material_key")).agg(
        F.min(F.struct(F.col("COD_GPM").alias("gpm"), F.col("DESC_GPD").alias("gpd"), F.col("DESC_MATERIAL").alias("text"))).alias("g")
    ).select("material_key", F.col("g.gpm").alias("new_gpm"), F.col("g.gpd").alias("new_gpd"), F.col("g.text").alias("new_text"))
    rows = overlay(
        rows.withColumn("material_key", code_int("product_cod")), splittable(groups), ["material_key"],
        {"gpm": "new_gpm", "gpd": "new_gpd", "product": "new_text"},
    ).drop("material_key")

    keys = ["org", "product_cod", "branch", "channel"]
    days = one_per_key(own.select(*keys, F.col("ref_date").alias("day"), "day_mean", "day_count"), [*keys, "day"])
    weeks = own.where(F.col("week_mean") > 0).select(*keys, "iso_year", "iso_week", "week_mean")
    weeks = one_per_key(weeks, [*keys, "iso_year", "iso_week"])
    rows = lookup(rows, days, [*keys, "day"])
    rows = rows.withColumns({"iso_year": F.extract(F.lit("YEAROFWEEK"), "day"), "iso_week": F.weekofyear("day")})
    rows = lookup(rows, weeks, [*keys, "iso_year", "iso_week"]).drop("iso_year", "iso_week")

    pace = run_rate(rows, capacity, "branch", "day", "approved", as_of).select("branch", "month", "status")
    rows = lookup(rows.withColumn("month", F.trunc("day", "month")), pace, ["branch", "month"]).drop("month")
    rows = price_std(rows, ["org", "branch", "maker", "channel"], "price_kg", "approved")
    rows = rows.withColumns(
        {
            "channel_label": channel_label("channel"),
            "material": material_label("product_cod", "product"),
        }
    ).withColumns(
        {
            "analysis_unit": analysis_unit("org", "region", "material"),
            "audit_key": audit_key(
                "day", "client_cod", "maker", "seller_cod", "unit", "channel", "branch", "product_cod", "city", "org", "price_with_taxes"
            ),
        }
    )
    return sample_keys(rows, "org", "product_cod", "branch", "channel", "seller_cod", "day")


def client_sector(client: DataFrame, sector: str = "083") -> DataFrame:
    """Clients of one sector (fixed value 083), organisations merged."""
    return client.select(
        "COD_CLIENT", remap_codes("ORGANIZATION_SALES_COD").alias("ORGANIZATION_SALES_COD"),
        F.when(F.col("SEGMENTATION_SECTOR") == sector, values.YES).otherwise(values.NO).alias("IN_SECTOR"),
    ).distinct()


def form_rows(form: DataFrame) -> DataFrame:
    """Prices of the public form: text numbers parsed, missing columns left to the union."""
    numbers = [c for c in ["price_with_taxes", "price_terms", "price_kg", "day_mean", "week_mean"] if c in form.columns]
    return form.withColumns({c: parse_number(F.col(c).cast("string")) for c in numbers})
