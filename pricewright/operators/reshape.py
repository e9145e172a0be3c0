"""Pivots, unpivots, code hierarchies and record flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from pricewright import values
from pricewright.functions.numbers import exact_mean, ratio
from pricewright.operators.joins import lookup, one_per_key, splittable


def prefix_hierarchy(
    codes: DataFrame,
    code: str,
    texts: DataFrame,
    text_code: str,
    text: str,
    lengths: list[int] | None = None,
) -> DataFrame:
    """One code and one description per prefix level; a text belongs to the level of its code's length.

    The different codes are exploded into their prefixes, which look up their texts in one join; an aggregate puts
    the texts of a code back into one row. A prefix many codes share is a hot key of that join and split as such. A
    code shorter than a level, and a level without a text, has no description there.
    """
    lengths = lengths or values.HIERARCHY_LENGTHS
    levels = range(1, len(lengths) + 1)
    prefix = {level: F.substring(code, 1, size) for level, size in zip(levels, lengths)}
    known = texts.where(F.length(text_code).isin(*lengths)).select(F.col(text_code).alias("_prefix"), F.col(text).alias("_text"))
    whole = [F.when(F.length(p) == size, p) for p, size in zip(prefix.values(), lengths)]
    asked = codes.select(code).distinct().select(F.col(code).alias("_code"), F.posexplode(F.array(*whole)).alias("_level", "_prefix"))
    found = asked.join(one_per_key(known, ["_prefix"]), "_prefix")
    described = found.groupBy("_code").agg(*[F.max(F.when(F.col("_level") == n - 1, F.col("_text"))).alias(f"desc_{n}") for n in levels])
    out = lookup(codes.withColumns({f"code_{n}": p for n, p in prefix.items()}), splittable(described), {code: "_code"})
    return out.select(*codes.columns, *[f"{kind}_{n}" for n in levels for kind in ("code", "desc")])


def pivot_mean(
    df: DataFrame, keys: list[str], label: str, value: Column | str, labels: dict[str, str], digits: int = 6
) -> DataFrame:
    """Mean of ``value`` per label as columns, 0 where a key lacks the label.

    The labels are stated, so there is no extra pass to find them.
    """
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(
        *[
            F.coalesce(
                exact_mean(F.when(F.col(label) == code, value), digits),
                F.lit(0.0),
            ).alias(name)
            for code, name in labels.items()
        ]
    )


def uom_pivot(
    units: DataFrame,
    material: str = "matnr",
    unit: str = "meinh",
    numerator: str = "umrez",
    denominator: str = "umren",
    labels: list[str] | None = None,
) -> DataFrame:
    """Mean conversion factor per (material, unit) as columns, 0 where a unit is missing."""
    factors = units.withColumn("_factor", ratio(numerator, denominator))
    names = {u: u for u in (labels or values.UNIT_CODES)}
    return pivot_mean(factors, [material], unit, "_factor", names, digits=10)


def role_pivot(
    partners: DataFrame, keys: list[str], role: str, number: Column | str, roles: dict[str, str] | None = None
) -> DataFrame:
    """Partner number per role as columns, 0 where a role is missing."""
    wide = pivot_mean(partners, keys, role, number, roles or values.PARTNER_ROLES)
    names = list((roles or values.PARTNER_ROLES).values())
    return wide.withColumns({n: F.col(n).cast("bigint") for n in names})


def unpivot_measures(
    wide: DataFrame, ids: list[str], measures: list[str], label: str, value: str, floor: bool = True
) -> DataFrame:
    """One row per (ids, measure); a missing or, with ``floor``, negative value counts 0."""
    tall = wide.unpivot(ids, measures, label, value)
    amount = F.coalesce(F.col(value), F.lit(0))
    return tall.withColumn(value, F.greatest(amount, F.lit(0)) if floor else amount)


def target_key(agent: Column, org: Column, state: Column, branch: Column | None = None) -> Column:
    """Key text of one line of the target sheet: agent[_branch|]orgstate."""
    parts = [F.upper(F.trim(agent))]
    if branch is not None:
        parts += [F.lit("_"), branch, F.lit("|")]
    return F.upper(F.trim(F.concat(*parts, org, state)))


def parse_target_key(df: DataFrame, key: str, with_branch: bool) -> DataFrame:
    """Agent, organisation, state and branch read back from the key text.

    Organisation and state are the last four characters. The branch text stands between the
    last ``_`` and the ``|``, so an agent code may hold ``_`` itself.
    """
    text = F.col(key)
    state = F.substring(text, -2, 2)
    org = F.substring(text, -4, 2)
    if with_branch:
        head = F.substring_index(text, "|", 1)
        branch = F.substring_index(head, "_", -1)
        agent = F.substring(head, F.lit(1), F.length(head) - F.length(branch) - 1)
    else:
        agent = F.substring(text, F.lit(1), F.length(text) - 4)
        branch = F.concat(F.lit("Vendas "), state)
    return df.withColumns(
        {"agent_cod": agent, "org_short": org, "state": state, "branch": branch}
    )


# Field in which the parsers leave a record they cannot read whole.
DAMAGED = "_damaged"


def flatten_json(df: DataFrame, col: str, schema: str | StructType, fields: dict[str, str]) -> DataFrame:
    """JSON text to columns; ``fields`` maps a dotted path to an output name. ``split_json`` keeps damaged records apart."""
    parsed = df.withColumn("_rec", F.from_json(col, schema))
    keep = [F.col(c) for c in df.columns if c != col]
    return parsed.select(*keep, *[F.col(f"_rec.{p}").alias(n) for p, n in fields.items()])


def flatten_xml(df: DataFrame, col: str, schema: str, fields: dict[str, str]) -> DataFrame:
    """XML record text to columns; tags outside ``fields`` (envelopes) are dropped. ``split_xml`` keeps damaged records apart."""
    parsed = df.withColumn("_rec", F.from_xml(col, schema))
    keep = [F.col(c) for c in df.columns if c != col]
    return parsed.select(*keep, *[F.col(f"_rec.{p}").alias(n) for p, n in fields.items()])


def split_json(df: DataFrame, col: str, schema: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(records flattened, damaged records as they came): every row is in one of the two.

    Damaged is a text that is not one JSON record, one with a field of another type than ``schema`` states, and a null or blank one.
    The rejected rows keep all columns, the text among them. ``schema`` is a DDL list of fields.
    """
    record = F.from_json(col, f"{schema}, {DAMAGED} string", {"columnNameOfCorruptRecord": DAMAGED})
    # The parser stops behind the first record; what follows it shows in the length of an array around the text.
    alone = F.json_array_length(F.concat(F.lit("["), F.col(col), F.lit("]"))) == 1
    return _split(df, col, F.when(alone, record), fields)


def split_xml(df: DataFrame, col: str, schema: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The same for XML record texts."""
    return _split(df, col, F.from_xml(col, f"{schema}, {DAMAGED} string", {"columnNameOfCorruptRecord": DAMAGED}), fields)


def _split(df: DataFrame, col: str, record: Column, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    parsed = df.withColumn("_rec", record)
    damaged = F.col("_rec").isNull() | F.col(f"_rec.{DAMAGED}").isNotNull() | (F.trim(col) == "")
    keep = [F.col(c) for c in df.columns if c != col]
    valid = parsed.where(~damaged).select(*keep, *[F.col(f"_rec.{p}").alias(n) for p, n in fields.items()])
    return valid, parsed.where(damaged).select(*df.columns)
