"""Code re-labelling (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pricewright import values
from pricewright.functions.numbers import column
from pricewright.functions.text import contains_any


def case_of(c: Column | str, mapping: dict[str, str]) -> Column:
    """The mapped text, null where the code is not in the map."""
    chain = F
    for old, new in mapping.items():
        chain = chain.when(column(c) == old, F.lit(new))
    return chain


def remap_codes(c: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """Merge codes; a code outside the map is kept."""
    mapping = values.SALES_ORG_MERGE if mapping is None else mapping
    return case_of(c, mapping).otherwise(column(c))


def default_label(c: Column | str, text: str) -> Column:
    return F.coalesce(column(c), F.lit(text))


def customer_group(
    group: Column | str, own_name: Column | str, generic: str = values.GENERIC_CUSTOMER_GROUP
) -> Column:
    """A customer without a group of its own stands for itself."""
    group = column(group)
    return F.when(group.isNull() | (group == generic), column(own_name)).otherwise(group)


def price_type(
    org: Column | str,
    rules: list[tuple[str, str]] | None = None,
    other: str = values.CHANNEL_OTHER,
) -> Column:
    """Sale channel of an organisation; the first rule whose text is contained wins."""
    chain = F
    for part, channel in rules or values.CHANNEL_BY_ORG:
        chain = chain.when(column(org).contains(part), F.lit(channel))
    return chain.otherwise(F.lit(other))


# Region as the branch name has it -> region.
REGION_NAMES = {"SAO": "São Paulo", "São J. Campos": "São José dos Campos"}


def region_label(branch: Column | str) -> Column:
    """Region of a branch: its name without the first word, corrected where it is cut short."""
    name = F.substring(column(branch), F.lit(7), F.length(column(branch)))
    return case_of(F.trim(name), REGION_NAMES).otherwise(name)


def channel_label(
    channel: Column | str,
    labels: dict[str, str] | None = None,
    other: str = values.CHANNEL_LABEL_OTHER,
) -> Column:
    return case_of(channel, labels or values.CHANNEL_LABELS).otherwise(F.lit(other))


def short_org(org: Column | str, office: Column | str, agent: Column | str) -> Column:
    """Two-letter organisation of a CRM price: from the organisation, else from the office."""
    org = column(org)
    by_org = (
        F.when(contains_any(org, ["CC", "CO"]), "CC")
        .when(contains_any(org, ["DI", "DO"]), "DI")
        .otherwise("IN")
    )
    by_office = F.when(F.coalesce(column(office).contains("DI"), F.lit(False)), "DI").otherwise("CC")
    short = F.when(org.isNull(), by_office).otherwise(by_org)
    # Fixed value: agent A61 always sells for DI.
    return F.when(column(agent) == "A61", "DI").otherwise(short)
