"""All query families in one place."""

from __future__ import annotations

from pricewright.queries import assembly, dims, jobs, margins, pricing, reports, selection, stored, targets

FAMILIES = [selection, pricing, margins, targets, assembly, dims, jobs, stored, reports]


def queries() -> dict:
    return {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
