"""All registered queries and their SQL checks by name."""

from riskloom.catalog import aggregates, cleaning, dashboards, histories, qualities, scoring, sources, streams
from riskloom.catalog.base import Query

FAMILIES = [sources, cleaning, scoring, histories, aggregates, dashboards, qualities, streams]


def queries() -> dict[str, Query]:
    return {name: q for family in FAMILIES for name, q in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
