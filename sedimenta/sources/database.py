"""Reads over JDBC.

A read without split settings runs in one task, which is fine for control
tables only; large tables take a :class:`Split` or ``predicates``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sedimenta.config import Rule, TableConfig


@dataclass(frozen=True)
class Split:
    """Value range of a numeric, date or timestamp column, read in ``parts`` tasks."""

    column: str
    lower: str | int
    upper: str | int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def jdbc_options(
    url: str,
    relation: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": relation, "fetchsize": str(fetch_size), **(properties or {})}
    if split is not None:
        options.update(split.options())
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole table.  ``predicates`` gives one task per condition (for skewed columns)."""
    if predicates is not None:
        if split is not None:
            raise ValueError("give split or predicates, not both")
        return spark.read.jdbc(
            url=url, table=table, predicates=list(predicates), properties=dict(properties or {})
        )
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, split)).load()


def read_query(
    spark: SparkSession,
    url: str,
    sql: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A query run inside the database.  As a derived table it may be split, unlike ``query``."""
    return (
        spark.read.format("jdbc").options(**jdbc_options(url, f"({sql}) q", properties, split)).load()
    )


def table_config(configs: DataFrame, table_id: int) -> TableConfig:
    """The settings of one table out of the control table (one row)."""
    rows = configs.filter(configs["table_id"] == table_id).head(2)
    if len(rows) != 1:
        raise LookupError(f"{len(rows)} settings rows for table_id {table_id}")
    return TableConfig.from_row(rows[0].asDict())


def table_rules(
    rules: DataFrame, table_id: int, parents: Mapping[str, tuple[str, str]] | None = None
) -> list[Rule]:
    """The active rules of one table (a handful of rows).

    ``parents`` maps a referential rule's id to its parent frame and column:
    the SQL text of such a rule cannot be bound to a frame.
    """
    parents = parents or {}
    rows = rules.filter(rules["table_id"] == table_id).orderBy("rule_id").collect()
    found = [Rule.from_row(r.asDict(), *parents.get(r["rule_id"], ())) for r in rows]
    return [rule for rule in found if rule.is_active]
