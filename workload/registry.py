"""Query registry and the types that leave a query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types every SQL client prints alike, for the comparison only.

    The library itself returns decimals, dates, arrays and zoned timestamps
    (tests check the declared schemas).
    """

    def column(field):
        kind, value = field.dataType, F.col(field.name)
        if isinstance(kind, DecimalType):
            value = value.cast("double")
        elif isinstance(kind, DateType):
            value = value.cast("string")
        elif isinstance(kind, ArrayType):
            value = F.concat_ws(",", value)
        elif isinstance(kind, TimestampType):
            value = value.cast("timestamp_ntz")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
