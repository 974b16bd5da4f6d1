"""Column expressions shared by the operators.  Built-in functions only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

# Operation codes of the change feed and the names they decode to.
DELETE = "DELETE"
INSERT = "INSERT"
UPDATE_BEFORE = "UPDATE_BEFORE"
UPDATE = "UPDATE"
UNKNOWN = "UNKNOWN"
OPERATION_NAMES = {1: DELETE, 2: INSERT, 3: UPDATE_BEFORE, 4: UPDATE}
INITIAL_LOAD = "F"


def moment(as_of: Column | dt.datetime | str, data_type: DataType | None = None) -> Column:
    """The load time as a column.  Always an argument; no operator reads the clock."""
    if isinstance(as_of, str):
        column = F.lit(as_of).cast("timestamp")
    elif isinstance(as_of, Column):
        column = as_of
    else:
        column = F.lit(as_of)
    return column.cast(data_type) if data_type is not None else column


def with_audit(df: DataFrame, run_id: str, times: dict[str, Column | dt.datetime | str]) -> DataFrame:
    """Append ``_pipeline_run_id`` and the named load-time columns."""
    added = {"_pipeline_run_id": F.lit(run_id)}
    added.update({name: moment(value) for name, value in times.items()})
    return df.withColumns(added)


def decode_operation(code: Column | str) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    (first, first_name), *rest = OPERATION_NAMES.items()
    decoded = F.when(code == first, first_name)
    for value, name in rest:
        decoded = decoded.when(code == value, name)
    return decoded.otherwise(UNKNOWN)


def row_hash(df: DataFrame, columns: Iterable[str], alias: str | None = None) -> Column:
    """SHA-256 over the listed columns (of ``df``, or of its alias in a join).

    Each value is written with its length in front and NULL has its own mark,
    so neither a separator inside a value nor a NULL can make rows collide.
    """
    parts = []
    for name in columns:
        text = F.col(f"{alias}.{name}" if alias else name)
        if not isinstance(df.schema[name].dataType, StringType):
            text = text.cast("string")
        counted = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(counted, F.lit("~")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def any_differs(left: str, right: str, columns: Iterable[str]) -> Column:
    """True when any listed column differs between two aliases; NULL equals NULL."""
    tests = [~F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns]
    return reduce(or_, tests, F.lit(False))


def all_present(columns: Iterable[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def any_missing(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def date_key(column: Column | str) -> Column:
    """``yyyymmdd`` as int, by arithmetic (no formatter call per row)."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.day(column)).cast("int")


def month_key(column: Column | str) -> Column:
    """``yyyymm`` as int."""
    return (F.year(column) * 100 + F.month(column)).cast("int")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types.  A value that does not fit stops the job."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def fitted(name: str, kind: DataType) -> Column:
        value = F.col(name).try_cast(kind)
        message = F.concat(
            F.lit(f"{name}: no {kind.simpleString()} can hold "), F.col(name).cast("string")
        )
        lost = F.col(name).isNotNull() & value.isNull()
        return F.when(lost, F.raise_error(message).cast(kind)).otherwise(value).alias(name)

    return df.select(
        *[F.col(f.name) if have[f.name] == f.dataType else fitted(f.name, f.dataType) for f in schema.fields]
    )
