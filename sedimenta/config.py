"""Per-table settings and row rules.

Both are plain values handed to operators as arguments.  ``from_row`` builds
them from a control-table row (any mapping, for example ``Row.asDict()``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

# Severities and rule types a rule row may carry.
ERROR = "ERROR"
SKIP_ROW = "SKIP_ROW"
WARNING = "WARNING"
SEVERITIES = (ERROR, SKIP_ROW, WARNING)

NULL_CHECK = "NULL_CHECK"
RANGE_CHECK = "RANGE_CHECK"
FORMAT_CHECK = "FORMAT_CHECK"
REF_INTEGRITY = "REF_INTEGRITY"
RULE_TYPES = (NULL_CHECK, RANGE_CHECK, FORMAT_CHECK, REF_INTEGRITY)

# How a raw table is loaded.
FULL = "FULL"
CDC = "CDC"
WATERMARK = "WATERMARK"
LOAD_TYPES = (FULL, CDC, WATERMARK)

_FALSE_TEXT = {"0", "false", "f", "n", "no", ""}


def parse_columns(text: str | None) -> tuple[str, ...]:
    """Split a comma-separated column list: ``"CITY, STATE"`` -> ``("CITY", "STATE")``."""
    if not text:
        return ()
    return tuple(name.strip() for name in text.split(",") if name.strip())


def _flag(value: Any) -> bool:
    if isinstance(value, str):
        return value.strip().lower() not in _FALSE_TEXT
    return bool(value)


@dataclass(frozen=True)
class TableConfig:
    """How one table is keyed, historised and laid out."""

    name: str
    keys: tuple[str, ...]
    scd_type: int = 1
    tracked: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    source_name: str | None = None
    path: str | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"table {self.name!r} needs at least one key column")
        if self.scd_type not in (1, 2):
            raise ValueError(f"table {self.name!r}: scd_type must be 1 or 2, got {self.scd_type!r}")
        if self.scd_type == 2 and not self.tracked:
            raise ValueError(f"table {self.name!r}: a history table needs tracked columns")

    @classmethod
    def from_row(cls, row: Mapping[str, Any]) -> TableConfig:
        """The row's column names are fixed values of the settings table."""
        return cls(
            name=row["silver_table_name"],
            keys=parse_columns(row["primary_key_columns"]),
            scd_type=int(row.get("scd_type") or 1),
            tracked=parse_columns(row.get("scd_tracked_columns")),
            partition_by=parse_columns(row.get("partition_columns")),
            cluster_by=parse_columns(row.get("z_order_columns")),
            source_name=row.get("bronze_table_name"),
            path=row.get("silver_s3_path"),
        )


@dataclass(frozen=True)
class RawConfig:
    """How one raw table is loaded, and from where on.

    ``last`` is the position (changes) or watermark value up to which rows are in;
    ``watermark`` names the column of the latter.
    """

    name: str
    keys: tuple[str, ...]
    load_type: str = CDC
    initial_load_completed: bool = False
    last: Any = None
    watermark: str | None = None
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"table {self.name!r} needs at least one key column")
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"table {self.name!r}: unknown load type {self.load_type!r}")
        if self.load_type == WATERMARK and not self.watermark:
            raise ValueError(f"table {self.name!r}: a watermark load needs its column")

    @classmethod
    def from_row(cls, row: Mapping[str, Any]) -> RawConfig:
        """The row's column names are fixed values of the settings table."""
        return cls(
            name=row["table_name"],
            keys=parse_columns(row["primary_key_columns"]),
            load_type=row.get("load_type") or CDC,
            initial_load_completed=_flag(row.get("initial_load_completed")),
            last=row.get("last_sync_version"),
            watermark=row.get("watermark_column"),
        )


@dataclass(frozen=True)
class Rule:
    """One row rule.

    ``expression`` is Spark SQL text that yields a boolean.  A ``REF_INTEGRITY``
    rule has no expression; it names the child column (``column_name``), the
    parent frame (``parent``, a name resolved by the caller) and the parent
    column.
    """

    rule_id: str
    rule_type: str
    column_name: str | None = None
    expression: str | None = None
    severity: str = SKIP_ROW
    is_active: bool = True
    parent: str | None = None
    parent_column: str | None = None

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"rule {self.rule_id}: unknown severity {self.severity!r}")
        if self.rule_type not in RULE_TYPES:
            raise ValueError(f"rule {self.rule_id}: unknown rule type {self.rule_type!r}")
        if self.rule_type == REF_INTEGRITY:
            if not (self.column_name and self.parent and self.parent_column):
                raise ValueError(f"rule {self.rule_id}: needs column_name, parent and parent_column")
        elif not self.expression:
            raise ValueError(f"rule {self.rule_id}: needs an expression")

    @property
    def rejects(self) -> bool:
        return self.severity in (ERROR, SKIP_ROW)

    @classmethod
    def from_row(
        cls, row: Mapping[str, Any], parent: str | None = None, parent_column: str | None = None
    ) -> Rule:
        """A referential row names its parent in ``parent_table_name`` and
        ``parent_column_name``; arguments take precedence."""
        return cls(
            rule_id=row["rule_id"],
            rule_type=row["rule_type"],
            column_name=row.get("column_name"),
            expression=None if row["rule_type"] == REF_INTEGRITY else row["rule_expression"],
            severity=row.get("severity") or SKIP_ROW,
            is_active=_flag(row.get("is_active", True)),
            parent=parent or row.get("parent_table_name"),
            parent_column=parent_column or row.get("parent_column_name"),
        )


def active(rules: list[Rule] | tuple[Rule, ...]) -> list[Rule]:
    return [rule for rule in rules if rule.is_active]
