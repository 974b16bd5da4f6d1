"""A standing table of orphans, kept up from what a load changes on either side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sedimenta.operators.quality import orphan_rows


def next_orphans(
    orphans: DataFrame | None,
    keys: Sequence[str],
    column: str,
    changed: DataFrame,
    parents: DataFrame,
    parent_column: str,
    rule_id: str,
    deleted: DataFrame | None = None,
    new_parents: DataFrame | None = None,
    lost_parents: DataFrame | None = None,
    children: DataFrame | None = None,
) -> DataFrame:
    """Orphans after a load; the rows that an audit of the whole tables gives.

    ``changed`` are child rows that the load wrote, ``deleted`` keys of children it removed,
    ``new_parents`` and ``lost_parents`` (their ``parent_column``) what it did to the parents,
    ``parents`` all parents after it.  Without ``orphans`` before, ``changed`` is the whole table.

    Changed children alone meet the parents; standing orphans meet the new parents; and only
    where parents were lost the ``children`` (all of them after the load) are read, to find those that
    had them.  Each side holds a child key once; a NULL reference is an orphan that
    no parent resolves.  A parent that is lost and new at once is there.
    """
    keys, names = list(keys), changed.columns
    found = orphan_rows(changed, column, parents, parent_column, rule_id)
    if orphans is None:
        return found
    gone = changed.select(*keys)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(*keys))
    kept = orphans.join(gone.distinct(), keys, "left_anti").select(*names, "rule_id")
    if new_parents is not None:
        known = new_parents.select(parent_column).dropna().distinct()
        kept = kept.join(known, kept[column] == known[parent_column], "left_anti").select(*names, "rule_id")
    result = kept.unionByName(found.select(*names, "rule_id"))
    if lost_parents is not None:
        if children is None:
            raise ValueError("lost parents need the children that may have had them")
        lost = lost_parents.select(parent_column).dropna().distinct().join(parents.select(parent_column), parent_column, "left_anti")
        left = children.join(lost, children[column] == lost[parent_column], "left_semi").select(*names)
        left = left.join(result.select(*keys), keys, "left_anti").select(*names)
        result = result.unionByName(orphan_rows(left, column, parents, parent_column, rule_id).select(*names, "rule_id"))
    return result
