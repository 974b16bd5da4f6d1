"""Orphans kept up over loads against audits of whole tables."""

import random

import pytest

from sedimenta.operators.audit import next_orphans
from sedimenta.operators.quality import orphan_rows
from sedimenta.session import stored

CHILD, PARENT = "k int, fk int, v string", "id int"


def plain(df):
    return sorted(map(tuple, df.select("k", "fk", "v", "rule_id").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_load_equals_a_whole_audit(spark, seed):
    pick = random.Random(seed)
    children, parents, state = {}, set(range(0, 20, 2)), None
    for load in range(5):
        changed = {k: pick.choice([*range(25), None]) for k in pick.sample(range(60), 25)}
        deleted = [] if load == 0 else pick.sample(sorted(children), 5)
        changed = {k: v for k, v in changed.items() if k not in deleted}
        new = set() if load == 0 else set(pick.sample(range(25), 4)) - parents
        lost = set() if load == 0 else set(pick.sample(sorted(parents), 3))
        again = set(pick.sample(sorted(lost), 1)) if lost else set()  # lost and new at once: it is there
        children = {k: v for k, v in children.items() if k not in deleted} | changed
        parents = (parents - lost) | new | again

        def frame(rows):
            return spark.createDataFrame([(k, v, f"r{load}") for k, v in rows.items()], CHILD)

        whole = spark.createDataFrame([(k, v, "r") for k, v in children.items()], CHILD)
        now = spark.createDataFrame([(p,) for p in parents], PARENT)
        batch = spark.createDataFrame([(k, v, "r") for k, v in changed.items()], CHILD)
        state = stored(
            next_orphans(
                state, ["k"], "fk", batch, now, "id", "R",
                deleted=spark.createDataFrame([(k,) for k in deleted], "k int"),
                new_parents=spark.createDataFrame([(p,) for p in new | again], PARENT),
                lost_parents=spark.createDataFrame([(p,) for p in lost], PARENT),
                children=whole,
            ),
            "orphans",
        )
        assert plain(state) == plain(orphan_rows(whole, "fk", now, "id", "R"))


def test_sides_that_do_not_change_are_not_needed(spark):
    batch = spark.createDataFrame([(1, 5, "a"), (2, None, "b")], CHILD)
    now = spark.createDataFrame([(7,)], PARENT)
    first = next_orphans(None, ["k"], "fk", batch, now, "id", "R")
    assert plain(first) == [(1, 5, "a", "R"), (2, None, "b", "R")]
    more = spark.createDataFrame([(1, 7, "a")], CHILD)
    assert plain(next_orphans(first, ["k"], "fk", more, now, "id", "R")) == [(2, None, "b", "R")]
    with pytest.raises(ValueError, match="children"):
        next_orphans(first, ["k"], "fk", more, now, "id", "R", lost_parents=now)
