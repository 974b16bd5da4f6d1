"""Month and running sums kept up from changed facts."""

import glob
import random
from decimal import Decimal

import pytest

from sedimenta.plans import dimensions
from sedimenta.plans.schemas import FACT_ORDERS
from sedimenta.plans.snapshots import customer_monthly_snapshot, maintain_customer_months, snapshot_of_months
from sedimenta.sinks.partitions import replace_version, upsert_version
from sedimenta.sinks.tables import write_snapshot
from sedimenta.sources.tables import date_range, read_snapshot, snapshot_path

NOW = "2025-01-15 00:00:00"
MONTHS = [202310, 202311, 202312, 202401, 202402, 202403, 202404]


def plain(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def orders(spark, pick, numbers, months):
    rows = []
    for n in numbers:
        day = pick.choice(months) * 100 + pick.choice((1, 2, 28))
        money = Decimal(pick.randrange(1, 10_000)) / 100
        rows.append((day, pick.choice((-1, 1, 2, 3, 4)), 1, -1, f"O{n}", "Shipped", "p", money, money, money, money, money, 0, None, "r"))
    return spark.createDataFrame(rows, FACT_ORDERS)


@pytest.fixture(scope="module")
def days(spark):
    return dimensions.dim_date(date_range(spark, "2023-10-01", "2024-04-30"))


def check(spark, facts_root, root, version, days):
    state = maintain_customer_months(spark, facts_root, root, version, days)
    facts = read_snapshot(spark, facts_root, version, FACT_ORDERS)
    assert plain(snapshot_of_months(state, "r", NOW)) == plain(customer_monthly_snapshot(facts, days, "r", NOW))
    return state


@pytest.mark.parametrize("seed", [1])
def test_every_load_equals_a_full_build(spark, tmp_path, days, seed):
    facts_root, root, pick = f"{tmp_path}/facts", f"{tmp_path}/months", random.Random(seed)
    write_snapshot(orders(spark, pick, range(40), MONTHS[:4]), facts_root, 1, ["dim_date_key"])
    states = [check(spark, facts_root, root, 1, days)]
    # New months, then a late one that also moves orders, then the newest again, then days that empty.
    for version, (numbers, months) in enumerate(
        [(range(40, 60), MONTHS[4:6]), (range(20, 50), MONTHS[1:3]), (range(55, 65), MONTHS[6:]), (range(5), MONTHS[:1])], 2
    ):
        upsert_version(orders(spark, pick, numbers, months), ["order_number"], "dim_date_key", facts_root, version)
        states.append(check(spark, facts_root, root, version, days))
    replace_version(orders(spark, pick, [70], MONTHS[5:6]), "dim_date_key", 20240101, facts_root, 6)
    check(spark, facts_root, root, 6, days)
    # A load that changes nothing, and a repeated one.
    upsert_version(orders(spark, pick, [], MONTHS), ["order_number"], "dim_date_key", facts_root, 7)
    check(spark, facts_root, root, 7, days)
    check(spark, facts_root, root, 7, days)
    assert plain(read_snapshot(spark, root, 2).filter("month_key > 0")) == plain(states[1])


def test_only_changed_months_of_the_facts_are_read(spark, tmp_path, days):
    facts_root, root, pick = f"{tmp_path}/facts", f"{tmp_path}/months", random.Random(5)
    write_snapshot(orders(spark, pick, range(60), MONTHS[:5]), facts_root, 1, ["dim_date_key"])
    maintain_customer_months(spark, facts_root, root, 1, days)
    upsert_version(orders(spark, pick, range(100, 110), [202402]), ["order_number"], "dim_date_key", facts_root, 2)
    wanted = plain(customer_monthly_snapshot(read_snapshot(spark, facts_root, 2, FACT_ORDERS), days, "r", NOW))
    before = {f: open(f, "rb").read() for f in glob.glob(f"{snapshot_path(root, 1)}/*/*.parquet")}
    for month in MONTHS[:4]:  # whatever lies in the other months
        for file in glob.glob(f"{snapshot_path(facts_root, 1)}/dim_date_key={month}*/*.parquet"):
            open(file, "wb").write(b"unreadable")
    assert plain(snapshot_of_months(maintain_customer_months(spark, facts_root, root, 2, days), "r", NOW)) == wanted
    assert {f: open(f, "rb").read() for f in before} == before
    written = {p.split("month_key=")[1] for p in glob.glob(f"{snapshot_path(root, 2)}/month_key=*")}
    assert written == {"202402", "-202402"}


def test_days_that_come_to_be_known(spark, tmp_path, days):
    facts_root, root, pick = f"{tmp_path}/facts", f"{tmp_path}/months", random.Random(6)
    write_snapshot(orders(spark, pick, range(30), MONTHS[:3]), facts_root, 1, ["dim_date_key"])
    known = days.filter("dim_date_key >= 20231101")
    check(spark, facts_root, root, 1, known)
    upsert_version(orders(spark, pick, [50], MONTHS[3:4]), ["order_number"], "dim_date_key", facts_root, 2)
    state = maintain_customer_months(spark, facts_root, root, 2, days, also=[202310])
    whole = customer_monthly_snapshot(read_snapshot(spark, facts_root, 2, FACT_ORDERS), days, "r", NOW)
    assert plain(snapshot_of_months(state, "r", NOW)) == plain(whole)


def test_a_table_of_no_facts(spark, tmp_path, days):
    facts_root, root = f"{tmp_path}/facts", f"{tmp_path}/months"
    write_snapshot(orders(spark, random.Random(1), [], MONTHS), facts_root, 1, ["dim_date_key"])
    assert maintain_customer_months(spark, facts_root, root, 1, days).count() == 0
    upsert_version(orders(spark, random.Random(1), [1, 2], MONTHS), ["order_number"], "dim_date_key", facts_root, 2, schema=FACT_ORDERS)
    assert check(spark, facts_root, root, 2, days).count() > 0
