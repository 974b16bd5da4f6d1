import pytest
from pyspark.errors import PySparkException

from sedimenta.config import ERROR, NULL_CHECK, RANGE_CHECK, REF_INTEGRITY, WARNING, Rule
from sedimenta.functions.strings import cast_timestamps, clean_strings
from sedimenta.operators.quality import (
    exception_summary,
    load_metrics,
    orphan_rows,
    rejected_rows,
    stop_on_error,
    table_rules,
    tag_rows,
    valid_rows,
    warned_rows,
)

PRESENT = Rule("N", NULL_CHECK, "email", "email IS NOT NULL", ERROR)
POSITIVE = Rule("V", RANGE_CHECK, "total", "total > 0")
SMALL = Rule("W", RANGE_CHECK, "total", "total < 100", WARNING)
KNOWN = Rule("R", REF_INTEGRITY, "customer_id", parent="customers", parent_column="id")
OFF = Rule("X", RANGE_CHECK, "total", "total > 1000", is_active=False)
RULES = [PRESENT, POSITIVE, SMALL, KNOWN, OFF]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "e", 5, 10),
            (2, None, 5, 10),
            (3, "e", None, 10),
            (4, "e", -1, None),
            (5, "e", 500, 10),
            (6, "e", 5, 77),
            (7, None, None, 77),
        ],
        "id int, email string, total int, customer_id int",
    )


@pytest.fixture(scope="module")
def parents(spark):
    return {"customers": spark.createDataFrame([(10,), (10,), (11,), (None,)], "id int")}


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_every_row_is_valid_or_rejected(rows, parents):
    valid, rejected = valid_rows(rows, RULES, parents), rejected_rows(rows, RULES, parents)
    assert ids(valid) == [1, 5]
    assert {r["id"]: r["_failed_rules"] for r in rejected.collect()} == {
        2: ["N"],
        3: ["V"],
        4: ["V", "R"],
        6: ["R"],
        7: ["N", "V", "R"],
    }
    assert valid.columns == rows.columns


def test_tags_agree_with_the_split(rows, parents):
    tagged = tag_rows(rows, RULES, parents)
    assert ids(tagged.filter("_accepted")) == ids(valid_rows(rows, RULES, parents))
    assert {r["id"]: r["_warnings"] for r in tagged.collect() if r["_warnings"]} == {3: ["W"], 5: ["W"], 7: ["W"]}
    assert load_metrics(tagged, "r").first().asDict() == {
        "records_read": 7,
        "records_written": 2,
        "records_quarantined": 5,
        "pipeline_run_id": "r",
    }


def test_warnings_and_summary(rows, parents):
    plain_rules = [PRESENT, POSITIVE, SMALL]
    assert ids(warned_rows(rows, plain_rules)) == [5]
    summary = exception_summary(rejected_rows(rows, RULES, parents), "r")
    assert {r["rule_id"]: r["exception_count"] for r in summary.collect()} == {"N": 2, "V": 3, "R": 3}


def test_no_rules_and_empty_parent(spark, rows):
    assert ids(valid_rows(rows, [])) == [1, 2, 3, 4, 5, 6, 7]
    assert rejected_rows(rows, []).count() == 0
    nobody = {"customers": spark.createDataFrame([], "id int")}
    assert valid_rows(rows, [KNOWN], nobody).count() == 0


def test_error_rules_can_stop_the_job(rows):
    with pytest.raises(PySparkException, match="row breaks rules: N"):
        stop_on_error(rows, RULES[:3]).collect()
    assert stop_on_error(rows.filter("email IS NOT NULL"), RULES[:3]).count() == 5


def test_table_rules(spark):
    def outcome(data):
        df = spark.createDataFrame(data, "k int")
        return {r["rule"]: (r["value"], r["passed"]) for r in table_rules(df, ["k"]).collect()}

    assert outcome([(1,), (2,), (2,), (None,)]) == {
        "RowCount": (4.0, True),
        "IsComplete": (0.75, False),
        "Uniqueness": (0.25, False),
    }
    assert outcome([(1,), (2,)])["Uniqueness"] == (1.0, True)
    assert outcome([])["RowCount"] == (0.0, False)


def test_null_reference_is_an_orphan(rows, parents):
    assert ids(orphan_rows(rows, "customer_id", parents["customers"], "id", "R")) == [4, 6, 7]


def test_cleanup(spark):
    df = spark.createDataFrame([(" a ", "  ", 1), ("\ta", "", 2)], "s string, t string, n int")
    assert [tuple(r) for r in clean_strings(df).orderBy("n").collect()] == [("a", None, 1), ("\ta", None, 2)]
    assert [r["t"] for r in clean_strings(df, ["s"]).orderBy("n").collect()] == ["  ", ""]


def test_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",)], "t string")
    assert [str(r[0]) for r in cast_timestamps(df, ["t"]).collect()] == ["2024-01-02 03:04:05", "None"]
    with pytest.raises(PySparkException):
        cast_timestamps(df, ["t"], strict=True).collect()
