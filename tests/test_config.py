import pytest

from sedimenta.config import ERROR, SKIP_ROW, Rule, TableConfig, active, parse_columns
from sedimenta.sources.database import Split, jdbc_options, table_config, table_rules


def test_column_lists_are_split_and_stripped():
    assert parse_columns("CITY, STATE ,") == ("CITY", "STATE")
    assert parse_columns(None) == ()


SETTINGS = {
    "table_id": 1,
    "bronze_table_name": "customers",
    "silver_table_name": "customers",
    "silver_s3_path": "/data/crm/customers",
    "primary_key_columns": "customer_id",
    "scd_type": 2,
    "scd_tracked_columns": "status,customer_type,email,phone",
    "partition_columns": None,
    "z_order_columns": "customer_id,email",
}


def test_table_settings_from_a_control_row():
    config = TableConfig.from_row(SETTINGS)
    assert config.keys == ("customer_id",)
    assert config.tracked == ("status", "customer_type", "email", "phone")
    assert config.partition_by == () and config.cluster_by == ("customer_id", "email")


@pytest.mark.parametrize("change", [{"primary_key_columns": ""}, {"scd_type": 3}, {"scd_tracked_columns": None}])
def test_bad_settings_are_refused(change):
    with pytest.raises(ValueError):
        TableConfig.from_row({**SETTINGS, **change})


def test_rules():
    rule = Rule.from_row(
        {"rule_id": "R", "rule_type": "NULL_CHECK", "rule_expression": "a IS NOT NULL", "severity": None, "is_active": "0"}
    )
    row = {"rule_id": "R", "rule_type": "REF_INTEGRITY", "rule_expression": "ignored", "column_name": "a"}
    found = Rule.from_row({**row, "parent_table_name": "p", "parent_column_name": "b"})
    assert (found.parent, found.parent_column, found.expression) == ("p", "b", None)
    assert rule.severity == SKIP_ROW and not rule.is_active and active([rule]) == []
    with pytest.raises(ValueError):
        Rule("R", "NULL_CHECK", expression="a", severity="LOUD")
    with pytest.raises(ValueError):
        Rule("R", "REF_INTEGRITY", "a")
    with pytest.raises(ValueError):
        Rule("R", "RANGE_CHECK", "a", severity=ERROR)


def test_settings_and_rules_from_control_tables(spark):
    columns = list(SETTINGS)
    schema = ", ".join(f"{c} {'int' if c in ('table_id', 'scd_type') else 'string'}" for c in columns)
    settings = spark.createDataFrame([[SETTINGS[c] for c in columns]], schema)
    assert table_config(settings, 1) == TableConfig.from_row(SETTINGS)
    with pytest.raises(LookupError):
        table_config(settings, 2)
    rules = spark.createDataFrame(
        [
            ("DQ-V-001", 1, "RANGE_CHECK", "total", "total > 0", "SKIP_ROW", True),
            ("DQ-R-001", 1, "REF_INTEGRITY", "customer_id", "EXISTS (...)", "SKIP_ROW", True),
            ("DQ-X", 1, "RANGE_CHECK", "total", "total < 9", "WARNING", False),
            ("OTHER", 2, "RANGE_CHECK", "total", "total < 9", "WARNING", True),
        ],
        "rule_id string, table_id int, rule_type string, column_name string, rule_expression string, "
        "severity string, is_active boolean",
    )
    found = table_rules(rules, 1, {"DQ-R-001": ("customers", "customer_id")})
    assert [r.rule_id for r in found] == ["DQ-R-001", "DQ-V-001"]
    assert found[0].parent == "customers" and found[0].expression is None


def test_database_reads_are_split():
    options = jdbc_options("jdbc:x", "(SELECT 1) q", {"user": "u"}, Split("id", 1, 1000, 40))
    assert options["dbtable"] == "(SELECT 1) q" and options["numPartitions"] == "40"
    assert options["partitionColumn"] == "id" and options["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")
