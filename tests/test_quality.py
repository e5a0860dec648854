from fixtures import A, RULE, SITE_B, USER, alert, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.operators import quality as q

OTHER = "f0000000-0000-0000-0000-000000000000"
ROW = ["check_name", "table_name", "row_key", "detail"]


def test_seed_tables_are_clean(spark):
    tables = seed_tables(spark)
    assert q.check_integrity(tables).collect() == []
    assert dict(map(tuple, q.table_counts(tables).collect())) == {
        "sites": 2, "devices": 7, "alert_rules": 3, "users": 1, "alerts": 0,
    }


def test_each_violation_is_found(spark):
    tables = seed_tables(spark)
    tables["alerts"] = spark.createDataFrame(
        [
            alert("1", RULE[1], severity="fatal", end=(1, OTHER)),
            alert("2", OTHER, "closed", device=OTHER, ack=(1, USER.upper())),
            alert("3", RULE[1], "acknowledged"),
            alert("4", None, "open"),
        ],
        schemas.ALERTS,
    )
    tables["sites"] = tables["sites"].withColumn("type", F.when(F.col("id") == SITE_B, "shed").otherwise(F.col("type")))
    tables["users"] = tables["users"].unionByName(tables["users"].withColumn("role", F.lit(None).cast("string")))
    got = rows(q.check_integrity(tables), *ROW)
    assert got == sorted(
        [
            ("allowed_values", "sites", SITE_B, "type=shed"),
            ("allowed_values", "alerts", "1", "severity=fatal"),
            ("allowed_values", "alerts", "2", "status=closed"),
            ("foreign_key", "alerts", "1", f"resolved_by={OTHER}"),
            ("foreign_key", "alerts", "2", f"alert_rule_id={OTHER}"),
            ("foreign_key", "alerts", "2", f"device_id={OTHER}"),
            ("unique", "users", USER, "id x 2"),
            ("unique", "users", "operator@example.org", "email x 2"),
            ("not_null", "alerts", "4", "alert_rule_id"),
            ("not_null", "users", USER, "role"),
            ("single_active", "alerts", RULE[1], "active=2"),
        ],
        key=repr,
    )


def test_blocked_deletes(spark):
    tables = seed_tables(spark)
    tables["alerts"] = spark.createDataFrame([alert("1", RULE[1], "resolved")], schemas.ALERTS)
    got = rows(q.blocked_deletes(tables), "table_name", "row_key", "detail")
    assert ("sites", SITE_B, "devices.site_id") in got
    assert [g for g in got if g[0] == "devices"] == [
        ("devices", A[1], "alert_rules.device_id"), ("devices", A[2], "alert_rules.device_id"), ("devices", A[2], "alerts.device_id"),
    ]
    assert [g for g in got if g[0] == "alert_rules"] == [("alert_rules", RULE[1], "alerts.alert_rule_id")]


def test_user_removal_keeps_history(spark):
    alerts = spark.createDataFrame(
        [alert("1", RULE[1], "resolved", ack=(1, USER), end=(2, OTHER)), alert("2", RULE[1])], schemas.ALERTS
    )
    after = q.remove_users(alerts, seed_tables(spark)["users"])
    assert rows(after, "id", "status", "acknowledged_by", "resolved_by") == [("1", "resolved", None, OTHER), ("2", "open", None, None)]
    assert after.where("acknowledged_at is not null").count() == 1


def test_reading_contract(spark):
    good = {"temperature_c": 18.0}
    history = telemetry(spark, [(A[2], good, 0), (A[2], {**good, "x": 1.0}, 1), (A[2], {}, 2), (A[2], {"temperature_c": 33.5}, 3)])
    assert rows(q.check_reading_keys(history), "row_key", "detail") == [
        (f"{A[2]}|1", "temp_sensor: temperature_c,x"), (f"{A[2]}|2", "temp_sensor: "),
    ]
    assert q.check_reading_keys(history.withColumn("device_type", F.lit("toaster"))).count() == 4
    assert rows(q.check_reading_bounds(history), "row_key", "detail") == [(f"{A[2]}|3", "temperature_c")]
    edge = telemetry(spark, [(A[4], {"battery_pct": 90.0, "load_pct": 75.0}, 0), (A[3], {"humidity_pct": float("nan")}, 1)])
    assert rows(q.check_reading_bounds(edge), "row_key") == [(f"{A[3]}|1",)]
