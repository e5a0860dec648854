import pytest
from fixtures import A, RULE, T0, alert, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.columns import breached
from fleetwatch.operators.alerts import auto_resolve, open_alerts, replay_alerts
from fleetwatch.operators.rules import active_rules, decide, enabled_rules, evaluate, match_rules


def test_threshold_operators(spark):
    nan = float("nan")
    cases = [
        ("gt", 5.0, False), ("gt", 5.1, True), ("gte", 5.0, True), ("gte", 4.9, False),
        ("lt", 5.0, False), ("lt", 4.9, True), ("lte", 5.0, True), ("lte", 5.1, False),
        ("unknown", 999.0, False), ("gt", nan, False), ("gte", nan, False), ("lt", nan, False), ("lte", nan, False),
        (None, 999.0, False), ("gt", None, False),
    ]
    df = spark.createDataFrame(cases, "operator string, value double, expected boolean")
    wrong = df.where(breached(F.col("value"), F.col("operator"), F.lit(5.0)) != F.col("expected"))
    assert wrong.collect() == []


def rule(n, metric="temperature_c", operator="gt", threshold=30.0):
    return (RULE[n], A[2], metric, operator, threshold, "warning", True, None)


@pytest.mark.parametrize(
    "value, rules, active, expected",
    [
        (33.0, [rule(1)], [], [(RULE[1], "create", 33.0)]),
        (33.0, [rule(1)], [1], []),
        (24.0, [rule(1)], [1], [(RULE[1], "auto_resolve", 24.0)]),
        (24.0, [rule(1)], [], []),
        (33.0, [rule(1, metric="power_kw", threshold=50.0)], [], []),
        (30.0, [rule(1, threshold=28.0), rule(2, threshold=32.0)], [2], [(RULE[1], "create", 30.0), (RULE[2], "auto_resolve", 30.0)]),
    ],
)
def test_decision_table(spark, value, rules, active, expected):
    alerts = spark.createDataFrame([alert(str(n), RULE[n], status="acknowledged") for n in active], schemas.ALERTS)
    matches = match_rules(telemetry(spark, [(A[2], {"temperature_c": value}, 0)]), spark.createDataFrame(rules, schemas.ALERT_RULES))
    assert rows(decide(matches, active_rules(alerts)), "alert_rule_id", "decision", "value") == sorted(expected)


def test_matching_is_per_device_and_metric_and_ignores_case(spark):
    rules = seed_tables(spark)["alert_rules"]
    readings = [
        (A[2].upper(), {"temperature_c": 1.0, "other": 2.0}, 0),
        (A[1], {"temperature_c": 3.0}, 1),
        ("stranger", {"temperature_c": 3.0}, 1),
    ]
    matches = evaluate(match_rules(telemetry(spark, readings), rules))
    assert rows(matches, "alert_rule_id", "value") == [(RULE[1], 1.0), (RULE[2], 1.0)]


def test_enabled_and_active(spark):
    rules = spark.createDataFrame([rule(1)[:6] + (False, None), rule(2)], schemas.ALERT_RULES)
    assert rows(enabled_rules(rules), "id") == [(RULE[2],)]
    alerts = spark.createDataFrame(
        [alert("1", RULE[1]), alert("2", RULE[1], "acknowledged"), alert("3", RULE[2], "resolved")], schemas.ALERTS
    )
    assert rows(active_rules(alerts), "device_id", "alert_rule_id") == [(A[2], RULE[1])]


def test_applying_decisions(spark):
    rules = seed_tables(spark)["alert_rules"]
    alerts = spark.createDataFrame(
        [
            alert("1", RULE[1], "acknowledged", ack=(5, "u")),
            alert("2", RULE[1], "resolved", end=(6, "u")),
            alert("3", RULE[2]),
        ],
        schemas.ALERTS,
    )
    hot = telemetry(spark, [(A[1], {"power_kw": 51.0}, 60), (A[2], {"temperature_c": 20.0}, 60)])
    decisions = decide(match_rules(hot, rules), active_rules(alerts))
    assert rows(open_alerts(decisions), "alert_rule_id", "severity", "status", "triggered_value") == [
        (RULE[3], "warning", "open", 51.0)
    ]
    resolved = {r.id: r for r in auto_resolve(alerts, decisions).collect()}
    assert [resolved[i].status for i in "123"] == ["resolved"] * 3
    assert resolved["1"].resolved_by is None and resolved["1"].acknowledged_by == "u"
    assert resolved["2"].resolved_by == "u"
    assert resolved["1"].resolved_at == resolved["3"].resolved_at != resolved["2"].resolved_at


def test_many_rules_out_of_a_small_table_are_not_broadcast_by_an_estimate(spark, capsys):
    """300,000 rules that one row is exploded to are estimated as one; the driver must not collect them for a join."""
    n = F.col("n").cast("string")
    rules = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(300_000))).alias("n")).select(
        n.alias("id"), n.alias("device_id"), F.lit("m").alias("metric"), F.lit("gt").alias("operator"), F.lit(0.0).alias("threshold"), F.lit("warning").alias("severity"), F.lit(True).alias("enabled")
    )
    readings = spark.range(1000).select(
        (F.col("id") + 1).cast("string").alias("device_id"), F.lit(T0).alias("received_at"), F.col("id").alias("seq"), F.create_map(F.lit("m"), F.lit(1.0)).alias("readings")
    )
    found = replay_alerts(readings, rules)
    found.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
    assert found.count() == 1000
