"""Threshold rules: which apply to a reading, which are broken, and what follows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import breached, canonical_id, is_active


def enabled_rules(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("enabled"))


def active_rules(alerts: DataFrame) -> DataFrame:
    """Rules, per device, that already have an alert nobody has resolved."""
    return alerts.where(is_active(F.col("status"))).select("device_id", "alert_rule_id").distinct()


def match_rules(telemetry: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per reading and rule on its device and metric.

    The join key is device and metric, so only real matches are formed. No side is broadcast by
    hand: Spark does so when the rules are measured to be small, and otherwise splits a device
    that dominates the shuffled telemetry (adaptive skew join).
    """
    readings = telemetry.select(
        canonical_id(F.col("device_id")).alias("device_id"),
        "received_at",
        "seq",
        F.explode("readings").alias("metric", "value"),
    )
    wanted = rules.select(
        canonical_id(F.col("id")).alias("alert_rule_id"),
        canonical_id(F.col("device_id")).alias("device_id"),
        "metric",
        "operator",
        "threshold",
        "severity",
    )
    return readings.join(wanted, ["device_id", "metric"])


def evaluate(matches: DataFrame) -> DataFrame:
    return matches.withColumn("breached", breached(F.col("value"), F.col("operator"), F.col("threshold")))


def decision(is_breached: Column, was_active: Column) -> Column:
    """A fresh breach opens an alert, a return to normal closes it, all else changes nothing."""
    return F.when(is_breached & ~was_active, "create").when(~is_breached & was_active, "auto_resolve")


def decide(matches: DataFrame, active: DataFrame) -> DataFrame:
    """Decisions of single messages against a given set of active rules."""
    marked = active.select(
        canonical_id(F.col("device_id")).alias("device_id"),
        canonical_id(F.col("alert_rule_id")).alias("alert_rule_id"),
        F.lit(True).alias("_active"),
    )
    was_active = F.coalesce(F.col("_active"), F.lit(False))
    return (
        evaluate(matches)
        .join(marked, ["device_id", "alert_rule_id"], "left")
        .withColumn("decision", decision(F.col("breached"), was_active))
        .where(F.col("decision").isNotNull())
        .drop("_active")
    )
