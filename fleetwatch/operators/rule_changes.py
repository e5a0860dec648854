"""Creating, replacing and deleting alert rules, applied as one batch of changes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import alert_id, canonical_id, filled
from fleetwatch.schemas import OPERATORS, SEVERITIES, UUID_PATTERN

_CHANGED = ["metric", "operator", "threshold", "severity", "enabled"]


def apply_rule_changes(
    rules: DataFrame, devices: DataFrame, alerts: DataFrame, changes: DataFrame, id_pattern: str = UUID_PATTERN
) -> tuple[DataFrame, DataFrame]:
    """The rules afterwards, and one outcome per change.

    Changes of one rule count in the order of time and id. A rule is gone after the first delete
    that nothing forbids, and ends up as its last update: a minimum and a maximum per rule.
    """
    judged = _judge(rules, devices, alerts, changes, id_pattern)
    return _apply(rules, judged), judged.select("chg_id", "chg_ts", "action", "rule_id", "outcome")


def _valid_words() -> Column:
    return F.coalesce(F.col("operator").isin(OPERATORS) & F.col("severity").isin(SEVERITIES), F.lit(False))


def _judge(rules, devices, alerts, changes, id_pattern) -> DataFrame:
    changes = changes.withColumns(
        {
            "_device": canonical_id(F.col("device_id")),
            "_rule": canonical_id(F.col("rule_id")),
            "_at": F.struct("chg_ts", "chg_id"),
            # Absent numbers are zero, an absent switch is on, an absent text is empty.
            "metric": F.coalesce("metric", F.lit("")),
            "threshold": F.coalesce("threshold", F.lit(0.0)),
            "enabled": F.coalesce("enabled", F.lit(True)),
        }
    )
    creates = F.coalesce(F.col("action") == "create", F.lit(False))
    return _judge_creates(changes.where(creates), devices).unionByName(
        _judge_others(changes.where(~creates), rules, alerts, id_pattern)
    )


def _judge_creates(creates: DataFrame, devices: DataFrame) -> DataFrame:
    known = devices.select(canonical_id(F.col("id")).alias("_device"), F.lit(True).alias("_known"))
    complete = filled(F.col("metric")) & _valid_words() & F.col("_known").isNotNull()
    return (
        creates.join(known, "_device", "left")
        .withColumn("outcome", F.when(complete, "ok").otherwise("bad_request"))
        .drop("_known")
    )


def _judge_others(rows: DataFrame, rules: DataFrame, alerts: DataFrame, id_pattern: str) -> DataFrame:
    """Updates and deletes, which address a rule. Creates in the batch cannot be addressed."""
    used = alerts.select(canonical_id(F.col("alert_rule_id")).alias("_rule")).distinct().withColumn("_used", F.lit(True))
    deletes = rows.where(F.col("action") == "delete").groupBy("_rule").agg(F.min("_at").alias("_deleted"))
    states = (
        rules.select(canonical_id(F.col("id")).alias("_rule"), F.lit(True).alias("_known"))
        .join(used, "_rule", "left")
        .join(deletes, "_rule", "left")
    )
    is_used = F.col("_used").isNotNull()
    gone = ~is_used & F.coalesce(F.col("_deleted") < F.col("_at"), F.lit(False))
    delete, update = F.col("action") == "delete", F.col("action") == "update"
    outcome = (
        F.when(~F.coalesce(delete | update, F.lit(False)), "bad_request")
        .when(~F.coalesce(F.col("rule_id").rlike(id_pattern), F.lit(False)), "invalid_id")
        .when(F.col("_known").isNull() | gone, "not_found")
        .when(delete & is_used, "conflict")
        .when(update & ~_valid_words(), "bad_request")
        .otherwise("ok")
    )
    return rows.join(states, "_rule", "left").withColumn("outcome", outcome).drop("_known", "_used", "_deleted")


def created_rules(judged: DataFrame) -> DataFrame:
    """New rules; the same change always gives the same id."""
    return judged.where((F.col("action") == "create") & (F.col("outcome") == "ok")).select(
        alert_id(F.lit("rule"), F.col("chg_ts"), F.col("chg_id")).alias("id"),
        F.col("_device").alias("device_id"),
        *_CHANGED,
        F.col("chg_ts").alias("created_at"),
    )


def _apply(rules: DataFrame, judged: DataFrame) -> DataFrame:
    done = judged.where((F.col("outcome") == "ok") & (F.col("action") != "create"))
    final = done.groupBy("_rule").agg(
        F.bool_or(F.col("action") == "delete").alias("_delete"),
        F.max_by(F.struct(*_CHANGED), F.when(F.col("action") == "update", F.col("_at"))).alias("_image"),
    )
    updated = F.col("_image").isNotNull()
    kept = (
        rules.join(final, canonical_id(F.col("id")) == F.col("_rule"), "left")
        .where(~F.coalesce(F.col("_delete"), F.lit(False)))
        .withColumns({c: F.when(updated, F.col(f"_image.{c}")).otherwise(F.col(c)) for c in _CHANGED})
        .select(*rules.columns)
    )
    at = rules.schema["created_at"].dataType
    fresh = created_rules(judged).withColumn("created_at", F.col("created_at").cast(at))
    return kept.unionByName(fresh)
