"""People's requests to acknowledge or resolve alerts, applied as one batch."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import canonical_id, filled, is_active
from fleetwatch.schemas import UUID_PATTERN


def apply_alert_commands(
    alerts: DataFrame, users: DataFrame, commands: DataFrame, id_pattern: str = UUID_PATTERN
) -> tuple[DataFrame, DataFrame]:
    """The alerts afterwards, and one outcome per command.

    Commands on one alert count in the order of time and id. Only the first valid command and the
    first valid resolve of an alert decide what the others meet, and both are plain minima: no task
    has to hold all commands of one alert.
    """
    outcomes = _outcomes(alerts, users, commands, id_pattern)
    return _apply(alerts, outcomes), outcomes.select("cmd_id", "cmd_ts", "action", "alert_id", "user_id", "outcome")


def _well_formed(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def _outcomes(alerts: DataFrame, users: DataFrame, commands: DataFrame, id_pattern: str) -> DataFrame:
    known = users.select(canonical_id(F.col("id")).alias("_user"), F.lit(True).alias("_known"))
    states = alerts.select(canonical_id(F.col("id")).alias("_alert"), F.col("status").alias("_status"))
    rows = (
        commands.withColumns({"_user": canonical_id(F.col("user_id")), "_alert": canonical_id(F.col("alert_id"))})
        .join(known, "_user", "left")
        .withColumns(
            {
                "_formed": _well_formed(F.col("alert_id"), id_pattern) & _well_formed(F.col("user_id"), id_pattern),
                "_at": F.struct("cmd_ts", "cmd_id"),
            }
        )
    )
    counts = filled(F.col("user_id")) & F.col("_formed") & F.col("_known").isNotNull()
    firsts = (
        rows.where(counts)
        .groupBy("_alert")
        .agg(F.min("_at").alias("_first"), F.min(F.when(F.col("action") == "resolve", F.col("_at"))).alias("_first_resolve"))
    )
    met = states.join(firsts, "_alert", "left")
    untouched = F.coalesce(F.col("_at") <= F.col("_first"), F.lit(True))
    unresolved = F.coalesce(F.col("_at") <= F.col("_first_resolve"), F.lit(True))
    guard = F.when(F.col("action") == "acknowledge", (F.col("_status") == "open") & untouched).when(
        F.col("action") == "resolve", is_active(F.col("_status")) & unresolved
    )
    outcome = (
        F.when(
            ~filled(F.col("user_id")) | ~F.coalesce(F.col("action").isin("acknowledge", "resolve"), F.lit(False)),
            "bad_request",
        )
        .when(~F.col("_formed"), "invalid_id")
        .when(F.col("_status").isNull(), "not_found")
        .when(~F.coalesce(guard, F.lit(False)), "conflict")
        .when(F.col("_known").isNull(), "invalid_user")
        .otherwise("ok")
    )
    return rows.join(met, "_alert", "left").withColumn("outcome", outcome)


def _apply(alerts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """At most one acknowledge and one resolve per alert succeed."""
    deed = F.struct(F.col("cmd_ts").alias("at"), F.col("_user").alias("by"))
    deeds = (
        outcomes.where(F.col("outcome") == "ok")
        .groupBy("_alert")
        .agg(
            F.max(F.when(F.col("action") == "acknowledge", deed)).alias("_ack"),
            F.max(F.when(F.col("action") == "resolve", deed)).alias("_end"),
        )
    )
    acked, ended = F.col("_ack").isNotNull(), F.col("_end").isNotNull()
    return (
        alerts.join(deeds, canonical_id(F.col("id")) == F.col("_alert"), "left")
        .withColumns(
            {
                "acknowledged_at": F.when(acked, F.col("_ack.at")).otherwise(F.col("acknowledged_at")),
                "acknowledged_by": F.when(acked, F.col("_ack.by")).otherwise(F.col("acknowledged_by")),
                "resolved_at": F.when(ended, F.col("_end.at")).otherwise(F.col("resolved_at")),
                "resolved_by": F.when(ended, F.col("_end.by")).otherwise(F.col("resolved_by")),
                "status": F.when(ended, "resolved").when(acked, "acknowledged").otherwise(F.col("status")),
            }
        )
        .select(*alerts.columns)
    )
