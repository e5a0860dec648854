"""Rule changes on the timeline of the readings: each reading is judged by its rules as they stood when it came.

A rule's base row, valid creates and valid updates are its versions; a version counts from its change, the instant
included, until the next one. A reading meets every rule that ever had its device and metric, then the version as of its
time, and counts if that version has the metric and is enabled. A delete succeeds if no alert of the rule opened before
it. As alerts open at broken readings, a rule's first broken reading and its first delete decide all its deletes; a rule
that is deleted never had an alert, so none of its readings count.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import alert_id, breached, canonical_id, filled
from fleetwatch.functions.timeline import STRETCH_SECONDS, nearest
from fleetwatch.operators.alerts import replay_readings
from fleetwatch.schemas import OPERATORS, SEVERITIES, UUID_PATTERN
from fleetwatch.session import kept

_IMAGE = ["metric", "operator", "threshold", "severity", "enabled"]
_VERSION, _READING = 0, 1


def replay_with_rule_changes(
    telemetry: DataFrame,
    rules: DataFrame,
    devices: DataFrame,
    changes: DataFrame,
    initial_alerts: DataFrame | None = None,
    used: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
    id_pattern: str = UUID_PATTERN,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The alert table, the rules afterwards, and one outcome per change.

    `used` names in alert_rule_id the rules that had an alert before; by default those of initial_alerts. Alerts keep the
    severity of the version they opened under; an edit does not touch them, and disabling a rule leaves its alert open.
    A change that addresses a created rule finds it from the create's time on.
    """
    timeline = RuleTimeline(telemetry, rules, devices, changes, initial_alerts, used, seconds, id_pattern)
    return replay_readings(timeline.readings, initial_alerts, seconds), timeline.rules_after, timeline.outcomes


class RuleTimeline:
    """What changes of rules make of them, of the readings they judge, and of the changes themselves."""

    def __init__(self, telemetry, rules, devices, changes, initial_alerts=None, used=None, seconds=STRETCH_SECONDS, id_pattern=UUID_PATTERN):
        rules = rules.withColumns({"id": canonical_id(F.col("id")), "device_id": canonical_id(F.col("device_id"))})
        judged = _judge(rules, devices, changes, id_pattern)
        # Stored once: what becomes of deletes and of the alerts are both read from it, the latter more than once.
        judged_readings = kept(_as_of(telemetry, _versions(rules, judged), seconds), "judged")
        if used is None and initial_alerts is not None:
            used = initial_alerts
        gone = _gone(judged, judged_readings, used)
        outcomes = _outcomes(judged, gone)
        #: alert_rule_id, device_id, severity, received_at, seq, value and breached of each reading and rule that judges it.
        self.readings = judged_readings.join(gone.where("_gone").select("alert_rule_id"), "alert_rule_id", "left_anti")
        self.outcomes = outcomes.select("chg_id", "chg_ts", "action", "rule_id", "outcome")
        self.rules_after = _after(rules, outcomes)
        #: Ids of the rules that the changes created, replaced or deleted.
        self.touched = outcomes.where("outcome = 'ok'").select(F.col("_rule").alias("id")).distinct()


def _judge(rules: DataFrame, devices: DataFrame, changes: DataFrame, id_pattern: str) -> DataFrame:
    """Changes with the rule they address, its device, and an outcome as far as deletes do not decide it."""
    creates = F.coalesce(F.col("action") == "create", F.lit(False))
    rows = changes.withColumns(
        {
            # Absent numbers are zero, an absent switch is on, an absent text is empty.
            "metric": F.coalesce("metric", F.lit("")),
            "threshold": F.coalesce("threshold", F.lit(0.0)),
            "enabled": F.coalesce("enabled", F.lit(True)),
            "_device": canonical_id(F.col("device_id")),
            "_at": F.struct("chg_ts", "chg_id"),
            "_words": F.coalesce(F.col("operator").isin(OPERATORS) & F.col("severity").isin(SEVERITIES), F.lit(False)),
        }
    )
    known = devices.select(canonical_id(F.col("id")).alias("_device"), F.lit(True).alias("_known")).distinct()
    made = (
        rows.where(creates)
        .join(known, "_device", "left")
        .withColumns(
            {
                "_rule": alert_id(F.lit("rule"), F.col("chg_ts"), F.col("chg_id")),
                "_verdict": F.when(~(filled(F.col("metric")) & F.col("_words") & F.col("_known").isNotNull()), "bad_request"),
            }
        )
        .drop("_known")
    )
    births = rules.select(F.col("id").alias("_rule"), F.col("device_id").alias("_home"), F.lit(True).alias("_base")).unionByName(
        made.where("_verdict IS NULL").select("_rule", F.col("_device").alias("_home"), F.col("_at").alias("_born")), allowMissingColumns=True
    )
    births = births.groupBy("_rule").agg(F.max("_base").alias("_base"), F.min("_born").alias("_born"), F.min("_home").alias("_home"))
    update, delete = F.col("action") == "update", F.col("action") == "delete"
    there = F.coalesce(F.col("_base"), F.lit(False)) | F.coalesce(F.col("_born") < F.col("_at"), F.lit(False))
    others = (
        rows.where(~creates)
        .withColumn("_rule", canonical_id(F.col("rule_id")))
        .join(births, "_rule", "left")
        .withColumn(
            "_verdict",
            F.when(~F.coalesce(update | delete, F.lit(False)), "bad_request")
            .when(~F.coalesce(F.col("rule_id").rlike(id_pattern), F.lit(False)), "invalid_id")
            .when(~there, "not_found"),
        )
        .withColumn("_device", F.col("_home"))
        .drop("_base", "_born", "_home")
    )
    return made.unionByName(others)


def _versions(rules: DataFrame, judged: DataFrame) -> DataFrame:
    """Each rule's images, with the time and number of the change they begin with; base rows begin before all time."""
    base = rules.select(F.col("id").alias("alert_rule_id"), "device_id", *_IMAGE)
    changed = judged.where(F.col("_verdict").isNull() & F.col("_words") & F.col("action").isin("create", "update"))
    return base.unionByName(
        changed.select(
            F.col("_rule").alias("alert_rule_id"), F.col("_device").alias("device_id"), *_IMAGE, F.col("chg_ts").alias("received_at"), F.col("chg_id").alias("seq")
        ),
        allowMissingColumns=True,
    )


def _as_of(telemetry: DataFrame, versions: DataFrame, seconds: int) -> DataFrame:
    """Readings with each rule that judges them. The join is on device and metric; the version is the nearest earlier
    one on the rule's timeline, so a rule with many versions costs no more than its rows."""
    meets = versions.select("alert_rule_id", "device_id", "metric").distinct()
    readings = telemetry.select(
        canonical_id(F.col("device_id")).alias("device_id"), "received_at", "seq", F.explode("readings").alias("metric", "value")
    ).join(meets, ["device_id", "metric"])
    at = telemetry.schema["received_at"].dataType
    marks = versions.select(
        "alert_rule_id", F.col("received_at").cast(at).alias("received_at"), F.lit(_VERSION).alias("rank"), "seq", F.struct(*_IMAGE).alias("version")
    )
    rows = readings.withColumn("rank", F.lit(_READING)).unionByName(marks, allowMissingColumns=True)
    placed = nearest(rows, "alert_rule_id", ["received_at", "rank", "seq"], {"now": F.col("version")}, seconds=seconds)
    judges = (F.col("rank") == _READING) & F.col("now.enabled") & (F.col("now.metric") == F.col("metric"))
    return placed.where(judges).select(
        "alert_rule_id",
        "device_id",
        F.col("now.severity").alias("severity"),
        "received_at",
        "seq",
        "value",
        breached(F.col("value"), F.col("now.operator"), F.col("now.threshold")).alias("breached"),
    )


def _gone(judged: DataFrame, readings: DataFrame, used: DataFrame | None) -> DataFrame:
    """alert_rule_id, the first delete that found the rule, and whether it succeeded."""
    firsts = (
        judged.where(F.col("_verdict").isNull() & (F.col("action") == "delete"))
        .groupBy(F.col("_rule").alias("alert_rule_id"))
        .agg(F.min("_at").alias("_deleted"))
    )
    asked = firsts.select("alert_rule_id")
    opened = (
        readings.where("breached").join(asked, "alert_rule_id", "left_semi").groupBy("alert_rule_id").agg(F.min("received_at").alias("_opened"))
    )
    found = firsts.join(opened, "alert_rule_id", "left")
    # A delete counts before readings of the same instant.
    free = F.col("_opened").isNull() | (F.col("_deleted.chg_ts") <= F.col("_opened"))
    if used is not None:
        held = used.select(canonical_id(F.col("alert_rule_id")).alias("alert_rule_id")).distinct().withColumn("_used", F.lit(True))
        found = found.join(held, "alert_rule_id", "left")
        free = free & F.col("_used").isNull()
    return found.select("alert_rule_id", "_deleted", free.alias("_gone"))


def _outcomes(judged: DataFrame, gone: DataFrame) -> DataFrame:
    delete = F.col("action") == "delete"
    late = F.coalesce(F.col("_gone") & (F.col("_deleted") < F.col("_at")), F.lit(False))
    outcome = (
        F.when(F.col("_verdict").isNotNull(), F.col("_verdict"))
        .when(late, "not_found")
        .when(delete & ~F.col("_gone"), "conflict")
        .when((F.col("action") == "update") & ~F.col("_words"), "bad_request")
        .otherwise("ok")
    )
    return judged.join(gone.withColumnRenamed("alert_rule_id", "_rule"), "_rule", "left").withColumn("outcome", outcome)


def _after(rules: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The rules after all changes: the last image of each that no delete removed."""
    done = outcomes.where("outcome = 'ok'")
    final = done.groupBy("_rule").agg(
        F.bool_or(F.col("action") == "delete").alias("_delete"),
        F.max_by(F.struct(*_IMAGE), F.when(F.col("action") != "delete", F.col("_at"))).alias("_image"),
        F.min(F.when(F.col("action") == "create", F.struct(F.col("chg_ts").alias("at"), F.col("_device").alias("device")))).alias("_create"),
    )
    updated = F.col("_image").isNotNull()
    extra = [c for c in rules.columns if c not in ("id", "device_id", "created_at", *_IMAGE)]
    joined = rules.join(final, F.col("id") == F.col("_rule"), "full_outer").where(~F.coalesce(F.col("_delete"), F.lit(False)))
    at = rules.schema["created_at"].dataType
    return joined.select(
        F.coalesce("id", "_rule").alias("id"),
        F.coalesce("device_id", "_create.device").alias("device_id"),
        *[F.when(updated, F.col(f"_image.{c}")).otherwise(F.col(c)).alias(c) for c in _IMAGE],
        F.coalesce("created_at", F.col("_create.at").cast(at)).alias("created_at"),
        *extra,
    ).select(*rules.columns)
