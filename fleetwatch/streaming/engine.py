"""The continuous form: one query stores telemetry, keeps devices' last-seen times, applies rule changes and runs alerts.

Messages, people's commands and rule changes enter through the same query, so the state has a single writer. Each
micro-batch writes what it adds and what it changes, and counts from its commit on (see store.py): a batch that fails
leaves the tables as they were, one that is run again after its commit does nothing. Its work depends on the batch and
on the active alerts and last-seen times, not on the length of the history.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwatch import schemas
from fleetwatch.functions.columns import canonical_id, is_active
from fleetwatch.operators.addressed import replay_addressed
from fleetwatch.operators.alerts import judged_readings, replay_readings, replay_readings_with_commands
from fleetwatch.operators.ingest import REJECT_REASONS, accepted, parse_messages, rejects
from fleetwatch.operators.liveness import last_written
from fleetwatch.operators.rule_versions import RuleTimeline
from fleetwatch.streaming.store import (
    REJECT_COUNTS,
    AlertStore,
    BatchWriter,
    current_alerts,
    current_last_seen,
    current_rules,
)

__all__ = ["AlertStore", "current_alerts", "current_last_seen", "current_rules", "mark_sources", "process_batch", "run_alert_stream"]


def run_alert_stream(
    messages: DataFrame,
    store: AlertStore,
    checkpoint: str,
    topic_root: str,
    load_rules: Callable[[], DataFrame],
    commands: DataFrame | None = None,
    users: DataFrame | None = None,
    once: bool = False,
    changes: DataFrame | None = None,
    devices: DataFrame | None = None,
    id_pattern: str = schemas.UUID_PATTERN,
) -> StreamingQuery:
    """Starts the stream over messages and, optionally, streams of commands and of rule changes.

    Commands address an alert by alert_id, or a rule's active alert by alert_rule_id. `load_rules` is called per batch
    and gives the base rules: one edited there counts from the next batch on. A rule that a change of the stream touched
    goes by the stream from that change's time on; created rules need `devices`.
    """
    inputs = mark_sources(messages, commands, changes)

    def batch(rows: DataFrame, number: int) -> None:
        process_batch(rows, number, store, topic_root, load_rules(), users, devices, id_pattern)

    writer = inputs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def mark_sources(messages: DataFrame, commands: DataFrame | None = None, changes: DataFrame | None = None) -> DataFrame:
    """All inputs in one table; `source` tells them apart whatever else is null."""
    rows = messages.select(*schemas.MESSAGES.names, F.lit("message").alias("source"))
    if commands is not None:
        names = (schemas.ALERT_COMMANDS if "alert_id" in commands.columns else schemas.RULE_COMMANDS).names
        rows = rows.unionByName(commands.select(*names, F.lit("command").alias("source")), allowMissingColumns=True)
    if changes is not None:
        rows = rows.unionByName(changes.select(*schemas.RULE_CHANGES.names, F.lit("change").alias("source")), allowMissingColumns=True)
    return rows


def process_batch(
    rows: DataFrame,
    number: int,
    store: AlertStore,
    topic_root: str,
    rules: DataFrame,
    users: DataFrame | None = None,
    devices: DataFrame | None = None,
    id_pattern: str = schemas.UUID_PATTERN,
    before_commit: Callable[[], None] | None = None,
) -> None:
    """Telemetry first, then last-seen times, then rules and alerts: the order in which failures may strike.

    `rows` come from mark_sources; rows without a `source` column are messages, all of them. `before_commit` is called
    when all is written and nothing of it is visible yet; if it fails, so does the batch.
    """
    spark = rows.sparkSession
    writer = BatchWriter(spark, store, number)
    if writer.done_before:
        return
    state = lambda table: store.state(spark, table, writer.before)
    marked = "source" in rows.columns
    messages = rows.where(F.col("source") == "message") if marked else rows
    counts = Observation()
    try:
        parsed = writer.hold("parsed", parse_messages(messages.select(*schemas.MESSAGES.names), topic_root))
        # Counted while the rows are written, so that the counts cost no further pass.
        counted = parsed.observe(counts, *[F.count_if(F.col("reject_reason") == reason).alias(reason) for reason in REJECT_REASONS])
        telemetry = writer.add("telemetry", accepted(counted))
        writer.add("rejects", rejects(parsed))
    finally:
        writer.release()
    found = [(reason, n) for reason, n in counts.get.items() if n]
    writer.add("reject_counts", spark.createDataFrame(found, REJECT_COUNTS))

    # Only devices with a write in this batch; the state takes the newest time of each.
    writer.change("last_seen", last_written(telemetry, state("last_seen")))
    writer.merge("last_seen")

    rules = current_rules(spark, store, rules, writer.before)
    readings = judged_readings(telemetry, rules)
    if marked and "chg_id" in rows.columns:
        changes = rows.where(F.col("source") == "change").select(*schemas.RULE_CHANGES.names)
        if not changes.isEmpty():
            known = spark.createDataFrame([], schemas.DEVICES) if devices is None else devices
            timeline = RuleTimeline(telemetry, rules, known, changes, used=state("used_rules"), id_pattern=id_pattern)
            writer.change("rules", _changed_rules(timeline))
            writer.merge("rules")
            writer.add("rule_outcomes", timeline.outcomes)
            readings = timeline.readings

    active = state("alerts").where(is_active(F.col("status")))
    try:
        readings = writer.hold("readings", readings)
        alerts, outcomes = _alerts(rows, readings, active, writer, users, id_pattern)
        # Written before it is read twice more; rows that a batch leaves as they were are not written.
        changed = writer.change("alerts", _different(alerts, active))
        opened = changed.join(active.select("id"), "id", "left_anti").select(canonical_id(F.col("alert_rule_id")).alias("alert_rule_id"))
        writer.change("used_rules", opened.distinct())
        writer.merge("used_rules")
        if outcomes is not None:
            writer.add("outcomes", outcomes)
    finally:
        writer.release()
    writer.snapshot_alerts()
    if before_commit is not None:
        before_commit()
    writer.commit()


def _alerts(rows, readings, active, writer: BatchWriter, users, id_pattern) -> tuple[DataFrame, DataFrame | None]:
    """The alerts after the batch, and outcomes of its commands if it has any."""
    if "cmd_id" not in rows.columns:
        return replay_readings(readings, active), None
    names = (schemas.ALERT_COMMANDS if "alert_id" in rows.columns else schemas.RULE_COMMANDS).names
    commands = rows.where(F.col("source") == "command").select(*names)
    if commands.isEmpty():
        return replay_readings(readings, active), None
    if "alert_id" not in names:
        return replay_readings_with_commands(readings, commands, active, users)
    spark, store = writer.spark, writer.store
    closed = store.all(spark, "closed_alerts").select("id")
    resolved = store.state(spark, "alerts", writer.before).where(~is_active(F.col("status"))).select("id")
    return replay_addressed(readings, commands, active, users, closed.unionByName(resolved), id_pattern=id_pattern)


def _different(after: DataFrame, before: DataFrame) -> DataFrame:
    """Alerts that are new or have another status."""
    known = before.select("id", F.col("status").alias("_was"))
    return after.join(known, "id", "left").where(F.col("_was").isNull() | (F.col("_was") != F.col("status"))).drop("_was")


def _changed_rules(timeline: RuleTimeline) -> DataFrame:
    """Images of the rules that changes touched; one that is gone is marked deleted."""
    touched = timeline.touched.join(timeline.rules_after.withColumn("deleted", F.lit(False)), "id", "left")
    return touched.withColumn("deleted", F.coalesce("deleted", F.lit(True)))
