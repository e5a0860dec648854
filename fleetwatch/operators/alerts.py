"""The alert table: applied from single decisions, or replayed from a whole history."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import alert_id, canonical_id, filled, is_active, micros
from fleetwatch.functions.timeline import STRETCH_SECONDS, nearest
from fleetwatch.operators.rules import decision, enabled_rules, evaluate, match_rules
from fleetwatch.schemas import ALERTS

_ORDER = ["received_at", "rank", "seq"]
# Readings precede commands of the same instant.
_READING, _COMMAND = 0, 1


def _as_alerts(rows: DataFrame, **columns: Column) -> DataFrame:
    """Projects onto the alert columns; what is not given is null, times keep their type."""
    at = rows.schema["received_at"].dataType
    kinds = {f.name: at if f.name.endswith("_at") else f.dataType for f in ALERTS}
    return rows.select(
        *[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]
    )


def open_alerts(decisions: DataFrame) -> DataFrame:
    """A new open alert per create decision, with the rule's severity of this moment."""
    rows = decisions.where(F.col("decision") == "create")
    return _as_alerts(
        rows,
        id=alert_id(F.col("alert_rule_id"), F.col("received_at"), F.col("seq")),
        alert_rule_id=F.col("alert_rule_id"),
        device_id=F.col("device_id"),
        triggered_value=F.col("value"),
        severity=F.col("severity"),
        status=F.lit("open"),
        triggered_at=F.col("received_at"),
    )


def auto_resolve(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Closes every active alert of each rule with an auto-resolve decision."""
    ends = (
        decisions.where(F.col("decision") == "auto_resolve")
        .groupBy(canonical_id(F.col("alert_rule_id")).alias("_rule"))
        .agg(F.min("received_at").alias("_end"))
    )
    closes = is_active(F.col("status")) & F.col("_end").isNotNull()
    return (
        alerts.join(ends, canonical_id(F.col("alert_rule_id")) == F.col("_rule"), "left")
        .withColumns(
            {
                "resolved_at": F.when(closes, F.col("_end")).otherwise(F.col("resolved_at")),
                "status": F.when(closes, "resolved").otherwise(F.col("status")),
            }
        )
        .drop("_rule", "_end")
    )


def judged_readings(telemetry: DataFrame, rules: DataFrame) -> DataFrame:
    return evaluate(match_rules(telemetry, enabled_rules(rules))).select(
        "alert_rule_id",
        "device_id",
        "severity",
        "received_at",
        F.lit(_READING).alias("rank"),
        "seq",
        F.lit("reading").alias("kind"),
        "value",
        "breached",
    )


def _carried(initial_alerts: DataFrame) -> DataFrame:
    """One row per rule that starts out with an active alert, placed before all others."""
    return (
        initial_alerts.where(is_active(F.col("status")))
        .select(canonical_id(F.col("alert_rule_id")).alias("alert_rule_id"))
        .distinct()
        .withColumns({"kind": F.lit("carried"), "breached": F.lit(True)})
    )


def _commands(commands: DataFrame, users: DataFrame | None) -> DataFrame:
    """Commands as timeline rows, each marked when it cannot take effect for lack of a valid user."""
    rows = commands.select(
        canonical_id(F.col("alert_rule_id")).alias("alert_rule_id"),
        F.col("cmd_ts").alias("received_at"),
        F.lit(_COMMAND).alias("rank"),
        F.col("cmd_id").alias("seq"),
        F.col("action").alias("kind"),
        canonical_id(F.col("user_id")).alias("user_id"),
        F.when(
            ~filled(F.col("user_id")) | ~F.coalesce(F.col("action").isin("acknowledge", "resolve"), F.lit(False)),
            "bad_request",
        ).alias("refusal"),
    )
    if users is None:
        return rows
    known = users.select(canonical_id(F.col("id")).alias("user_id"), F.lit(True).alias("_known"))
    stranger = F.coalesce(F.col("refusal"), F.when(F.col("_known").isNull(), "invalid_user"))
    return rows.join(known, "user_id", "left").withColumn("refusal", stranger).drop("_known")


def _timeline(
    readings: DataFrame, initial_alerts: DataFrame | None, seconds: int, commands: DataFrame | None = None
) -> DataFrame:
    """Adds to each row whether the rule was active before it, what follows, and what it causes.

    After a reading, a rule is active exactly when that reading broke it; after a valid resolve it
    is not; an acknowledge changes nothing. So the state before a row, the end of an alert and its
    acknowledgement are each the nearest row of some kind: the sequential state machine needs no
    sequential pass. `cut` is the last row that left the rule inactive; the rows of one alert share
    it.
    """
    rows = readings if commands is None else readings.unionByName(commands, allowMissingColumns=True)
    if initial_alerts is not None:
        rows = rows.unionByName(_carried(initial_alerts), allowMissingColumns=True)
    for absent in {"user_id", "refusal"} - set(rows.columns):
        rows = rows.withColumn(absent, F.lit(None).cast("string"))

    kind, works = F.col("kind"), F.col("refusal").isNull()
    after = F.when(kind.isin("reading", "carried"), F.col("breached")).when(
        (kind == "resolve") & works, F.lit(False)
    )
    place, actor = F.struct(*_ORDER), F.struct(*_ORDER, "user_id")
    earlier, later = {"was": after}, {"end": F.when(~after, actor)}
    if commands is not None:
        earlier["cut"] = F.when(~after, place)
        later["ack"] = F.when((kind == "acknowledge") & works, actor)
    rows = nearest(rows, "alert_rule_id", _ORDER, earlier, later, seconds)
    if commands is None:
        rows = rows.withColumn("ack", F.lit(None).cast(rows.schema["end"].dataType))

    was = F.coalesce("was", F.lit(False))
    event = (
        F.when(kind == "reading", decision(F.col("breached"), was))
        .when(kind == "carried", kind)
        .when(F.col("refusal") == "bad_request", "bad_request")
        .when(~was, "conflict")
        .when(works, kind)
        .otherwise(F.col("refusal"))
    )
    in_time = F.col("end").isNull() | (F.col("ack") < F.col("end"))
    return rows.withColumns({"event": event, "ack": F.when(in_time, F.col("ack"))})


def _edges(readings: DataFrame, initial_alerts: DataFrame | None, seconds: int, *facts: str) -> DataFrame:
    """Readings that change their rule's state, and carried rows, with the time at which the alert they open ends.

    Without commands five columns are enough: rule, time, sequence, value and whether the rule is broken.
    """
    rows = readings.select("alert_rule_id", "received_at", "seq", "value", "breached", *facts)
    if initial_alerts is not None:
        # A carried row has no time, so it comes before all others, and no value.
        rows = rows.withColumn("kind", F.lit("reading")).unionByName(_carried(initial_alerts), allowMissingColumns=True)
    cleared = F.when(~F.col("breached"), F.col("received_at"))
    rows = nearest(rows, "alert_rule_id", ["received_at", "seq"], {"was": F.col("breached")}, {"cleared": cleared}, seconds)
    event = decision(F.col("breached"), F.coalesce("was", F.lit(False)))
    if initial_alerts is not None:
        event = F.when(F.col("kind") == "carried", "carried").otherwise(event)
    return rows.withColumn("event", event).where("event IS NOT NULL")


def _facts(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Edges with the device and the severity of their rule."""
    facts = rules.select(
        canonical_id(F.col("id")).alias("alert_rule_id"), canonical_id(F.col("device_id")).alias("device_id"), "severity"
    )
    return edges.join(facts.dropDuplicates(["alert_rule_id"]), "alert_rule_id", "left")


def alert_transitions(
    telemetry: DataFrame,
    rules: DataFrame,
    initial_alerts: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
) -> DataFrame:
    """Every create and auto-resolve of a history."""
    edges = _edges(judged_readings(telemetry, rules), initial_alerts, seconds).where(F.col("event") != "carried")
    return _facts(edges, rules).select(
        "alert_rule_id", "device_id", "severity", "received_at", "seq", "value", F.col("event").alias("decision")
    )


def replay_alerts(
    telemetry: DataFrame,
    rules: DataFrame,
    initial_alerts: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
) -> DataFrame:
    """The alert table after a history of readings: when each alert opened and when it cleared."""
    edges = _edges(judged_readings(telemetry, rules), initial_alerts, seconds).where(F.col("event") != "auto_resolve")
    return _alerts(_unattended(_facts(edges, rules)), initial_alerts)


def replay_readings(readings: DataFrame, initial_alerts: DataFrame | None = None, seconds: int = STRETCH_SECONDS) -> DataFrame:
    """replay_alerts for readings that are judged already, which carry the device and severity of their moment.

    readings: alert_rule_id, device_id, severity, received_at, seq, value, breached.
    """
    edges = _edges(readings, initial_alerts, seconds, "device_id", "severity").where(F.col("event") != "auto_resolve")
    return _alerts(_unattended(edges), initial_alerts)


def _unattended(edges: DataFrame) -> DataFrame:
    """Edges as rows of a timeline without people."""
    at, nobody = F.col("cleared"), F.lit(None).cast("string").alias("user_id")
    end = F.when(at.isNotNull(), F.struct(at.alias("received_at"), nobody))
    return edges.withColumns({"end": end, "ack": F.when(F.lit(False), end)})


def replay_with_commands(
    telemetry: DataFrame,
    rules: DataFrame,
    commands: DataFrame,
    initial_alerts: DataFrame | None = None,
    users: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """Readings and people's commands on one timeline: the alert table and an outcome per command.

    A command addresses the active alert of its rule. Resolving while the reading still breaks the
    rule lets the next such reading open a new alert.
    """
    return replay_readings_with_commands(judged_readings(telemetry, rules), commands, initial_alerts, users, seconds)


def replay_readings_with_commands(
    readings: DataFrame,
    commands: DataFrame,
    initial_alerts: DataFrame | None = None,
    users: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """replay_with_commands for readings that are judged already, as in replay_readings."""
    marked = readings.withColumns({"rank": F.lit(_READING), "kind": F.lit("reading")})
    rows = _timeline(marked, initial_alerts, seconds, _commands(commands, users))
    return _alerts(rows, initial_alerts), _outcomes(rows, initial_alerts)


def resolved_timeline(readings: DataFrame, initial_alerts: DataFrame, resolves: DataFrame, seconds: int = STRETCH_SECONDS) -> DataFrame:
    """The timeline of readings and of resolves that all work; resolves: alert_rule_id, received_at, seq, user_id."""
    deeds = resolves.select(
        "alert_rule_id", "received_at", F.lit(_COMMAND).alias("rank"), "seq", F.lit("resolve").alias("kind"), "user_id", F.lit(None).cast("string").alias("refusal")
    )
    marked = readings.withColumns({"rank": F.lit(_READING), "kind": F.lit("reading")})
    return _timeline(marked, initial_alerts, seconds, deeds)


def _alerts(rows: DataFrame, initial_alerts: DataFrame | None) -> DataFrame:
    fresh = _as_alerts(
        rows.where(F.col("event") == "create"),
        id=alert_id(F.col("alert_rule_id"), F.col("received_at"), F.col("seq")),
        alert_rule_id=F.col("alert_rule_id"),
        device_id=F.col("device_id"),
        triggered_value=F.col("value"),
        severity=F.col("severity"),
        status=F.when(F.col("end").isNotNull(), "resolved")
        .when(F.col("ack").isNotNull(), "acknowledged")
        .otherwise("open"),
        triggered_at=F.col("received_at"),
        acknowledged_at=F.col("ack.received_at"),
        acknowledged_by=F.col("ack.user_id"),
        resolved_at=F.col("end.received_at"),
        resolved_by=F.col("end.user_id"),
    )
    if initial_alerts is None:
        return fresh
    changes = rows.where(F.col("event") == "carried").select(
        F.col("alert_rule_id").alias("_rule"), F.col("ack").alias("_ack"), F.col("end").alias("_end")
    )
    acked = (F.col("status") == "open") & F.col("_ack").isNotNull()
    ended = is_active(F.col("status")) & F.col("_end").isNotNull()
    continued = (
        initial_alerts.join(changes, canonical_id(F.col("alert_rule_id")) == F.col("_rule"), "left")
        .withColumns(
            {
                "acknowledged_at": F.when(acked, F.col("_ack.received_at")).otherwise(F.col("acknowledged_at")),
                "acknowledged_by": F.when(acked, F.col("_ack.user_id")).otherwise(F.col("acknowledged_by")),
                "resolved_at": F.when(ended, F.col("_end.received_at")).otherwise(F.col("resolved_at")),
                "resolved_by": F.when(ended, F.col("_end.user_id")).otherwise(F.col("resolved_by")),
                "status": F.when(ended, "resolved").when(acked, "acknowledged").otherwise(F.col("status")),
            }
        )
        .drop("_rule", "_ack", "_end")
    )
    return continued.unionByName(fresh)


def _outcomes(rows: DataFrame, initial_alerts: DataFrame | None) -> DataFrame:
    """A resolve that meets an active alert succeeds; of an alert's acknowledges only the first."""
    cut = F.concat_ws("|", micros(F.col("cut.received_at")), "cut.rank", "cut.seq")
    commands = rows.where(F.col("rank") == _COMMAND).withColumn("cut", cut)
    place = F.struct("received_at", "seq")
    acks = commands.where(F.col("event") == "acknowledge").select(
        "alert_rule_id", "cut", place.alias("_first"), F.lit(False).alias("_taken")
    )
    if initial_alerts is not None:
        # An alert acknowledged before the start cannot be acknowledged again.
        taken = (
            initial_alerts.where(is_active(F.col("status")))
            .groupBy(canonical_id(F.col("alert_rule_id")).alias("alert_rule_id"))
            .agg(F.bool_and(F.col("status") == "acknowledged").alias("_taken"))
            .withColumn("cut", F.lit(""))
        )
        acks = acks.unionByName(taken, allowMissingColumns=True)
    firsts = acks.groupBy("alert_rule_id", "cut").agg(
        F.min("_first").alias("_first"), F.bool_or("_taken").alias("_taken")
    )
    is_late = F.coalesce("_taken", F.lit(False)) | F.coalesce(F.col("_first") < place, F.lit(False))
    # The state is checked before the user, as far as the outcome goes.
    outcome = (
        F.when((F.col("kind") == "acknowledge") & F.col("event").isin("acknowledge", "invalid_user") & is_late, "conflict")
        .when(F.col("event") == F.col("kind"), "ok")
        .otherwise(F.col("event"))
    )
    return commands.join(firsts, ["alert_rule_id", "cut"], "left").select(
        F.col("seq").alias("cmd_id"),
        F.col("received_at").alias("cmd_ts"),
        F.col("kind").alias("action"),
        "alert_rule_id",
        outcome.alias("outcome"),
    )
