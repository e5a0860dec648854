"""People's commands by alert id on the timeline of the readings.

An alert's id follows from the reading that opens it, so a command's id leads to that reading, whether or not it opens an
alert in the end. A resolve works if its alert is the rule's active one at that time; then the next broken reading opens
another alert, which may be resolved in turn. So within one run of broken readings the alerts form a chain: the run's
first reading, then after each resolve the next reading. Whether an addressed reading lies on the chain is found by
following its links in doubled steps, for addressed readings only. With the working resolves known, the timeline gives
every alert its end, and all outcomes follow from a join of commands with alerts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import alert_id, canonical_id, filled, is_active
from fleetwatch.functions.timeline import STRETCH_SECONDS, nearest
from fleetwatch.operators.alerts import resolved_timeline
from fleetwatch.schemas import ALERTS, UUID_PATTERN
from fleetwatch.session import kept

_READING, _COMMAND = 0, 1
_PLACE = ["received_at", "rank", "seq"]
#: What episodes take from the timeline.
_EPISODE = ["alert_rule_id", "device_id", "severity", "received_at", "seq", "value", "event", "end"]


def replay_addressed(
    readings: DataFrame,
    commands: DataFrame,
    initial_alerts: DataFrame | None = None,
    users: DataFrame | None = None,
    ended: DataFrame | None = None,
    seconds: int = STRETCH_SECONDS,
    id_pattern: str = UUID_PATTERN,
) -> tuple[DataFrame, DataFrame]:
    """The alert table after readings and commands by alert id, and one outcome per command.

    readings: alert_rule_id, device_id, severity, received_at, seq, value, breached, best a stored table. commands:
    cmd_id, cmd_ts, action, alert_id, user_id; readings precede commands of the same instant, commands go by cmd_id.
    Outcomes, the first that fits: bad_request (no user, unknown action), invalid_id, not_found (no such alert yet),
    conflict (resolved already, or acknowledged already), invalid_user, ok. `ended` holds in `id` alerts that were
    resolved before and are not among initial_alerts. Alerts of one rule that are carried in active each end by their own
    resolve, or all with the next unbroken reading.
    """
    spark = readings.sparkSession
    carried = spark.createDataFrame([], ALERTS) if initial_alerts is None else initial_alerts
    carried = carried.withColumns({c: canonical_id(F.col(c)) for c in ("id", "alert_rule_id")})
    asked = _kept(_asked(commands, users, id_pattern))
    resolves = asked.where("_refusal IS NULL AND _known AND action = 'resolve'")
    working = _working(readings, resolves, carried, seconds)
    # Each of these is read several times below; computed anew each time, the timeline would be built twelve times over.
    rows = _kept(resolved_timeline(readings, carried, _kept(working), seconds).where("event IN ('create', 'carried')").select(*_EPISODE))
    alerts = _kept(_episodes(rows, carried, resolves))
    judged = _kept(_judged(asked, alerts, ended))
    return _table(alerts, judged), judged.select("cmd_id", "cmd_ts", "action", "alert_id", "user_id", "outcome")


def _asked(commands: DataFrame, users: DataFrame | None, id_pattern: str) -> DataFrame:
    formed = F.coalesce(F.col("alert_id").rlike(id_pattern) & F.col("user_id").rlike(id_pattern), F.lit(False))
    action = F.coalesce(F.col("action").isin("acknowledge", "resolve"), F.lit(False))
    rows = commands.withColumns(
        {
            "_alert": canonical_id(F.col("alert_id")),
            "_user": canonical_id(F.col("user_id")),
            "_at": F.struct(F.col("cmd_ts").alias("received_at"), F.lit(_COMMAND).alias("rank"), F.col("cmd_id").alias("seq")),
            "_refusal": F.when(~filled(F.col("user_id")) | ~action, "bad_request").when(~formed, "invalid_id"),
        }
    )
    if users is None:
        return rows.withColumn("_known", F.lit(True))
    known = users.select(canonical_id(F.col("id")).alias("_user"), F.lit(True).alias("_is")).distinct()
    return rows.join(known, "_user", "left").withColumn("_known", F.col("_is").isNotNull()).drop("_is")


def _opening(row: str = "") -> Column:
    return F.struct(F.col(f"{row}received_at"), F.col(f"{row}seq"))


def _working(readings: DataFrame, resolves: DataFrame, carried: DataFrame, seconds: int) -> DataFrame:
    """Per resolve that works: alert_rule_id, received_at, seq, user_id."""
    wanted = resolves.select("_alert", "_at", "_user")
    first = F.min(F.struct("_at", "_user")).alias("_first")
    # Readings that commands name, each with the first valid resolve behind it.
    named = (
        readings.where("breached")
        .select(alert_id(F.col("alert_rule_id"), F.col("received_at"), F.col("seq")).alias("_alert"), "alert_rule_id", _opening().alias("opening"))
        .join(wanted, "_alert")
        .where(F.col("_at.received_at") >= F.col("opening.received_at"))
        .groupBy("alert_rule_id", "opening")
        .agg(first)
    )
    # A rule that starts out active stays so until all its active alerts are resolved.
    old = (
        carried.where(is_active(F.col("status")))
        .select(F.col("id").alias("_alert"), "alert_rule_id")
        .join(wanted.groupBy("_alert").agg(first), "_alert", "left")
        .groupBy("alert_rule_id")
        .agg(F.max("_first").alias("_first"), F.bool_and(F.col("_first").isNotNull()).alias("_all"))
        .where("_all")
        .select("alert_rule_id", F.lit(None).cast(named.schema["opening"].dataType).alias("opening"), "_first")
    )
    nodes = _kept(named.unionByName(old).select("alert_rule_id", "opening", "_first"))

    rules = nodes.select("alert_rule_id").distinct()
    active = carried.where(is_active(F.col("status"))).select("alert_rule_id").distinct().withColumn("breached", F.lit(True))
    rows = (
        readings.select("alert_rule_id", "received_at", F.lit(_READING).alias("rank"), "seq", "breached")
        .unionByName(active.withColumn("rank", F.lit(-1)), allowMissingColumns=True)
        .join(rules, "alert_rule_id", "left_semi")
        .unionByName(
            nodes.select("alert_rule_id", F.col("_first._at.received_at").alias("received_at"), F.col("_first._at.rank").alias("rank"), F.col("_first._at.seq").alias("seq"), "opening", "_first"),
            allowMissingColumns=True,
        )
    )
    place, reading = F.struct(*_PLACE), F.col("breached").isNotNull()
    placed = nearest(
        rows,
        "alert_rule_id",
        _PLACE,
        {"was": F.col("breached"), "cut": F.when(~F.col("breached"), _opening())},
        {"next": F.when(reading, F.struct(*_PLACE, "breached"))},
        seconds,
    )
    placed = _kept(placed.where(F.col("_first").isNotNull() | F.col("breached")).join(rules, "alert_rule_id", "left_semi"))
    firsts = placed.where("_first IS NULL AND rank = 0 AND NOT coalesce(was, false)").select("alert_rule_id", _opening().alias("opening"))
    whole = F.col("cut").isNull() | F.coalesce(F.col("cut") < F.col("opening"), F.lit(False))
    links = placed.where("_first IS NOT NULL").select(
        "alert_rule_id", "opening", "_first", whole.alias("whole"), F.when(whole & F.col("next.breached"), _opening("next.")).alias("next")
    )
    links = _kept(links)
    same = ["alert_rule_id", "opening"]
    reached = links.join(firsts, same, "left_semi").select(*same).unionByName(links.where("opening IS NULL").select(*same))
    reached = _follow(reached, links.select(*same, "next"))
    on_chain = F.col("r.alert_rule_id") == F.col("l.alert_rule_id")
    found = links.alias("l").join(reached.alias("r"), on_chain & F.col("r.opening").eqNullSafe(F.col("l.opening")), "left_semi")
    return found.where("whole").select(
        "alert_rule_id", F.col("_first._at.received_at").alias("received_at"), F.col("_first._at.seq").alias("seq"), F.col("_first._user").alias("user_id")
    )


def _follow(reached: DataFrame, links: DataFrame) -> DataFrame:
    """All openings on the chains that begin at the reached ones, in as many rounds as the longest chain has digits."""
    jump = links.where("next IS NOT NULL").join(links.select("alert_rule_id", F.col("opening").alias("next")), ["alert_rule_id", "next"], "left_semi")
    jump, reached = _kept(jump.select("alert_rule_id", "opening", "next")), _kept(reached)
    while not jump.isEmpty():
        from_here = F.col("r.alert_rule_id") == F.col("j.alert_rule_id")
        further = reached.alias("r").join(jump.alias("j"), from_here & F.col("r.opening").eqNullSafe(F.col("j.opening"))).select("r.alert_rule_id", F.col("j.next").alias("opening"))
        reached = _kept(reached.unionByName(further).distinct())
        twice = jump.alias("a").join(jump.alias("b"), (F.col("a.alert_rule_id") == F.col("b.alert_rule_id")) & (F.col("a.next") == F.col("b.opening")))
        jump = _kept(twice.select("a.alert_rule_id", "a.opening", "b.next"))
    return reached


def _kept(rows: DataFrame) -> DataFrame:
    return kept(rows, "chain")


def _episodes(rows: DataFrame, carried: DataFrame, resolves: DataFrame) -> DataFrame:
    """Every alert with the places where it opened (null for one carried in) and ended, and by whom."""
    end = F.when(F.col("end").isNotNull(), F.struct(*[F.col(f"end.{c}").alias(c) for c in _PLACE]))
    fresh = rows.where("event = 'create'").select(
        alert_id(F.col("alert_rule_id"), F.col("received_at"), F.col("seq")).alias("id"),
        "alert_rule_id",
        "device_id",
        F.col("value").alias("triggered_value"),
        "severity",
        F.lit("open").alias("status"),
        F.col("received_at").alias("triggered_at"),
        F.col("received_at").alias("_opened"),
        end.alias("_end"),
        F.col("end.user_id").alias("_ended_by"),
    )
    ends = rows.where("event = 'carried'").select("alert_rule_id", end.alias("_rule_end"))
    own = resolves.groupBy(F.col("_alert").alias("id")).agg(F.min(F.struct("_at", "_user")).alias("_own"))
    active = is_active(F.col("status"))
    by_hand = active & F.col("_own").isNotNull() & (F.col("_rule_end").isNull() | (F.col("_own._at") <= F.col("_rule_end")))
    old = (
        carried.join(ends, "alert_rule_id", "left")
        .join(own, "id", "left")
        .withColumns(
            {
                "_end": F.when(by_hand, F.col("_own._at")).when(active, F.col("_rule_end")),
                "_ended_by": F.when(by_hand, F.col("_own._user")),
            }
        )
        .drop("_rule_end", "_own")
    )
    return old.unionByName(fresh, allowMissingColumns=True)


def _judged(asked: DataFrame, alerts: DataFrame, ended: DataFrame | None) -> DataFrame:
    states = alerts.select(F.col("id").alias("_alert"), "status", "_opened", "_end")
    if ended is not None:
        past = ended.select(canonical_id(F.col("id")).alias("_alert")).join(asked.select("_alert"), "_alert", "left_semi")
        states = states.unionByName(past.withColumn("status", F.lit("resolved")), allowMissingColumns=True)
    met = asked.join(states, "_alert", "left")
    there = F.col("status").isNotNull() & (F.col("_opened").isNull() | (F.col("_opened") <= F.col("_at.received_at")))
    live = is_active(F.col("status")) & (F.col("_end").isNull() | (F.col("_at") <= F.col("_end")))
    acks = (F.col("_refusal").isNull() & F.col("_known") & (F.col("action") == "acknowledge") & there & live)
    firsts = met.where(acks).groupBy("_alert").agg(F.min("_at").alias("_first_ack"))
    unseen = (F.col("status") == "open") & (F.col("_first_ack").isNull() | (F.col("_at") <= F.col("_first_ack")))
    guard = live & F.when(F.col("action") == "acknowledge", unseen).otherwise(F.lit(True))
    outcome = (
        F.when(F.col("_refusal").isNotNull(), F.col("_refusal"))
        .when(~F.coalesce(there, F.lit(False)), "not_found")
        .when(~F.coalesce(guard, F.lit(False)), "conflict")
        .when(~F.col("_known"), "invalid_user")
        .otherwise("ok")
    )
    return met.join(firsts, "_alert", "left").withColumn("outcome", outcome)


def _table(alerts: DataFrame, judged: DataFrame) -> DataFrame:
    acks = (
        judged.where("outcome = 'ok' AND action = 'acknowledge'")
        .groupBy(F.col("_alert").alias("id"))
        .agg(F.min(F.struct(F.col("cmd_ts").alias("at"), F.col("_user").alias("by"))).alias("_ack"))
    )
    acked, ended = F.col("_ack").isNotNull(), F.col("_end").isNotNull()
    rows = alerts.join(acks, "id", "left").withColumns(
        {
            "acknowledged_at": F.when(acked, F.col("_ack.at")).otherwise(F.col("acknowledged_at")),
            "acknowledged_by": F.when(acked, F.col("_ack.by")).otherwise(F.col("acknowledged_by")),
            "resolved_at": F.when(ended, F.col("_end.received_at")).otherwise(F.col("resolved_at")),
            "resolved_by": F.when(ended, F.col("_ended_by")).otherwise(F.col("resolved_by")),
            "status": F.when(ended, "resolved").when(acked, "acknowledged").otherwise(F.col("status")),
        }
    )
    return rows.select(*ALERTS.names)
