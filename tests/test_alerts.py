import random
from datetime import timedelta

import pytest
from fixtures import A, RULE, T0, USER, alert, at, rows, seed_tables, telemetry

from fleetwatch import schemas
from fleetwatch.operators.alerts import alert_transitions, replay_alerts, replay_with_commands

TEMP = "temperature_c"


def commands(spark, data):
    return spark.createDataFrame(
        [(n, at(s), action, rule, user) for n, (s, action, rule, user) in enumerate(data)], schemas.RULE_COMMANDS
    )


def facts(alerts):
    return rows(alerts, "alert_rule_id", "status", "triggered_value", "triggered_at", "resolved_at")


def test_life_cycle(spark):
    history = telemetry(spark, [(A[2], {TEMP: v}, s) for v, s in ((33.0, 0), (33.0, 5), (24.0, 10))])
    rules = seed_tables(spark)["alert_rules"]
    assert facts(replay_alerts(history, rules)) == [
        (RULE[1], "resolved", 33.0, at(0), at(10)),
        (RULE[2], "resolved", 33.0, at(0), at(10)),
    ]
    assert len(facts(alert_transitions(history, rules).withColumnsRenamed({}).selectExpr(
        "alert_rule_id", "decision as status", "value as triggered_value", "received_at as triggered_at", "null as resolved_at"
    ))) == 4


def test_flapping_is_not_smoothed(spark):
    history = telemetry(spark, [(A[1], {"power_kw": 50.5 if n % 2 else 50.0}, n) for n in range(10)])
    alerts = replay_alerts(history, seed_tables(spark)["alert_rules"])
    assert alerts.count() == 5
    assert alerts.where("status = 'open'").count() == 1


def test_acknowledged_stays_active_and_resolves_by_itself(spark):
    history = telemetry(spark, [(A[2], {TEMP: v}, s) for v, s in ((33.0, 0), (33.0, 20), (24.0, 30))])
    cmds = commands(spark, [(10, "acknowledge", RULE[1], USER), (11, "acknowledge", RULE[1], USER)])
    alerts, outcomes = replay_with_commands(history, seed_tables(spark)["alert_rules"], cmds)
    first = alerts.where(f"alert_rule_id = '{RULE[1]}'").collect()
    assert len(first) == 1
    assert (first[0].status, first[0].acknowledged_by, first[0].resolved_by) == ("resolved", USER, None)
    assert (first[0].acknowledged_at, first[0].resolved_at) == (at(10), at(30))
    assert rows(outcomes, "cmd_id", "outcome") == [(0, "ok"), (1, "conflict")]


def test_resolving_by_hand_while_breaching_opens_a_second_alert(spark):
    history = telemetry(spark, [(A[1], {"power_kw": 60.0}, s) for s in (0, 20, 40)])
    cmds = commands(spark, [(10, "resolve", RULE[3], USER), (15, "resolve", RULE[3], USER)])
    alerts, outcomes = replay_with_commands(history, seed_tables(spark)["alert_rules"], cmds)
    assert facts(alerts) == [(RULE[3], "open", 60.0, at(20), None), (RULE[3], "resolved", 60.0, at(0), at(10))]
    assert rows(outcomes, "cmd_id", "outcome") == [(0, "ok"), (1, "conflict")]


def test_disabled_rule_leaves_its_alert_open(spark):
    before = spark.createDataFrame([alert("x", RULE[3], device=A[1])], schemas.ALERTS)
    rules = spark.createDataFrame([(RULE[3], A[1], "power_kw", "gt", 50.0, "warning", False, T0)], schemas.ALERT_RULES)
    after = replay_alerts(telemetry(spark, [(A[1], {"power_kw": 1.0}, 5)]), rules, before)
    assert rows(after, "id", "status", "resolved_at") == [("x", "open", None)]


def test_carried_alerts_keep_their_severity_and_all_resolve(spark):
    before = spark.createDataFrame(
        [alert("x", RULE[1], severity="critical"), alert("y", RULE[1].upper(), "acknowledged"), alert("z", RULE[1], "resolved", end=(1, USER))],
        schemas.ALERTS,
    )
    after = replay_alerts(telemetry(spark, [(A[2], {TEMP: 20.0}, 50)]), seed_tables(spark)["alert_rules"], before)
    assert rows(after, "id", "status", "severity", "resolved_at") == [
        ("x", "resolved", "critical", at(50)),
        ("y", "resolved", "warning", at(50)),
        ("z", "resolved", "warning", at(1)),
    ]


def test_same_history_gives_same_ids(spark):
    history = telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)])
    rules = seed_tables(spark)["alert_rules"]
    ids = [rows(replay_alerts(history, rules), "id") for _ in range(2)]
    assert ids[0] == ids[1]
    assert len(ids[0][0][0]) == 36


# -- against a message-by-message fold ---------------------------------------------------------


def fold(rules, readings, cmds, initial, users):
    """The alert table and command outcomes, one event at a time."""
    alerts = [dict(zip(schemas.ALERTS.names, a)) for a in initial]
    outcomes = []
    events = [(r[2], 0, r[3], r) for r in readings] + [(c[1], 1, c[0], c) for c in cmds]
    for when, kind, seq, event in sorted(events, key=lambda e: e[:3]):
        if kind == 0:
            device, values, _, _ = event
            for rule in rules:
                if rule[1] != device or not rule[6] or rule[2] not in values:
                    continue
                value, limit = values[rule[2]], rule[4]
                broken = {"gt": value > limit, "gte": value >= limit, "lt": value < limit, "lte": value <= limit}.get(rule[3], False)
                active = [a for a in alerts if a["alert_rule_id"] == rule[0] and a["status"] != "resolved"]
                if broken and not active:
                    alerts.append(dict(zip(schemas.ALERTS.names, (None, rule[0], device, value, rule[5], "open", when, None, None, None, None))))
                elif not broken:
                    for a in active:
                        a.update(status="resolved", resolved_at=when)
            continue
        cmd_id, _, action, rule_id, user = event
        active = [a for a in alerts if a["alert_rule_id"] == rule_id and a["status"] != "resolved"]
        if not user:
            outcomes.append((cmd_id, "bad_request"))
        elif not active or (action == "acknowledge" and active[0]["status"] == "acknowledged"):
            outcomes.append((cmd_id, "conflict"))
        elif user not in users:
            outcomes.append((cmd_id, "invalid_user"))
        else:
            outcomes.append((cmd_id, "ok"))
            for a in active:
                if action == "acknowledge":
                    a.update(status="acknowledged", acknowledged_at=when, acknowledged_by=user)
                else:
                    a.update(status="resolved", resolved_at=when, resolved_by=user)
    return alerts, outcomes


def random_history(seed):
    rnd = random.Random(seed)
    devices = [f"dev{n}" for n in range(12)]
    rules = []
    for n in range(40):
        rules.append(
            (f"rule{n}", rnd.choice(devices), rnd.choice("xyz"), rnd.choice(["gt", "gte", "lt", "lte", "odd"]),
             float(rnd.randint(2, 7)), rnd.choice(["warning", "critical"]), rnd.random() < 0.9, T0)
        )
    readings = []
    for seq in range(900):
        # One device sends a third of all messages; equal times are common.
        device = devices[0] if rnd.random() < 0.33 else rnd.choice(devices)
        values = {m: float(rnd.randint(0, 9)) for m in "xyz" if rnd.random() < 0.6} or {"x": 5.0}
        readings.append((device, values, T0 + timedelta(seconds=rnd.randint(0, 3000)), seq))
    initial = [alert(f"old{n}", f"rule{n}", rnd.choice(["open", "acknowledged", "resolved"]), triggered=-n) for n in range(0, 40, 3)]
    cmds = [
        (n, T0 + timedelta(seconds=rnd.randint(0, 3000)), rnd.choice(["acknowledge", "acknowledge", "resolve"]),
         f"rule{rnd.randint(0, 41)}", rnd.choice(["u1", "u2", "u3", "nobody", None, ""]))
        for n in range(400)
    ]
    return rules, readings, cmds, initial


@pytest.mark.parametrize("seed, seconds", [(1, 10), (2, 200), (3, 100_000)])
def test_replay_equals_a_fold(spark, seed, seconds):
    rules, readings, cmds, initial = random_history(seed)
    history = spark.createDataFrame([(d, "s", "t", v, when, when, seq) for d, v, when, seq in readings], schemas.TELEMETRY)
    rule_df = spark.createDataFrame(rules, schemas.ALERT_RULES)
    columns = [c for c in schemas.ALERTS.names if c != "id"]

    want, _ = fold(rules, readings, [], [], set())
    got = replay_alerts(history, rule_df, seconds=seconds)
    assert rows(got, *columns) == sorted((tuple(a[c] for c in columns) for a in want), key=repr)

    users = spark.createDataFrame([(u, u, u, "operator", T0) for u in ("u1", "u2", "u3")], schemas.USERS)
    want, outcomes = fold(rules, readings, cmds, initial, {"u1", "u2", "u3"})
    got, answered = replay_with_commands(
        history,
        rule_df,
        spark.createDataFrame(cmds, schemas.RULE_COMMANDS),
        spark.createDataFrame(initial, schemas.ALERTS),
        users,
        seconds,
    )
    assert rows(got, *columns) == sorted((tuple(a[c] for c in columns) for a in want), key=repr)
    assert rows(answered, "cmd_id", "outcome") == sorted(outcomes, key=repr)


def test_replay_without_broadcast(spark):
    """The same alerts when the rules are too large to broadcast and a hot device is split."""
    rules, readings, _, _ = random_history(4)
    history = spark.createDataFrame([(d, "s", "t", v, when, when, seq) for d, v, when, seq in readings], schemas.TELEMETRY)
    rule_df = spark.createDataFrame(rules, schemas.ALERT_RULES)
    want = facts(replay_alerts(history, rule_df))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert facts(replay_alerts(history, rule_df)) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_replay_shuffles_five_columns_and_the_stretch(spark):
    """No state, facts or copies of the time cross the network with the readings."""
    plan = replay_alerts(telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)]), seed_tables(spark)["alert_rules"])
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [lines[n + 1] for n, line in enumerate(lines) if "RepartitionByExpression" in line]
    assert below
    for line in below:
        for column in ("alert_rule_id", "received_at", "seq", "value", "breached", "_stretch"):
            assert column in line
        for column in ("device_id", "severity", "_in_", "struct("):
            assert f"{column}#" not in line and f"AS {column}" not in line
