"""Rule changes and commands by alert id on the timeline, against a fold over random histories."""

import random
from datetime import timedelta

import pytest
from fixtures import A, RULE, T0, USER, alert, at, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.columns import alert_id
from fleetwatch.operators.addressed import replay_addressed
from fleetwatch.operators.alerts import judged_readings, replay_alerts
from fleetwatch.operators.rule_versions import RuleTimeline, replay_with_rule_changes

ANY = r"^[0-9a-z]+(-[0-9a-z]+)*$"
NO_ID = [c for c in schemas.ALERTS.names if c != "id"]
WORDS = {"gt", "gte", "lt", "lte"}


def broken(operator, value, limit):
    return {"gt": value > limit, "gte": value >= limit, "lt": value < limit, "lte": value <= limit}.get(operator, False)


class Fold:
    """One event at a time: readings, rule changes, commands by alert id."""

    def __init__(self, spark, rules, devices, users, initial):
        self.rules = {r[0]: list(r) for r in rules}
        self.devices, self.users = devices, users
        self.alerts = [dict(zip(schemas.ALERTS.names, a)) for a in initial]
        self.outcomes = []
        self.spark = spark

    def ids(self, pairs):
        """{(rule, time, seq): the id the library gives}"""
        if not pairs:
            return {}
        df = self.spark.createDataFrame(list(pairs), "rule string, t timestamp, seq long")
        return {(r.rule, r.t, r.seq): r.id for r in df.select("*", alert_id(F.col("rule"), F.col("t"), F.col("seq")).alias("id")).collect()}

    def run(self, readings=(), changes=(), commands=()):
        names = self.ids({("rule", c[1], c[0]) for c in changes if c[2] == "create"})
        named = self.ids({(r, when, seq) for _, _, when, seq in readings for r in [*self.rules, *names.values()]})
        events = [(c[1], 0, c[0], c) for c in changes] + [(r[2], 1, r[3], r) for r in readings] + [(c[1], 2, c[0], c) for c in commands]
        for when, kind, seq, event in sorted(events, key=lambda e: e[:3]):
            if kind == 0:
                self.outcomes.append((seq, self.change(event, names)))
            elif kind == 1:
                self.reading(event, named)
            else:
                self.outcomes.append((seq, self.command(event)))

    def reading(self, event, named):
        device, values, when, seq = event
        for rule in self.rules.values():
            if rule[1] != device or not rule[6] or rule[2] not in values:
                continue
            active = [a for a in self.alerts if a["alert_rule_id"] == rule[0] and a["status"] != "resolved"]
            hit = broken(rule[3], values[rule[2]], rule[4])
            if hit and not active:
                facts = (named[rule[0], when, seq], rule[0], device, values[rule[2]], rule[5], "open", when, None, None, None, None)
                self.alerts.append(dict(zip(schemas.ALERTS.names, facts)))
            elif not hit:
                for a in active:
                    a.update(status="resolved", resolved_at=when)

    def change(self, event, names):
        chg, when, action, rule, device, metric, operator, threshold, severity, enabled = event
        metric, threshold, enabled = metric or "", threshold or 0.0, True if enabled is None else enabled
        words = operator in WORDS and severity in schemas.SEVERITIES
        if action == "create":
            if not (metric and words and device in self.devices):
                return "bad_request"
            made = names["rule", when, chg]
            self.rules[made] = [made, device, metric, operator, threshold, severity, enabled, when]
            return "ok"
        if action not in ("update", "delete"):
            return "bad_request"
        if rule is None or not rule.replace("-", "").isalnum():
            return "invalid_id"
        if rule not in self.rules:
            return "not_found"
        if action == "delete":
            if any(a["alert_rule_id"] == rule for a in self.alerts):
                return "conflict"
            del self.rules[rule]
        elif not words:
            return "bad_request"
        else:
            self.rules[rule][2:7] = [metric, operator, threshold, severity, enabled]
        return "ok"

    def command(self, event):
        _, when, action, target, user = event
        if not user or action not in ("acknowledge", "resolve"):
            return "bad_request"
        if target is None or "!" in target or "!" in user:
            return "invalid_id"
        found = [a for a in self.alerts if a["id"] == target]
        if not found:
            return "not_found"
        a = found[0]
        if a["status"] == "resolved" or (action == "acknowledge" and a["status"] != "open"):
            return "conflict"
        if user not in self.users:
            return "invalid_user"
        if action == "acknowledge":
            a.update(status="acknowledged", acknowledged_at=when, acknowledged_by=user)
        else:
            a.update(status="resolved", resolved_at=when, resolved_by=user)
        return "ok"


def world(seed, n=500):
    rnd = random.Random(seed)
    devices = [f"dev{k}" for k in range(5)]
    rules = [(f"rule{k}", rnd.choice(devices), rnd.choice("xyz"), rnd.choice(["gt", "lt", "gte", "odd"]), float(rnd.randint(2, 7)), "warning", rnd.random() < 0.9, T0) for k in range(12)]
    readings = [(devices[0] if rnd.random() < 0.4 else rnd.choice(devices), {m: float(rnd.randint(0, 9)) for m in "xyz" if rnd.random() < 0.6} or {"x": 1.0}, T0 + timedelta(seconds=rnd.randint(0, 1500)), k) for k in range(n)]
    return rnd, devices, rules, readings


def history(spark, readings):
    return spark.createDataFrame([(d, "s", "t", v, when, when, seq) for d, v, when, seq in readings], schemas.TELEMETRY)


def edits(rnd, devices, n=150):
    out = []
    for k in range(n):
        action = rnd.choice(["create", "update", "update", "update", "delete", "nothing"])
        out.append((k, T0 + timedelta(seconds=rnd.randint(0, 1500)), action, rnd.choice([f"rule{rnd.randint(0, 13)}"] * 9 + ["no id!", None]), rnd.choice([*devices, "nowhere"]), rnd.choice(["x", "y", "z", None]),
                    rnd.choice(["gt", "lt", "gte", "lte", "eq"]), rnd.choice([2.0, 5.0, 8.0, None]), rnd.choice(["critical", "critical", "fatal"]), rnd.choice([True, None, False])))
    return out


@pytest.mark.parametrize("seed, seconds", [(1, 60), (2, 100_000)])
def test_rule_changes_equal_a_fold(spark, seed, seconds):
    rnd, devices, rules, readings = world(seed)
    changes = edits(rnd, devices)
    initial = [alert("a", "rule1", device="dev1"), alert("b", "rule2", "resolved", end=(0, USER))]
    # Later changes also address a rule that an earlier change created.
    fold = Fold(spark, rules, devices, {USER}, initial)
    born = next(c for c in sorted(changes, key=lambda c: c[1]) if c[2] == "create" and c[4] in devices and c[5] and c[6] in WORDS and c[8] == "critical")
    made = fold.ids({("rule", born[1], born[0])})["rule", born[1], born[0]]
    changes += [(900 + k, born[1] + timedelta(seconds=s), "update", made, None, "x", "gt", float(k), "warning", True) for k, s in enumerate((-5, 0, 30, 300))]
    changes += [(950, born[1] + timedelta(seconds=1), "delete", made, None, None, None, None, None, None)] if seed == 2 else []
    fold.run(readings, changes)
    devices_df = seed_tables(spark)["devices"].limit(0).unionByName(spark.createDataFrame([(d, "s", d, "ups", None, T0) for d in devices], schemas.DEVICES))
    got, after, outcomes = replay_with_rule_changes(
        history(spark, readings), spark.createDataFrame(rules, schemas.ALERT_RULES), devices_df, spark.createDataFrame(changes, schemas.RULE_CHANGES),
        spark.createDataFrame(initial, schemas.ALERTS), seconds=seconds, id_pattern=ANY,
    )
    assert rows(outcomes, "chg_id", "outcome") == sorted(fold.outcomes, key=repr)
    assert {"ok", "conflict", "not_found", "bad_request", "invalid_id"} == {o for _, o in fold.outcomes}
    assert rows(after, *schemas.ALERT_RULES.names) == sorted(map(tuple, fold.rules.values()), key=repr)
    assert rows(got, *NO_ID) == sorted((tuple(a[c] for c in NO_ID) for a in fold.alerts), key=repr)


def test_a_deleted_rule_opens_nothing_and_a_used_one_stays(spark):
    tables = seed_tables(spark)
    events = telemetry(spark, [(A[1], {"power_kw": v}, s) for v, s in ((10.0, 0), (60.0, 20), (60.0, 40))])
    delete = lambda s: spark.createDataFrame([(1, at(s), "delete", RULE[3], None, None, None, None, None, None)], schemas.RULE_CHANGES)
    for s, outcome, opened in ((10, "ok", 0), (20, "ok", 0), (21, "conflict", 1)):
        alerts, after, outcomes = replay_with_rule_changes(events, tables["alert_rules"], tables["devices"], delete(s))
        assert rows(outcomes, "outcome") == [(outcome,)] and alerts.count() == opened and after.count() == 2 + opened
    timeline = RuleTimeline(events, tables["alert_rules"], tables["devices"], delete(10).limit(0))
    assert timeline.readings.count() == 3 and timeline.rules_after.count() == 3 and timeline.touched.count() == 0


@pytest.mark.parametrize("seed, seconds", [(3, 60), (4, 100_000)])
def test_commands_by_alert_id_equal_a_fold(spark, seed, seconds):
    rnd, devices, rules, readings = world(seed, 350)
    # Long broken runs, so that resolving by hand opens alert after alert.
    rules = [(r[0], r[1], r[2], "gte", float(rnd.randint(0, 3)), r[5], r[6], r[7]) for r in rules]
    initial = [alert("a", "rule1", device="dev1"), alert("b", "rule2", "acknowledged", ack=(0, USER)), alert("c", "rule2"), alert("d", "rule3", "resolved", end=(0, USER))]
    users = {"u1", "u2"}
    users_df = spark.createDataFrame([(u, u, u, "operator", T0) for u in users], schemas.USERS)
    fold = Fold(spark, rules, devices, users, initial)
    every = fold.ids({(r[0], when, seq) for d, _, when, seq in readings for r in rules if r[1] == d})
    commands, n = [], 0
    for (_, when, _), name in sorted(every.items(), key=repr):
        for _ in range(rnd.choice([0, 1, 1, 2])):
            n += 1
            commands.append((n, when + timedelta(seconds=rnd.choice([-3, 0, 1, 5, 40])), rnd.choice(["resolve", "resolve", "acknowledge"]), name, rnd.choice(["u1", "u2", "u1", "stranger", None])))
    for target in ["a", "b", "c", "d", "no!", "unknown", None] * 3:
        n += 1
        commands.append((n, T0 + timedelta(seconds=rnd.randint(0, 300)), rnd.choice(["resolve", "acknowledge", "look"]), target, "u2"))
    fold.run(readings, commands=commands)
    rule_df = spark.createDataFrame(rules, schemas.ALERT_RULES)
    past = spark.createDataFrame([("d",)], "id string")
    for old, ended in ((initial, None), (initial[:3], past)):
        got, outcomes = replay_addressed(
            judged_readings(history(spark, readings), rule_df), spark.createDataFrame(commands, schemas.ALERT_COMMANDS),
            spark.createDataFrame(old, schemas.ALERTS), users_df, ended, seconds, ANY,
        )
        assert rows(outcomes, "cmd_id", "outcome") == sorted(fold.outcomes, key=repr)
        want = [a for a in fold.alerts if ended is None or a["id"] != "d"]
        assert rows(got, *schemas.ALERTS.names) == sorted((tuple(a[c] for c in schemas.ALERTS.names) for a in want), key=repr)
    assert {"ok", "conflict", "not_found", "invalid_user", "bad_request", "invalid_id"} == {o for _, o in fold.outcomes}
    by_hand = [a for a in fold.alerts if a["resolved_by"]]
    assert len(by_hand) > 10


def test_current_ended_and_unknown_ids(spark):
    tables = seed_tables(spark)
    events = telemetry(spark, [(A[1], {"power_kw": 60.0}, s) for s in (0, 20, 40, 60)])
    ids = [r[0] for r in events.orderBy("seq").select(alert_id(F.lit(RULE[3]), F.col("received_at"), F.col("seq"))).collect()]
    data = [(5, "resolve", ids[0]), (6, "resolve", ids[0]), (25, "acknowledge", ids[1]), (26, "resolve", ids[1]), (27, "resolve", ids[3]), (50, "resolve", ids[3]), (50, "acknowledge", ids[2])]
    commands = spark.createDataFrame([(n, at(s), action, i, USER) for n, (s, action, i) in enumerate(data)], schemas.ALERT_COMMANDS)
    alerts, outcomes = replay_addressed(judged_readings(events, tables["alert_rules"]), commands)
    assert rows(outcomes, "cmd_id", "outcome") == [(0, "ok"), (1, "conflict"), (2, "ok"), (3, "ok"), (4, "not_found"), (5, "not_found"), (6, "ok")]
    assert rows(alerts, "id", "status") == sorted([(ids[0], "resolved"), (ids[1], "resolved"), (ids[2], "acknowledged")], key=repr)


def test_no_commands_is_the_plain_replay(spark):
    tables = seed_tables(spark)
    events = telemetry(spark, [(A[1], {"power_kw": v}, s) for s, v in enumerate((60.0, 10.0, 60.0))])
    alerts, outcomes = replay_addressed(judged_readings(events, tables["alert_rules"]), spark.createDataFrame([], schemas.ALERT_COMMANDS))
    assert rows(alerts, *schemas.ALERTS.names) == rows(replay_alerts(events, tables["alert_rules"]), *schemas.ALERTS.names)
    assert outcomes.count() == 0


def test_the_timeline_is_not_built_again_by_what_is_read(spark, capsys):
    tables = seed_tables(spark)
    events = telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)])
    commands = spark.createDataFrame([(1, at(5), "resolve", "no-such", USER)], schemas.ALERT_COMMANDS)
    for found in replay_addressed(judged_readings(events, tables["alert_rules"]), commands):
        found.explain()
        plan = capsys.readouterr().out
        assert "Window" not in plan and "FileScan" in plan
