import random
from datetime import timedelta

import pytest
from fixtures import SITE_B, SITE_R, T0, USER, A, B, RULE, alert, at, rows, seed_tables

from fleetwatch import schemas
from fleetwatch.operators.deletes import apply_deletes

DELETES = "del_id long, del_ts timestamp, table_name string, row_id string"


def test_parents_go_once_their_dependants_went(spark):
    tables = seed_tables(spark)
    tables["alerts"] = spark.createDataFrame([alert("x", RULE[3], "resolved", device=A[1], end=(1, USER))], schemas.ALERTS)
    steps = [
        ("devices", A[2], "conflict"), ("alert_rules", RULE[1], "ok"), ("devices", A[2], "conflict"), ("alert_rules", RULE[2].upper(), "ok"),
        ("alert_rules", RULE[2], "not_found"), ("devices", A[2], "ok"), ("alert_rules", RULE[3], "conflict"), ("devices", A[1], "conflict"),
        ("sites", SITE_R, "conflict"), *[("devices", B[n], "ok") for n in (1, 2, 3)], ("sites", SITE_R, "ok"), ("sites", SITE_B, "conflict"),
        ("users", USER, "ok"), ("users", USER, "not_found"), ("alerts", "x", "bad_request"), ("sites", "nowhere", "not_found"), (None, None, "bad_request"), ("sites", None, "not_found"),
    ]
    deletes = spark.createDataFrame([(n, at(n // 3), t, i) for n, (t, i, _) in enumerate(steps)], DELETES)
    after, outcomes = apply_deletes(tables, deletes)
    assert sorted(rows(outcomes, "del_id", "outcome")) == [(n, o) for n, (_, _, o) in enumerate(steps)]
    assert rows(after["sites"], "id") == [(SITE_B,)] and after["devices"].count() == 3
    assert rows(after["alert_rules"], "id") == [(RULE[3],)] and after["users"].count() == 0
    assert rows(after["alerts"], "id", "resolved_by") == [("x", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_deletes_equal_a_fold(spark, seed):
    rnd = random.Random(seed)
    site = lambda n: (f"s{n}", "n", "building", None, T0)
    sites = [site(n) for n in range(4)]
    devices = [(f"d{n}", f"s{n % 4 if n > 2 else 0}", "n", "ups", None, T0) for n in range(9)]
    rules = [(f"r{n}", f"d{rnd.randrange(9)}", "x", "gt", 1.0, "warning", True, T0) for n in range(12)]
    alerts = [alert("a", "r1", device=rules[1][1])]
    pools = {"sites": [r[0] for r in sites], "devices": [r[0] for r in devices], "alert_rules": [r[0] for r in rules]}
    asked = [(n, T0 + timedelta(seconds=rnd.randint(0, 200)), t, rnd.choice([*pools[t], "none"])) for n in range(400) for t in [rnd.choice(list(pools))]]
    asked = [(n, when, t, i) for n, (_, when, t, i) in enumerate(asked)]
    state = {"sites": {r[0]: None for r in sites}, "devices": {r[0]: r[1] for r in devices}, "alert_rules": {r[0]: r[1] for r in rules}}
    want = []
    for n, _, table, name in sorted(asked, key=lambda x: (x[1], x[0])):
        below = {"sites": "devices", "devices": "alert_rules", "alert_rules": None}[table]
        if name not in state[table]:
            want.append((n, "not_found"))
        elif (below and name in state[below].values()) or (table == "alert_rules" and name == "r1") or (table == "devices" and name == rules[1][1]):
            want.append((n, "conflict"))
        else:
            del state[table][name]
            want.append((n, "ok"))
    tables = {name: spark.createDataFrame(data, schemas.TABLES[name]) for name, data in (("sites", sites), ("devices", devices), ("alert_rules", rules), ("alerts", alerts), ("users", []))}
    after, outcomes = apply_deletes(tables, spark.createDataFrame(asked, DELETES))
    assert sorted(rows(outcomes, "del_id", "outcome")) == sorted(want)
    for table, left in state.items():
        assert {r[0] for r in rows(after[table], "id")} == set(left)
    assert {o for _, o in want} == {"ok", "conflict", "not_found"} and len(state["sites"]) < 4
