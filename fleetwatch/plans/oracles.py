"""The same results in plain SQL, for checking. Written from the rules, not from the Spark code."""

from fleetwatch.functions.columns import parse_rfc3339
from fleetwatch.plans import queries as q
from fleetwatch.plans.views import RULES, TOPIC_ROOT
from fleetwatch.schemas import DEVICE_TYPES, OPERATORS, ROLES, SEVERITIES, SITE_TYPES, STATUSES


def _words(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_RULE_ROWS = ", ".join(f"({n}, '{m}', '{o}', {t}, '{s}')" for n, (m, o, t, s) in enumerate(RULES))
_BREACHED = """(CASE operator WHEN 'gt' THEN value > threshold WHEN 'gte' THEN value >= threshold
    WHEN 'lt' THEN value < threshold WHEN 'lte' THEN value <= threshold ELSE false END)"""


def _uuid(text: str) -> str:
    h = f"sha256({text})"
    return (
        f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), "
        f"substr({h}, 21, 12))"
    )


def _replay(matches: str) -> str:
    """Alerts out of a table of evaluated readings, by LAG and LEAD."""
    return f"""
    SELECT {_uuid("concat_ws('|', alert_rule_id, epoch_us(received_at), seq)")} AS id, alert_rule_id, device_id,
           value AS triggered_value, severity,
           CASE WHEN ended IS NULL THEN 'open' ELSE 'resolved' END AS status, received_at AS triggered_at,
           CAST(NULL AS TIMESTAMP) AS acknowledged_at, CAST(NULL AS VARCHAR) AS acknowledged_by,
           ended AS resolved_at, CAST(NULL AS VARCHAR) AS resolved_by
    FROM (
        SELECT *, lead(received_at) OVER (PARTITION BY alert_rule_id ORDER BY received_at, seq) AS ended
        FROM (
            SELECT *, coalesce(lag(breached) OVER (PARTITION BY alert_rule_id ORDER BY received_at, seq), false) AS was
            FROM {matches}
        ) WHERE breached <> was
    ) WHERE breached"""


# Views in the order in which they build on one another.
_VIEWS = {
    "v_sites": """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name,
           CASE n_regionkey % 3 WHEN 0 THEN 'data_center' WHEN 1 THEN 'building' ELSE 'factory' END AS type,
           CASE WHEN n_nationkey % 5 <> 0 THEN r_name END AS location, TIMESTAMP '2024-01-01' AS created_at
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_devices": """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS site_id, c_name AS name,
           c_mktsegment AS type, CAST(NULL AS TIMESTAMP) AS last_seen_at, TIMESTAMP '2024-01-01' AS created_at
    FROM customer""",
    "v_rules": f"""
    SELECT CAST(c_custkey * 10 + n AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS device_id, metric, operator,
           CAST(threshold AS DOUBLE) AS threshold, severity, c_custkey % 7 <> 0 AS enabled,
           TIMESTAMP '2024-01-01' AS created_at
    FROM customer, (VALUES {_RULE_ROWS}) AS r(n, metric, operator, threshold, severity)""",
    "v_users": """
    SELECT CAST(s_suppkey AS VARCHAR) AS id,
           'user' || CASE WHEN s_suppkey % 11 = 0 THEN 0 ELSE s_suppkey END AS email, s_name AS name,
           CASE s_suppkey % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'operator' ELSE 'guest' END AS role,
           TIMESTAMP '2024-01-01' AS created_at
    FROM supplier""",
    "v_telemetry": """
    SELECT CAST(user_id AS VARCHAR) AS device_id, coalesce(CAST(c_nationkey AS VARCHAR), 'nowhere') AS site_id,
           coalesce(c_mktsegment, 'unknown') AS device_type, event_type AS metric, value, ts,
           ts + to_seconds(event_id % 5) AS received_at, event_id AS seq
    FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "v_matches": f"""
    SELECT r.id AS alert_rule_id, t.device_id, r.severity, r.operator, r.threshold, t.metric, t.value,
           t.received_at, t.seq, r.enabled, {_BREACHED} AS breached
    FROM v_telemetry t JOIN v_rules r ON r.device_id = t.device_id AND r.metric = t.metric""",
    "v_live": "SELECT * FROM v_matches WHERE enabled",
    "v_alerts": _replay("v_live"),
    "v_newest": """
    SELECT device_id, arg_max(seq, (received_at, seq)) AS seq FROM v_telemetry GROUP BY device_id""",
    "v_before": "SELECT m.* FROM v_live m ANTI JOIN v_newest n ON m.device_id = n.device_id AND m.seq = n.seq",
    "v_earlier": _replay("v_before"),
    "v_decisions": """
    SELECT m.alert_rule_id, m.device_id, m.severity, m.received_at, m.seq, m.value,
           CASE WHEN breached THEN 'create' ELSE 'auto_resolve' END AS decision
    FROM v_live m JOIN v_newest n ON m.device_id = n.device_id AND m.seq = n.seq
    WHERE breached <> (m.alert_rule_id IN (SELECT alert_rule_id FROM v_earlier WHERE status = 'open'))""",
    "v_damage": """
    SELECT *, CASE WHEN seq % 10 = 0 THEN seq % 100 // 10 END AS kind FROM v_telemetry""",
    "v_parsed": """
    SELECT * EXCLUDE (value), value AS sent, CASE WHEN kind = 8 THEN 0 ELSE value END AS value,
           CASE WHEN kind = 0 THEN 'bad_topic' WHEN kind IN (1, 5, 6, 7) THEN 'invalid_json'
                WHEN kind IN (2, 9) THEN 'missing_field' WHEN kind = 3 THEN 'empty_readings'
                WHEN kind = 4 THEN 'id_mismatch' END AS reject_reason
    FROM v_damage""",
    "v_topics": f"""
    SELECT *, CASE WHEN kind = 0 THEN 'no' ELSE '' END || '{TOPIC_ROOT}/' || site_id || '/' ||
           CASE WHEN kind = 4 THEN 'x' ELSE device_id END || '/telemetry' AS topic
    FROM v_parsed""",
    "v_commands": """
    SELECT o * 3 + n AS cmd_id, triggered_at + INTERVAL 1 HOUR AS cmd_ts,
           CASE WHEN (o + n * n) % 3 = 0 THEN 'resolve' ELSE 'acknowledge' END AS action,
           CASE WHEN (o + n) % 19 = 0 THEN '0' || substr(id, 2, 40) ELSE id END AS alert_id,
           CASE WHEN (o + n) % 11 = 0 THEN NULL WHEN (o + n) % 13 = 0 THEN '999999999'
                WHEN (o + n) % 17 = 0 THEN 'no such id!' ELSE CAST((o + n) % 10 AS VARCHAR) END AS user_id
    FROM (SELECT *, epoch_us(triggered_at) AS o FROM v_earlier), (VALUES (0), (1), (2)) AS k(n)""",
    "v_changes": """
    SELECT o_orderkey * 3 + n AS chg_id, o_orderdate AS chg_ts,
           CASE WHEN x % 5 = 0 THEN 'create' WHEN x % 5 < 4 THEN 'update' ELSE 'delete' END AS action,
           CASE WHEN x % 29 = 0 THEN 'bad id!'
                WHEN x % 5 <> 0 THEN CAST(o_custkey * 10 + x % 7 AS VARCHAR) END AS rule_id,
           CASE WHEN x % 23 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE '999999999' END AS device_id,
           CASE WHEN x % 31 <> 0 THEN 'view' END AS metric,
           CASE WHEN o_orderkey % 11 = 0 THEN 'eq'
                ELSE ['gt', 'gte', 'lt', 'lte', 'eq'][CAST(x % 5 + 1 AS INTEGER)] END AS operator,
           CASE WHEN x % 3 <> 0 THEN o_totalprice END AS threshold,
           CASE WHEN o_orderkey % 17 = 0 THEN 'fatal' ELSE 'critical' END AS severity,
           CASE WHEN x % 4 <> 0 THEN x % 2 = 0 END AS enabled
    FROM (SELECT *, o_orderkey * 7 + n * 3 AS x FROM orders, (VALUES (0), (1), (2)) AS k(n))""",
}


def _commands(where: str = "true") -> str:
    """Commands one after another: counts of the earlier valid ones tell what each of them meets."""
    return f"""
    SELECT c.*, CASE
        WHEN c.user_id IS NULL THEN 'bad_request' WHEN c.user_id = 'no such id!' THEN 'invalid_id'
        WHEN c.status IS NULL THEN 'not_found'
        WHEN NOT CASE c.action WHEN 'acknowledge' THEN c.status = 'open' AND c.resolves + c.acks = 0
                 ELSE c.status IN ('open', 'acknowledged') AND c.resolves = 0 END THEN 'conflict'
        WHEN NOT valid THEN 'invalid_user' ELSE 'ok' END AS outcome
    FROM (
        SELECT *, coalesce(sum(CASE WHEN valid AND action = 'resolve' THEN 1 END) OVER w, 0) AS resolves,
               coalesce(sum(CASE WHEN valid AND action = 'acknowledge' THEN 1 END) OVER w, 0) AS acks
        FROM (
            SELECT c.*, a.status, u.id IS NOT NULL AS valid
            FROM v_commands c LEFT JOIN v_earlier a ON a.id = c.alert_id LEFT JOIN v_users u ON u.id = c.user_id
            WHERE {where}
        )
        WINDOW w AS (PARTITION BY alert_id ORDER BY cmd_ts, cmd_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ) c"""


def _alerts_after(outcomes: str) -> str:
    return f"""
    SELECT a.id, a.alert_rule_id, a.device_id, a.triggered_value, a.severity,
           CASE WHEN e.alert_id IS NOT NULL THEN 'resolved' WHEN k.alert_id IS NOT NULL THEN 'acknowledged'
                ELSE a.status END AS status,
           a.triggered_at, k.cmd_ts AS acknowledged_at, k.user_id AS acknowledged_by,
           coalesce(e.cmd_ts, a.resolved_at) AS resolved_at, e.user_id AS resolved_by
    FROM v_earlier a
    LEFT JOIN (SELECT * FROM {outcomes} WHERE outcome = 'ok' AND action = 'acknowledge') k ON k.alert_id = a.id
    LEFT JOIN (SELECT * FROM {outcomes} WHERE outcome = 'ok' AND action = 'resolve') e ON e.alert_id = a.id"""


def _changes(where: str = "true") -> str:
    """Rule changes one after another."""
    return f"""
    SELECT *, CASE
        WHEN action = 'create' THEN
            CASE WHEN metric IS NOT NULL AND words AND device_id <> '999999999' THEN 'ok' ELSE 'bad_request' END
        WHEN rule_id = 'bad id!' THEN 'invalid_id'
        WHEN NOT known OR (NOT used AND deletes > 0) THEN 'not_found'
        WHEN action = 'delete' AND used THEN 'conflict'
        WHEN action = 'update' AND NOT words THEN 'bad_request' ELSE 'ok' END AS outcome
    FROM (
        SELECT *, coalesce(sum(CASE WHEN action = 'delete' THEN 1 END) OVER w, 0) AS deletes
        FROM (
            SELECT c.*, c.operator <> 'eq' AND c.severity <> 'fatal' AS words, r.id IS NOT NULL AS known,
                   u.alert_rule_id IS NOT NULL AS used
            FROM v_changes c LEFT JOIN v_rules r ON r.id = c.rule_id
            LEFT JOIN (SELECT DISTINCT alert_rule_id FROM v_alerts) u ON u.alert_rule_id = c.rule_id
            WHERE {where}
        )
        WINDOW w AS (PARTITION BY rule_id ORDER BY chg_ts, chg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )"""


_CREATED = """
    SELECT device_id, metric, operator, coalesce(threshold, 0) AS threshold, severity,
           coalesce(enabled, true) AS enabled, chg_ts AS created_at
    FROM v_outcomes WHERE action = 'create' AND outcome = 'ok'"""
_KEPT = """
    SELECT r.id, r.device_id, coalesce(u.metric, r.metric) AS metric, coalesce(u.operator, r.operator) AS operator,
           coalesce(u.threshold, r.threshold) AS threshold, coalesce(u.severity, r.severity) AS severity,
           coalesce(u.enabled, r.enabled) AS enabled, r.created_at
    FROM v_rules r LEFT JOIN (
        SELECT rule_id, coalesce(metric, '') AS metric, operator, coalesce(threshold, 0) AS threshold, severity,
               coalesce(enabled, true) AS enabled
        FROM v_outcomes WHERE action = 'update' AND outcome = 'ok'
        QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY chg_ts DESC, chg_id DESC) = 1
    ) u ON u.rule_id = r.id
    WHERE r.id NOT IN (SELECT rule_id FROM v_outcomes WHERE action = 'delete' AND outcome = 'ok')"""

_LIFECYCLE = f"""
    v_timeline AS (
        SELECT alert_rule_id, received_at, 0 AS rank, seq, 'reading' AS kind, breached, device_id, severity, value,
               CAST(NULL AS VARCHAR) AS user_id FROM v_live
        UNION ALL
        SELECT alert_rule_id, triggered_at + to_hours(CAST(n * 5 AS INTEGER)), 1, o * 3 + n,
               CASE WHEN (o + n) % 3 = 0 THEN 'resolve' ELSE 'acknowledge' END, NULL, NULL, NULL, NULL,
               CASE WHEN (o + n) % 11 <> 0 THEN CAST((o + n) % 12 AS VARCHAR) END
        FROM (SELECT *, epoch_us(triggered_at) AS o FROM v_alerts), (VALUES (1), (2)) AS k(n)
    ),
    v_state AS (
        SELECT *, coalesce(last_value(later IGNORE NULLS) OVER (PARTITION BY alert_rule_id
            ORDER BY received_at, rank, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS was
        FROM (SELECT *, CASE WHEN kind = 'reading' THEN breached
                             WHEN kind = 'resolve' AND user_id IS NOT NULL THEN false END AS later FROM v_timeline)
    ),
    v_episodes AS (
        SELECT *, sum(CASE WHEN kind = 'reading' AND breached AND NOT was THEN 1 ELSE 0 END) OVER
            (PARTITION BY alert_rule_id ORDER BY received_at, rank, seq ROWS UNBOUNDED PRECEDING) AS episode
        FROM v_state
    ),
    v_acks AS (
        SELECT * FROM v_episodes WHERE kind = 'acknowledge' AND user_id IS NOT NULL AND was
        QUALIFY row_number() OVER (PARTITION BY alert_rule_id, episode ORDER BY received_at, rank, seq) = 1
    ),
    v_ends AS (
        SELECT * FROM v_episodes
        WHERE was AND ((kind = 'reading' AND NOT breached) OR (kind = 'resolve' AND user_id IS NOT NULL))
    )"""

_FIRST_WRITE = f"""
    WITH RECURSIVE v_writes AS (
        SELECT device_id, min(received_at) AS written_at FROM v_telemetry GROUP BY device_id
        UNION ALL
        SELECT w.device_id,
               (SELECT min(received_at) FROM v_telemetry t WHERE t.device_id = w.device_id
                AND t.received_at >= w.written_at + INTERVAL {q.GAP_SECONDS} SECOND)
        FROM v_writes w WHERE w.written_at IS NOT NULL
    )"""

_FACTS = ", ".join(q._ALERT_FACTS)


def _rule_versions(telemetry: str) -> str:
    """Versions with the times between which they count, and changes judged by the first alert and the first delete."""
    return f"""
    t_changes AS (
        SELECT event_id AS chg_id, ts + INTERVAL 3 HOUR AS chg_ts,
               CASE WHEN x % 5 = 0 THEN 'create' WHEN x % 5 < 4 THEN 'update' ELSE 'delete' END AS action,
               CASE WHEN x % 29 = 0 THEN 'bad id!' WHEN x % 5 <> 0 THEN CAST(user_id * 10 + x % 7 AS VARCHAR) END AS rule_id,
               CASE WHEN x % 23 <> 0 THEN CAST(user_id AS VARCHAR) ELSE '999999999' END AS device_id,
               CASE WHEN x % 31 <> 0 THEN ['click', 'view', 'purchase', 'error'][CAST(x % 4 + 1 AS INTEGER)] END AS metric,
               CASE WHEN event_id % 11 = 0 THEN 'eq' ELSE ['gt', 'lt', 'gte', 'lte'][CAST(event_id % 4 + 1 AS INTEGER)] END AS operator,
               CASE WHEN x % 3 <> 0 THEN value END AS threshold, CASE WHEN event_id % 17 = 0 THEN 'fatal' ELSE 'critical' END AS severity,
               CASE WHEN x % 6 <> 0 THEN x % 7 <> 0 END AS enabled
        FROM (SELECT *, event_id * 7 + user_id * 3 AS x FROM events)
    ),
    t_known AS (
        SELECT c.*, c.operator <> 'eq' AND c.severity <> 'fatal' AS words, r.device_id AS home, d.id IS NOT NULL AS housed
        FROM t_changes c LEFT JOIN v_rules r ON r.id = c.rule_id LEFT JOIN v_devices d ON d.id = c.device_id
    ),
    t_images AS (
        SELECT id AS rule, device_id, metric, operator, threshold, severity, enabled, TIMESTAMP '0001-01-01' AS since, 0 AS n FROM v_rules
        UNION ALL
        SELECT CASE action WHEN 'create' THEN {_uuid("concat_ws('|', 'rule', epoch_us(chg_ts), chg_id)")} ELSE rule_id END,
               CASE action WHEN 'create' THEN device_id ELSE home END, coalesce(metric, ''), operator, coalesce(threshold, 0), severity,
               coalesce(enabled, true), chg_ts, chg_id
        FROM t_known
        WHERE words AND ((action = 'create' AND metric IS NOT NULL AND housed) OR (action = 'update' AND home IS NOT NULL))
    ),
    t_versions AS (
        SELECT *, coalesce(lead(since) OVER (PARTITION BY rule ORDER BY since, n), TIMESTAMP '9999-01-01') AS until FROM t_images
    ),
    t_matches AS (
        SELECT v.rule AS alert_rule_id, t.device_id, v.severity, v.operator, v.threshold, t.value, t.received_at, t.seq, {_BREACHED} AS breached
        FROM {telemetry} t JOIN t_versions v ON v.device_id = t.device_id AND v.metric = t.metric AND t.received_at >= since AND t.received_at < until
        WHERE v.enabled
    ),
    t_gone AS (
        SELECT rule_id AS rule, min((chg_ts, chg_id)) AS first, any_value(opened) IS NULL OR min(chg_ts) <= any_value(opened) AS gone
        FROM t_known LEFT JOIN (SELECT alert_rule_id, min(received_at) AS opened FROM t_matches WHERE breached GROUP BY 1) ON alert_rule_id = rule_id
        WHERE action = 'delete' AND home IS NOT NULL GROUP BY rule_id
    ),
    t_judged AS (
        SELECT c.*, CASE WHEN action = 'create' THEN CASE WHEN metric IS NOT NULL AND words AND housed THEN 'ok' ELSE 'bad_request' END
            WHEN rule_id = 'bad id!' THEN 'invalid_id' WHEN home IS NULL OR (gone AND (chg_ts, chg_id) > first) THEN 'not_found'
            WHEN action = 'delete' AND NOT gone THEN 'conflict' WHEN action = 'update' AND NOT words THEN 'bad_request' ELSE 'ok' END AS outcome
        FROM t_known c LEFT JOIN t_gone ON rule = rule_id
    ),
    t_live AS (SELECT * FROM t_matches WHERE alert_rule_id NOT IN (SELECT rule FROM t_gone WHERE gone))"""


_TIMED = _rule_versions("v_telemetry")
_TIMED_STREAM = _rule_versions("(SELECT * FROM v_parsed WHERE reject_reason IS NULL)")


def _addressed(live: str) -> str:
    """Readings and commands one after the other: which alert is the rule's active one, and is it acknowledged?"""
    return f"""
    c_rows AS (
        SELECT alert_rule_id, received_at AS t, 0 AS rank, seq, breached, NULL::BIGINT AS target, NULL::VARCHAR AS action, NULL::VARCHAR AS who,
               NULL::BOOLEAN AS bad FROM {live}
        UNION ALL
        SELECT alert_rule_id, received_at + INTERVAL 5 HOUR, 1, seq * 10 + CAST(alert_rule_id AS BIGINT) % 10, NULL, seq,
               CASE WHEN x % 3 <> 1 THEN 'resolve' ELSE 'acknowledge' END, CASE WHEN x % 11 <> 0 THEN CAST(x % 12 AS VARCHAR) END, x % 19 = 0
        FROM (SELECT *, seq + CAST(alert_rule_id AS BIGINT) % 10 AS x FROM v_live WHERE breached)
    ),
    c_placed AS (
        SELECT c.*, u.id IS NOT NULL AS known, row_number() OVER (PARTITION BY alert_rule_id ORDER BY t, rank, seq) AS k
        FROM c_rows c LEFT JOIN v_users u ON u.id = c.who
    ),
    c_steps AS (
        SELECT alert_rule_id, 0::BIGINT AS k, NULL::BIGINT AS was, false AS seen, NULL::BIGINT AS now, false AS acked FROM c_placed WHERE k = 1
        UNION ALL
        SELECT r.alert_rule_id, r.k, s.now, s.acked,
               CASE WHEN rank = 0 AND breached THEN coalesce(s.now, r.seq) WHEN rank = 0 THEN NULL
                    WHEN known AND NOT bad AND action = 'resolve' AND target = s.now THEN NULL ELSE s.now END,
               CASE WHEN rank = 0 THEN s.acked AND breached AND s.now IS NOT NULL
                    ELSE s.acked OR (known AND NOT bad AND action = 'acknowledge' AND coalesce(target = s.now, false)) END
        FROM c_steps s JOIN c_placed r ON r.alert_rule_id = s.alert_rule_id AND r.k = s.k + 1
    ),
    c_done AS (SELECT r.*, s.was, s.seen, s.now, s.acked FROM c_placed r JOIN c_steps s USING (alert_rule_id, k)),
    c_open AS (SELECT alert_rule_id, seq, t, k FROM c_done WHERE rank = 0 AND breached AND was IS NULL),
    c_ends AS (SELECT alert_rule_id, was AS seq, min(k) AS k, arg_min(t, k) AS t, arg_min(CASE WHEN rank = 1 THEN who END, k) AS who, arg_min(rank, k) AS by_hand
        FROM c_done WHERE was IS NOT NULL AND now IS NULL GROUP BY alert_rule_id, was),
    c_acks AS (SELECT alert_rule_id, was AS seq, t, who FROM c_done WHERE rank = 1 AND now IS NOT NULL AND acked AND NOT seen),
    c_alerts AS (
        SELECT {_uuid("concat_ws('|', o.alert_rule_id, epoch_us(o.t), o.seq)")} AS id, o.alert_rule_id, m.device_id, m.value AS triggered_value, m.severity,
               CASE WHEN e.seq IS NOT NULL THEN 'resolved' WHEN a.seq IS NOT NULL THEN 'acknowledged' ELSE 'open' END AS status, o.t AS triggered_at,
               a.t AS acknowledged_at, a.who AS acknowledged_by, e.t AS resolved_at, CASE WHEN e.by_hand = 1 THEN e.who END AS resolved_by
        FROM c_open o JOIN {live} m ON m.alert_rule_id = o.alert_rule_id AND m.seq = o.seq
        LEFT JOIN c_ends e ON e.alert_rule_id = o.alert_rule_id AND e.seq = o.seq LEFT JOIN c_acks a ON a.alert_rule_id = o.alert_rule_id AND a.seq = o.seq
    ),
    c_outcomes AS (
        SELECT c.seq AS cmd_id, c.t AS cmd_ts, c.action,
               CASE WHEN bad THEN 'no such id!' ELSE {_uuid("concat_ws('|', c.alert_rule_id, epoch_us(c.t - INTERVAL 5 HOUR), c.target)")} END AS alert_id,
               c.who AS user_id,
               CASE WHEN c.who IS NULL THEN 'bad_request' WHEN bad THEN 'invalid_id' WHEN o.seq IS NULL OR o.k > c.k THEN 'not_found'
                    WHEN c.was IS DISTINCT FROM c.target OR (c.action = 'acknowledge' AND c.seen) THEN 'conflict'
                    WHEN NOT c.known THEN 'invalid_user' ELSE 'ok' END AS outcome
        FROM c_done c LEFT JOIN c_open o ON o.alert_rule_id = c.alert_rule_id AND o.seq = c.target WHERE c.rank = 1
    )"""


_DELETES = """
    x_asked AS (
        SELECT o_orderkey * 3 + n AS del_id, o_orderdate AS del_ts,
               CASE WHEN n = 0 THEN 'alert_rules' WHEN n = 1 THEN 'devices' WHEN o_orderkey % 3 = 0 THEN 'sites' WHEN o_orderkey % 3 = 1 THEN 'users' ELSE 'alerts' END AS table_name,
               CAST(CASE WHEN n = 0 THEN o_custkey * 10 + o_orderkey % 7 WHEN n = 1 THEN o_custkey WHEN o_orderkey % 3 = 0 THEN o_custkey % 30 ELSE o_custkey % 120 END AS VARCHAR) AS row_id
        FROM orders, (VALUES (0), (1), (2)) AS k(n)
    ),
    x_rules AS (
        SELECT row_id AS id, min((del_ts, del_id)) AS gone FROM x_asked WHERE table_name = 'alert_rules' AND row_id IN (SELECT id FROM v_rules)
        AND row_id NOT IN (SELECT alert_rule_id FROM v_alerts) GROUP BY row_id
    ),
    x_ready_devices AS (
        SELECT d.id, max(x.gone) AS last FROM v_devices d LEFT JOIN v_rules r ON r.device_id = d.id LEFT JOIN x_rules x ON x.id = r.id
        WHERE d.id NOT IN (SELECT device_id FROM v_alerts) GROUP BY d.id HAVING count(r.id) = count(x.id)
    ),
    x_devices AS (
        SELECT id, min((del_ts, del_id)) AS gone FROM x_asked JOIN x_ready_devices ON id = row_id
        WHERE table_name = 'devices' AND (last IS NULL OR (del_ts, del_id) > last) GROUP BY id
    ),
    x_ready_sites AS (
        SELECT s.id, max(x.gone) AS last FROM v_sites s LEFT JOIN v_devices d ON d.site_id = s.id LEFT JOIN x_devices x ON x.id = d.id
        GROUP BY s.id HAVING count(d.id) = count(x.id)
    ),
    x_gone AS (
        SELECT 'alert_rules' AS table_name, * FROM x_rules UNION ALL SELECT 'devices', * FROM x_devices
        UNION ALL SELECT 'sites', id, min((del_ts, del_id)) FROM x_asked JOIN x_ready_sites ON id = row_id
            WHERE table_name = 'sites' AND (last IS NULL OR (del_ts, del_id) > last) GROUP BY id
        UNION ALL SELECT 'users', row_id, min((del_ts, del_id)) FROM x_asked WHERE table_name = 'users' AND row_id IN (SELECT id FROM v_users) GROUP BY row_id
    ),
    x_there AS (
        SELECT 'alert_rules' AS table_name, id FROM v_rules UNION ALL SELECT 'devices', id FROM v_devices
        UNION ALL SELECT 'sites', id FROM v_sites UNION ALL SELECT 'users', id FROM v_users
    )"""

_STREAMED = f"""v_stored AS (SELECT m.* REPLACE (p.value AS value) FROM v_live m JOIN v_parsed p ON p.seq = m.seq WHERE p.reject_reason IS NULL),
    v_judged AS (SELECT * EXCLUDE (breached), {_BREACHED} AS breached FROM v_stored)"""
_START, _END = parse_rfc3339(q.FROM), parse_rfc3339(q.TO)
_POINT = "device_id, metric, value, ts, received_at"


def _renamed(every: int, hit: int) -> str:
    return f"CASE WHEN CAST(id AS BIGINT) % {every} = {hit} THEN 'new-' || id ELSE id END AS id"


_DAMAGED = f"""
    d_sites AS (SELECT * REPLACE ({_renamed(9, 4)}) FROM v_sites),
    d_devices AS (
        SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 8 <> 5 THEN name END AS name, {_renamed(10, 3)})
        FROM v_devices
    ),
    d_alert_rules AS (
        SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 70 <> 0 THEN threshold END AS threshold, {_renamed(50, 1)})
        FROM v_rules
    ),
    d_users AS (
        SELECT * REPLACE ({_renamed(4, 1)}) FROM v_users
        UNION ALL SELECT * FROM v_users WHERE CAST(id AS BIGINT) % 4 = 0
    ),
    v_outcomes AS ({_commands()}),
    d_alerts AS ({_alerts_after("v_outcomes")})"""


def _violations(parts) -> str:
    """Each part: check, table, key, detail, from-clause."""
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, {key} AS row_key, {detail} AS detail FROM {rest}"
        for check, table, key, detail, rest in parts
    )


def _domain(table, view, column, words):
    return ("allowed_values", table, "id", f"'{column}=' || {column}", f"{view} WHERE {column} NOT IN {_words(words)}")


def _orphans(table, column, parent):
    return (
        "foreign_key",
        table,
        "c.id",
        f"'{column}=' || c.{column}",
        f"d_{table} c WHERE c.{column} IS NOT NULL AND c.{column} NOT IN (SELECT id FROM d_{parent})",
    )


def _blocked(table, view, column, parent, parent_view):
    return ("blocked_delete", parent, "id", f"'{table}.{column}'", f"{parent_view} WHERE id IN (SELECT {column} FROM {view})")


def _repeats(table, column):
    return (
        "unique",
        table,
        column,
        f"'{column} x ' || count(*)",
        f"d_{table} GROUP BY {column} HAVING count(*) > 1",
    )


_CONTRACT_ROWS = ", ".join(f"('{t}', '{','.join(sorted(keys))}')" for t, keys in q.CONTRACT.items())
_BOUND_ROWS = ", ".join(f"('{m}', {lo}, {hi})" for m, (lo, hi) in q.BOUNDS.items())

_BODIES = {
    "src_messages": f"""SELECT topic, received_at, seq, sha256(CASE WHEN kind = 9 THEN 'null' ELSE
        CASE WHEN kind = 7 THEN '[' ELSE '' END || '{{"device_id":"' || CASE WHEN kind = 2 THEN '' ELSE device_id END
        || '","site_id":"' || site_id || '","device_type":"' || device_type || '","readings":{{' || CASE WHEN kind = 3
        THEN '' ELSE '"' || metric || '":' || CASE kind WHEN 5 THEN '"high"' WHEN 8 THEN 'null'
        ELSE CAST(sent AS VARCHAR) END END || '}},"ts":"' || strftime(ts, '%Y-%m-%d')
        || CASE WHEN kind = 6 THEN ' ' ELSE 'T' END || strftime(ts, '%H:%M:%S.%fZ') || '"}}'
        || CASE kind WHEN 1 THEN ' tail' WHEN 7 THEN ']' ELSE '' END END) AS payload_hash FROM v_topics""",
    "encode_messages": f"""SELECT '{TOPIC_ROOT}/' || site_id || '/' || device_id || '/telemetry' AS topic, device_id,
        site_id, device_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text, metric, value, received_at, seq
        FROM v_telemetry""",
    "telemetry_raw": """SELECT device_id, site_id, device_type, metric, value, ts, received_at, seq FROM v_parsed
        WHERE reject_reason IS NULL""",
    "telemetry_layout": """SELECT *, CAST(ts AS DATE) AS ts_date FROM v_telemetry""",
    "telemetry_layout_late": """SELECT *, CAST(ts AS DATE) AS ts_date FROM v_telemetry""",
    "parse_accepted": """SELECT device_id, site_id, device_type, metric, value, ts, received_at, seq FROM v_parsed
        WHERE reject_reason IS NULL""",
    "ingest_rejects": "SELECT topic, received_at, seq, reject_reason FROM v_topics WHERE reject_reason IS NOT NULL",
    "alert_stream_rejects": """SELECT CASE WHEN seq % 70 <> 7 THEN topic END AS topic, received_at, seq,
        CASE WHEN seq % 70 = 7 THEN 'bad_topic' ELSE reject_reason END AS reject_reason
        FROM v_topics WHERE reject_reason IS NOT NULL OR seq % 70 = 7""",
    "reject_counts": """SELECT reject_reason, count(*) AS messages FROM v_parsed WHERE reject_reason IS NOT NULL
        GROUP BY reject_reason""",
    "stream_reject_counts": """SELECT reject_reason, count(*) AS messages FROM v_parsed WHERE reject_reason IS NOT NULL
        GROUP BY reject_reason""",
    "enabled_rules": "SELECT * EXCLUDE (created_at) FROM v_rules WHERE enabled",
    "active_rules": "SELECT DISTINCT device_id, alert_rule_id FROM v_alerts WHERE status = 'open'",
    "rule_matches": "SELECT * EXCLUDE (enabled, breached) FROM v_live",
    "threshold_eval": "SELECT alert_rule_id, seq, value, operator, threshold, breached FROM v_matches",
    "rule_decisions": "SELECT alert_rule_id, device_id, seq, value, decision FROM v_decisions",
    "alerts_opened": f"""SELECT {_uuid("concat_ws('|', alert_rule_id, epoch_us(received_at), seq)")} AS id,
        alert_rule_id, device_id, value AS triggered_value, severity, 'open' AS status,
        received_at AS triggered_at, CAST(NULL AS TIMESTAMP) AS resolved_at
        FROM v_decisions WHERE decision = 'create'""",
    "alerts_auto_resolved": """SELECT a.alert_rule_id, a.device_id, a.triggered_value, a.severity,
        CASE WHEN a.status = 'open' AND d.seq IS NOT NULL THEN 'resolved' ELSE a.status END AS status, a.triggered_at,
        CASE WHEN a.status = 'open' AND d.seq IS NOT NULL THEN d.received_at ELSE a.resolved_at END AS resolved_at
        FROM v_earlier a LEFT JOIN v_decisions d ON d.alert_rule_id = a.alert_rule_id AND d.decision = 'auto_resolve'""",
    "alert_replay": f"SELECT id, {_FACTS} FROM v_alerts",
    "alert_transitions": """SELECT alert_rule_id, device_id, severity, received_at, seq, value,
        CASE WHEN breached THEN 'create' ELSE 'auto_resolve' END AS decision
        FROM (SELECT *, coalesce(lag(breached) OVER (PARTITION BY alert_rule_id ORDER BY received_at, seq), false) AS was
              FROM v_live) WHERE breached <> was""",
    "alert_lifecycle": (
        _LIFECYCLE,
        f"""SELECT {_uuid("concat_ws('|', c.alert_rule_id, epoch_us(c.received_at), c.seq)")} AS id,
        c.alert_rule_id, c.device_id, c.value AS triggered_value, c.severity,
        CASE WHEN e.seq IS NOT NULL THEN 'resolved' WHEN a.seq IS NOT NULL THEN 'acknowledged' ELSE 'open' END AS status,
        c.received_at AS triggered_at, a.received_at AS acknowledged_at, a.user_id AS acknowledged_by,
        e.received_at AS resolved_at, e.user_id AS resolved_by
        FROM v_episodes c
        LEFT JOIN v_acks a ON a.alert_rule_id = c.alert_rule_id AND a.episode = c.episode
        LEFT JOIN v_ends e ON e.alert_rule_id = c.alert_rule_id AND e.episode = c.episode
        WHERE c.kind = 'reading' AND c.breached AND NOT c.was""",
    ),
    "alert_lifecycle_outcomes": (
        _LIFECYCLE,
        """SELECT t.seq AS cmd_id, t.received_at AS cmd_ts, t.kind AS action, t.alert_rule_id,
        CASE WHEN t.user_id IS NULL THEN 'bad_request' WHEN NOT t.was THEN 'conflict'
             WHEN t.kind = 'resolve' OR a.seq = t.seq THEN 'ok' ELSE 'conflict' END AS outcome
        FROM v_episodes t LEFT JOIN v_acks a ON a.alert_rule_id = t.alert_rule_id AND a.episode = t.episode
        WHERE t.kind <> 'reading'""",
    ),
    "alert_stream": (
        f"""v_stored AS (SELECT m.* REPLACE (p.value AS value) FROM v_live m JOIN v_parsed p ON p.seq = m.seq
            WHERE p.reject_reason IS NULL),
        v_judged AS (SELECT * EXCLUDE (breached), {_BREACHED} AS breached FROM v_stored),
        v_streamed AS ({_replay("v_judged")})""",
        f"SELECT {_FACTS} FROM v_streamed",
    ),
    "alert_stream_commits": (
        ",\n".join([_STREAMED, *[f"v_until{n} AS (SELECT * FROM v_judged WHERE received_at < TIMESTAMP '{cut}'), v_state{n} AS ({_replay(f'v_until{n}')})" for n, cut in enumerate(q.CUTS, 1)]]),
        " UNION ALL ".join(f"SELECT {n} AS batches, {_FACTS} FROM v_state{n}" for n in range(1, len(q.CUTS) + 1)),
    ),
    "alert_stream_rules": (f"{_TIMED_STREAM}, t_alerts AS ({_replay('t_live')})", f"SELECT id, {_FACTS} FROM t_alerts"),
    "alert_replay_rule_versions": (f"{_TIMED}, t_alerts AS ({_replay('t_live')})", f"SELECT id, {_FACTS} FROM t_alerts"),
    "rule_version_outcomes": (_TIMED, "SELECT chg_id, chg_ts, action, rule_id, outcome FROM t_judged"),
    "rules_after_versions": (
        _TIMED,
        """SELECT i.rule AS id, i.device_id, i.metric, i.operator, i.threshold, i.severity, i.enabled,
        CASE WHEN b.id IS NOT NULL THEN TIMESTAMP '2024-01-01' ELSE i.since END AS created_at
        FROM t_versions i LEFT JOIN v_rules b ON b.id = i.rule
        WHERE i.rule NOT IN (SELECT rule FROM t_gone WHERE gone) AND until = TIMESTAMP '9999-01-01'""",
    ),
    "alert_stream_commands": (f"{_STREAMED}, {_addressed('v_judged')}", "SELECT * FROM c_alerts"),
    "alert_replay_by_id": (_addressed("v_live"), "SELECT * FROM c_alerts"),
    "alert_id_outcomes": (_addressed("v_live"), "SELECT * FROM c_outcomes"),
    "last_seen_writes": ("v_w AS (" + _FIRST_WRITE + " SELECT * FROM v_writes WHERE written_at IS NOT NULL)", "SELECT * FROM v_w"),
    "device_last_seen": (
        "v_w AS (" + _FIRST_WRITE + " SELECT device_id, max(written_at) AS newest FROM v_writes GROUP BY device_id)",
        "SELECT id, name, newest AS last_seen_at FROM v_devices LEFT JOIN v_w ON device_id = id",
    ),
    "list_sites": "SELECT id, name, type, coalesce(location, '') AS location FROM v_sites ORDER BY name, id",
    "list_devices": (
        "v_w AS (" + _FIRST_WRITE + " SELECT device_id, max(written_at) AS newest FROM v_writes GROUP BY device_id)",
        "SELECT id, site_id, name, type, newest AS last_seen_at FROM v_devices LEFT JOIN v_w ON device_id = id ORDER BY name, id",
    ),
    "list_devices_by_site": f"""SELECT id, site_id, name, type, last_seen_at FROM v_devices
        WHERE site_id = '{q.SITE}' ORDER BY name, id""",
    "get_device": f"SELECT id, site_id, name, type, last_seen_at FROM v_devices WHERE id = '{q.DEVICE}'",
    "device_telemetry": f"""SELECT {_POINT} FROM (SELECT * FROM v_telemetry WHERE device_id = '{q.DEVICE}'
        ORDER BY ts DESC, received_at DESC, seq DESC LIMIT 50)""",
    "device_telemetry_range": f"""SELECT {_POINT} FROM (SELECT * FROM v_telemetry WHERE device_id = '{q.DEVICE}'
        AND ts >= TIMESTAMP '{_START}' AND ts <= TIMESTAMP '{_END}'
        ORDER BY ts DESC, received_at DESC, seq DESC LIMIT 1000)""",
    "latest_telemetry_per_device": f"""SELECT {_POINT}, seq FROM v_telemetry
        QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY ts DESC, received_at DESC, seq DESC) <= {q.LATEST}""",
    "list_alerts": "SELECT * FROM v_alerts ORDER BY triggered_at DESC, id DESC LIMIT 50",
    "list_alerts_by_site": f"""SELECT a.* FROM v_alerts a JOIN v_devices d ON d.id = a.device_id
        WHERE d.site_id = '{q.SITE}' AND a.status = 'open' ORDER BY a.triggered_at DESC, a.id DESC LIMIT 500""",
    "list_alerts_page": f"""SELECT * FROM v_alerts WHERE status = 'resolved' ORDER BY triggered_at DESC, id DESC
        LIMIT {q.PAGE["limit"]} OFFSET {q.PAGE["offset"]}""",
    "list_rules": "SELECT * EXCLUDE (created_at) FROM v_rules ORDER BY metric, id",
    "list_rules_by_device": f"SELECT * EXCLUDE (created_at) FROM v_rules WHERE device_id = '{q.DEVICE}' ORDER BY metric, id",
    "acknowledge_alerts": (f"v_outcomes AS ({_commands("action = 'acknowledge'")})", _alerts_after("v_outcomes")),
    "resolve_alerts": (f"v_outcomes AS ({_commands("action = 'resolve'")})", _alerts_after("v_outcomes")),
    "alerts_after_commands": (f"v_outcomes AS ({_commands()})", _alerts_after("v_outcomes")),
    "command_outcomes": (
        f"v_outcomes AS ({_commands()})",
        "SELECT cmd_id, cmd_ts, action, alert_id, user_id, outcome FROM v_outcomes",
    ),
    "rules_created": (f"v_outcomes AS ({_changes("action = 'create'")})", _CREATED),
    "rules_updated": (f"v_outcomes AS ({_changes("action = 'update'")})", _KEPT),
    "rules_deleted": (
        f"v_outcomes AS ({_changes("action = 'delete'")})",
        """SELECT id, device_id, metric FROM v_rules
        WHERE id IN (SELECT rule_id FROM v_outcomes WHERE outcome = 'ok')""",
    ),
    "rules_after_changes": (
        f"v_outcomes AS ({_changes()})",
        f"SELECT * EXCLUDE (id) FROM ({_KEPT}) UNION ALL ({_CREATED})",
    ),
    "rule_change_outcomes": (
        f"v_outcomes AS ({_changes()})",
        "SELECT chg_id, chg_ts, action, rule_id, outcome FROM v_outcomes",
    ),
    "check_domains": _violations(
        [
            _domain("sites", "v_sites", "type", SITE_TYPES),
            _domain("devices", "v_devices", "type", DEVICE_TYPES),
            _domain("alert_rules", "v_rules", "operator", OPERATORS),
            _domain("alert_rules", "v_rules", "severity", SEVERITIES),
            _domain("alerts", "v_alerts", "severity", SEVERITIES),
            _domain("alerts", "v_alerts", "status", STATUSES),
            _domain("users", "v_users", "role", ROLES),
        ]
    ),
    "check_foreign_keys": (
        _DAMAGED,
        _violations(
            [
                _orphans("devices", "site_id", "sites"),
                _orphans("alert_rules", "device_id", "devices"),
                _orphans("alerts", "alert_rule_id", "alert_rules"),
                _orphans("alerts", "device_id", "devices"),
                _orphans("alerts", "acknowledged_by", "users"),
                _orphans("alerts", "resolved_by", "users"),
            ]
        ),
    ),
    "blocked_deletes": _violations(
        [
            _blocked("devices", "v_devices", "site_id", "sites", "v_sites"),
            _blocked("alert_rules", "v_rules", "device_id", "devices", "v_devices"),
            _blocked("alerts", "v_alerts", "alert_rule_id", "alert_rules", "v_rules"),
            _blocked("alerts", "v_alerts", "device_id", "devices", "v_devices"),
        ]
    ),
    "parent_delete_outcomes": (
        _DELETES,
        """SELECT del_id, del_ts, a.table_name, row_id, CASE WHEN a.table_name = 'alerts' THEN 'bad_request'
        WHEN t.id IS NULL OR (g.gone IS NOT NULL AND g.gone < (del_ts, del_id)) THEN 'not_found'
        WHEN g.gone = (del_ts, del_id) THEN 'ok' ELSE 'conflict' END AS outcome
        FROM x_asked a LEFT JOIN x_there t ON t.table_name = a.table_name AND t.id = row_id
        LEFT JOIN x_gone g ON g.table_name = a.table_name AND g.id = row_id""",
    ),
    "devices_after_deletes": (_DELETES, "SELECT id, site_id, name FROM v_devices WHERE id NOT IN (SELECT id FROM x_devices)"),
    "user_removal": (
        f"v_outcomes AS ({_commands()}), d_alerts AS ({_alerts_after('v_outcomes')})",
        """SELECT a.id, a.status, CASE WHEN k.role <> 'guest' THEN a.acknowledged_by END AS acknowledged_by,
        CASE WHEN e.role <> 'guest' THEN a.resolved_by END AS resolved_by
        FROM d_alerts a LEFT JOIN v_users k ON k.id = a.acknowledged_by LEFT JOIN v_users e ON e.id = a.resolved_by""",
    ),
    "check_unique": (
        _DAMAGED,
        _violations(
            [
                _repeats("sites", "id"),
                _repeats("devices", "id"),
                _repeats("alert_rules", "id"),
                _repeats("users", "id"),
                _repeats("alerts", "id"),
                _repeats("users", "email"),
            ]
        ),
    ),
    "check_not_null": (
        _DAMAGED,
        _violations(
            [
                ("not_null", "devices", "id", "'name'", "d_devices WHERE name IS NULL"),
                ("not_null", "alert_rules", "id", "'threshold'", "d_alert_rules WHERE threshold IS NULL"),
            ]
        ),
    ),
    "check_single_active": """SELECT 'single_active' AS check_name, 'alerts' AS table_name, alert_rule_id AS row_key,
        'active=' || count(*) AS detail
        FROM (SELECT * FROM v_alerts UNION ALL SELECT * FROM v_earlier) WHERE status = 'open'
        GROUP BY alert_rule_id HAVING count(*) > 1""",
    "check_integrity": (
        _DAMAGED,
        _violations(
            [
                _domain("sites", "d_sites", "type", SITE_TYPES),
                _domain("devices", "d_devices", "type", DEVICE_TYPES),
                _domain("alert_rules", "d_alert_rules", "operator", OPERATORS),
                _domain("alert_rules", "d_alert_rules", "severity", SEVERITIES),
                _domain("alerts", "d_alerts", "severity", SEVERITIES),
                _domain("alerts", "d_alerts", "status", STATUSES),
                _domain("users", "d_users", "role", ROLES),
                _orphans("devices", "site_id", "sites"),
                _orphans("alert_rules", "device_id", "devices"),
                _orphans("alerts", "alert_rule_id", "alert_rules"),
                _orphans("alerts", "device_id", "devices"),
                _orphans("alerts", "acknowledged_by", "users"),
                _orphans("alerts", "resolved_by", "users"),
                _repeats("sites", "id"),
                _repeats("devices", "id"),
                _repeats("alert_rules", "id"),
                _repeats("users", "id"),
                _repeats("alerts", "id"),
                _repeats("users", "email"),
                ("not_null", "devices", "id", "'name'", "d_devices WHERE name IS NULL"),
                ("not_null", "alert_rules", "id", "'threshold'", "d_alert_rules WHERE threshold IS NULL"),
            ]
        )
        + """ UNION ALL SELECT 'single_active', 'alerts', alert_rule_id, 'active=' || count(*)
        FROM d_alerts WHERE status IN ('open', 'acknowledged') GROUP BY alert_rule_id HAVING count(*) > 1""",
    ),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}"
        for name, view in [
            ("sites", "v_sites"),
            ("devices", "v_devices"),
            ("alert_rules", "v_rules"),
            ("users", "v_users"),
            ("alerts", "v_alerts"),
            ("telemetry_raw", "v_telemetry"),
        ]
    ),
    "check_reading_keys": f"""SELECT 'reading_keys' AS check_name, 'telemetry_raw' AS table_name,
        device_id || '|' || seq AS row_key, device_type || ': ' || metric AS detail
        FROM v_telemetry LEFT JOIN (VALUES {_CONTRACT_ROWS}) AS c(kind, keys) ON kind = device_type
        WHERE keys IS NULL OR keys <> metric""",
    "check_reading_bounds": f"""SELECT 'reading_bounds' AS check_name, 'telemetry_raw' AS table_name,
        device_id || '|' || seq AS row_key, v.metric AS detail
        FROM v_telemetry v JOIN (VALUES {_BOUND_ROWS}) AS b(metric, low, high) ON b.metric = v.metric
        WHERE value < low OR value > high""",
}


def _needed(text: str) -> list[str]:
    """The views a text uses, with those they use, in order."""
    found = set()
    for name in reversed(_VIEWS):
        if any(name in t for t in [text, *[_VIEWS[f] for f in found]]):
            found.add(name)
    return [name for name in _VIEWS if name in found]


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, body in _BODIES.items():
        extra, select = body if isinstance(body, tuple) else ("", body)
        steps = [f"{v} AS ({_VIEWS[v]})" for v in _needed(extra + select)] + ([extra] if extra else [])
        result[name] = "WITH RECURSIVE " + ",\n".join(steps) + "\n" + select
    return result
