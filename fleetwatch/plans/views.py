"""The engine's tables derived from the given star-schema tables, always over all their rows.

nation and region give sites, customers give devices and rules, events give telemetry, suppliers
give users. Messages, alerts, commands and rule changes follow from those.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwatch.functions.columns import alert_id
from fleetwatch.operators.alerts import judged_readings, replay_alerts
from fleetwatch.session import configure
from fleetwatch.sources.messages import encode_messages

TOPIC_ROOT = "plant"
ID_PATTERN = r"^[0-9a-f]+(-[0-9a-f]+)*$"
START = "2024-01-01 00:00:00"

# metric, operator, threshold, severity of the rules every device gets
RULES = [
    ("error", "gt", 40.0, "warning"),
    ("error", "gt", 80.0, "critical"),
    ("purchase", "gte", 50.0, "warning"),
    ("click", "lt", 5.0, "warning"),
    ("view", "lte", 2.0, "critical"),
    ("signup", "bogus", 0.0, "warning"),
]


def _text(column: str):
    return F.col(column).cast("string")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def _given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _created():
        return F.lit(START).cast("timestamp_ntz").alias("created_at")

    @cached_property
    def sites(self) -> DataFrame:
        kind = F.when(F.col("n_regionkey") % 3 == 0, "data_center").when(F.col("n_regionkey") % 3 == 1, "building")
        return (
            self._given("nation")
            .join(self._given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                _text("n_nationkey").alias("id"),
                F.col("n_name").alias("name"),
                kind.otherwise("factory").alias("type"),
                F.when(F.col("n_nationkey") % 5 != 0, F.col("r_name")).alias("location"),
                self._created(),
            )
        )

    @cached_property
    def devices(self) -> DataFrame:
        return self._given("customer").select(
            _text("c_custkey").alias("id"),
            _text("c_nationkey").alias("site_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("type"),
            F.lit(None).cast("timestamp_ntz").alias("last_seen_at"),
            self._created(),
        )

    @cached_property
    def rules(self) -> DataFrame:
        listed = F.array(
            *[
                F.struct(
                    F.lit(n).alias("n"),
                    F.lit(metric).alias("metric"),
                    F.lit(operator).alias("operator"),
                    F.lit(threshold).alias("threshold"),
                    F.lit(severity).alias("severity"),
                )
                for n, (metric, operator, threshold, severity) in enumerate(RULES)
            ]
        )
        return (
            self._given("customer")
            .select("c_custkey", F.inline(listed))
            .select(
                (F.col("c_custkey") * 10 + F.col("n")).cast("string").alias("id"),
                _text("c_custkey").alias("device_id"),
                "metric",
                "operator",
                "threshold",
                "severity",
                (F.col("c_custkey") % 7 != 0).alias("enabled"),
                self._created(),
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        role = F.when(F.col("s_suppkey") % 3 == 0, "admin").when(F.col("s_suppkey") % 3 == 1, "operator")
        return self._given("supplier").select(
            _text("s_suppkey").alias("id"),
            # Every eleventh address repeats the first one.
            F.concat(F.lit("user"), F.when(F.col("s_suppkey") % 11 == 0, 0).otherwise(F.col("s_suppkey"))).alias("email"),
            F.col("s_name").alias("name"),
            role.otherwise("guest").alias("role"),
            self._created(),
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        delay = F.make_dt_interval(secs=F.col("event_id") % 5)
        return (
            self._given("events")
            # Devices that no table knows send messages too, and they are accepted.
            .join(self._given("customer"), F.col("user_id") == F.col("c_custkey"), "left")
            .select(
                _text("user_id").alias("device_id"),
                F.coalesce(_text("c_nationkey"), F.lit("nowhere")).alias("site_id"),
                F.coalesce("c_mktsegment", F.lit("unknown")).alias("device_type"),
                F.create_map("event_type", "value").alias("readings"),
                "ts",
                (F.col("ts") + delay).alias("received_at"),
                F.col("event_id").alias("seq"),
            )
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Encoded telemetry; nine of ten kinds of damage strike every tenth message in turn."""
        whole = encode_messages(self.telemetry, TOPIC_ROOT)
        kind = F.when(F.col("seq") % 10 == 0, F.floor(F.col("seq") % 100 / 10))
        payload, topic = F.col("payload"), F.col("topic")
        number = r'("readings":\{"[a-z]+":)[^}]*\}'
        return whole.withColumns(
            {
                "topic": F.when(kind == 0, F.concat(F.lit("no"), topic))
                .when(kind == 4, F.regexp_replace(topic, "/[0-9]+/telemetry", "/x/telemetry"))
                .otherwise(topic),
                "payload": F.when(kind == 1, F.concat(payload, F.lit(" tail")))
                .when(kind == 2, F.regexp_replace(payload, '"device_id":"[^"]*"', '"device_id":""'))
                .when(kind == 3, F.regexp_replace(payload, number, '"readings":{}'))
                .when(kind == 5, F.regexp_replace(payload, number, '$1"high"}'))
                .when(kind == 6, F.regexp_replace(payload, '"ts":"([^T]*)T', '"ts":"$1 '))
                .when(kind == 7, F.concat(F.lit("["), payload, F.lit("]")))
                .when(kind == 8, F.regexp_replace(payload, number, "$1null}"))
                .when(kind == 9, F.lit("null"))
                .otherwise(payload),
            }
        )

    @cached_property
    def alerts(self) -> DataFrame:
        return replay_alerts(self.telemetry, self.rules)

    @cached_property
    def newest_seq(self) -> DataFrame:
        """The last message of each device."""
        return self.telemetry.groupBy("device_id").agg(F.max(F.struct("received_at", "seq")).alias("_last")).select(
            "device_id", F.col("_last.seq").alias("seq")
        )

    @cached_property
    def newest_messages(self) -> DataFrame:
        return self.telemetry.join(self.newest_seq, ["device_id", "seq"], "left_semi")

    @cached_property
    def earlier_alerts(self) -> DataFrame:
        """Alerts as they stood before each device's last message."""
        return replay_alerts(self.telemetry.join(self.newest_seq, ["device_id", "seq"], "left_anti"), self.rules)

    @cached_property
    def commands(self) -> DataFrame:
        """Three commands per alert, as its opening time decides; some name nobody or nothing."""
        opened = F.unix_micros(F.col("triggered_at").cast("timestamp"))
        user = (
            F.when((opened + F.col("n")) % 11 == 0, F.lit(None))
            .when((opened + F.col("n")) % 13 == 0, "999999999")
            .when((opened + F.col("n")) % 17 == 0, "no such id!")
            .otherwise(((opened + F.col("n")) % 10).cast("string"))
        )
        return self.earlier_alerts.withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(3)]))).select(
            (opened * 3 + F.col("n")).alias("cmd_id"),
            (F.col("triggered_at") + F.make_dt_interval(hours=F.lit(1))).alias("cmd_ts"),
            F.when((opened + F.col("n") * F.col("n")) % 3 == 0, "resolve").otherwise("acknowledge").alias("action"),
            F.when((opened + F.col("n")) % 19 == 0, F.concat(F.lit("0"), F.substring("id", 2, 40)))
            .otherwise(F.col("id"))
            .alias("alert_id"),
            user.alias("user_id"),
        )

    @cached_property
    def rule_commands(self) -> DataFrame:
        """Commands on the timeline: two per alert the readings alone would open."""
        opened = F.unix_micros(F.col("triggered_at").cast("timestamp"))
        return self.alerts.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
            (opened * 3 + F.col("n")).alias("cmd_id"),
            (F.col("triggered_at") + F.make_dt_interval(hours=F.col("n") * 5)).alias("cmd_ts"),
            F.when((opened + F.col("n")) % 3 == 0, "resolve").otherwise("acknowledge").alias("action"),
            "alert_rule_id",
            F.when((opened + F.col("n")) % 11 != 0, ((opened + F.col("n")) % 12).cast("string")).alias("user_id"),
        )

    @cached_property
    def rule_changes(self) -> DataFrame:
        """Three changes per order, addressed by its customer: creates, updates and deletes."""
        o = F.col("o_orderkey")
        n = F.col("n")
        mix = o * 7 + n * 3
        words = F.array(*[F.lit(w) for w in ("gt", "gte", "lt", "lte", "eq")])
        return (
            self._given("orders")
            .withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(3)])))
            .select(
                (o * 3 + n).alias("chg_id"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("chg_ts"),
                F.when(mix % 5 == 0, "create").when(mix % 5 < 4, "update").otherwise("delete").alias("action"),
                F.when(mix % 29 == 0, "bad id!")
                .when(mix % 5 != 0, (F.col("o_custkey") * 10 + mix % 7).cast("string"))
                .alias("rule_id"),
                F.when(mix % 23 != 0, _text("o_custkey")).otherwise("999999999").alias("device_id"),
                F.when(mix % 31 != 0, F.lit("view")).alias("metric"),
                F.element_at(words, (mix % 5 + (o % 11 == 0).cast("int") * (4 - mix % 5) + 1).cast("int")).alias("operator"),
                F.when(mix % 3 != 0, F.col("o_totalprice")).alias("threshold"),
                F.when(o % 17 == 0, F.lit("fatal")).otherwise("critical").alias("severity"),
                F.when(mix % 4 != 0, mix % 2 == 0).alias("enabled"),
            )
        )

    @cached_property
    def timed_changes(self) -> DataFrame:
        """A rule change three hours after every event, addressed by its user."""
        e, u = F.col("event_id"), F.col("user_id")
        mix = e * 7 + u * 3
        pick = lambda words, k: F.element_at(F.array(*[F.lit(w) for w in words]), (k % len(words) + 1).cast("int"))
        return self._given("events").select(
            e.alias("chg_id"),
            (F.col("ts") + F.make_dt_interval(hours=F.lit(3))).alias("chg_ts"),
            F.when(mix % 5 == 0, "create").when(mix % 5 < 4, "update").otherwise("delete").alias("action"),
            F.when(mix % 29 == 0, "bad id!").when(mix % 5 != 0, (u * 10 + mix % 7).cast("string")).alias("rule_id"),
            F.when(mix % 23 != 0, u.cast("string")).otherwise("999999999").alias("device_id"),
            F.when(mix % 31 != 0, pick(["click", "view", "purchase", "error"], mix)).alias("metric"),
            F.when(e % 11 == 0, "eq").otherwise(pick(["gt", "lt", "gte", "lte"], e)).alias("operator"),
            F.when(mix % 3 != 0, F.col("value")).alias("threshold"),
            F.when(e % 17 == 0, "fatal").otherwise("critical").alias("severity"),
            F.when(mix % 6 != 0, mix % 7 != 0).alias("enabled"),
        )

    @cached_property
    def alert_commands(self) -> DataFrame:
        """A command five hours after every broken reading, on the alert it opened or would have opened."""
        x = F.col("seq") + F.col("alert_rule_id").cast("long") % 10
        return judged_readings(self.telemetry, self.rules).where("breached").select(
            (F.col("seq") * 10 + F.col("alert_rule_id").cast("long") % 10).alias("cmd_id"),
            (F.col("received_at") + F.make_dt_interval(hours=F.lit(5))).alias("cmd_ts"),
            F.when(x % 3 != 1, "resolve").otherwise("acknowledge").alias("action"),
            F.when(x % 19 == 0, "no such id!").otherwise(alert_id(F.col("alert_rule_id"), F.col("received_at"), F.col("seq"))).alias("alert_id"),
            F.when(x % 11 != 0, (x % 12).cast("string")).alias("user_id"),
        )

    @cached_property
    def deletes(self) -> DataFrame:
        """Three deletes per order: a rule of its customer, its customer's device, and a site or a user."""
        o, c, n = F.col("o_orderkey"), F.col("o_custkey"), F.col("n")
        table = F.when(n == 0, "alert_rules").when(n == 1, "devices").when(o % 3 == 0, "sites").when(o % 3 == 1, "users").otherwise("alerts")
        row = F.when(n == 0, c * 10 + o % 7).when(n == 1, c).when(o % 3 == 0, c % 30).otherwise(c % 120)
        return (
            self._given("orders")
            .withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(3)])))
            .select((o * 3 + n).alias("del_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("del_ts"), table.alias("table_name"), row.cast("string").alias("row_id"))
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "sites": self.sites,
            "devices": self.devices,
            "alert_rules": self.rules,
            "users": self.users,
            "alerts": self.alerts,
        }
