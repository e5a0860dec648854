"""The stream's tables: written batch by batch, and visible only by a commit that is written last.

Every attempt at a batch writes folders of its own. The commit of a batch is one small file that the writer's last job
renames into place, so it is there whole or not at all; it names the attempt, and the segments that make up the state.
Readers go by commits alone: whatever an unfinished or failed attempt left behind is never read.

Tables that only grow (telemetry, rejects and their counts, outcomes, closed alerts) keep one folder per batch. State is kept as changes:
a batch adds a segment with the rows it changed, and a fold by key takes the newest. Segments of last-seen times, rules
and used rules are merged by levels, as many of one level into one of the next, so a row is rewritten a number of times
that grows with the logarithm of the batches. Alerts are compacted every few batches: active ones into one snapshot,
resolved ones, which never change again, to the closed table. A commit says which folders it replaced; they are removed
with the next commit, so that a reader who began under the commit before is not left without them.
"""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatch import schemas
from fleetwatch.functions.columns import is_active


def _with(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in fields]])


_S, _L = T.StringType(), T.LongType()
LAST_SEEN = T.StructType([T.StructField("device_id", _S), T.StructField("written_at", T.TimestampType())])
REJECTS = _with(schemas.MESSAGES, ("reject_reason", _S))
OUTCOMES = _with(T.StructType(), ("cmd_id", _L), ("cmd_ts", T.TimestampType()), ("action", _S), ("alert_rule_id", _S), ("alert_id", _S), ("user_id", _S), ("outcome", _S))
RULE_OUTCOMES = _with(T.StructType(), ("chg_id", _L), ("chg_ts", T.TimestampType()), ("action", _S), ("rule_id", _S), ("outcome", _S))
REJECT_COUNTS = _with(T.StructType(), ("reject_reason", _S), ("messages", _L))
_VERSION = ("version", _L)

#: Tables that grow by what a batch adds.
GROWING = {
    "telemetry": schemas.TELEMETRY,
    "rejects": REJECTS,
    "reject_counts": REJECT_COUNTS,
    "outcomes": OUTCOMES,
    "rule_outcomes": RULE_OUTCOMES,
    "closed_alerts": schemas.ALERTS,
}
#: State, as changes; `version` is the number of the commit a row came with.
STATE = {
    "last_seen": _with(LAST_SEEN, _VERSION),
    "rules": _with(schemas.ALERT_RULES, ("deleted", T.BooleanType()), _VERSION),
    "used_rules": _with(T.StructType(), ("alert_rule_id", _S), _VERSION),
    "alerts": _with(schemas.ALERTS, _VERSION),
}
_KEYS = {"last_seen": "device_id", "rules": "id", "used_rules": "alert_rule_id", "alerts": "id"}

_SEGMENT = T.StructType([T.StructField("table", _S), T.StructField("level", T.IntegerType()), T.StructField("folder", _S)])
COMMITS = T.StructType(
    [
        T.StructField("batch_id", _L),
        T.StructField("attempt", _S),
        T.StructField("version", _L),
        T.StructField("segments", T.ArrayType(_SEGMENT)),
        T.StructField("replaced", T.ArrayType(_S)),
        T.StructField("run", T.IntegerType()),
        T.StructField("block", _L),
    ]
)
#: Batches whose commits share a folder, and one file once the folder is full.
COMMIT_BLOCK = 256


@dataclass(frozen=True)
class Commit:
    version: int = 0
    segments: tuple = ()
    replaced: tuple = ()
    again: bool = False

    def of(self, table: str) -> list:
        return [s for s in self.segments if s[0] == table]


@dataclass(frozen=True)
class AlertStore:
    """Where the stream keeps its tables. A new checkpoint needs a new `run`, counted upwards. One writer at a time."""

    root: str
    run: int = 0
    #: Batches between snapshots of the alerts; segments of a level that are merged into one of the next.
    every: int = 8
    fan: int = 4

    # -- reading -----------------------------------------------------------------------------------

    def commits(self, spark: SparkSession) -> DataFrame:
        return _read(spark.read.schema(COMMITS).format("json"), spark, COMMITS, f"{self.root}/_commits")

    def newest(self, spark: SparkSession, number: int | None = None) -> Commit:
        """The last commit, an empty state before the first; `again` tells if batch `number` of this run has one."""
        image = F.when(F.col("segments").isNotNull(), F.struct("version", "segments", "replaced"))
        place = F.when(F.col("segments").isNotNull(), F.struct("run", "batch_id"))
        here = (F.col("run") == self.run) & (F.col("batch_id") == F.lit(number))
        found = self.commits(spark).agg(F.max_by(image, place).alias("last"), F.bool_or(F.coalesce(here, F.lit(False))).alias("again")).first()
        if found["last"] is None:
            return Commit()
        last = found["last"]
        return Commit(last["version"], tuple(tuple(s) for s in last["segments"]), tuple(last["replaced"] or ()), found["again"])

    def all(self, spark: SparkSession, table: str) -> DataFrame:
        """What committed batches of all runs added to a growing table, with `run` and `batch_id`."""
        schema = _with(GROWING[table], ("run", T.IntegerType()), ("batch_id", _L), ("attempt", _S))
        rows = _read(spark.read.schema(schema), spark, schema, f"{self.root}/{table}")
        done = self.commits(spark).select("run", "batch_id", "attempt").distinct()
        return rows.join(done, ["run", "batch_id", "attempt"], "left_semi").drop("attempt").select(*GROWING[table].names, "run", "batch_id")

    def batch(self, spark: SparkSession, table: str, number: int) -> DataFrame:
        """What a committed batch of this run added to a growing table."""
        return self.all(spark, table).where((F.col("run") == self.run) & (F.col("batch_id") == number)).drop("run", "batch_id")

    def state(self, spark: SparkSession, table: str, commit: Commit | None = None) -> DataFrame:
        """The newest row of each key, as of a commit."""
        folders = [folder for _, _, folder in (commit or self.newest(spark)).of(table)]
        return _fold(self._segments(spark, table, folders), table).drop("version")

    def _segments(self, spark: SparkSession, table: str, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], STATE[table])
        return spark.read.schema(STATE[table]).parquet(*[f"{self.root}/{f}" for f in folders])


class BatchWriter:
    """One attempt at one batch: what it writes counts once commit() is done."""

    def __init__(self, spark: SparkSession, store: AlertStore, number: int):
        self.spark, self.store, self.number = spark, store, number
        self.attempt = uuid.uuid4().hex
        self.before = store.newest(spark, number)
        self.segments, self.replaced = list(self.before.segments), []
        self.held: list[str] = []

    @property
    def done_before(self) -> bool:
        """An earlier attempt at this batch was committed."""
        return self.before.again

    def _place(self, table: str, name: str = "") -> str:
        return f"{table}{name}/run={self.store.run}/batch_id={self.number}/attempt={self.attempt}"

    def _write(self, rows: DataFrame, schema: T.StructType, folder: str) -> str:
        rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(f"{self.store.root}/{folder}")
        return folder

    def hold(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that the batch uses several times: computed once, and stored until release().

        A cached plan would keep its shuffle partitions, however small, and every shuffle after it makes a file for each
        pair of them; stored rows are read in splits by their size.
        """
        folder = f"{self.store.root}/{self._place('_held', f'/{name}')}"
        self.held.append(folder)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def release(self) -> None:
        """Removes what is held."""
        for folder in self.held:
            _remove(self.spark, folder)
        self.held = []

    def add(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows for a growing table; returns what was written."""
        folder = self._write(rows, GROWING[table], self._place(table))
        return self.spark.read.schema(GROWING[table]).parquet(f"{self.store.root}/{folder}")

    def change(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows of a state table that are new or different; returns what was written."""
        version = F.lit(self.before.version + 1)
        folder = self._write(rows.withColumn("version", version), STATE[table], self._place(table, "_0"))
        self._add_segment(table, 0, folder)
        return self.store._segments(self.spark, table, [folder])

    def _add_segment(self, table: str, level: int, folder: str) -> None:
        self.segments.append((table, level, folder))

    def _replace(self, segments: list) -> None:
        self.segments = [s for s in self.segments if s not in segments]
        self.replaced += [folder for _, _, folder in segments]

    def merge(self, table: str) -> None:
        """As many segments of a level as `fan` become one of the next level."""
        level = 0
        while len(full := [s for s in self.segments if s[:2] == (table, level)]) >= self.store.fan:
            level += 1
            folded = _fold(self.store._segments(self.spark, table, [s[2] for s in full]), table)
            folder = self._write(folded, STATE[table], self._place(table, f"_{level}"))
            self._replace(full)
            self._add_segment(table, level, folder)

    def snapshot_alerts(self) -> None:
        """Every few batches: resolved alerts to the closed table, active ones into one segment."""
        held = [s for s in self.segments if s[0] == "alerts"]
        if len(held) <= self.store.every:
            return
        folded = _fold(self.store._segments(self.spark, "alerts", [s[2] for s in held]), "alerts")
        active = is_active(F.col("status"))
        self.add("closed_alerts", folded.where(~active))
        folder = self._write(folded.where(active), STATE["alerts"], self._place("alerts", "_1"))
        self._replace(held)
        self._add_segment("alerts", 1, folder)

    def commit(self) -> None:
        """Makes the batch count, then removes what the commit before replaced."""
        block = self.number // COMMIT_BLOCK
        row = (self.number, self.attempt, self.before.version + 1, self.segments, self.replaced, self.store.run, block)
        one = self.spark.createDataFrame([row], COMMITS).coalesce(1).drop("run", "block")
        one.write.mode("append").json(f"{self.store.root}/_commits/run={self.store.run}/block={block}")
        for folder in self.before.replaced:
            _remove(self.spark, f"{self.store.root}/{folder}")
        if self.number % COMMIT_BLOCK == 0 and block:
            self._shrink(block - 1)

    def _shrink(self, block: int) -> None:
        """The commits of a full block as one file, without the segments that no one needs any more."""
        folder = f"{self.store.root}/_commits/run={self.store.run}/block={block}"
        old = self.spark.read.schema(COMMITS).json(folder).select("batch_id", "attempt", "version")
        files = old.inputFiles()
        if len(files) > 1:
            old.distinct().coalesce(1).write.mode("append").json(folder)
            for file in files:
                _remove(self.spark, file)


def current_alerts(spark: SparkSession, store: AlertStore) -> DataFrame:
    """All alerts as of the last commit."""
    commit = store.newest(spark)
    closed = store.all(spark, "closed_alerts").drop("run", "batch_id")
    # A batch that is committed while this reads may move alerts to the closed table: the state's row goes first.
    held = store.state(spark, "alerts", commit)
    return held.unionByName(closed.join(held.select("id"), "id", "left_anti"))


def current_last_seen(spark: SparkSession, store: AlertStore) -> DataFrame:
    return store.state(spark, "last_seen")


def current_rules(spark: SparkSession, store: AlertStore, base: DataFrame, commit: Commit | None = None) -> DataFrame:
    """Base rules with what the stream's changes made of them; a changed rule goes by the stream, not by the base."""
    changed = store.state(spark, "rules", commit)
    kept = base.join(changed.select(F.col("id")), "id", "left_anti")
    at = base.schema["created_at"].dataType
    return kept.unionByName(changed.where("NOT deleted").drop("deleted").withColumn("created_at", F.col("created_at").cast(at)))


def _fold(rows: DataFrame, table: str) -> DataFrame:
    key = _KEYS[table]
    rest = [c for c in rows.columns if c not in (key, "version")]
    image = F.max_by(F.struct(F.lit(0).alias("_"), *rest), "version").alias("image")
    folded = rows.groupBy(key).agg(image, F.max("version").alias("version"))
    return folded.select(key, *[F.col(f"image.{c}").alias(c) for c in rest], "version").select(*rows.columns)


def _read(reader, spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The files there are now; none before the first write."""
    try:
        return reader.load(path).select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file through Spark's file systems, wherever the store lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
