"""Reading and writing the stored tables."""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetwatch.functions.columns import canonical_id, utc_date
from fleetwatch.schemas import TABLES, TELEMETRY


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Sites, devices, rules, users and alerts from Parquet, ids in one spelling."""
    return {name: _canonical(spark.read.schema(schema).parquet(f"{root}/{name}")) for name, schema in TABLES.items()}


def _canonical(rows: DataFrame) -> DataFrame:
    ids = [c for c in rows.columns if c == "id" or c.endswith(("_id", "ed_by"))]
    return rows.withColumns({c: canonical_id(F.col(c)) for c in ids})


@dataclass(frozen=True)
class Slices:
    """How to read a table in parallel: a numeric or time column, its bounds, and how many parts."""

    column: str
    lower: str
    upper: str
    parts: int


def load_tables_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], slices: dict[str, Slices] | None = None
) -> dict[str, DataFrame]:
    """The same tables from a live database; those named in `slices` (at least alerts) in parallel parts."""
    found = {}
    for name, schema in TABLES.items():
        cut = (slices or {}).get(name)
        parts = {} if cut is None else dict(column=cut.column, lowerBound=cut.lower, upperBound=cut.upper, numPartitions=cut.parts)
        rows = spark.read.jdbc(url, name, properties=properties, **parts)
        found[name] = _canonical(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]))
    return found


def write_telemetry(
    telemetry: DataFrame, path: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery | None:
    """Appends accepted messages unchanged; a stream needs a checkpoint folder."""
    if not telemetry.isStreaming:
        telemetry.write.mode("append").parquet(path)
        return None
    writer = telemetry.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


#: Batches of compactions begin so; batches of callers must not.
COMPACTED = "compacted-"


def write_telemetry_layout(telemetry: DataFrame, path: str, batch: str | None = None) -> None:
    """Lays telemetry out for reads by device and time, each batch of rows beside the others of its days.

    Days go by the publishers' clocks, so late rows are normal: they land in folders of their own
    batch and leave what their days hold. A batch that is written again replaces itself. Without a
    name a batch is named after its rows, for one more pass over them: other rows never replace it.
    The range shuffle is on day, device and time, so a busy device or day spreads over several files
    and each file holds few devices.
    """
    if batch is not None and batch.startswith(COMPACTED):
        raise ValueError(f"batch names that begin with {COMPACTED!r} are those of compactions")
    _write_layout(telemetry, path, _content_name(telemetry) if batch is None else batch)


def _write_layout(telemetry: DataFrame, path: str, batch: str) -> None:
    (
        telemetry.withColumns({"ts_date": utc_date(F.col("ts")), "batch": F.lit(batch)})
        .repartitionByRange("ts_date", "device_id", F.desc("ts"))
        .sortWithinPartitions("ts_date", "device_id", F.desc("ts"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ts_date", "batch")
        .parquet(path)
    )


def _content_name(telemetry: DataFrame) -> str:
    """The same for the same rows, whatever their order and the session's zone."""
    fields = sorted((f for f in telemetry.schema if f.name not in ("ts_date", "batch")), key=lambda f: f.name)
    # A hash passes over nulls, so which columns are null is hashed too; maps have no hash, their entries have.
    nulls = F.concat(*[F.col(f.name).isNull().cast("int").cast("string") for f in fields])
    values = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in fields]
    sums = [F.sum(F.xxhash64(F.lit(seed), nulls, *values).cast("decimal(38,0)")) for seed in (1, 2)]
    return "rows-" + hashlib.sha256(repr(tuple(telemetry.agg(F.count("*"), *sums).first())).encode()).hexdigest()[:32]


def compact_telemetry_layout(spark: SparkSession, path: str, target: str) -> None:
    """Writes all batches of a layout, or of a stream's small files, as one batch to another folder.

    The source stays as it is until its owner drops it, so readers and a repeated run lose nothing.
    The batch is named after the source, so a repeated run replaces it and nothing else does.
    """
    source = hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:32]
    _write_layout(read_telemetry(spark, path), target, COMPACTED + source)


def read_telemetry(spark: SparkSession, path: str, laid_out: bool = False) -> DataFrame:
    schema = TELEMETRY
    if laid_out:
        schema = T.StructType([*TELEMETRY.fields, T.StructField("ts_date", T.DateType()), T.StructField("batch", T.StringType())])
    return spark.read.schema(schema).parquet(path)
