"""Reading and writing device messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.functions.columns import utc_clock
from fleetwatch.schemas import MESSAGES


def read_messages(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """Messages as JSON lines, replayed as a batch or followed as a stream."""
    reader = (spark.readStream if streaming else spark.read).schema(MESSAGES)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Appends messages as JSON lines; times keep their microseconds."""
    messages.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGES]).write.mode("append").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Messages out of Kafka records whose key is the device topic.

    Alerts and liveness go by the time of receipt, so the topic must use LogAppendTime (timestamp
    type 1); a record with the producer's clock fails the query. Offsets count per Kafka partition:
    `seq` is the partition in the upper 16 bits and the offset below.
    """
    appended = F.col("timestampType") == 1
    refused = F.raise_error(F.lit("the topic's message.timestamp.type must be LogAppendTime")).cast("timestamp")
    return records.select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        F.when(appended, F.col("timestamp")).otherwise(refused).alias("received_at"),
        F.shiftleft(F.col("partition").cast("long"), 48).bitwiseOR(F.col("offset")).alias("seq"),
    )


def encode_messages(telemetry: DataFrame, topic_root: str) -> DataFrame:
    """Topic and JSON payload of each reading. Times keep their microseconds."""
    payload = F.struct(
        "device_id",
        "site_id",
        "device_type",
        "readings",
        F.date_format(utc_clock(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
    )
    return telemetry.select(
        F.concat_ws("/", F.lit(topic_root), "site_id", "device_id", F.lit("telemetry")).alias("topic"),
        F.to_json(payload).alias("payload"),
        "received_at",
        "seq",
    )
