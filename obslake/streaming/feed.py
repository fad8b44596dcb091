"""Live feed to raw hour folders, and views on the running feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.functions.calendar import hour_parts
from obslake.functions.weather import FEED_BOUNDS
from obslake.operators.filters import usable, within_bounds
from obslake.plans import ledger
from obslake.plans.silver import MESSAGE_ID, normalise_feed
from obslake.schemas import FEED_MESSAGE, OBSERVATION_COLUMNS
from obslake.session import settle
from obslake.sources import versions
from obslake.sources.readers import read_table
from obslake.sources.sinks import write_partitions

# Rate limit and trigger of the feed job.
OFFSETS_PER_TRIGGER = 20_000
TRIGGER_SECONDS = 30
UNIQUE_KEY = ["station_id", "timestamp"]
HOUR_COLUMNS = ["year", "month", "day", "hour"]
#: commits of micro-batches after which a versioned table is compacted
BATCH_COMMITS = 120


def kafka_options(
    servers: str, topic: str, from_earliest: bool = False, per_trigger: int | None = None,
    allow_loss: bool = False,
) -> dict[str, str]:
    """Options of the topic reader.

    Without ``per_trigger`` (OFFSETS_PER_TRIGGER is the usual limit) a backlog is read as fast as it can be;
    messages that the topic no longer holds fail the job unless ``allow_loss`` says otherwise.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_earliest else "latest",
        "failOnDataLoss": "false" if allow_loss else "true",
    }
    return options | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def kafka_messages(spark: SparkSession, servers: str, topic: str, **choices) -> DataFrame:
    """Message texts of a topic (needs the Kafka connector on the class path); see kafka_options."""
    return message_text(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **choices)).load())


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Message texts from files that appear below a path."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return message_text(reader.load(path))


def message_text(source: DataFrame) -> DataFrame:
    """The value of each message as text, without empty messages."""
    return source.select(F.col("value").cast("string").alias("json_value")).where(
        F.col("json_value").isNotNull()
    )


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with a readable event time, their fields and the raw text."""
    return (
        messages.withColumn("m", F.from_json("json_value", FEED_MESSAGE))
        .withColumn("event_time", F.try_to_timestamp("m.timestamp"))
        .where(F.col("event_time").isNotNull())
    )


def by_hour(messages: DataFrame) -> DataFrame:
    """The raw text under its event-time hour."""
    return parsed(messages).select("json_value", *[
        col.alias(name) for name, col in hour_parts(F.col("event_time")).items()
    ])


def checked_fields(messages: DataFrame, id_field: str | None = None) -> DataFrame:
    """Fields with impossible measures made NULL and empty records dropped; ``id_field`` names a message's own id."""
    sent = [F.coalesce(F.get_json_object("json_value", f"$.{id_field}"), F.lit("")).alias(MESSAGE_ID)] if id_field else []
    fields = parsed(messages).select("m.*", "event_time", *sent)
    return usable(within_bounds(fields, FEED_BOUNDS))


def write_hours(
    batch: DataFrame, epoch: int, path: str, ledger_path: str, name: str | None = None
) -> None:
    """Writes one micro-batch below its hours and marks the hours.

    The batch is parsed once and an hour's rows go to one file. The files lie
    in a folder of the stream and the epoch, so a replayed epoch replaces its
    own files and nothing is doubled. The stream's own id, which belongs to
    its checkpoint, is the default name. Below a versioned root a batch is one commit, which a replay does not
    repeat, and every BATCH_COMMITS commits become one file set per hour.
    """
    context = batch.sparkSession.sparkContext
    name = name or context.getLocalProperty("sql.streaming.queryId") or "batch"
    rows = by_hour(batch).withColumn("epoch", F.lit(f"{name}-{epoch}")).persist()
    try:
        hours = rows.groupBy(*HOUR_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
        if hours.isEmpty():
            return
        if versions.is_versioned(batch.sparkSession, path):
            _commit_batch(rows.drop("epoch"), epoch, path, name, HOUR_COLUMNS)
        else:
            (
                rows.hint("rebalance", *HOUR_COLUMNS).write.mode("overwrite")
                .partitionBy(*HOUR_COLUMNS, "epoch")
                .option("partitionOverwriteMode", "dynamic")
                .text(path)
            )
        keys = hours.select(F.concat_ws("/", *HOUR_COLUMNS).alias("key"))
        ledger.mark(batch.sparkSession, ledger_path, "stream", keys, run=f"{name}-{epoch}")
    finally:
        rows.unpersist()


def _commit_batch(rows: DataFrame, epoch: int, path: str, name: str, columns: list[str]) -> None:
    """Appends a micro-batch once and compacts the table when many have come."""
    spark = rows.sparkSession
    root, table = versions.split(path)
    with versions.Change(spark, root, f"{name}-{table}", epoch) as change:
        change.append(table, rows, columns)
    if sum(not versions.partition_of(folder) for folder in versions.live_folders(spark, path)) >= BATCH_COMMITS:
        versions.compact(spark, path, columns)
        versions.expire(spark, root)


def start_hourly(
    messages: DataFrame, path: str, ledger_path: str, checkpoint: str, name: str | None = None,
    trigger_seconds: int | None = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Starts the feed job; without a trigger time it stops when all input is read."""
    trigger = (
        {"availableNow": True}
        if trigger_seconds is None
        else {"processingTime": f"{trigger_seconds} seconds"}
    )
    return (
        messages.writeStream.foreachBatch(
            lambda batch, epoch: write_hours(batch, epoch, path, ledger_path, name)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Lets the job run for a bounded time; True if it ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def unique_messages(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Checked observations once per station and time, in streams with bounded state.

    A stream forgets what is older than ``delay`` and drops rows that come later; ``start_unique`` loses none.
    """
    rows = normalise_feed(checked_fields(messages))
    if not rows.isStreaming:
        return rows.dropDuplicates(UNIQUE_KEY)
    return rows.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(UNIQUE_KEY)


def write_unique(batch: DataFrame, epoch: int, path: str, name: str | None = None) -> None:
    """Adds those observations of a micro-batch that its days do not hold yet, however late they are.

    An observation is its station and time, and the message id where the rows have one. Rows lie below their day
    and the epoch, so a replayed epoch replaces its own rows; only the days that the batch touches are read. Below a versioned root a batch is one commit, as in ``write_hours``.
    """
    spark = batch.sparkSession
    name = name or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    key = [*UNIQUE_KEY, *[c for c in batch.columns if c == MESSAGE_ID]]
    rows = batch.dropDuplicates(key).withColumn("epoch", F.lit(f"{name}-{epoch}")).persist()
    try:
        stored = read_table(spark, path)
        new = rows
        if versions.is_versioned(spark, path):
            if stored is not None:
                days = rows.select("dt").distinct()
                known = stored.join(days, "dt", "left_semi").select(*key)
                new = rows.join(known, key, "left_anti")
            _commit_batch(new.drop("epoch"), epoch, path, name, ["dt"])
            return
        if stored is not None:
            days = rows.select("dt").distinct()
            known = stored.where(F.col("epoch") != f"{name}-{epoch}").join(days, "dt", "left_semi")
            new = rows.join(known.select(*key), key, "left_anti")
        write_partitions(settle(new), path, ["dt", "epoch"])
    finally:
        rows.unpersist()


def start_unique(
    messages: DataFrame, path: str, checkpoint: str, name: str | None = None, trigger_seconds: int | None = None,
    id_field: str | None = None,
) -> StreamingQuery:
    """Writes the unique observations; late ones go to their day like any others.

    Without a trigger time it stops when all input that is there is read. Where several instruments report for
    one station at the same time, ``id_field`` names the message's id: copies of a message then go, not other messages.
    """
    trigger = {"availableNow": True} if trigger_seconds is None else {"processingTime": f"{trigger_seconds} seconds"}
    rows = normalise_feed(checked_fields(messages, id_field)).select(*OBSERVATION_COLUMNS, *([MESSAGE_ID] if id_field else []))
    return (
        rows.writeStream.foreachBatch(lambda batch, epoch: write_unique(batch, epoch, path, name))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )



# The cities asked for when no list is given.
DEFAULT_CITIES = [
    ("Paris", 48.8534, 2.3488),
    ("Lyon", 45.764, 4.8357),
    ("Marseille", 43.2965, 5.3698),
    ("Bordeaux", 44.8378, -0.5792),
    ("Lille", 50.6292, 3.0573),
]
CITY_LIST = "array<struct<city: string, latitude: double, longitude: double>>"


def city_list(rows: DataFrame, column: str) -> DataFrame:
    """Cities of JSON array texts; an empty or unreadable text stands for the fixed list."""
    listed = F.from_json(column, CITY_LIST)
    fixed = F.array(
        *[
            F.struct(F.lit(city).alias("city"), F.lit(lat).alias("latitude"), F.lit(lon).alias("longitude"))
            for city, lat, lon in DEFAULT_CITIES
        ]
    )
    chosen = F.when(F.size(F.coalesce(listed, F.array().cast(CITY_LIST))) > 0, listed).otherwise(fixed)
    return rows.select(F.inline(chosen))


def flatten_record(calls: DataFrame) -> DataFrame:
    """Service answers (city, coordinates, ``current`` struct) as feed fields."""
    now = "current."
    return calls.select(
        "city", "latitude", "longitude",
        F.col(now + "time").alias("timestamp"),
        F.col(now + "temperature_2m").alias("temperature"),
        F.col(now + "wind_speed_10m").alias("windspeed"),
        F.col(now + "wind_direction_10m").alias("winddirection"),
        F.col(now + "weather_code").alias("weathercode"),
        F.col(now + "precipitation").alias("precipitation"),
        F.lit("OPENMETEO").alias("source"),
    )
