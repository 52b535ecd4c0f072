"""Live events: parse, validate, route, and measure in event-time windows.

The expressions are the same for a batch frame and a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelspark.contracts import EVENT_TYPES, STREAM_FIELDS
from reelspark.functions.exprs import count_where, is_watch, ratio, round_even, to_timestamp
from reelspark.functions.masking import mask_ip
from reelspark.operators.anomaly import MAX_ADDRESSES, MAX_FRICTION, MAX_SESSION_MINS, MIN_SEARCHES
from reelspark.operators.quality import accepted
from reelspark.operators.spread import few_join, stored
from reelspark.sources.sinks import insert_ignore

# What absent fields of a valid event become.
DEFAULTS = {"device": "Unknown", "session_id": "sess_stream", "ip_address": "127.0.0.1"}
SOURCE_TAG = "kafka_stream_consumer"
TOPIC = "user-events"


def read_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """JSON lines that arrive as files in a folder, with their file and byte range."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"))


def read_topic(spark: SparkSession, servers: str, max_offsets: int = 1_000_000) -> DataFrame:
    """JSON messages of the topic. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", TOPIC)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(
            F.col("value").cast("string").alias("value"),
            F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("source"),
            F.col("offset").alias("position"),
        )
    )


def to_lines(events: DataFrame) -> DataFrame:
    """Events as flat JSON lines; null fields are absent."""
    fields = [c for c in STREAM_FIELDS if c in events.columns]
    return events.select(F.to_json(F.struct(*fields)).alias("value"))


def _minutes(document: Column) -> Column:
    """Whole minutes; 0 when absent, null when malformed. Whole-number text counts,
    text with a fraction does not, a number with a fraction is truncated."""
    found = F.try_variant_get(document, "$.watch_time_mins", "variant")
    kind = F.schema_of_variant(found)
    text = F.try_variant_get(document, "$.watch_time_mins", "string")
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return (
        F.when(kind.isNull(), F.lit(0).cast("bigint"))
        .when(kind == "STRING", F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint")))
        .when(kind == "BOOLEAN", (text == "true").cast("bigint"))
        .when(number, text.try_cast("decimal(38,9)").try_cast("bigint"))
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """The fields of each JSON line as text, the minutes, and whether it parsed; other
    columns of the lines stay."""
    document = F.col("_document")
    fields = [
        F.try_variant_get(document, f"$.{name}", "string").alias(name)
        for name in STREAM_FIELDS
        if name != "watch_time_mins"
    ]
    parsed = lines.withColumn("_document", F.try_parse_json("value"))
    return parsed.select(
        *(c for c in lines.columns if c != "value"),
        *fields,
        _minutes(document).alias("watch_time_mins"),
        document.isNotNull().alias("_parsed"),
    )


def _absent(column: str) -> Column:
    return F.coalesce(F.col(column) == "", F.lit(True))


def validate(events: DataFrame) -> DataFrame:
    """Add ``is_valid`` and the note of the first failing rule."""
    shown = F.coalesce("event_type", F.lit("None"))
    note = (
        F.when(~F.col("_parsed"), "Malformed JSON")
        .when(_absent("event_id"), "Missing event_id")
        .when(_absent("user_id"), "Missing user_id")
        .when(
            ~accepted("event_type", EVENT_TYPES),
            F.concat(F.lit("Invalid event_type '"), shown, F.lit("'")),
        )
        .when(F.col("watch_time_mins") < 0, "Negative watch_time_mins")
        .when(F.col("watch_time_mins").isNull(), "Malformed watch_time_mins")
        .otherwise("Valid")
    )
    return (
        events.withColumn("validation_note", note)
        .withColumn("is_valid", F.col("validation_note") == "Valid")
        .drop("_parsed")
    )


def accepted_events(checked: DataFrame) -> DataFrame:
    """Valid events as stored: defaults filled, address masked."""

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(DEFAULTS[column]))

    arrival = F.col("consumed_at").cast("timestamp_ntz")
    return checked.where("is_valid").select(
        "event_id",
        "user_id",
        "event_type",
        "content_id",
        "watch_time_mins",
        filled("device").alias("device"),
        filled("session_id").alias("session_id"),
        F.when(F.col("timestamp").isNull(), arrival)
        .otherwise(to_timestamp(F.col("timestamp")))
        .alias("timestamp"),
        mask_ip(filled("ip_address")).alias("ip_address"),
        "arrival",
    )


def stream_documents(checked: DataFrame) -> DataFrame:
    return checked.where("is_valid").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("event"),
        "content_id",
        "timestamp",
        F.struct("device", "watch_time_mins", F.lit(SOURCE_TAG).alias("source")).alias("metadata"),
        F.current_timestamp().alias("inserted_at"),
    )


@dataclass(frozen=True)
class StreamStore:
    """Folders of the routed stream."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def with_positions(checked: DataFrame) -> DataFrame:
    """Add ``arrival``, the order of the rows, and ``source_key``, which names the place
    that an event was read from: partition and offset of a topic, or file and line.

    Lines are numbered by place: those of earlier byte ranges of the file, plus the
    place inside the range. So the same line has the same key in whatever batch and
    byte range it is read. Rows without a source have no key.
    """
    numbered = stored(checked.withColumn("arrival", F.monotonically_increasing_id()))
    if "source" not in numbered.columns:
        return numbered.withColumn("source_key", F.lit(None).cast("string"))
    place = F.col("position") if "position" in numbered.columns else None
    if place is None:
        ranges = numbered.groupBy("source", "block").agg(F.count("*").alias("_rows"), F.min("arrival").alias("_first"))
        earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
        # one row for each byte range of the batch
        numbered = few_join(numbered, stored(ranges), ["source", "block"])
        place = F.col("_before") + F.col("arrival") - F.col("_first")
    keyed = numbered.withColumn("source_key", F.concat_ws(":", F.col("source"), place.cast("string")))
    return keyed.drop("_before", "_first", "source", "block", "position")


def route_batch(checked: DataFrame, batch_id: int, store: StreamStore) -> None:
    """Write one micro-batch: consumed log first, the other sinks from that log.

    Every sink owns a folder per batch and overwrites it, so a repeated batch leaves
    the same files. Reading the log back keeps arrival time and order equal in all sinks.
    Batch numbers restart with a new checkpoint, so a folder is named after the stream,
    whose id its checkpoint keeps, and the number. The log keeps each source position
    once: what a new checkpoint reads again is in it already, and no sink sees it twice.
    """
    spark = checked.sparkSession
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    batch = f"{stream}-{batch_id}" if stream else str(batch_id)
    part = f"batch_id={batch}"
    logged = f"{store.at('consumed')}/{part}"
    keyed = "source" in checked.columns
    stamped = with_positions(checked).withColumn("consumed_at", F.current_timestamp())
    if keyed:
        ordered = stamped.withColumn("_order", F.col("arrival"))
        insert_ignore(ordered, store.at("consumed"), "source_key", batch, "_order")
    else:
        stamped.write.mode("overwrite").parquet(logged)
    consumed = spark.read.schema(stamped.schema).parquet(logged)
    rejected = consumed.where("NOT is_valid")
    rejected.write.mode("overwrite").parquet(f"{store.at('rejected')}/{part}")
    insert_ignore(accepted_events(consumed), store.at("events"), "event_id", batch, "arrival")
    stream_documents(consumed).write.mode("overwrite").json(f"{store.at('raw_documents')}/{part}")


def start_routing(
    lines: DataFrame, store: StreamStore, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    writer = (
        validate(parse_lines(lines))
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, n: route_batch(df, n, store))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def metrics(checked: DataFrame) -> DataFrame:
    """Consumed, valid and invalid events and the valid rate."""
    rate = round_even(ratio(F.count_if("is_valid"), F.count("*")) * 100, 1)
    return checked.agg(
        F.count("*").alias("total_consumed"),
        count_where(F.col("is_valid")).alias("valid_events"),
        count_where(~F.col("is_valid")).alias("invalid_events"),
        F.coalesce(rate, F.lit(100.0)).alias("valid_rate"),
    )


def _on_time(events: DataFrame, delay: str) -> DataFrame:
    """Set the watermark of a stream; its clock must be of the zoned type. A batch
    frame has no late rows and is left alone."""
    if not events.isStreaming:
        return events
    zoned = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return zoned.withWatermark("timestamp", delay)


def drop_repeats(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One event per id within the watermark; the state is bounded by the delay."""
    return _on_time(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def typed(checked: DataFrame) -> DataFrame:
    """Valid events with a readable timestamp, for event-time operators."""
    return (
        checked.where("is_valid")
        .withColumn("timestamp", to_timestamp(F.col("timestamp")))
        .where(F.col("timestamp").isNotNull())
    )


def _windowed(events: DataFrame, delay: str, length: str) -> DataFrame:
    """Tumbling windows; rows later than the delay are dropped on streams."""
    return _on_time(events, delay).withColumn("_window", F.window("timestamp", length))


def _window_start() -> Column:
    return F.col("_window.start").cast("timestamp_ntz").alias("window_start")


def usage_windows(events: DataFrame, delay: str = "1 day", exact: bool = False) -> DataFrame:
    """Daily usage per tumbling day. Streams count users approximately, which keeps a
    fixed-size sketch per day; a batch frame may ask for the exact number."""
    users = F.countDistinct("user_id") if exact else F.approx_count_distinct("user_id")
    return (
        _windowed(events, delay, "1 day")
        .groupBy("_window")
        .agg(
            users.alias("daily_active_users"),
            F.count("event_id").alias("total_events_logged"),
            F.sum(F.when(is_watch(), F.col("watch_time_mins")).otherwise(0)).alias("total_daily_watch_mins"),
            F.count_if(F.col("event_type") == "subscription").alias("new_subscriptions_started"),
        )
        .select(_window_start(), "*")
        .drop("_window")
    )


def multi_ip_windows(events: DataFrame, delay: str = "1 day", length: str = "1 day") -> DataFrame:
    """Users with more than two addresses in a window. Addresses are deduplicated in
    keyed state, then counted, so no user's addresses are collected in one place."""
    return (
        _windowed(events, delay, length)
        .where(F.col("user_id").isNotNull() & F.col("ip_address").isNotNull())
        .dropDuplicates(["_window", "user_id", "ip_address"])
        .groupBy("_window", "user_id")
        .agg(F.count("*").alias("n_ips"))
        .where(F.col("n_ips") > MAX_ADDRESSES)
        .select(_window_start(), "user_id", "n_ips")
    )


def friction_windows(events: DataFrame, delay: str = "1 day", length: str = "1 day") -> DataFrame:
    trouble = F.count_if(F.col("event_type").isin("buffering", "error"))
    return (
        _windowed(events, delay, length)
        .groupBy("_window")
        .agg(ratio(trouble, F.count("event_type")).alias("friction"))
        .where(F.col("friction") > MAX_FRICTION)
        .select(_window_start(), "friction")
    )


def long_session_windows(events: DataFrame, length: str = "1 day") -> DataFrame:
    """Stateless: each long session with the window it falls into."""
    return (
        events.where(is_watch() & (F.col("watch_time_mins") > MAX_SESSION_MINS))
        .withColumn("_window", F.window("timestamp", length))
        .select(_window_start(), "event_id", "user_id", "watch_time_mins")
    )


def scraper_windows(events: DataFrame, delay: str = "1 day", length: str = "1 day") -> DataFrame:
    return (
        _windowed(events, delay, length)
        .where(F.col("user_id").isNotNull())
        .groupBy("_window", "user_id")
        .agg(
            F.count_if(F.col("event_type") == "search").alias("searches"),
            F.count_if(is_watch()).alias("_plays"),
        )
        .where((F.col("searches") >= MIN_SEARCHES) & (F.col("_plays") == 0))
        .select(_window_start(), "user_id", "searches")
    )
