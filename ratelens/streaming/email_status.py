"""Mail status as a stream: the batch fold of ``operators.delivery`` kept up to date event by event.

Each micro-batch is stored as it came, in folders by day of the events, and the periods of a message that it touches are summed up anew from the
stored events with the very rules of the batch (``delivery.email_periods``). So the result does not depend on how the events were
cut into micro-batches or in which order they came, no event is ever too late, and what the stream has to remember lies in
files instead of executors' memory. A repeated micro-batch replaces its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.delivery import email_periods, known_events, merge_periods, period_of

PAYLOAD = (
    "array<struct<MessageID:string, RecordType:string, DeliveredAt:string, ReceivedAt:string, Type:string, "
    "Description:string>>"
)
EVENTS = "event_id long, part int, ts timestamp_ntz, message_id string, record_type string, bounce_type string, description string"


def read_payloads(lines: DataFrame) -> DataFrame:
    """Mail events from JSON texts ``(event_id, value)`` that hold one event or a list; ``part`` is the place in the list."""
    one_each = lines.select("event_id", F.posexplode(F.from_json("value", PAYLOAD)).alias("part", "e"))
    return one_each.select(
        "event_id",
        "part",
        F.coalesce("e.DeliveredAt", "e.ReceivedAt").try_cast("timestamp").cast("timestamp_ntz").alias("ts"),
        F.col("e.MessageID").alias("message_id"),
        F.col("e.RecordType").alias("record_type"),
        F.col("e.Type").alias("bounce_type"),
        F.col("e.Description").alias("description"),
    )


def payload_text(events: DataFrame) -> DataFrame:
    """Events as the JSON texts that a mail service sends."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    event = F.struct(
        F.col("message_id").alias("MessageID"),
        F.col("record_type").alias("RecordType"),
        F.when(F.lower("record_type") == "delivery", time).alias("DeliveredAt"),
        F.when(F.lower("record_type") != "delivery", time).alias("ReceivedAt"),
        F.col("bounce_type").alias("Type"),
        F.col("description").alias("Description"),
    )
    listed = F.col("event_id") % 2 == 0
    return events.select("event_id", F.when(listed, F.to_json(F.array(event))).otherwise(F.to_json(event)).alias("value"))


def _store(batch: DataFrame, batch_id: int, emails: DataFrame, folder: str) -> None:
    spark = batch.sparkSession
    logged = known_events(batch).drop("kind").join(emails.select("message_id").distinct(), "message_id", "left_semi")
    stored = f"{folder}/events/batch={batch_id}"
    if "part" not in logged.columns:
        logged = logged.withColumn("part", F.lit(0))
    logged.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(stored)
    mine = spark.read.schema(f"{EVENTS}, day date").parquet(stored)
    days = [r[0] for r in mine.select("day").distinct().collect()]  # one value per day of events in the batch
    if not days:
        return
    touched = mine.select("message_id", period_of("ts").alias("period")).distinct()
    earlier = spark.read.schema(f"{EVENTS}, batch int, day date").parquet(f"{folder}/events")
    again = earlier.filter(F.col("day").isin(days) & (F.col("batch") <= batch_id)).withColumn("period", period_of("ts"))
    again = again.join(touched, ["message_id", "period"], "left_semi").drop("period", "batch", "day")
    email_periods(again).write.mode("overwrite").parquet(f"{folder}/updates/batch={batch_id}")


def run_to_table(events: DataFrame, emails: DataFrame, folder: str) -> None:
    """Drain a stream of events into ``folder``: the events of logged mails and the newest summaries of their periods."""
    query = (
        events.writeStream.foreachBatch(lambda batch, batch_id: _store(batch, batch_id, emails, folder))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_status(spark: SparkSession, folder: str, emails: DataFrame) -> DataFrame:
    """Status of every logged mail from the newest summary of each of its periods."""
    updates = spark.read.parquet(f"{folder}/updates")
    summary = F.struct(*[c for c in updates.columns if c not in ("batch", "message_id", "period")])
    newest = updates.groupBy("message_id", "period").agg(F.max_by(summary, "batch").alias("s"))
    return merge_periods(newest.select("message_id", "period", "s.*"), emails)
