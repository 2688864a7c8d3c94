"""Events as JSON messages: decode with quarantine, encode, Kafka source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import EVENT, EVENT_COLUMNS

# Closes the frame around a message; no key of the contract.
_END = "_end"

def _parsed(messages: DataFrame) -> DataFrame:
    """``value``, the event's columns, and ``_valid``: UTF-8, one JSON object, parsed without error."""
    text = F.col("value").cast("string")
    # The pattern only looks at messages with whitespace around the object, and at malformed ones.
    braces = F.when(text.startswith("{") & text.endswith("}"), True).otherwise(text.rlike(r"(?s)^\s*\{.*\}\s*$"))
    one_object = braces & F.is_valid_utf8(text)
    # Read as the first of two array elements, so that whatever follows the object shows.
    schema = f"array<struct<{', '.join(f'{c}: string' for c in (*EVENT_COLUMNS, _END))}>>"
    framed = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"1"}}]'))
    parsed = F.from_json(framed, schema, {"allowSingleQuotes": "false"})
    whole = (F.size("_events") == 2) & F.col("_events")[1][_END].isNotNull()
    single = F.when(whole, F.col("_events")[0])
    return (
        messages.select("value", F.coalesce(one_object, F.lit(False)).alias("_one_object"), parsed.alias("_events"))
        # Taking the struct apart as a generator parses each message once, not once per column.
        .select("value", "_one_object", F.explode(F.array(single)).alias("_event"))
        .select(
            "value",
            *[F.col("_event")[c].alias(c) for c in EVENT_COLUMNS],
            (F.col("_one_object") & F.col("_event").isNotNull()).alias("_valid"),
        )
    )


def decode_events(messages: DataFrame) -> DataFrame:
    """Well-formed messages of ``value`` as text columns; absent keys and '' are NULL, other keys ignored."""
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in EVENT.names]
    return _parsed(messages).filter("_valid").select(*fields)


def malformed_messages(messages: DataFrame) -> DataFrame:
    """The messages that ``decode_events`` leaves out, as they came."""
    return _parsed(messages).filter("NOT _valid").select("value")


def encode_events(rows: DataFrame) -> DataFrame:
    """One JSON object of strings per row in ``value``; a NULL is sent as '' so that every key is present."""
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def publish_events(rows: DataFrame, format: str = "kafka", **options: str) -> None:
    """Send every row as a message without key. Spark fails the job on delivery errors."""
    encode_events(rows).write.format(format).mode("append").options(**options).save()


def kafka_messages(
    spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str | None = None, **options: str
) -> DataFrame:
    """Stream of a topic's messages from its beginning; progress is kept in the query's checkpoint.

    ``options`` go to the source as they are: security settings, or ``maxOffsetsPerTrigger``, without which a first
    drain is one micro-batch of the whole backlog. Needs Spark's Kafka connector: ``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version>``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.options(**options).load().select("value")
