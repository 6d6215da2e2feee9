"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netwatch.schema import ENVELOPE_SCHEMA

# Where a topic is read from, and what a gap in it does.
TOPIC_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_stream(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """A stream of ``key, value`` messages.

    ``source="kafka"`` takes the connector's options, with ``__`` for dots, for example
    ``kafka__bootstrap__servers`` and ``subscribe``; the connector must be on the class path. Any
    other source is a file format, with ``path`` naming the folder of message files.
    """
    settings = {key.replace("__", "."): value for key, value in options.items()}
    reader = spark.readStream.format(source)
    if source == "kafka":
        return reader.options(**{**TOPIC_OPTIONS, **settings}).load().select("key", "value")
    return reader.schema(ENVELOPE_SCHEMA).options(**settings).load()


def write_messages(messages: DataFrame, **options: str) -> None:
    """Sends encoded messages to a topic; needs the connector on the class path."""
    settings = {key.replace("__", "."): value for key, value in options.items()}
    messages.write.format("kafka").options(**settings).save()
