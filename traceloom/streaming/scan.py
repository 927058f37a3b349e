"""Scanning a stream of units: the batch projection on unbounded input.

A scan has no state, so the same expressions run on a stream; duplicates that
arrive again within the watermark are dropped by their digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from traceloom.operators.rules import RULES, Rule
from traceloom.operators.scan import scan_text, text_units


def stream_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Documents as files arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def stream_findings(docs: DataFrame, key: str, text: str, event_time: str | None = None, delay: str = "1 day", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings of a stream; with an event time, equal texts within the delay are scanned once."""
    if event_time:
        docs = docs.withWatermark(event_time, delay).withColumn("_digest", F.sha2(F.col(text), 256)).dropDuplicatesWithinWatermark(["_digest"])
    return scan_text(text_units(docs, key, text), rules)


def count_by_window(docs: DataFrame, event_time: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Documents per window of event time; late ones within the delay still count."""
    return docs.withWatermark(event_time, delay).groupBy(F.window(event_time, window).alias("w")).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("start"), "n"
    )


def write_findings(findings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append findings as they come; the checkpoint makes restarts exact."""
    return findings.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start()
