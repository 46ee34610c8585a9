"""Lists that keep arriving: lines are classified as a stream and merged into what is known with each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from listloom.operators.classify import classify
from listloom.operators.dedup import deduplicate, gathered, survivors
from listloom.storage import delete


def classify_stream(lines: DataFrame) -> DataFrame:
    """classify() of a stream of lines: it keeps no state, so any output mode does."""
    return classify(lines)


def remerge(lines: DataFrame, store: str, checkpoint: str, done: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start a query that merges each batch's rules into the survivors at store and calls done(merged rules, batch number).

    The survivors after a batch are a table of their own, made of those after the batch before and of the batch: a batch
    costs its lines and the distinct keys, not the whole history, and one that is replayed replaces its table, so results
    are exactly-once. Tables two batches old are deleted.
    """

    def batch(rules: DataFrame, number: int) -> None:
        spark = rules.sparkSession
        new = survivors(rules)
        if number:
            new = gathered(spark.read.schema(new.schema).parquet(f"{store}/batch={number - 1}").unionByName(new))
        new.write.mode("overwrite").parquet(f"{store}/batch={number}")
        done(deduplicate(rules, spark.read.schema(new.schema).parquet(f"{store}/batch={number}")), number)
        if number > 1:
            delete(spark, f"{store}/batch={number - 2}")

    return classify_stream(lines).writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start()
