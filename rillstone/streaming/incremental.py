"""Incremental work: micro-batches that pick up only what is new, rounds until complete, retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def process_new(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Everything below `source` that earlier runs have not seen, transformed and appended to `target`.

    A second run without new files adds nothing; an interrupted run resumes at its last commit.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    q = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def upsert_new(spark: SparkSession, source: str, schema: T.StructType, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """The same with a function of (batch, id) per micro-batch, for state that is rewritten."""
    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def until_complete(pending: Callable[[], int], attempt: Callable[[int], None], rounds: int = 8, least: int = 3) -> list[int]:
    """Attempts until nothing is pending, or until a round after the first `least` gains nothing; what was pending before each."""
    left = [pending()]
    for r in range(rounds):
        if not left[-1]:
            break
        attempt(r)
        left.append(pending())
        if r + 1 >= least and left[-1] >= left[-2]:
            break
    return left


def stuck(state: DataFrame, attempts: int = 3) -> DataFrame:
    """Keys tried often and never done, the least tried first."""
    return state.where(f"not done and attempts >= {attempts}").orderBy("attempts", state.columns[0])
