"""Queries over incremental work."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.text import stem_number
from rillstone.operators import joins
from rillstone.sources import io
from rillstone.sources.working import keep, shared_dir
from rillstone.streaming.incremental import process_new, stuck, until_complete, upsert_new

from .registry import ORACLES, QUERIES


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken up as a stream, twice: the second run finds nothing new."""
    # as a pattern the path may be a file or a folder of files
    source, target, done = f"{sf_dir}/events[.]parquet", _folder(spark, "taken"), _folder(spark, "progress")
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        process_new(spark, source, schema, lambda s: s.where("value >= 50").select("event_id", "user_id", F.round("value", 2).alias("value")), target, done)
    return spark.read.parquet(target)


def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken up as a stream in micro-batches, each folded into a state that is rewritten; a second run finds nothing new."""
    source, progress = f"{sf_dir}/events[.]parquet", _folder(spark, "progress")
    schema = spark.read.parquet(source).schema
    versions = [_folder(spark, "state")]
    spark.createDataFrame([], "key long, done boolean, attempts long").write.parquet(versions[0])

    def apply(batch: DataFrame, _: int) -> None:
        news = batch.select(F.col("user_id").cast("long").alias("key"), (F.col("value") > 90).alias("done"), F.lit(1).cast("long").alias("attempts"))
        target = _folder(batch.sparkSession, "state")
        joins.manifest_upsert(batch.sparkSession.read.parquet(versions[-1]), news).write.parquet(target)
        versions.append(target)

    for _ in range(2):
        upsert_new(spark, source, schema, apply, progress)
    return spark.read.parquet(versions[-1])


def _rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds over events until one gains nothing: keys get done in the round that their number names, those ending in 7 never."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    held = [events.select(F.col("event_id").alias("key"), F.lit(False).alias("done"), F.lit(0).cast("bigint").alias("attempts"))]

    def attempt(r: int) -> None:
        news = held[-1].where("not done").select("key", ((F.col("key") % 3 == r) & (F.col("key") % 10 != 7)).alias("done"), F.lit(1).cast("bigint").alias("attempts"))
        held.append(keep(joins.manifest_upsert(held[-1], news, "key"), "state"))

    until_complete(lambda: held[-1].where("not done").count(), attempt)
    return held[-1]


def retry_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What rounds over events leave undone, with the attempts of each key."""
    return _rounds(spark, sf_dir)


def stuck_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys tried in every round and never done."""
    return stuck(_rounds(spark, sf_dir)).select("key", "attempts")


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files read by an engine that is opened once a task; what it can't read is a row with its error."""
    folder = _folder(spark, "pages")
    for i in range(6):
        io.write_text(spark, f"{folder}/page_{i}.txt", "broken" if i == 4 else f"text of page {i}")
    files = spark.read.format("binaryFile").load(folder)
    got = io.read_pages(files, _Careful())
    return got.select(stem_number(F.col("path")).alias("page"), "text", "error")


class _Careful(io.Plain):
    def open(self) -> None:
        self.opened = True

    def text(self, content: bytes) -> str:
        if content == b"broken" or not self.opened:
            raise ValueError("unreadable")
        return super().text(content)


for _f, _sql in (
    (incremental_stream, "select event_id, user_id, round(value, 2) as value from events where value >= 50"),
    (upsert_stream, "select user_id as key, bool_or(value > 90) as done, count(*) as attempts from events group by user_id"),
    (
        retry_rounds,
        # the fourth round is the first that gains nothing, and comes after the third at least
        "select event_id as key, event_id % 10 <> 7 as done, case when event_id % 10 = 7 then 4 else event_id % 3 + 1 end as attempts from events",
    ),
    (stuck_keys, "select event_id as key, 4 as attempts from events where event_id % 10 = 7"),
    (read_pages, "select i as page, case when i <> 4 then 'text of page ' || i end as text, case when i = 4 then 'unreadable' end as error from range(0, 6) r(i)"),
):
    QUERIES[_f.__name__], ORACLES[_f.__name__] = _f, _sql
