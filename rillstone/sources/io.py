"""Readers, sinks and shapes: tolerant CSV, nested JSON, listings, manifests."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.operators.joins import same_keys


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV with a header (a byte-order mark is skipped), all text, blanks instead of nulls, projected to `columns`."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).na.fill("")
    return conform_schema(df, columns) if columns else df


def write_csv(df: DataFrame, path: str) -> None:
    """The commit protocol makes the overwrite visible whole or not at all."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def conform_schema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns, as text; missing ones blank, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file with this text."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def guard_overwrite(spark: SparkSession, path: str, force: bool = False) -> str:
    """The path, unless something is there and may not be replaced."""
    if not force and exists(spark, path):
        raise FileExistsError(path)
    return path


def put(df: DataFrame, path: str) -> bool:
    """Write a table; a failure is an answer, not an error."""
    try:
        df.write.mode("overwrite").parquet(path)
    except Exception:  # noqa: BLE001  whatever went wrong, the caller goes on without this table
        return False
    return True


def cached(keys: DataFrame, key: str, path: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """build(keys), written at path, as long as the set of keys there is the one asked for; built anew otherwise."""
    spark = keys.sparkSession
    if not exists(spark, path) or not same_keys(spark.read.parquet(path), keys, key):
        build(keys).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_nested(df: DataFrame, path: str) -> None:
    """A JSON document per row, one a line; nulls are written, so that every document has every field."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_nested(spark: SparkSession, path: str, array: str, schema: T.StructType | None = None, lines: bool = False) -> DataFrame:
    """JSON documents with an array of structs, a row per element: a document a file, or (lines) one a line."""
    r = spark.read.option("multiLine", lines is False)
    return explode_nested((r.schema(schema) if schema else r).json(path), array)


def explode_nested(df: DataFrame, array: str) -> DataFrame:
    """A row per element, its fields beside the document's own columns; documents without elements give none."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.inline(array))


def nest_documents(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], array: str = "items") -> DataFrame:
    """A document per key: its rows as an array of structs in the given order, and how many there are."""
    item = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in fields if c not in order])
    one = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias(array))
    return one.withColumn("n_items", F.size(array).cast("bigint"))


def list_keys(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Paths and lengths below a prefix; contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or none of its rows where nothing is there."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def page_tasks(df: DataFrame, pages: Column, first: int = 3, skip_last: int = 2, most: int | None = None) -> DataFrame:
    """A row per page from `first` to the last but `skip_last`, `most` at most."""
    last = pages - skip_last
    if most is not None:
        last = F.least(last, F.lit(first + most - 1))
    return df.where(last >= first).withColumn("page_no", F.explode(F.sequence(F.lit(first).cast("bigint"), last.cast("bigint"))))


class PageReader:
    """What turns a page's bytes into text; engines implement it, and `Plain` is a deterministic stand-in."""

    def open(self) -> None:
        """Called once in every task, before its first page: the place to load what all pages need."""

    def text(self, content: bytes) -> str:
        raise NotImplementedError


class Plain(PageReader):
    def text(self, content: bytes) -> str:
        return content.decode("utf-8", "replace")


def read_pages(files: DataFrame, reader: PageReader) -> DataFrame:
    """path and content -> path, text and error; a file that fails is a row with its error, not a failed job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader.open()
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    out.append((path, reader.text(bytes(content)), None))
                except Exception as e:  # noqa: BLE001  isolation of single files is the point
                    out.append((path, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")


def expand_pages(pages: DataFrame, page: str, text: str) -> DataFrame:
    """Every page's lines as rows of kind 'line', and one row of kind 'page' with how many there were."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x) != "")
    item = lambda kind, no, body: F.struct(F.lit(kind).alias("kind"), no.cast("bigint").alias("no"), body.cast("string").alias("body"))
    rows = F.concat(F.transform(lines, lambda x, i: item("line", i + 1, x)), F.array(item("page", F.size(lines), F.lit(None))))
    return pages.select(page, F.inline(rows))
