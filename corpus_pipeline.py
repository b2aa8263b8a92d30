"""Corpus pipeline: language ID, near-duplicates, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Null texts, empty
tables and repeated rows follow the operators' own rules; columns other than those of documents are
dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.language import identify
from rillstone.llm.minhash import near_duplicates
from rillstone.llm.mixing import mix_documents
from rillstone.llm.packing import pack_documents
from rillstone.llm.queries import tokenizer
from rillstone.llm.shared import keep
from rillstone.llm.suffixes import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Two texts are near copies if their shingle sets' intersection is so many hundredths of the union or more.
NEAR_PERCENT = 80


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number each, written: read again after executors came or went, scans may be cut otherwise and number anew."""
    return keep(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; the others get the language they are written in, or keep theirs if none could be learned."""
    judged = identify(docs.select(*COLUMNS), carry=COLUMNS)
    told = F.when(F.col("lang_pred") == "und", F.col("lang")).otherwise(F.col("lang_pred")).alias("lang")
    given = [told if c == "lang" else F.col(c) for c in COLUMNS]
    return judged.where((F.col("lang_pred") != "und") | F.col("text").rlike(r"\p{L}")).select(*given)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (`NEAR_PERCENT` of five-word shingles) stays: the one with the smallest id.

    Rows are judged each, whatever their ids: several texts of one id are several documents, rows without an id come last
    in their group, and of equal rows one stays. Texts without words belong to no group.
    """
    rows = numbered(docs)
    found = near_duplicates(rows.select("_row", "text"), percent=NEAR_PERCENT, size=5, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    named = keep(found.join(rows.select("_row", "doc_id"), "_row"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_row"))).alias("first")
    stays = named.groupBy("component_id").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id", F.col("first._row").alias("stays"))
    stays = keep(stays, "stays")  # written, so that the rows of a large group can be split over tasks
    gone = named.join(stays, "component_id").where("_row <> stays").select("_row")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier in the corpus leave the texts; texts left empty, and null ones, go.

    Several texts of one id are several documents; rows without an id keep their texts.
    """
    cut = remove_repeats(docs.select(*COLUMNS), digests=False)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).where("length(btrim(text)) > 0").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it; each row is a document, whatever its id."""
    rows = numbered(docs)
    taken = mix_documents(rows, carry=("_row",)).where("copies > 0").select("_row", F.col("copies").alias("_copies"))
    out = rows.join(keep(taken, "copies"), "_row")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents and the sequences that they lie in."""
    return pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicate),
    ("suffix-array dedup", repeated_passages),
    ("source mix", source_mix),
    ("best-fit packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES in order, applied to documents; each result is a written table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
