"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets come from a water-filling share of all words; a source's whole epochs come first, then the
documents with the smallest exponential keys (scaled by their quality weights) until the rest of the
budget is used. Keys are cut into ranges whose word sums are prefix-summed, so only the documents of
the one range that the budget ends in are ranked row by row, however large their source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.joins import small

from .shared import keep

#: Documents that a key range holds on average.
RANGE_ROWS = 500
#: Ranges of a block.
BLOCK_RANGES = 1000
WORD = r"[^\x20\x09-\x0D]+"


def target_words(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: float = 3.0) -> DataFrame:
    """sizes (source, source_size[, ...]), one row a source -> the same with target.

    Sources by code point, nulls last, take the weights in turn and share the sum of all sizes; a
    target stops at `limit` times its source's size and the excess goes to the others by weight:
    the level x with sum(min(limit * size, x * weight)) = total, found from sorted ratios. Code
    points order as UTF-8 bytes do, which is how strings compare here.
    """
    one = Window.partitionBy(F.lit(0))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    w = sizes.withColumn("weight", F.element_at(turn, (F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1))
    w = w.withColumn("roof", F.col("source_size") * F.lit(float(limit))).withColumn("total", F.sum("source_size").over(one).cast("double"))
    order = one.orderBy(F.col("roof") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    w = w.withColumn("capped", F.coalesce(F.sum("roof").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(after))
    w = w.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    # the level is that of the first source, in this order, which stays below its roof
    w = w.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("roof"), F.struct(F.col("roof") / F.col("weight"), F.col("level")))).over(one)["level"])
    return w.withColumn("target", F.least(F.col("roof"), F.coalesce(F.col("level") * F.col("weight"), F.col("roof")))).drop("weight", "roof", "total", "capped", "open", "level")


def word_length_weight(chars: Column, words: Column) -> Column:
    """The weight of documents without a given one, from 0 to 1: how near the mean word length is to ordinary prose's."""
    return 1.0 / (1.0 + F.abs(chars / F.greatest(words, F.lit(1)) - 6.0) / 6.0)


def mix_documents(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: float = 3.0, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality_col: str | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Words that a mix takes of each document: doc_id, source, size, source_size, target, copies, taken and the carried columns.

    size counts runs of anything but ASCII white space (null: 0). A document's key is -ln(u) / q, u
    from a hash of its id and the seed, q its quality weight: `quality_col`, above 0 (null, not finite or 0 and less: a
    millionth), or without one `word_length_weight`; so reruns agree. Documents without words take nothing; rows with
    one key, as repeated ones have, are dealt one by one in order of id and size; a null id has the key of all null ids;
    a null source is a source of its own; very long texts are counted whole; empty tables give empty results.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = F.lit(None).cast("double") if quality_col is None else F.col(quality_col).cast("double")
    # what is carried travels under numbers, so no name can clash
    taken_along = [f"_{i}" for i in range(len(carry))]
    d = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.char_length(text).alias("chars"), given.alias("given"), *[F.col(c).alias(n) for c, n in zip(carry, taken_along, strict=True)]
    )
    if quality_col is None:
        quality = word_length_weight(F.col("chars"), F.col("size"))
    else:
        quality = F.when((F.col("given") > 0) & (F.col("given") < float("inf")) & ~F.isnan("given"), F.greatest(F.col("given"), F.lit(1e-6))).otherwise(F.lit(1e-6))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) + 0.5) * F.lit(2.0**-53)
    d = d.select("doc_id", "source", "size", (-F.log(u) / quality).alias("key"), quality.alias("quality"), *taken_along)
    d = keep(d, "mix")  # small rows; the texts are read once
    per = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"), F.avg("quality").alias("scale"))
    plan = target_words(per, weights, limit)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("ranges", F.ceil(F.col("rows") / RANGE_ROWS))
    # one row a source: broadcast if their number is checked to be small, else joined as the optimizer sees fit
    p = keep(plan.select(F.col("source").alias("s"), "source_size", "target", "epochs", "rest", "ranges", "scale"), "targets")
    d = d.join(small(p), F.col("source").eqNullSafe(F.col("s")), "inner").drop("s", "quality")
    # for documents of the source's mean weight this is uniform, so ranges hold nearly as many rows each
    d = d.withColumn("range", F.least(F.floor((1 - F.exp(-F.col("key") * F.col("scale"))) * F.col("ranges")), F.col("ranges") - 1).cast("long"))
    sums = d.groupBy("source", "range", "rest").agg(F.sum("size").alias("words"))
    sums = keep(sums.withColumn("block", F.floor(F.col("range") / BLOCK_RANGES)), "ranges")
    # prefix sums in two levels: over blocks of ranges, then over the ranges of the one block that the budget ends in
    blocks = _prefixed(sums.groupBy("source", "block", "rest").agg(F.sum("words").alias("words")), F.lit(0), "block", "source")
    blocks = keep(blocks, "blocks")
    inside = small(blocks.where("begin < rest and end > rest").select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("begin").alias("base")))
    cut = sums.join(inside, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    cut = keep(_prefixed(cut, F.col("base"), "range", "source"), "cut")
    edge = cut.where("begin < rest and end > rest").select(F.col("source").alias("s"), F.col("range").alias("edge"), "begin")
    full = blocks.where("end <= rest").select("source", ((F.col("block") + 1) * BLOCK_RANGES - 1).alias("range"))
    whole = cut.where("end <= rest").select("source", "range").unionByName(full).groupBy(F.col("source").alias("s2")).agg(F.max("range").alias("whole"))
    d = d.join(small(edge), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").join(small(whole), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
    last = F.col("range") == F.col("edge")
    inside = d.where(last).withColumn("sum", F.col("begin") + F.sum("size").over(Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)))
    # the document that the budget ends in comes along if most of it lies inside
    inside = inside.withColumn("more", (F.col("sum") - F.col("size") / 2.0 <= F.col("rest")).cast("long")).drop("sum")
    rest = d.where(~F.coalesce(last, F.lit(False))).withColumn("more", F.coalesce(F.col("range") <= F.col("whole"), F.lit(False)).cast("long"))
    out = inside.unionByName(rest).withColumn("copies", F.least(F.col("epochs") + F.col("more"), F.lit(int(limit))))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *[F.col(n).alias(c) for c, n in zip(carry, taken_along, strict=True)])


def _prefixed(sums: DataFrame, base: Column, order: str, part: str) -> DataFrame:
    """With the sum of words before each row, from `base` on, and after it."""
    end = base + F.sum("words").over(Window.partitionBy(part).orderBy(order))
    return sums.withColumn("end", end).withColumn("begin", F.col("end") - F.col("words"))
