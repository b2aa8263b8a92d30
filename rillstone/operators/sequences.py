"""Ordered operators that windows can express; every one takes its order key."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.sources.working import keep


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Rows numbered from 1 within their keys (none: over the whole table), however frequent a key is.

    The table is written once in range partitions of keys and order, so a frequent key spreads over many of
    them; a row's number is its rank there plus the rows of its key in the partitions before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = keep(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    inside = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order)))
    counts = ranged.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return inside.join(before, same).withColumn(name, (F.col("_before") + F.col("_r")).cast("bigint")).select(*df.columns, name)


def ordinal(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    return ranked(df, [], order, name)


def batching(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    return ordinal(df, order, "_at").withColumn(name, F.floor((F.col("_at") - 1) / size)).drop("_at")


def adaptive_chunk(total: int, workers: int, most: int = 8) -> int:
    return max(1, min(most, -(-total // (workers * 3))))


def running_suffix(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """The key with how many of it came before, nothing for the first."""
    n = F.col("_nth") - 1
    d = ranked(df, [key], [order], "_nth")
    return d.withColumn(name, F.when(n == 0, F.col(key)).otherwise(F.concat(F.col(key), F.lit(" "), n.cast("string")))).drop("_nth")


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key; an aggregate, so a frequent key is combined before it is shuffled."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), order).alias("_row")).select(*keys, "_row.*")


def collision_suffix(df: DataFrame, name: str, stem: str, order: str, out: str) -> DataFrame:
    """The first claimant keeps a name, later ones get their stem behind it; firsts are an aggregate, not a sort per name."""
    first = df.groupBy(F.col(name).alias("_name")).agg(F.min(order).alias("_first"))
    d = df.join(first, F.col(name).eqNullSafe(F.col("_name")))
    return d.withColumn(out, F.when(F.col(order) > F.col("_first"), F.concat(F.col(name), F.lit("__"), F.col(stem).cast("string"))).otherwise(F.col(name))).drop("_name", "_first")


def grid_order(df: DataFrame, page: str, y: Column, x: str, ident: str, name: str = "place") -> DataFrame:
    """Reading order on a page: rows by a coarse y, then x."""
    return ranked(df.withColumn("_y", y), [page], ["_y", x, ident], name).drop("_y")


def islands(df: DataFrame, part: str, order: str, value: str, name: str = "run") -> DataFrame:
    """Runs of one value in order; a null joins the run before it."""
    w = Window.partitionBy(part).orderBy(order)
    before = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(value) != before), F.lit(False)).cast("int")
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("_new")


def gap_islands(df: DataFrame, keys: Sequence[str], at: str, gap: int, name: str = "run") -> DataFrame:
    """Rows of one key belong together while not more than `gap` ordinals lie between neighbours; a negative gap parts all."""
    w = Window.partitionBy(*keys).orderBy(at)
    far = F.coalesce(F.col(at) - F.lag(at).over(w) - 1 > gap, F.lit(True)).cast("int")
    return df.withColumn("_far", far).withColumn(name, F.sum("_far").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_far")


def first_seen_mode(df: DataFrame, keys: Sequence[str], value: str, order: str, name: str = "mode") -> DataFrame:
    """The most frequent value of each group, ties to the one seen first."""
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    return per.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(name), F.max("_n").alias("mode_count"), F.sum("_n").alias("rows"))


def sequence_fit(df: DataFrame, page: str, order: str, read: str, least: int = 3) -> DataFrame:
    """Numbers of a page from their first-seen modal offset to the row's place; fewer than `least` reads change nothing."""
    w = Window.partitionBy(page).orderBy(order)
    d = df.withColumn("_i", F.row_number().over(w) - 1)
    ok = d.where(F.col(read) > 0).withColumn("_off", F.col(read) - F.col("_i"))
    base = first_seen_mode(ok, [page], "_off", "_i", "_base").where(F.col("rows") >= least).select(page, "_base")
    d = d.join(base, page, "left")
    fit = F.when(F.col("_base").isNull(), F.col(read)).otherwise(F.col("_base") + F.col("_i"))
    flag = F.when(F.col("_base").isNull(), F.when(F.col(read).isNull(), "unfitted")).when(F.col(read).isNotNull() & (F.col(read) != fit), "mismatch")
    return d.withColumn("fitted", fit).withColumn("flag", F.coalesce(flag, F.lit(""))).drop("_i", "_base")


#: Fixed value: the form of a code that was read whole.
CODE_FORM = r"^[A-Z]{2,4}[0-9]{6,9}$"


def vote_repair(df: DataFrame, page: str, code: str, order: str, head: int = 3, least: int = 3, most: int = 2, form: str = CODE_FORM) -> DataFrame:
    """Codes repaired by their page: glyphs by zone, then rare heads to the unique nearest frequent one."""
    from rillstone.functions.text import positional_repair

    d = df.withColumn("_raw", F.coalesce(code, F.lit(""))).withColumn("_c", positional_repair(F.col("_raw"), head))
    good = d.where(F.col("_c").rlike(form)).select(page, order, F.left("_c", F.lit(head)).alias("_h"), (F.char_length("_c") - head).alias("_len"))
    common = good.groupBy(page, "_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).groupBy(page).agg(F.array_sort(F.collect_set("_h")).alias("_common"))
    modal = first_seen_mode(good, [page], "_len", order, "_modal").select(page, "_modal")
    d = d.join(common, page, "left").join(modal, page, "left").withColumn("_modal", F.coalesce("_modal", F.lit(0)))
    split = F.col("_c").rlike("^[A-Z]+[0-9]+$")
    cut = F.greatest(F.char_length("_c") - F.col("_modal"), F.lit(0))
    d = d.withColumn("_head", F.when(split, F.regexp_extract("_c", "^([A-Z]+)", 1)).otherwise(F.substring("_c", F.lit(1), cut)))
    d = d.withColumn("_tail", F.substr("_c", F.char_length("_head") + 1))
    near = F.array_sort(F.transform("_common", lambda h: F.struct(F.levenshtein(F.col("_head"), h).alias("d"), h.alias("h"))))
    one, two = F.get(near, F.lit(0)), F.get(near, F.lit(1))
    fix = F.coalesce((F.size("_common") > 0) & F.col("_tail").rlike("^[0-9]+$") & ~F.array_contains("_common", F.col("_head")) & (one["d"] <= most) & (two.isNull() | (two["d"] > one["d"])), F.lit(False)) & (F.col("_c") != "")
    modal_bad = lambda n: (F.col("_modal") > 0) & (n != F.col("_modal"))
    flags = F.array_compact(
        F.array(
            F.when((F.col("_c") != F.col("_raw")), "glyph_fixed"),
            F.when(F.col("_c") == "", "missing"),
            F.when(fix, "prefix_fixed"),
            F.when((F.col("_c") != "") & ~fix & ~F.col("_c").rlike(form), "bad"),
            F.when(F.when(fix, modal_bad(F.char_length("_tail"))).otherwise(F.col("_c").rlike(form) & modal_bad(F.char_length("_c") - head)), "length"),
        )
    )
    fixed = F.when(fix, F.concat(one["h"], F.col("_tail"))).otherwise(F.col("_c"))
    return d.withColumn("repaired", fixed).withColumn("flags", F.array_join(flags, ";")).drop("_raw", "_c", "_common", "_modal", "_head", "_tail")


def capacity_chunks(df: DataFrame, part: str, order: str, size: str, cap: float, label: str | None = None, name: str = "chunk") -> DataFrame:
    """Parts of at most `cap` stay whole; larger ones are cut where the label changes (a blank joins what is before it), and
    a piece that is still larger is filled in order into chunks of at most `cap`; a row above it is a chunk of its own.

    Sums and cuts are aggregates and windows; only a piece above `cap` is filled row by row, in one task.
    """
    blank = F.when(F.col(label).cast("string") != "", F.col(label)) if label else F.lit(None).cast("string")
    d = islands(df.withColumn("_label", blank), part, order, "_label", "_piece").drop("_label")
    of_part = d.groupBy(F.col(part).alias("_p")).agg(F.sum(size).alias("_whole"))
    of_piece = d.groupBy(F.col(part).alias("_q"), F.col("_piece").alias("_r")).agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    d = d.join(of_part, F.col(part).eqNullSafe(F.col("_p"))).join(of_piece, F.col(part).eqNullSafe(F.col("_q")) & (F.col("_piece") == F.col("_r"))).drop("_p", "_q", "_r")
    d = keep(d.withColumn("_piece", F.when(F.col("_whole") <= cap, F.lit(0).cast("long")).otherwise(F.col("_piece"))), "pieces")
    large = (F.col("_whole") > cap) & (F.col("_sum") > cap) & (F.col("_n") > 1)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of a bucket of whole pieces, each filled in order."""
        pdf = pdf.sort_values(["_key", order], kind="stable")
        fills, n, used, of = [], 0, 0.0, None
        for key, s in zip(pdf["_key"].tolist(), pdf[size].tolist(), strict=True):
            if key != of:
                n, used, of = 1, 0.0, key
            elif used + s > cap:
                n, used = n + 1, 0.0
            used += s
            fills.append(n)
        return pdf.assign(_fill=fills).drop(columns=["_key", "_bucket"])

    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    key = F.concat_ws("/", F.col(part).cast("string"), F.col("_piece").cast("string"))
    pieces = d.where(large).withColumn("_key", key).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    filled = pieces.groupBy("_bucket").applyInPandas(fill, f"{fields}, _fill int")
    both = filled.unionByName(d.where(~large).withColumn("_fill", F.lit(1)))
    heads = both.groupBy(part, "_piece", "_fill").agg(F.count(F.lit(1)).alias("_rows"))
    nth = heads.select(F.col(part).alias("_p"), F.col("_piece").alias("_q"), F.col("_fill").alias("_r"), F.row_number().over(Window.partitionBy(part).orderBy("_piece", "_fill")).alias(name))
    return both.join(nth, F.col(part).eqNullSafe(F.col("_p")) & (F.col("_piece") == F.col("_q")) & (F.col("_fill") == F.col("_r"))).select(*df.columns, name)
