"""Sharding by a minimax contiguous partition of ordered atomic groups. DataFrame and SQL functions only.

Documents of equal text form a group that no cut may part. The leading bits of a 64-bit hash of the text
name one of `UNITS` atomic units, so the array of unit sizes has a fixed length whatever the corpus
holds; the units stand in an order that leaves small ones near the cuts. A binary search over the shard capacity, each step a greedy fill of
the ordered units, finds the smallest capacity that needs no more than the wanted number of shards;
the cuts keep to that capacity, and as near to equal shares as it allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep

#: Atomic units; with u of them a cut misses the ideal by one unit, about total / u, at most.
UNITS = 1 << 14
#: Rows ranked together when slots are numbered.
SLOT_BLOCK = 128


def _fill(sizes: Column, capacity: Column) -> Column:
    """Shards that a greedy fill needs (an item above the capacity counts as a failure by the caller's lower bound)."""
    start = F.struct(F.lit(1).alias("n"), F.lit(0).cast("long").alias("used"))
    step = lambda a, x: F.when(a["used"] + x <= capacity, F.struct(a["n"].alias("n"), (a["used"] + x).alias("used"))).otherwise(
        F.struct((a["n"] + 1).alias("n"), x.alias("used"))
    )
    return F.aggregate(sizes, start, step, lambda a: a["n"])


def _plan(units: DataFrame, shards: int) -> DataFrame:
    """units (unit, bytes) -> (unit, shard) by the smallest feasible capacity.

    Units are ordered by falling size, dealt out to as many turns as there are shards, turn after turn: large
    ones open a turn and the smallest close it, so that cuts, which lie near the turns' ends, find small steps.
    Units above an equal share of what larger ones leave stand before all turns, each to be a shard of its own.
    """
    falling = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), F.col("unit").alias("unit"))))
    row = units.agg(falling.alias("f"), F.sum("bytes").alias("total"), F.max("bytes").alias("top"))

    def alone(a: Column, x: Column) -> Column:
        more = (a["n"] == x["i"]) & (x["bytes"] * (F.lit(shards) - a["n"]) > a["left"])
        return F.struct((a["n"] + more.cast("int")).alias("n"), F.when(more, a["left"] - x["bytes"]).otherwise(a["left"]).alias("left"))

    largest = F.transform(F.slice("f", 1, shards), lambda x, i: F.struct(i.alias("i"), (-x["less"]).alias("bytes")))
    row = row.withColumn("own", F.aggregate(largest, F.struct(F.lit(0).alias("n"), F.col("total").alias("left")), alone, lambda a: a["n"]))
    turn = lambda i: F.when(i < F.col("own"), i - F.col("own")).otherwise((i - F.col("own")) % (F.lit(shards) - F.col("own")))
    turns = F.array_sort(F.transform("f", lambda x, i: F.struct(turn(i).alias("turn"), i.alias("at"), x["unit"].alias("id"), (-x["less"]).alias("bytes"))))
    row = row.select(F.transform(turns, lambda x, i: F.struct(i.alias("unit"), x["bytes"].alias("bytes"), x["id"].alias("id"))).alias("u"), "total", "top")
    row = row.where("total is not null").select("u", F.transform("u", lambda x: x["bytes"]).alias("s"), "total", "top")
    low = F.greatest(F.col("top"), F.ceil(F.col("total") / shards).cast("long"))
    row = row.withColumn("lo", low).withColumn("hi", F.greatest(F.col("total"), low))
    # a minimax capacity never exceeds ideal + largest unit, so the search starts from that bracket
    row = row.withColumn("hi", F.least(F.col("hi"), F.ceil(F.col("total") / shards).cast("long") + F.col("top")))

    def halve(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("long")
        ok = _fill(F.col("s"), mid) <= shards
        return F.when(a["lo"] >= a["hi"], a).otherwise(F.struct(F.when(ok, a["lo"]).otherwise(mid + 1).alias("lo"), F.when(ok, mid).otherwise(a["hi"]).alias("hi")))

    row = row.withColumn("cap", F.aggregate(F.sequence(F.lit(1), F.lit(48)), F.struct("lo", "hi"), halve, lambda a: a["hi"]))
    # what the lambdas need rides in their accumulators: a column named there would be computed anew for each unit
    none = F.array().cast("array<int>")

    def from_the_end(a: Column, x: Column) -> Column:
        fits = a["used"] + x["bytes"] <= a["cap"]
        return F.when(fits, F.struct(a["cap"].alias("cap"), (a["used"] + x["bytes"]).alias("used"), x["unit"].cast("int").alias("at"), a["starts"].alias("starts"))).otherwise(
            F.struct(a["cap"].alias("cap"), x["bytes"].alias("used"), x["unit"].cast("int").alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts"))
        )

    # the first unit from which 1, 2, ... shards of that capacity hold all the rest
    start = F.struct(F.col("cap").alias("cap"), F.lit(0).cast("long").alias("used"), F.lit(0).alias("at"), none.alias("starts"))
    row = row.withColumn("starts", F.aggregate(F.reverse("u"), start, from_the_end, lambda a: F.concat(a["starts"], F.array(a["at"]))))
    begin = F.struct(F.col("cap").alias("cap"), F.col("total").alias("total"), (F.col("total") / shards).alias("aim"), F.col("starts").alias("starts"), F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("all"), none.alias("at"))

    # cut where the capacity forces it, or at the unit nearest to an equal share of what the shards before left, if the
    # rest still fits behind it; a unit above the share so takes from the shards behind it alike
    def cut(a: Column, x: Column) -> Column:
        n = F.size(a["at"]) + 1
        rest_fits = (F.lit(shards) - n >= F.size(a["starts"])) | (x["unit"] >= F.coalesce(F.get(a["starts"], F.lit(shards) - n - 1), F.lit(UNITS)))
        even = (n < shards) & (a["used"] > 0) & (a["all"] + x["bytes"] / 2 > a["aim"]) & rest_fits
        new = (a["used"] + x["bytes"] > a["cap"]) | even
        aim = F.when(new, a["all"] + (a["total"] - a["all"]) / F.greatest(F.lit(shards) - n, F.lit(1))).otherwise(a["aim"])
        same = (a["cap"].alias("cap"), a["total"].alias("total"), aim.alias("aim"), a["starts"].alias("starts"))
        return F.when(new, F.struct(*same, x["bytes"].alias("used"), (a["all"] + x["bytes"]).alias("all"), F.concat(a["at"], F.array(x["unit"].cast("int"))).alias("at"))).otherwise(
            F.struct(*same, (a["used"] + x["bytes"]).alias("used"), (a["all"] + x["bytes"]).alias("all"), a["at"].alias("at"))
        )

    cuts = row.select("u", F.aggregate("u", begin, cut, lambda a: a["at"]).alias("at"))
    return cuts.select(F.explode("u").alias("x"), "at").select(
        F.col("x.id").alias("unit"), F.size(F.filter("at", lambda c: c <= F.col("x.unit"))).alias("shard")
    )


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into `shards` contiguous shards of nearly equal bytes; equal texts stay together.

    Returns doc_id, size (UTF-8 bytes of the text plus `overhead`), text_crc32, law ('bytes'), shard,
    slot (gapless from 0 within a shard) and grown_shard (null: only a keyed law has one). A null text
    has no bytes and goes with the empty ones; a very long text is a unit's size like any other, and may
    be a shard of its own; repeated rows are rows of their own, rows that tie in id and size stand in any order; null ids are
    ordinary values; an empty table gives an empty result. Other columns are left out. With fewer
    units than shards the last shards stay empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - UNITS.bit_length() + 1).cast("int").alias("unit"),
    )
    base = keep(base, "rows")  # narrow rows; the texts are read once
    units = keep(base.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "units")
    plan = keep(units.join(F.broadcast(_plan(units.select("unit", "bytes"), shards)), "unit"), "shards")  # UNITS rows at most
    # slots: blocks of rows within a unit, so that a unit with a third of all rows is ranked in many tasks
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("rows") / SLOT_BLOCK)).cast("long"))
    placed = base.join(F.broadcast(plan.select("unit", "shard", "blocks")), "unit").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    in_block = Window.partitionBy("unit", "block").orderBy("doc_id", "size")
    ranked = placed.withColumn("at", F.row_number().over(in_block) - 1)
    # first slot of each block: per unit by its blocks, per shard by its units
    counts = placed.groupBy("shard", "unit", "block").agg(F.count(F.lit(1)).alias("n"))
    of_block = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("unit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of_unit = plan.select("shard", "unit", F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return (
        ranked.join(of_block.select("unit", "block", "before"), ["unit", "block"])
        .join(F.broadcast(of_unit.select("unit", "first")), "unit")
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("before") + F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
