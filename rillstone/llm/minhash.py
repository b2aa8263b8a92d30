"""Near-duplicates by MinHash with odd sketches.

Each text becomes the set of its distinct word shingles. MinHash samples of the set give banded keys,
and the same samples are folded into a parity bitmap: the population count of two bitmaps' XOR tells
how many samples differ, so high similarities are estimated well from a few machine words. Texts with
equal sets are one node. In a band's bucket each node is compared with the bucket's hub, the node that
meets the most others over all bands, never with all others; pairs whose sketches allow the threshold
are confirmed on full sets; a few bands come first, and the rest where they left nodes apart. Nodes that stay apart from their hub's component get a further hub, and those
apart after that meet the bucket's other components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import U, mix, nested, sets, shingles, slices
from .shared import components, forget, keep, sweep

ROWS, MISS = 6, 1.2e-5  # independent samples of a band key; how often a pair right at the threshold may meet in no band
SAMPLES, BITS = 512, 1024  # bottom samples, a whole set if it has no more, folded into a sketch of BITS parities
#: Standard errors that a sampled estimate may lie off before a pair is left unconfirmed.
SIGMAS = 5.0
#: Bands whose buckets meet first.
FIRST_BANDS = 6


def bands_for(percent: int) -> int:
    """Bands in which a pair at the threshold fails to meet with probability MISS at most: 24 for 85, 38 for 80."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else 1


def odd_sketches(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Parities of the hashed bottom samples: sets are sorted by hash, so the first SAMPLES are the smallest."""
    n_docs = len(at) - 1
    out = np.zeros((n_docs, BITS // 64), U)
    count = np.minimum(np.diff(at), SAMPLES)
    for i in range(0, n_docs, 1024):
        c = count[i : i + 1024]
        doc = np.repeat(np.arange(len(c)), c)
        pick = np.repeat(at[i : i + len(c)] - np.cumsum(c) + c, c) + np.arange(c.sum())
        bit = (mix(h[pick] + U(77)) >> U(54)).astype(np.int64)
        parity = (np.bincount(doc * BITS + bit, minlength=len(c) * BITS) & 1).astype(np.uint8)
        out[i : i + len(c)] = np.packbits(parity).view(U).reshape(len(c), -1)
    return out


def signatures(buf: np.ndarray, offs: np.ndarray, size: int, bands: int) -> tuple[np.ndarray, ...]:
    """Set sizes, two 64-bit sums that identify the set, band keys and odd sketches of each document."""
    mul = (np.random.default_rng(11).integers(1, 1 << 62, bands * ROWS, dtype=np.int64).astype(U) << U(1)) | U(1)
    h, at = sets(*shingles(buf, offs, size))
    n_docs = len(offs) - 1
    n = np.diff(at)
    live = np.flatnonzero(n)
    begin = at[:-1][live]
    one, two = np.zeros(n_docs, U), np.zeros(n_docs, U)
    keys, odd = np.zeros((n_docs, bands), U), odd_sketches(h, at)
    if len(live):
        one[live] = np.add.reduceat(mix(h + U(1)), begin)
        two[live] = np.add.reduceat(mix(h ^ U(0xA5A5A5A5A5A5A5A5)), begin)
        low = np.empty((bands * ROWS, len(live)), U)
        for k, m in enumerate(mul):
            np.minimum.reduceat(h * m, begin, out=low[k])
        values = mix(low + (np.arange(bands * ROWS, dtype=U) * U(0x9E3779B97F4A7C15))[:, None])
        for b in range(bands):
            key = np.full(len(live), b + 1, U)
            for r in range(ROWS):
                key = mix(key * U(0xD6E8FEB86659FD93) + values[b * ROWS + r])
            keys[live, b] = key
    return n, one, two, keys, odd


def differing(a: Column, b: Column) -> Column:
    """Set bits of the XOR of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches of n_a, odd_a and n_b, odd_b allow the threshold.

    Two sets at the threshold share at least percent / (100 + percent) of their summed sizes. An XOR never
    counts more than the samples that are in one set only, so for whole sets the test is never wrong
    against a link; for sampled ones it leaves SIGMAS standard errors.
    """
    na, nb = F.col(f"n_{a}"), F.col(f"n_{b}")
    big = F.greatest(na, nb)
    common = (na + nb) * F.lit(percent / (100 + percent)) * F.least(F.lit(1.0), F.lit(float(SAMPLES)) / big)
    alone = F.least(na, F.lit(SAMPLES)) + F.least(nb, F.lit(SAMPLES)) - 2 * common
    most = F.when(big > SAMPLES, alone + SIGMAS * F.sqrt(F.greatest(alone, F.lit(1.0)))).otherwise(alone + 1e-6)
    return (F.least(na, nb) * 100 >= big * percent) & (differing(F.col(f"odd_{a}"), F.col(f"odd_{b}")) <= most)


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5, hub_rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and kept (id = component_id).

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets, confirmed on the
    full sets. Texts with fewer words than a shingle are one shingle; texts without words, nulls included,
    have no set and are linked with nothing. Repeated rows of an id are one node; null ids and empty tables
    give no links. Very long texts are shingled whole, a window at a time; a bucket's ties go to the smaller id. Other columns are left out.
    """

    bands = bands_for(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in slices(batch.column(1), 1 << 19):
                n, one, two, keys, odd = signatures(buf, offs, size, bands)
                wide = lambda v: nested(v.view(np.int64).ravel(), np.arange(len(v) + 1) * v.shape[1], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), wide(keys), wide(odd)], ["doc_id", "n", "s1", "s2", "keys", "odd"])

    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in slices(batch.column(1), 1 << 19):
                h, at = sets(*shingles(buf, offs, size))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), nested(h.view(np.int64), at, pa.int64())], ["id", "grams"])

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = keep(rows.mapInArrow(sign, "doc_id long, n long, s1 long, s2 long, keys array<long>, odd array<long>"), "signed")
    one_set = ["s1", "s2", "n"]
    nodes = keep(signed.where("n > 0 and doc_id is not null").groupBy(*one_set).agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("odd").alias("odd")), "nodes")

    # buckets of two nodes or more, and how many nodes a node meets over all bands
    entries = nodes.select("id", F.posexplode("keys").alias("band", "key"))
    shared = keep(entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1"), "shared")
    meetings = keep(entries.join(shared, "key"), "meetings")
    forget(shared)
    rank = meetings.groupBy("id").agg(F.sum("met").alias("rank"))
    facts = keep(rank.join(nodes.select("id", "n", "odd", "keys"), "id"), "facts")
    entries = keep(meetings.join(facts.select("id", "rank"), "id").select("key", "band", "id", "rank"), "entries")
    forget(meetings)
    wanted = rows.join(facts.select(F.col("id").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi")
    grams = keep(wanted.mapInArrow(collect_sets, "id long, grams array<long>").dropDuplicates(["id"]), "grams")
    sweep(spark)

    side = facts.select("id", "n", "odd")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Links among pairs (hub, other): sizes, then sketches, then the full sets."""
        of = lambda k: side.select(*(F.col(c).alias(f"{c}_{k}") for c in side.columns))
        alike = pairs.join(of("a"), F.col("hub") == F.col("id_a")).join(of("b"), F.col("other") == F.col("id_b"))
        alike = keep(alike.where(_may_link("a", "b", percent)).select("hub", "other"), "alike")
        both = alike.join(grams.select(F.col("id").alias("other"), F.col("grams").alias("g")), "other").join(grams.select(F.col("id").alias("hub"), F.col("grams").alias("h")), "hub")
        common = F.size(F.array_intersect("g", "h"))
        found = keep(both.where(common * 100 >= percent * (F.size("g") + F.size("h") - common)).select(F.col("hub").alias("a"), F.col("other").alias("b")), "links")
        forget(alike)
        return found

    def still_apart(entries: DataFrame, label: DataFrame) -> DataFrame:
        """Entries of the buckets that hold several components; loose: outside the bucket's largest one."""
        now = entries.drop("part", "loose").join(label.select("id", F.col("component_id").alias("part")), "id", "left").withColumn("part", F.coalesce("part", "id"))
        per = now.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"))
        mixed = per.groupBy("key").agg(F.max(F.struct("c", "part")).alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        mixed = keep(mixed.select("key", F.col("m.part").alias("main")), "mixed")
        out = keep(now.join(mixed, "key").withColumn("loose", F.col("part") != F.col("main")).drop("main"), "open")
        forget(mixed)
        return out

    # hubs first: each round is linear in the bucket; the first bands alone unite most copies, so the others' buckets
    # come only as far as several components are left in them
    tried = label = None
    left = entries.where(F.col("band") < FIRST_BANDS).withColumn("part", F.col("id")).withColumn("loose", F.lit(True))

    def united(found: DataFrame) -> DataFrame:
        """Components of all links so far: those known already stand for the links that made them."""
        known = [] if label is None else [label.where("id <> component_id").select(F.col("id").alias("a"), F.col("component_id").alias("b"))]
        return keep(components(reduce(DataFrame.unionByName, known, found)), "parts")

    for turn in range(hub_rounds):
        hub = left.where("loose").groupBy("key").agg(F.max(F.struct("rank", (-F.col("id")).alias("m"), "part")).alias("h"))
        hub = keep(hub.select("key", (-F.col("h.m")).alias("hub"), F.col("h.part").alias("hub_part")), "hubs")
        pairs = left.join(hub, "key").where("id <> hub and part <> hub_part").select("hub", F.col("id").alias("other"))
        pairs = keep((pairs.distinct() if tried is None else pairs.distinct().join(tried, ["hub", "other"], "left_anti")), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        tried = tried.unionByName(pairs.select(F.col("other").alias("hub"), F.col("hub").alias("other")))
        label = united(confirm(pairs))
        left = still_apart(left if turn else entries, label)
    # then what hubs left apart, each loose node against the bucket's other components: few by now
    side = facts.select("id", "n", "odd", "keys")
    x = left.where("loose").join(side, "id").select("key", *(F.col(c).alias(f"{c}_x") for c in (*side.columns, "part", "loose")))
    y = left.join(side, "id").select(F.col("key").alias("key_y"), *(F.col(c).alias(f"{c}_y") for c in (*side.columns, "part", "loose")))
    first = F.element_at(F.array_intersect("keys_x", "keys_y"), 1) == F.col("key")  # a pair counts in one of its buckets
    rest = x.join(y, (F.col("key") == F.col("key_y")) & (F.col("part_x") != F.col("part_y")) & (~F.col("loose_y") | (F.col("id_x") < F.col("id_y"))) & _may_link("x", "y", percent) & first)
    rest = keep(rest.select(F.col("id_x").alias("hub"), F.col("id_y").alias("other")).distinct().join(tried, ["hub", "other"], "left_anti"), "rest")
    found = confirm(rest)
    if found.limit(1).count():
        label = united(found)
    # only signatures, nodes and components are read from here on
    for done in (grams, entries, facts, rest, found, left):
        forget(done)
    member = signed.select("doc_id", "n", "s1", "s2").join(nodes.select(F.col("id").alias("node"), *(F.col(c).alias(f"{c}_") for c in one_set)), (F.col("s1") == F.col("s1_")) & (F.col("s2") == F.col("s2_")) & (F.col("n") == F.col("n_")), "left")
    out = member.join(label.select(F.col("id").alias("node"), "component_id"), "node", "left")
    root = F.coalesce("component_id", "node", "doc_id")
    sweep(spark)
    return out.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"), F.coalesce(F.col("doc_id") == root, F.lit(True)).alias("kept"))
