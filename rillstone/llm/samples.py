"""Bounded labelled samples for the classifiers that are fitted on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of text that a fit reads at most (one text may be longer).
MOST_BYTES = 48 << 20


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def within(found: DataFrame, rows: int, most_bytes: int = MOST_BYTES) -> list[tuple]:
    """Rows (h, label, text) of `found` in the order of h: as many as `most_bytes` of text and `rows` allow.

    Lengths come first, so no more text than that ever reaches the driver.
    """
    sizes = sorted(tuple(r) for r in found.select("h", F.octet_length("text")).limit(rows).collect())
    total, cut = 0, None
    for h, size in sizes:
        total += size
        if cut is not None and total > most_bytes:
            break
        cut = h
    if cut is None:
        return []
    return sorted(tuple(r) for r in found.where(F.col("h") <= cut).select("h", "label", "text").limit(rows).collect())


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """At most `rows` texts of each class (0 and 1) and MOST_BYTES in all, those with the smallest hashed ids, in that order.

    `labels` (id, label) has been cut to the rows one may learn from. The ids are chosen first, so the
    join's small side has 2 * rows rows at most. Rows with null labels or texts don't count; an id with
    several labels takes the largest.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    picked = None
    for value in (0, 1):
        part = one.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text is not null")
    found = given.join(F.broadcast(picked), "_id").select(F.xxhash64("_id").alias("h"), F.col("_label").alias("label"), "text")
    got = within(found, 3 * rows)
    return [r[2] for r in got], np.array([r[1] for r in got], np.float64)
