"""Embedding columns as matrices."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(col: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold `dims` finite numbers, not all zero, and their matrix in double precision."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == dims)
    flat = pc.list_flatten(col.take(pa.array(rows)))
    flat = flat.cast(pa.float64())
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[ok], x[ok]


def lengths(df: DataFrame, col: str) -> list[tuple[int, int]]:
    """The lengths of usable vectors, in order, and how many each has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            v = batch.column(0)
            for dims in pc.unique(pc.list_value_length(v)).to_pylist():
                if dims:
                    seen[dims] += len(matrix(v, dims)[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["dims", "n"])

    per = df.select(col).mapInArrow(count, "dims int, n long").groupBy("dims").agg(F.sum("n").alias("n")).where("n > 0").orderBy("dims")
    return [(int(r[0]), int(r[1])) for r in per.collect()]  # one row a length


def sample(df: DataFrame, id_col: str, col: str, rows: int, dims: int, total: int, seed: int) -> np.ndarray:
    """About `rows` of the `total` usable vectors of length `dims`, 1.5 times that at most, drawn by their hashed ids: the same ones on every run.

    At least one comes back if there is one: where the draw takes none, the first few count.
    """

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = matrix(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array([r.tobytes() for r in x], pa.binary())], ["h", "x"])

    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 11) * F.lit(2.0**-53) < rows / max(total, 1)
    for chosen in (drawn, F.lit(True)):
        got = df.where((F.size(col) == dims) & chosen).select(F.xxhash64(id_col).alias("h"), F.col(col).alias("v")).mapInArrow(usable, "h long, x binary").limit(rows + rows // 2).toArrow()
        if got.num_rows:
            break
    got = got.sort_by([("h", "ascending"), ("x", "ascending")])
    return np.frombuffer(b"".join(got["x"].to_pylist()), np.float64).reshape(-1, dims).copy()
