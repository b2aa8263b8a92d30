"""Connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.sources.working import forget, keep

#: Edges that a task contracts together; more are contracted in several lots.
LOT = 500_000


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (a, b), sorted, and the smallest node that each is connected with by these edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        p, q = root[x], root[y]
        if (p == q).all():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A lot's edges become one edge from each of its nodes to the smallest that the lot connects it with."""
    held, n = [], 0

    def lot() -> pa.RecordBatch:
        a, b = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in (0, 1))
        nodes, root = smallest(a, b)
        own = nodes != root
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(root[own])], ["u", "v"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= LOT:
            yield lot()
            n = 0
    yield lot()


def _star_forest(e: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most and no such neighbour has one itself."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60, hint: str | None = None, one_lot: bool = False) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component_id), component_id the smallest reachable id.

    Each task first contracts lots of its own edges to stars. Alternating large-star and small-star rounds then
    join what tasks know: a round's edges are a written table, and it only aggregates by partial sums of minima,
    so no node's neighbours are gathered anywhere. Rounds end when all edges are stars.
    `hint` names the strategy of the rounds' joins ("merge": minima are never broadcast), else the optimizer chooses.
    With `one_lot`, edges that are LOT at most after the tasks' contraction are contracted as one lot, which settles them
    without rounds: a round costs the driver four tables and some sixteen jobs, however few its edges.
    Nodes without edges do not appear. Null ends are dropped; an empty input gives an empty table.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u is not null and v is not null and u <> v")
    whole = all(f.dataType.simpleString() == "bigint" for f in e.schema.fields)  # other ids have no contraction, only rounds
    shorter = lambda d: d.mapInArrow(_contracted, "u long, v long") if whole else d.distinct()
    met = lambda d: d.hint(hint) if hint else d
    e = keep(shorter(e), "edges")
    if one_lot and whole and e.count() <= LOT:
        parts, e = e, keep(shorter(e.coalesce(1)), "edges")
        forget(parts)
    for _ in range(max_rounds):
        if _star_forest(e):
            break
        # large star: neighbours larger than u go to u's smallest neighbour (or u itself)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written tables: a join with one can split a hub's rows over tasks, which it couldn't
        # if the aggregate's own partitioning decided where they meet
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = keep(both.where("v > u").join(met(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        # small star: each node's smaller neighbours, and the node, go to the smallest of them
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(met(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        new = keep(shorter(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()), "edges")
        for done in (e, least, large, low):
            forget(done)
        e = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = e.groupBy("u").agg(F.min("v").alias("component_id")).select(F.col("u").alias("id"), "component_id")
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return star.unionByName(roots)
