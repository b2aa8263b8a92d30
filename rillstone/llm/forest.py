"""Embedding near-duplicates by a random-projection tree forest with spill overlap.

Every tree is grown on a bounded sample: a node splits at the median that its own vectors have in a random
direction, drawn from a pool of the tree; a vector close to a split goes to both sides, and a vector stops at a
node whose share of its label's vectors fits a leaf. Vectors of one label that share a leaf are compared, in
blocks if the leaf is large; a pair counts in the first leaf that it shares, so links are counted without listing
pairs. Each block passes on a spanning set of its links, and those unite the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, forget, keep, tasks_for
from .vectors import lengths, matrix, sample

#: A vector goes to both sides of a split within SPILL standard deviations, over all vectors, of the direction.
TREES, LEAF, SPILL, POOL, BLOCK = 6, 64, 0.16, 96, 512
#: Vectors that the trees are grown on: a quarter of all within these bounds; the least of them that a node splits;
#: the largest part of them that a split may leave on one side (a dense cluster, spilling whole, stays a leaf).
SAMPLE_ROWS, SPLITS, UNDIVIDED = (4096, 1 << 16), 12, 0.9
#: Rows of leaves that a task compares at a time.
LOT = 16_384


class Forest:
    """For each tree: its directions, and of each node the direction, the middle, the first child (0: a leaf) and its share of all vectors."""

    def __init__(self, x: np.ndarray, trees: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            pool = r.normal(size=(POOL, x.shape[1]))
            pool /= np.linalg.norm(pool, axis=1, keepdims=True)
            p = x @ pool.T
            near = SPILL * p.std(axis=0)
            way, middle, child, share = [], [], [], []
            todo = [np.arange(len(x))]
            made = 1
            while todo:
                rows = todo.pop(0)
                w = int(r.integers(POOL))
                m = float(np.median(p[rows, w]))
                v = p[rows, w] - m
                left, right = rows[v < near[w]], rows[v >= -near[w]]
                splits = len(rows) >= SPLITS and max(len(left), len(right)) <= UNDIVIDED * len(rows)
                way.append(w)
                middle.append(m)
                share.append(len(rows) / len(x))
                child.append(made if splits else 0)
                if splits:
                    todo += [left, right]
                    made += 2
            self.trees.append((pool, near, np.array(way), np.array(middle), np.array(child), np.array(share)))

    def leaves(self, x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of unit vectors in all trees, where n vectors of its label go with each; a leaf's number holds its tree."""
        rows, codes = [], []
        for t, (pool, near, way, middle, child, share) in enumerate(self.trees):
            p = x @ pool.T
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            while True:
                go = (child[node] > 0) & (share[node] * n[row] > LEAF)
                rows.append(row[~go])
                codes.append((np.int64(t) << 32) | node[~go])
                row, node = row[go], node[go]
                if not len(row):
                    break
                w = way[node]
                v = p[row, w] - middle[node]
                left, right = v < near[w], v >= -near[w]
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([child[node[left]], child[node[right]] + 1])
        return np.concatenate(rows), np.concatenate(codes)


def links_in(ids: np.ndarray, node: np.ndarray, x: np.ndarray, codes: list[bytes], w: np.ndarray, a: np.ndarray, b: np.ndarray, code: int, at_least: float) -> list[tuple[np.ndarray, ...]]:
    """id, node, links that no earlier shared leaf has, and root (smallest id connected here) of the rows a and b with links between them."""
    same = a is b
    linked = x[a] @ x[b].T >= at_least
    if same:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return []
    ra, rb = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    linked, a, b = linked[np.ix_(ra, rb)], a[ra], b[rb]
    own = {k: {c for c in np.frombuffer(codes[k], np.int64).tolist() if c < code} for k in {*a.tolist(), *b.tolist()}}
    earlier = {c: i for i, c in enumerate(sorted(set().union(*(own[k] for k in a.tolist()))))}

    def member(rows: np.ndarray) -> np.ndarray:
        m = np.zeros((len(rows), len(earlier)), np.float32)
        for i, k in enumerate(rows.tolist()):
            m[i, [earlier[c] for c in own[k] if c in earlier]] = 1
        return m

    new = linked & ~((member(a) @ member(b).T) > 0) if earlier else linked
    count_a, count_b = new @ w[b], w[a] @ new
    # smallest id over neighbours until nothing moves; edges to it span what is connected here
    la, lb = ids[a].copy(), ids[b].copy()
    top = np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], top).min(1))
        nb = np.minimum(lb, np.where(linked, na[:, None], top).min(0))
        if same:
            na = nb = np.minimum(na, nb)
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    out = [(ids[a], node[a], count_a, la)]
    return out if same else [*out, (ids[b], node[b], count_b, lb)]


def near_duplicate_vectors(vectors: DataFrame, at_least: float = 0.93, trees: int = TREES, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id reachable) and kept (id = component_id).

    Vectors of equal, non-null labels and of equal length are linked if their cosine in double precision is `at_least`;
    only found pairs count, none below it. Vectors that are null, zero or with null or non-finite parts link with
    nothing. Equal vectors of a label are compared as one and counted each, repeated rows included; ties need no
    rule. An empty table gives an empty result. Other columns are left out.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    known = v.where("vec_id is not null and label is not null and v is not null")
    nodes = counts = None
    for dims, rows in lengths(known, "v"):
        of_length = keep(known.where(F.size("v") == dims).groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w")), "vectors")
        found = _links(of_length, dims, rows, at_least, trees)
        nodes = of_length if nodes is None else nodes.unionByName(of_length)
        counts = found if counts is None else counts.unionByName(found)
    if nodes is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    parts = components(counts.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    # a node has one id, but an id may have several vectors: what they link with is one component, counts are each vector's own
    per = counts.groupBy("id", "node").agg(F.sum("n").alias("n"))
    about = nodes.select("id", F.xxhash64("label", "v").alias("node"), "w", F.col("label").alias("l"), F.col("v").alias("u")).join(per, ["id", "node"], "left").join(parts, "id", "left")
    out = v.join(about, (F.col("label") == F.col("l")) & (F.col("v") == F.col("u")), "left")
    # a vector that takes no part finds its node only if it is one of equal unusable ones
    part = F.col("vec_id").isNotNull() & F.col("id").isNotNull() & F.exists("v", lambda e: e != 0) & ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    root = F.when(part, F.coalesce("component_id", "id")).otherwise(F.col("vec_id"))
    n = F.when(part, F.coalesce("n", F.lit(0)) + F.col("w") - 1).otherwise(F.lit(0))
    return out.select("vec_id", n.cast("long").alias("n_links"), root.alias("component_id"), F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"))


def _links(nodes: DataFrame, dims: int, rows: int, at_least: float, trees: int) -> DataFrame:
    """id, node, n (links) and root (the smallest id of what a leaf's block connects it with) of all nodes with links, a row a block."""
    spark = nodes.sparkSession
    drawn = sample(nodes, "id", "v", min(max(rows // 4, SAMPLE_ROWS[0]), SAMPLE_ROWS[1]), dims, rows, seed=23)
    drawn /= np.linalg.norm(drawn, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(Forest(drawn, trees))  # as many nodes as the sample allows
    kind = "f4" if nodes.schema["v"].dataType.simpleString() == "array<float>" else "f8"
    per = keep(nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "labels")
    deep = nodes.join(per, "label").select("id", "v", "w", "n", F.xxhash64("label").alias("lab"), F.xxhash64("label", "v").alias("node"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                part = batch.slice(begin, 2048)
                rows, x = matrix(part.column(1), dims)
                if not len(rows):
                    continue
                raw = [r.tobytes() for r in x.astype(kind)]
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                row, code = forest.leaves(x, part.column(3).to_numpy()[rows])
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                at = np.searchsorted(row, np.arange(len(rows) + 1))
                own = [code[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                pick = pa.array(rows[row])
                yield pa.RecordBatch.from_arrays([part.column(4).take(pick), pa.array(code), part.column(0).take(pick), part.column(5).take(pick), part.column(2).take(pick), pa.array([raw[k] for k in row], pa.binary()), pa.array([own[k] for k in row], pa.binary())], ["lab", "code", "id", "node", "w", "x", "codes"])

    entries = keep(deep.mapInArrow(dealt, "lab long, code long, id long, node long, w long, x binary, codes binary"), "leaves")
    sizes = keep(entries.groupBy("lab", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lab", "code", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sizes")
    own_block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    blocked = entries.join(sizes, ["lab", "code"]).withColumn("own", own_block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.select("lab", "code", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "node", "w", "x", "codes")

    def compare(table: pa.Table) -> pa.Table:
        lab, code, p, q = (table[c].to_numpy() for c in ("lab", "code", "p", "q"))
        order = np.lexsort((q, p, code, lab))
        lab, code, p, q = lab[order], code[order], p[order], q[order]
        new = (np.diff(lab) != 0) | (np.diff(code) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0)
        cut = np.concatenate([[0], np.flatnonzero(new) + 1, [len(lab)]])
        ids, node, w, side = (table[c].to_numpy()[order] for c in ("id", "node", "w", "own"))
        x = np.frombuffer(b"".join(table["x"].to_pylist()), kind).reshape(len(ids), dims)[order].astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        codes = table["codes"].take(pa.array(order)).to_pylist()
        found = [(np.zeros(0, np.int64),) * 4]
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if j - i < 2:
                continue
            if p[i] == q[i]:
                a = b = np.arange(i, j)
            else:
                a, b = i + np.flatnonzero(side[i:j] == p[i]), i + np.flatnonzero(side[i:j] == q[i])
            found += links_in(ids, node, x, codes, w, a, b, int(code[i]), at_least)
        cols = [np.concatenate([f[k] for f in found]).astype(np.int64) for k in range(4)]
        return pa.table({"id": cols[0], "node": cols[1], "n": cols[2], "root": cols[3]})

    # a lot holds whole blocks, of 2 * BLOCK rows at most each, and about LOT rows in all
    lots = max(tasks_for(nodes), 3 * trees * rows // LOT)
    lot = F.pmod(F.xxhash64("lab", "code", "p", "q"), F.lit(lots)).cast("int").alias("lot")
    out = keep(blocked.select(lot, "*").groupBy("lot").applyInArrow(compare, "id long, node long, n long, root long"), "found")
    forget(entries)
    return out
