"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector goes down it to a leaf. A query takes leaves from a
priority queue of nodes, best bound first, and visits as many as calibration asks for: visits widen until
held-out queries find their share of the true neighbours in a second bounded sample; a query goes on beyond
that while the leaves it took hold too few vectors for its k. Neighbouring leaves form groups, a task each: a
query goes once to a group that holds leaves of its own, and the group passes on its k best from them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, tasks_for
from .vectors import lengths, matrix, sample

#: Vectors that the tree is fitted on: an eighth of all within these bounds. Vectors and held-out queries that calibrate.
SAMPLE_ROWS, TRIAL_ROWS, TRIALS = (4096, 1 << 16), 1 << 15, 256
#: Children of a node; sample vectors of a leaf; parts of the radius that a bound may add to the centre's product.
BRANCH, LEAF, SLACKS = 8, 64, (0.0, 0.1, 0.25, 0.5, 1.0)
#: Vectors of a group; a larger leaf is several chunks. Queries that one task compares; a group asked by more is sent again.
GROUP, CHUNK = (2048, 16_384), 16_384


class Tree:
    """children[i]: nodes of node i (none: a leaf); centre and radius of each node; number of each leaf."""

    def __init__(self, x: np.ndarray, seed: int = 9):
        self.children, self.centre, self.radius, self.leaf = [], [], [], []
        r = np.random.default_rng(seed)
        self.leaves = 0
        self._grow(x, r)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _grow(self, x: np.ndarray, r: np.random.Generator) -> int:
        me = len(self.children)
        c = x.mean(0)
        self.children.append([])
        self.centre.append(c)
        self.radius.append(float(np.sqrt(((x - c) ** 2).sum(1).max())))
        self.leaf.append(-1)
        groups = self._split(x, r) if len(x) > LEAF else []
        if len(groups) < 2:
            self.leaf[me] = self.leaves
            self.leaves += 1
            return me
        for g in groups:
            self.children[me].append(self._grow(x[g], r))
        return me

    @staticmethod
    def _split(x: np.ndarray, r: np.random.Generator) -> list[np.ndarray]:
        c = x[r.choice(len(x), BRANCH, replace=False)]
        for _ in range(8):
            own = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
            c = np.array([x[own == k].mean(0) if (own == k).any() else c[k] for k in range(len(c))])
        own = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        return [g for k in range(len(c)) if len(g := np.flatnonzero(own == k))]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at every node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            c = self.centre[kids]
            own = ((c**2).sum(1)[None, :] - 2 * x[rows] @ c.T).argmin(1)
            todo += [(kid, rows[own == k]) for k, kid in enumerate(kids) if (own == k).any()]
        return out

    def visit(self, q: np.ndarray, most: int, slack: float, sizes: np.ndarray | None = None, least: np.ndarray | None = None) -> np.ndarray:
        """Each query's first `most` leaves, best bin first: by inner product with the centre plus `slack` of what norm and radius allow.

        With the leaves' sizes, empty leaves are passed over and further ones follow until they hold `least` vectors.
        """
        sizes = np.ones(self.leaves, np.int64) if sizes is None else sizes
        least = np.zeros(len(q), np.int64) if least is None else least
        bound = q @ self.centre.T + slack * np.linalg.norm(q, axis=1)[:, None] * self.radius[None, :]
        out = np.full((len(q), self.leaves), -1, np.int64)
        for i, b in enumerate(bound.tolist()):
            queue, n, held = [(-b[0], 0)], 0, 0
            while queue and (n < most or held < least[i]):
                _, node = heapq.heappop(queue)
                kids = self.children[node]
                if not kids and sizes[self.leaf[node]]:
                    out[i, n] = self.leaf[node]
                    n += 1
                    held += sizes[self.leaf[node]]
                for kid in kids:
                    heapq.heappush(queue, (-b[kid], kid))
        return out


def calibrate(tree: Tree, trial: np.ndarray, x: np.ndarray, k: int, recall: float) -> tuple[int, float]:
    """Leaf visits at which the trial queries find `recall` of their k nearest among x, and the slack that needs the fewest.

    Neither trial queries nor x have to do with the tree's fit. x stands for a larger table, so k is its share of the
    real one; a trial query is no neighbour of its own: equal vectors are left out.
    """
    own = tree.place(x)
    score = trial @ x.T
    own_score = np.einsum("ij,ij->i", trial, trial)[:, None]
    score[np.abs(score - own_score) <= 1e-12 * own_score] = -np.inf  # itself, if it is in x
    k = min(k, len(x))
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    real = np.take_along_axis(score, best, axis=1) > -np.inf
    if not real.any():
        return 1, SLACKS[0]
    found = []
    for slack in SLACKS:
        order = tree.visit(trial, tree.leaves, slack)
        when = np.empty((len(trial), tree.leaves), np.int64)
        np.put_along_axis(when, order, np.broadcast_to(np.arange(tree.leaves), order.shape), axis=1)
        needed = np.sort(np.take_along_axis(when, own[best], axis=1)[real])
        found.append((int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1, slack))
    return min(found)


def best(query: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, nearest first, ties to the smaller id."""
    order = np.lexsort((found, -score, query))
    q = query[order]
    new = np.ones(len(q), bool)
    new[1:] = q[1:] != q[:-1]
    rank = np.arange(len(q)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(q) else np.zeros(0, int)
    return order[rank < k]


HIT = np.dtype([("q", "i8"), ("v", "i8"), ("s", "f8")])


def spread(ids: np.ndarray, n: int) -> np.ndarray:
    return (ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n


def cuts(of: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]]) if len(of) else np.zeros(1, int)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product in double precision) of each query's k nearest found.

    Candidates are all rows but those of the query's own id. Vectors that are null, zero or with null or non-finite parts
    take no part, as do rows without an id; vectors of different lengths have no inner product, so each length is a
    search of its own. Ties go to the smaller id; an id is asked once, however many rows it has; a repeated row is a
    candidate of its own; with fewer than k candidates all are returned. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("ask")).where("vec_id is not null and v is not null")
    out = None
    for dims, n in lengths(v, "v"):
        found = _nearest(v.where(F.size("v") == dims), dims, n, k, recall)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


SCHEMA = "query_id long, rank int, vec_id long, score double"


def _nearest(v: DataFrame, dims: int, rows: int, k: int, recall: float) -> DataFrame:
    spark = v.sparkSession
    tree = Tree(sample(v, "vec_id", "v", min(max(rows // 8, SAMPLE_ROWS[0]), SAMPLE_ROWS[1]), dims, rows, seed=23))
    x = sample(v, "vec_id", "v", TRIAL_ROWS, dims, rows, seed=29)
    trial = sample(v, "vec_id", "v", TRIALS, dims, rows, seed=31)[:TRIALS]
    visits, slack = calibrate(tree, trial, x, max(1, round(k * len(x) / rows)), recall)
    shared = spark.sparkContext.broadcast(tree)  # as many nodes as the sample allows
    kind = "f4" if v.schema["v"].dataType.simpleString() == "array<float>" else "f8"
    parts = tasks_for(v)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                rows, x = matrix(part.column(1), dims)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(tree.place(x)), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()), part.column(2).take(pa.array(rows))], ["vec_id", "leaf", "x", "ask"])

    placed = keep(v.mapInArrow(dealt, "vec_id long, leaf long, x binary, ask boolean"), "placed")
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, n in placed.groupBy("leaf").count().collect():  # one row a leaf
        sizes[leaf] = n
    # neighbouring leaves up to a size are a group; a leaf above it is a group of several chunks
    most = int(min(max(rows // parts, GROUP[0]), GROUP[1]))
    group, held = np.zeros(tree.leaves, np.int64), 0
    for i in range(1, tree.leaves):
        held += sizes[i - 1]
        group[i] = group[i - 1] + (held + sizes[i] > most)
        held = held if group[i] == group[i - 1] else 0
    chunks = np.maximum(1, -(-np.bincount(group, sizes).astype(np.int64) // most))

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                ids = part.column(0).to_numpy()
                q = np.frombuffer(b"".join(part.column(1).to_pylist()), kind).reshape(len(ids), dims)
                order = tree.visit(q.astype(np.float64), visits, slack, sizes, k + part.column(2).to_numpy())
                takes = np.zeros((len(ids), tree.leaves), bool)
                row, at = np.nonzero(order >= 0)
                takes[row, order[row, at]] = True
                out = []
                for g in np.unique(group[order[row, at]]):
                    own = takes[:, group == g]
                    who = np.flatnonzero(own.any(1))
                    out += [(int(g), c, len(who), ids[who].tobytes(), q[who].tobytes(), np.packbits(own[who], axis=1).tobytes()) for c in range(chunks[g])]
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["g", "c", "n", "ids", "qs", "takes"])

    # an id is asked once; rows of its own are no candidates, so it needs as many vectors more
    asking = placed.groupBy("vec_id").agg(F.min(F.when(F.col("ask"), F.col("x"))).alias("x"), F.count(F.lit(1)).alias("own")).where("x is not null").select("vec_id", "x", "own")
    asked = keep(asking.mapInArrow(asks, "g long, c long, n long, ids binary, qs binary, takes binary"), "asked")
    turns = np.ones(len(chunks), np.int64)
    for g, n in asked.where("c = 0").groupBy("g").agg(F.sum("n")).collect():  # one row a group
        turns[g] = -(-n // CHUNK)
    of_group = [(int(g), int(chunks[g]), int(turns[g])) for g in range(len(chunks))]
    per_group = F.broadcast(spark.createDataFrame(of_group, "g long, chunks long, turns long"))
    of_leaf = F.broadcast(spark.createDataFrame([(i, int(g)) for i, g in enumerate(group)], "leaf long, g long"))
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("t")
    candidates = placed.join(of_leaf, "leaf").join(per_group, "g").select("g", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).alias("c"), turn, "vec_id", "leaf", "x")
    asked = asked.join(per_group, "g").select("g", "c", F.pmod(F.xxhash64("ids"), F.col("turns")).alias("t"), "ids", "qs", "takes")

    def compare(own: pa.Table, asking: pa.Table) -> pa.Table:
        hits = [np.zeros(0, HIT)]
        if own.num_rows and asking.num_rows:
            leaf = own["leaf"].to_numpy()
            order = np.argsort(leaf, kind="stable")
            ids, leaf = own["vec_id"].to_numpy()[order], leaf[order]
            x = np.frombuffer(b"".join(own["x"].to_pylist()), kind).reshape(len(ids), dims)[order].astype(np.float64)
            first = int(np.flatnonzero(group == group[leaf[0]])[0])
            width = -(-int((group == group[leaf[0]]).sum()) // 8)
            takes = np.unpackbits(np.frombuffer(b"".join(asking["takes"].to_pylist()), np.uint8).reshape(-1, width), axis=1).astype(bool)
            qid = np.frombuffer(b"".join(asking["ids"].to_pylist()), np.int64)
            q = np.frombuffer(b"".join(asking["qs"].to_pylist()), kind).reshape(len(qid), dims)
            order = np.argsort(takes.argmax(1), kind="stable")  # queries of like leaves side by side
            for i in range(0, len(order), 128):
                rows = order[i : i + 128]
                col = np.flatnonzero(takes[rows].any(0)[leaf - first])
                if not len(col):
                    continue
                score = q[rows].astype(np.float64) @ x[col].T
                score[~takes[rows][:, leaf[col] - first] | (ids[col][None, :] == qid[rows][:, None])] = -np.inf
                edge = max(0, score.shape[1] - k)
                top = np.partition(score, edge, axis=1)[:, edge]
                row, at = np.nonzero((score >= top[:, None]) & (score > -np.inf))
                pick = best(row, ids[col[at]], score[row, at], k)
                h = np.zeros(len(pick), HIT)
                h["q"], h["v"], h["s"] = qid[rows[row[pick]]], ids[col[at[pick]]], score[row[pick], at[pick]]
                hits.append(h)
        h = np.concatenate(hits)
        part = spread(h["q"], parts)
        order = np.argsort(part, kind="stable")
        part, h = part[order], h[order]
        cut = cuts(part)
        return pa.table({"part": pa.array(part[cut[:-1]].astype(np.int32)), "hits": pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    def settle(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.zeros(0, HIT), *(np.frombuffer(b, HIT) for b in table["hits"].to_pylist())])
        pick = best(h["q"], h["v"], h["s"], k)
        h = h[pick]
        new = np.ones(len(h), bool)
        new[1:] = h["q"][1:] != h["q"][:-1]
        rank = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(h) else np.zeros(0, int)
        return pa.table({"query_id": h["q"], "rank": (rank + 1).astype(np.int32), "vec_id": h["v"], "score": h["s"]})

    hits = candidates.groupBy("g", "c", "t").cogroup(asked.groupBy("g", "c", "t")).applyInArrow(compare, "part int, hits binary")
    return hits.groupBy("part").applyInArrow(settle, SCHEMA)
