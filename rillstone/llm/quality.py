"""Quality: a byte-level convolutional network in numpy over overlapping chunks of the whole text.

Each byte has a learned vector. Learned filters read windows of bytes at a stride; their rectified answers are
max-pooled over overlapping chunks, and the mean and the maximum over all chunks go into one logistic unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import WINDOW, slices
from .samples import labelled_texts, remainder

#: Labelled texts of each class that the fit reads at most.
SAMPLE_ROWS = 1200
WIDTH, STRIDE, DIMS, FILTERS, HALF = 8, 4, 8, 32, 256


def lay_out(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with every document padded to whole half-chunks, and each document's first half-chunk."""
    n = np.diff(offs)
    halves = np.maximum(1, -(-n // HALF))
    first = np.zeros(len(offs), np.int64)
    np.cumsum(halves, out=first[1:])
    out = np.zeros(first[-1] * HALF + WIDTH, np.uint8)
    out[np.arange(len(buf)) + np.repeat(first[:-1] * HALF - offs[:-1], n)] = buf
    return out, first


class ByteNet:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "emb": r.normal(0, 0.5, (256, DIMS)).astype(np.float32),
            "filt": (r.normal(0, 1, (WIDTH * DIMS, FILTERS)) / np.sqrt(WIDTH * DIMS)).astype(np.float32),
            "fb": np.zeros(FILTERS, np.float32),
            "out": np.zeros(2 * FILTERS, np.float32),
            "ob": np.zeros(1, np.float32),
        }

    def windows(self, data: np.ndarray) -> np.ndarray:
        flat = self.p["emb"][data].ravel()
        n = (len(data) - WIDTH) // STRIDE
        return np.lib.stride_tricks.as_strided(flat, (n, WIDTH * DIMS), (flat.itemsize * STRIDE * DIMS, flat.itemsize), writeable=False)

    def halves(self, win: np.ndarray, last: np.ndarray, where: bool = False):
        """Maxima over the windows of each half-chunk; with `where` also which windows they come from.

        The windows at the end of a document's last half-chunk reach into the next document: they don't count.
        """
        per = HALF // STRIDE
        act = (win @ self.p["filt"]).reshape(-1, per, FILTERS)
        act[last, per - (WIDTH - 1) // STRIDE :] = -np.inf
        arg = act.argmax(1) + np.arange(len(act))[:, None] * per if where else None
        return np.maximum(act.max(1) + self.p["fb"], 0), arg

    def pooled(self, half: np.ndarray, first: np.ndarray, arg: np.ndarray | None = None):
        """Mean and maximum over each document's chunks; with `arg` also what the gradient needs."""
        # a chunk is two neighbouring half-chunks; a document's last half-chunk stands alone
        chunk = half.copy()
        chunk_arg = None if arg is None else arg.copy()
        joint = np.ones(len(half), bool)
        joint[first[1:] - 1] = False
        i = np.flatnonzero(joint)
        if len(i):
            later = half[i + 1] > half[i]
            chunk[i] = np.where(later, half[i + 1], half[i])
            if arg is not None:
                chunk_arg[i] = np.where(later, arg[i + 1], arg[i])
        mean = np.add.reduceat(chunk, first[:-1], 0) / np.diff(first)[:, None]
        top = np.maximum.reduceat(chunk, first[:-1], 0)
        return np.hstack([mean, top]), chunk, chunk_arg

    def predict(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if len(offs) == 2 and len(buf) > 4 * WINDOW:  # one very long text: half-chunks of a window of bytes at a time
            first, parts = np.array([0, -(-len(buf) // HALF)]), []
            for a in range(0, len(buf), WINDOW):
                here = min(WINDOW, len(buf) - a)
                data, _ = lay_out(buf[a : a + here], np.array([0, here]))
                data[len(data) - WIDTH :][: len(buf[a + here : a + here + WIDTH])] = buf[a + here : a + here + WIDTH]
                parts.append(self.halves(self.windows(data), np.array([-1]) if a + here == len(buf) else np.zeros(0, np.int64))[0])
            half = np.concatenate(parts)
        else:
            data, first = lay_out(buf, offs)
            half, _ = self.halves(self.windows(data), first[1:] - 1)
        z = self.pooled(half, first)[0] @ self.p["out"] + self.p["ob"]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -35, 35)))

    def gradients(self, buf: np.ndarray, offs: np.ndarray, y: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cost-weighted log loss of the documents."""
        data, first = lay_out(buf, offs)
        win = self.windows(data)
        half, where = self.halves(win, first[1:] - 1, True)
        feat, chunk, arg = self.pooled(half, first, where)
        p = 1 / (1 + np.exp(-np.clip(feat @ self.p["out"] + self.p["ob"], -35, 35)))
        d = (cost * (p - y)).astype(np.float32) / len(y)
        doc = np.repeat(np.arange(len(y)), np.diff(first))
        back = d[:, None] * self.p["out"]
        share = back[doc, :FILTERS] / np.diff(first)[doc][:, None]
        # the maximum's gradient goes to the first chunk that attains it
        best = chunk == feat[doc, FILTERS:]
        count = np.cumsum(best, axis=0)
        before = np.vstack([np.zeros((1, FILTERS), np.int64), count])[first[:-1]][doc]
        share += np.where(best & (count - before == 1), back[doc, FILTERS:], 0)
        share = np.where(chunk > 0, share, 0).astype(np.float32)
        g_filt = np.empty_like(self.p["filt"])
        g_emb = np.zeros_like(self.p["emb"])
        step = np.arange(WIDTH)
        for f in range(FILTERS):
            at = arg[:, f]
            g_filt[:, f] = win[at].T @ share[:, f]
            into = share[:, f][:, None, None] * self.p["filt"][:, f].reshape(WIDTH, DIMS)[None]
            np.add.at(g_emb, data[at[:, None] * STRIDE + step], into)
        return {"emb": g_emb, "filt": g_filt, "fb": share.sum(0), "out": feat.T @ d, "ob": d.sum(keepdims=True)}

    def fit(self, texts: list[str], y: np.ndarray, epochs: int = 5, steps: int = 500, batch: int = 24, rate: float = 0.01, seed: int = 7) -> ByteNet:
        """Adam over whole texts, `epochs` times or until `steps` batches; both classes weigh as much. One class alone gives a constant."""
        if not len(y) or y.min() == y.max():
            self.p["ob"][:] = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
            return self
        raw = [t.encode() for t in texts]
        cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, t = np.random.default_rng(seed), 0
        epochs = max(epochs, -(-steps // -(-len(y) // batch)))
        total = epochs * -(-len(y) // batch)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                own = order[i : i + batch]
                col = pa.array([raw[k] for k in own], pa.binary())
                grads = None
                for a, b, buf, offs in slices(col, 1 << 19):
                    g = self.gradients(buf, offs, y[own[a:b]], cost[own[a:b]])
                    w = (b - a) / len(own)
                    grads = {k: v * w + (grads[k] if grads else 0) for k, v in g.items()}
                t += 1
                lr = rate * (1 - 0.9 * t / total)
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.01 * (g * g - s[k])
                    self.p[k] -= (lr * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= threshold) of every whole text.

    Learns from at most `sample_rows` texts of each class whose crc32(id) mod 5 is not 0. Null texts count
    as empty ones, which are one chunk of padding; very long ones are read a window at a time; repeated rows are scored each; empty labels give a
    score of one half; empty tables give empty results. Columns beside id and text are not read.
    """
    texts, y = labelled_texts(docs, labels.where(remainder(id_col, 5) != 0), "quality", sample_rows, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(ByteNet().fit(texts, y).p)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = ByteNet()
        net.p = model.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, j, buf, offs in slices(batch.column(2), 1 << 19):
                out[i:j] = net.predict(buf, offs)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col, 5) == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
