"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, U, WINDOW, mix, prefix_hash, slices, span_hash, word_hashes, words
from .samples import labelled_texts, remainder

#: Hashed features; weights are a table of this length, most of it zero.
BITS = 20
#: Labelled texts of each class that the fit reads at most.
SAMPLE_ROWS = 4000
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_TABLE = np.where(_PLAIN, LOWER, np.uint8(32))


def features(buf: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each document's words (letters and digits, lower-cased) and where each document's begin.

    Per word: itself, the pair with its successor, and the pair that skips one word.
    """
    plain = _TABLE[buf]
    starts, ends, first = words(plain, offs)
    h = span_hash(prefix_hash(plain), starts, ends)
    return _with_pairs(h, np.repeat(np.arange(len(offs) - 1), np.diff(first)), bits).ravel(), first * 3


def _with_pairs(h: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    n = len(h)
    out = np.empty((n, 3), U)
    out[:, 0] = h
    for k in (1, 2):
        out[:, k] = h
        if n > k:
            same = doc[:-k] == doc[k:]
            pair = mix(h[:-k] * U(3) + h[k:] * U(0x9E3779B97F4A7C15) + U(k))
            out[:-k, k] = np.where(same, pair, h[:-k])
    return (out >> U(64 - bits)).astype(np.int64)


def lots(buf: np.ndarray, bits: int = BITS) -> Iterator[np.ndarray]:
    """The features of one very long text, those of WINDOW words at a time."""
    h = word_hashes(buf, _TABLE)
    for i in range(0, len(h), WINDOW):
        part = h[i : i + WINDOW + 2]
        yield _with_pairs(part, np.zeros(len(part), np.int64), bits)[: min(WINDOW, len(h) - i)].ravel()


def distinct(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    key = np.unique((doc << 32) | ids)
    return key & 0xFFFFFFFF, np.searchsorted(key, np.arange(len(at), dtype=np.int64) << 32)


def fit(texts: list[str], y: np.ndarray, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.05, epochs: int = 10) -> tuple[np.ndarray, float]:
    """FTRL-proximal: per-coordinate rates from squared gradients, L1 keeps a weight at zero until |z| exceeds it.

    Features are present or absent; texts come in their given order, both classes weigh as much.
    Returns the weights and a bias (the last, unregularised coordinate). One class alone gives a constant.
    """
    if not len(y) or y.min() == y.max():
        return np.zeros(1 << bits, np.float32), (0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rows = []
    for _, _, buf, offs in slices(pa.array(texts, pa.string())):
        if len(buf) > 4 * WINDOW:
            rows.append(np.unique(np.concatenate([np.unique(ids) for ids in lots(buf, bits)])))
            continue
        ids, at = distinct(*features(buf, offs, bits))
        rows += [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias, bias_n = 0.0, 1e-3
    cost = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(epochs):
        for ids, label, c in zip(rows, y, cost, strict=True):
            zi, ni = z[ids], n[ids]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = c * (p - label)
            sigma = (np.sqrt(ni + g * g) - root) / alpha
            z[ids] = zi + g - sigma * w
            n[ids] = ni + g * g
            bias_n += g * g
            bias -= 0.1 * g / np.sqrt(bias_n)
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w.astype(np.float32), float(bias)


def score_texts(col: pa.Array, w: np.ndarray, bias: float) -> np.ndarray:
    bits = len(w).bit_length() - 1
    out = np.empty(len(col))
    live = w != 0
    for i, j, buf, offs in slices(col, 1 << 19):
        if len(buf) > 4 * WINDOW:
            hits = np.unique(np.concatenate([np.unique(ids[live[ids]]) for ids in lots(buf, bits)]))
            out[i] = 1 / (1 + np.exp(-np.clip(w[hits].sum(dtype=np.float64) + bias, -35, 35)))
            continue
        ids, at = features(buf, offs, bits)
        hit = np.flatnonzero(live[ids])  # few: weights are sparse
        doc = np.searchsorted(at, hit, "right") - 1
        key = np.unique((doc.astype(np.int64) << 32) | ids[hit])
        total = np.bincount(key >> 32, w[key & 0xFFFFFFFF], minlength=j - i)
        out[i:j] = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
    return out


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= threshold) of every whole text.

    Learns from at most `sample_rows` texts of each class whose crc32(id) mod 3 is not 1. Null and empty
    texts have no features and get the bias's score; very long ones are read a window at a time; repeated rows are scored
    each; empty labels give a score of one half; empty tables give empty results. Columns beside id and text are not read.
    """
    texts, y = labelled_texts(docs, labels.where(remainder(id_col, 3) != 1), "toxic", sample_rows, id_col, text_col)
    w, bias = fit(texts, y)
    used = np.flatnonzero(w)
    model = docs.sparkSession.sparkContext.broadcast((used, w[used], len(w), bias))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, size, b = model.value
        full = np.zeros(size, np.float32)
        full[at] = values
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score_texts(batch.column(2), full, b))], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col, 3) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
