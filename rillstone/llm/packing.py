"""Vector best-fit packing of token pieces into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths). Pieces of one length are alike, so the plan is made from the histogram of lengths, which has
as many entries as a sequence has tokens at most, whatever the corpus holds: lengths in falling order
go to the open bins with the smallest weighted norm of what would be left of the three residuals, under
every capacity. Bins with equal contents are one entry with a count. The plan says where the r-th piece
of each length goes; ranks come from counts per task, so no length is gathered anywhere.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import LOWER, SPACE, WINDOW, prefix_hash, slices, span_hash, words
from .shared import keep

#: Words whose ids a Python worker remembers.
CACHE_WORDS = 2_500_000
#: A word of its own with one id, put between words that are encoded together.
MARK = "\x1f"


_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[c for c in range(48, 123) if chr(c).isalnum()]] = True


def units(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and apart from them the ASCII signs that end them behind an ASCII letter or digit: fewer different ones.

    The tokenizer always parts there; an apostrophe, which may open a suffix of its own, stays with its word.
    """
    starts, ends, first = words(buf, offs)
    if not len(starts):
        return starts, ends, first
    last = np.maximum.accumulate(np.where(_SIGN[buf], -1, np.arange(len(buf))))[ends - 1]  # last byte that is no sign
    cut = np.flatnonzero((last >= starts) & (last < ends - 1) & _PLAIN[buf[last]])
    starts, ends = np.sort(np.concatenate([starts, last[cut] + 1])), np.sort(np.concatenate([ends, last[cut] + 1]))
    return starts, ends, np.searchsorted(starts, offs)


class WordTokens:
    """Token ids by word, for tokenizers that never join across ASCII white space; remembers words by hash."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.uint32)
        self.count = np.zeros(0, np.uint32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def tokens_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and how many each has. Many words go through in one text, a mark between them."""
        count = np.zeros(len(texts), np.int64)
        marked = [k for k, t in enumerate(texts) if MARK in t]
        if marked or len(self.mark) != 1:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            count[:] = [len(g) for g in got]
            return np.fromiter((i for g in got for i in g), np.uint32, count.sum()), count
        step = 500
        joined = [f" {MARK} ".join(texts[i : i + step]) for i in range(0, len(texts), step)]
        parts = []
        for i, e in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            mark = ids == self.mark[0]
            at = np.flatnonzero(mark)
            count[i * step : i * step + len(at) + 1] = np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
            parts.append(ids[~mark])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), count

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, `end_id` after each, and the documents' offsets.

        A very long text is encoded a window at a time, cut at white space; what has none is one word, however long.
        """
        if len(offs) == 2 and len(buf) > 4 * WINDOW:
            parts, a = [], 0
            while a < len(buf):
                z = a + WINDOW
                while z < len(buf) and not (gap := np.flatnonzero(SPACE[buf[max(a, z - WINDOW) : z]])).size:
                    z += WINDOW
                z = max(a, z - WINDOW) + int(gap[-1]) + 1 if z < len(buf) else len(buf)
                parts.append(self._encode(buf[a:z], np.array([0, z - a]), end_id)[0][:-1])
                a = z
            ids = np.concatenate([*parts, np.array([end_id], np.uint32)])
            return ids, np.array([0, len(ids)])
        return self._encode(buf, offs, end_id)

    def _encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if len(buf) > 1 and ((buf[:-1] == ord("<")) & (buf[1:] == ord("|"))).any():
            starts, ends, first = words(buf, offs)  # a special token may stand here: whole words, as they are
        else:
            starts, ends, first = units(buf, offs)
            buf = LOWER[buf]  # the tokenizer lower-cases too, all but its special tokens
        h = span_hash(prefix_hash(buf), starts, ends)
        own, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, own)
        new = np.ones(len(own), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != own[inside]
        if new.any():
            if len(self.known) + new.sum() > CACHE_WORDS:
                self.forget()
                new[:] = True
            raw = buf.tobytes()
            flat, count = self.tokens_of([raw[starts[k] : ends[k]].decode("utf-8", "replace") for k in sample[new]])
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            at = self.used + np.cumsum(count) - count
            self.used += len(flat)
            spot = np.searchsorted(self.known, own[new])
            self.known = np.insert(self.known, spot, own[new])
            self.at, self.count = np.insert(self.at, spot, at.astype(np.uint32)), np.insert(self.count, spot, count.astype(np.uint32))
            spot = np.searchsorted(self.known, own)
        at, count = self.at[spot].astype(np.int64)[inverse], self.count[spot].astype(np.int64)[inverse]
        total = np.concatenate([[0], np.cumsum(count)])
        n_docs = len(offs) - 1
        doc_at = total[first] + np.arange(n_docs + 1)
        out = np.full(doc_at[-1], end_id, np.uint32)
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        to = total[:-1] + doc
        step = np.arange(total[-1]) - np.repeat(total[:-1], count)
        out[np.repeat(to, count) + step] = self.ids[np.repeat(at, count) + step]
        return out, doc_at


_tokens: dict[str, WordTokens] = {}


def plan_bins(lengths: np.ndarray, counts: np.ndarray, tokens: int, documents: int, attention: int, weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> np.ndarray:
    """Rows (length, first rank, ranks, pieces per bin, first bin, offset) that place counts[i] pieces of lengths[i].

    Best fit in falling order of length: of all bins that keep within the three capacities, the one with
    the smallest weighted norm of its residuals once filled; a new bin only where none has room.
    """
    res = np.zeros((4, 1), np.int64)  # tokens, documents, attention left; first bin
    size = np.zeros(1, np.int64)  # bins of that kind; the first column stays a bin without room
    bins, events = 0, []
    full = np.array([tokens, documents, attention], np.float64)[:, None]
    scale = np.array(weights)[:, None] / full
    for length, count in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        rank, need = 0, np.array([length, 1, length * length], np.int64)[:, None]
        fits = np.flatnonzero((res[:3] >= need).all(0))
        room = np.minimum.reduce(res[:3, fits] // need)
        left = (((res[:3, fits] - need * room) * scale) ** 2).sum(0)
        gone, added = [], []
        for k in np.argsort(left, kind="stable"):
            if rank == count:
                break
            g, m = fits[k], int(room[k])
            first, have = int(res[3, g]), int(size[g])
            whole = min(have, (count - rank) // m)
            for n_bins, per in ((whole, m), (1 if whole < have and (count - rank) - whole * m else 0, (count - rank) - whole * m)):
                if n_bins:
                    events.append((length, rank, n_bins * per, per, first, tokens - int(res[0, g])))
                    added.append([*(res[:3, g] - need[:, 0] * per), first, n_bins])
                    rank, first, have = rank + n_bins * per, first + n_bins, have - n_bins
            gone.append(g)
            if have:
                added.append([*res[:3, g], first, have])
        if rank < count:
            m = int(min(tokens // length, documents, attention // (length * length)))
            if m < 1:
                raise ValueError(f"a piece of {length} tokens fits no empty sequence")
            whole, part = divmod(count - rank, m)
            for n_bins, per in ((whole, m), (1 if part else 0, part)):
                if n_bins:
                    events.append((length, rank, n_bins * per, per, bins, 0))
                    added.append([tokens - length * per, documents - per, attention - length * length * per, bins, n_bins])
                    rank, bins = rank + n_bins * per, bins + n_bins
        alive = np.ones(len(size), bool)
        alive[gone] = False
        new = np.array(added, np.int64).T
        new = new[:, new[0] > 0]  # full bins leave
        res, size = np.hstack([res[:, alive], new[:4]]), np.concatenate([size[alive], new[4]])
    return np.array(events, np.int64).reshape(-1, 6)


def pack_documents(docs: DataFrame, tokenizer_path: str, tokens: int = 2048, documents: int = 2048, attention: int | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    A document is its ids and then `end_id`; only those longer than `tokens` are cut. Null and empty
    texts are the end id alone. Repeated rows are packed each, as documents of their own; an empty table
    gives an empty result. Other columns are left out. `attention` (default: tokens squared) and
    `documents` bound each sequence too.
    """
    attention = tokens * tokens if attention is None else attention
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokens.setdefault(tokenizer_path, None) or WordTokens(tokenizer_path)
        _tokens[tokenizer_path] = tok
        part = TaskContext.get().partitionId()
        seen = np.zeros(tokens + 1, np.int64)
        for batch in batches:
            for i, j, buf, offs in slices(batch.column(1), 1 << 20):
                ids, at = tok.encode(buf, offs, end_id)
                n = np.diff(at)
                pieces = -(-n // tokens)
                row = np.repeat(np.arange(j - i), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * tokens
                length = np.minimum(tokens, n[row] - start)
                begin = at[row] + start
                view = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = np.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)], np.int64)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.searchsorted(ordered, ordered)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - first + seen[ordered]
                seen += np.bincount(length, minlength=tokens + 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc), pa.array(np.full(len(row), part, np.int32)), pa.array(nth)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long")
    pieces = keep(pieces, "pieces")  # task numbers are settled once written
    per = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    per = keep(per, "lengths")
    hist = per.groupBy("length").agg(F.sum("n").alias("n")).collect()  # `tokens` rows at most
    events = plan_bins(np.array([r[0] for r in hist], np.int64), np.array([r[1] for r in hist], np.int64), tokens, documents, attention)
    events = events[np.lexsort((events[:, 1], events[:, 0]))]
    plan = docs.sparkSession.sparkContext.broadcast(events)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = per.select(F.col("length").alias("l"), F.col("part").alias("p"), before.alias("base"))
    ranked = pieces.join(bases, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = plan.value
        key = (e[:, 0] << 48) + e[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            k = np.searchsorted(key, (length << 48) + rank, "right") - 1
            r = rank - e[k, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(e[k, 4] + r // e[k, 3]), pa.array(e[k, 5] + r % e[k, 3] * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
