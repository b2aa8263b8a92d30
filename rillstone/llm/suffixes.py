"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

A byte goes if a string of `length` bytes that covers it also starts earlier in the corpus. Hashes only choose
what is sorted, and where; whatever goes is equal, byte by byte, to a neighbour in suffix order:

1. Every window of `length` bytes names an anchor, the least hashed run of `GRAM` bytes in it, so equal
   windows name equal anchors. Consecutive windows with one anchor are a run. A task sends one run of each of its
   anchors to the anchor's hash range; an anchor that is found once in all repeats nowhere.
2. The bytes of all other runs, as pieces, go to the range of their anchor. Equal pieces are one string: bytes are
   compared, all but the first in the corpus repeat whole.
3. Each range sorts the suffixes of its pieces by the difference cover modulo 3: sampled triples are
   sorted and named, the string of names is solved by recursion, the remaining suffixes are sorted by
   their first byte and the rank that follows, and merged. Neighbours in suffix order that share `length`
   bytes are equal windows; all but the first in the corpus go. Pieces of one anchor are sorted in lots of whole anchors.
4. An anchor with more runs than `HOT` would be one task's work whatever the cluster. Its windows become runs of their own,
   with the whole window as anchor, and take the same way once more, so that they spread out.

Ranges and buckets carry packed arrays, a row per task and range, and none of it comes to the driver but the anchors
with more than `HOT` runs and more than a millionth of all runs: a million at most.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import U, mix, powers, prefix_hash, raw_column, slices, span_hash, stretches
from .shared import keep, sweep, tasks_for

GRAM = 40
#: Runs that a task sends off together; runs of an anchor that make it hot; bytes of pieces that are sorted together.
FLUSH, HOT, LOT = 600_000, 8192, 1 << 20
#: A run: anchor's hash; document (id, and crc32 of the text, as an id may have several); first window, windows, anchor's offset; runs that it stands for.
RUN = np.dtype([("h", "u8"), ("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u2"), ("off", "u2"), ("many", "u4")])
#: Windows that repeat, or (ask) that may.
MARK = np.dtype([("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u2"), ("off", "u2"), ("ask", "u1")])
PIECE = np.dtype([("key", "u8"), ("doc", "i8"), ("tie", "u4"), ("at", "u4"), ("n", "u2")])
#: What a packed row holds.
RUNS, MARKS, PIECES, COUNTS = range(4)


def ties(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    view = memoryview(np.ascontiguousarray(buf)).cast("B") if len(buf) else memoryview(b"")
    return np.array([zlib.crc32(view[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], np.uint32)


def runs_of(buf: np.ndarray, offs: np.ndarray, ids: np.ndarray, tie: np.ndarray, length: int, base: int = 0, own: int | None = None) -> np.ndarray:
    """All runs of windows with one anchor, of those windows that begin at the first `own` bytes of each text."""
    n, w = len(buf), length - GRAM + 1
    per = np.minimum(np.maximum(0, np.diff(offs) - length + 1), n if own is None else own)
    total = int(per.sum())
    if not total:
        return np.zeros(0, RUN)
    sums = prefix_hash(buf)
    _, down = powers(n + 1)
    g = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    bits = U(max(20, n.bit_length()))
    low = (g >> bits << bits) | np.arange(len(g), dtype=U)
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
    doc = np.repeat(np.arange(len(ids)), per)
    s = np.arange(total) + np.repeat(offs[:-1] - np.cumsum(per) + per, per)
    anchor = (low[s] & ((U(1) << bits) - U(1))).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    out = np.zeros(len(first), RUN)
    count = np.diff(np.append(first, total))
    s, anchor, doc = s[first], anchor[first], doc[first]
    out["h"], out["doc"], out["tie"] = g[anchor], ids[doc], tie[doc]
    out["at"], out["n"], out["off"], out["many"] = s - offs[doc] + base, count, anchor - s, 1
    return out


def meet(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs: one for each anchor, with the runs that it stands for; single runs that have met others; and all the sums."""
    runs = runs[np.argsort(runs["h"], kind="stable")]
    new = np.ones(len(runs), bool)
    new[1:] = runs["h"][1:] != runs["h"][:-1]
    first = np.flatnonzero(new)
    met = np.diff(np.append(first, len(runs))) > 1
    one = runs[first]
    one["many"] = np.minimum(np.add.reduceat(runs["many"].astype(np.int64), first), 0xFFFFFFFF) if len(runs) else 0
    return one, runs[met[np.cumsum(new) - 1] & (runs["many"] == 1)], one[met]


def by_range(h: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of evenly spread hashes (anchors, being minima, are not: mix them first)."""
    return ((h >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def bucket_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return by_range(mix(doc.astype(np.int64).view(U) + U(99)), parts)


def packed(part: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows by part, each part's as bytes."""
    order = np.argsort(part, kind="stable")
    part, rows = part[order], rows[order]
    cut = np.flatnonzero(np.diff(part)) + 1
    begin = np.concatenate([[0], cut]) if len(part) else np.zeros(0, int)
    return [int(p) for p in part[begin]], [x.tobytes() for x in (np.split(rows, cut) if len(part) else [])]


def marks(of: np.ndarray, ask: bool) -> np.ndarray:
    out = np.zeros(len(of), MARK)
    for k in ("doc", "tie", "at", "n", "off") if ask else ("doc", "tie", "at", "n"):
        out[k] = of[k]
    out["ask"] = ask
    return out


def join_spans(m: np.ndarray) -> np.ndarray:
    """Windows of one document that repeat and follow each other become one mark (65,535 windows at most)."""
    m = m[np.lexsort((m["at"], m["tie"], m["doc"]))]
    if len(m) < 2:
        return m
    at, n = m["at"].astype(np.int64), m["n"].astype(np.int64)
    new = np.ones(len(m), bool)
    new[1:] = (m["doc"][1:] != m["doc"][:-1]) | (m["tie"][1:] != m["tie"][:-1]) | (at[1:] > at[:-1] + n[:-1])
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(at + n, first)
    out, total = m[first], end - at[first]
    more = -(-total // 0xFFFF)
    out, nth = np.repeat(out, more), np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    out["at"] += (nth * 0xFFFF).astype(np.uint32)
    out["n"] = np.minimum(np.repeat(total, more) - nth * 0xFFFF, 0xFFFF)
    return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array by the difference cover {1, 2} modulo 3; s holds whole numbers above 0."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    top = int(t.max()) + 1
    # sampled triples, sorted and named (position n stands for an empty suffix if it is sampled)
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    cover = np.concatenate([one, two])
    pair = t[cover] * top + t[cover + 1]
    if top < 1 << 20:
        triple = pair * top + t[cover + 2]
        order = np.argsort(triple, kind="stable")
        step = np.diff(triple[order]) != 0
    else:
        order = np.lexsort((t[cover + 2], pair))
        step = (np.diff(pair[order]) != 0) | (np.diff(t[cover + 2][order]) != 0)
    name = np.empty(len(cover), np.int64)
    name[order] = np.concatenate([[1], 1 + np.cumsum(step)])
    if name.max() < len(cover):
        order = suffix_array(name)
    rank = np.zeros(n + 3, np.int64)
    rank[cover[order]] = np.arange(1, len(cover) + 1)
    sampled = cover[order]
    sampled = sampled[sampled < n]
    # the remaining suffixes: first symbol, then the rank behind it
    zero = np.arange(0, n, 3)
    wide = n + 3
    zero = zero[np.argsort(t[zero] * wide + rank[zero + 1], kind="stable")]
    # merge: how many sampled suffixes of either kind come before each remaining one
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(t[ones] * wide + rank[ones + 1], t[zero] * wide + rank[zero + 1])
    if len(twos):
        both = np.concatenate([twos, zero])
        _, pairs = np.unique(t[both] * top + t[both + 1], return_inverse=True)
        key = pairs * wide + rank[both + 2]
        before = before + np.searchsorted(key[: len(twos)], key[len(twos) :])
    out = np.empty(n, np.int64)
    spot = before + np.arange(len(zero))
    rest = np.ones(n, bool)
    rest[spot] = False
    out[spot] = zero
    out[rest] = sampled
    return out


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... size[0] of them, then those of begin[1], and so on."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def gather(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes text[begin : begin + size] of all items, end to end; positions are held for a lot at a time."""
    out, at = np.empty(int(size.sum()), np.uint8), 0
    for i, j in lots(size):
        got = text[spread(begin[i:j], size[i:j])]
        out[at : at + len(got)] = got
        at += len(got)
    return out


def collapse(head: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (heads, bytes end to end) without those that equal another, byte by byte, and marks for all but the first in the corpus."""
    size = head["n"].astype(np.int64) + length - 1
    begin = np.cumsum(size) - size
    same = np.concatenate([span_hash(prefix_hash(text[begin[i] : begin[j - 1] + size[j - 1]]), begin[i:j] - begin[i], begin[i:j] - begin[i] + size[i:j]) for i, j in lots(size)]) if len(head) else np.zeros(0, U)
    order = np.lexsort((head["at"], head["tie"], head["doc"], same))
    twin = np.zeros(len(order), bool)
    twin[1:] = same[order][1:] == same[order][:-1]
    # a hash may lie, bytes do not: a piece is dropped only if it equals the first of its hash
    first = order[np.flatnonzero(~twin)[np.cumsum(~twin) - 1]] if len(order) else order
    at = np.flatnonzero(twin & (size[order] == size[first]))
    equal = np.zeros(len(order), bool)
    for i, j in lots(size[order[at]]):
        a, b = order[at[i:j]], first[at[i:j]]
        differ = np.add.reduceat(text[spread(begin[a], size[a])] != text[spread(begin[b], size[b])], np.cumsum(size[a]) - size[a])
        equal[at[i:j]] = differ == 0
    gone, of = order[equal], first[equal]
    itself = (head["doc"][gone] == head["doc"][of]) & (head["tie"][gone] == head["tie"][of]) & (head["at"][gone] == head["at"][of])
    left = np.ones(len(head), bool)
    left[gone] = False
    left = np.flatnonzero(left)
    return head[left], gather(text, begin[left], size[left]), marks(head[gone[~itself]], False)


def lots(size: np.ndarray, most: int = LOT // 2) -> Iterator[tuple[int, int]]:
    """Consecutive items of about `most` bytes in all."""
    end = np.cumsum(size)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + most, "right")))
        yield i, j
        i = j


def repeats_among(head: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Windows of the pieces that start earlier too, as marks. text: the pieces' bytes, end to end."""
    head, text, whole = collapse(head, text, length)
    out = [join_spans(whole)]
    order = np.argsort(head["key"], kind="stable")
    new = np.ones(len(head), bool)
    new[1:] = head["key"][order][1:] != head["key"][order][:-1]
    size = head["n"].astype(np.int64) + length - 1
    begin = np.cumsum(size) - size
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(head)))
    order, first, count = order[np.repeat(count > 1, count)], None, count[count > 1]
    # whole keys to a lot
    by_key = np.add.reduceat(size[order], np.cumsum(count) - count) if len(count) else np.zeros(0, np.int64)
    to = np.concatenate([[0], np.cumsum(count)])
    for i, j in lots(by_key, LOT):
        pick = order[to[i] : to[j]]
        out.append(sorted_repeats(head[pick], gather(text, begin[pick], size[pick]), length))
    return np.concatenate(out)


def sorted_repeats(head: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """The same by the suffix array of all pieces: neighbours that share `length` bytes are equal windows."""
    size = head["n"].astype(np.int64) + length - 1
    at = np.cumsum(size) - size
    sa = suffix_array(text.astype(np.int64) + 1)
    n_win = head["n"].astype(np.int64)
    row = np.repeat(np.arange(len(head)), n_win)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    where = np.full(len(text), -1, np.int64)
    where[at[row] + step] = np.arange(len(row))
    spots = sa[where[sa] >= 0]
    same = np.zeros(len(spots), bool)
    reach = np.arange(length)
    block = max(1, (5 << 20) // length)
    for i in range(1, len(spots), block):
        j = min(len(spots), i + block)
        near = text[spots[i - 1 : j, None] + reach]
        same[i:j] = (near[1:] == near[:-1]).all(1)
    w = where[spots]
    doc, tie, start, group = head["doc"][row[w]], head["tie"][row[w]], head["at"][row[w]].astype(np.int64) + step[w], np.cumsum(~same)
    order = np.lexsort((start, tie, doc, group))
    doc, tie, start, group = doc[order], tie[order], start[order], group[order]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[first]) | (tie != tie[first]) | (start != start[first])
    out = np.zeros(int(later.sum()), MARK)
    out["doc"], out["tie"], out["at"], out["n"] = doc[later], tie[later], start[later], 1
    return join_spans(out)


def rows_of(doc: np.ndarray, tie: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, row): document i, given by id and tie, stands in that row, each in order of i. A document may have several rows or none."""
    known, rank = np.unique(ids, return_inverse=True)
    key = rank.astype(np.int64) << 32 | tags
    order = np.argsort(key, kind="stable")
    spot = np.minimum(np.searchsorted(known, doc), max(len(known) - 1, 0))
    there = known[spot] == doc if len(known) else np.zeros(len(doc), bool)
    wanted = np.where(there, spot.astype(np.int64) << 32 | tie, -1)
    lo, hi = np.searchsorted(key[order], wanted), np.searchsorted(key[order], wanted, "right")
    return np.repeat(np.arange(len(doc)), hi - lo), order[spread(lo, hi - lo)]


def pieces_of(table: pa.Table, asked: np.ndarray, length: int, hot: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the asked runs (heads, bytes end to end) and, of runs with a hot anchor, a run for every window instead."""
    ids = table["doc_id"].to_numpy()
    rows = np.flatnonzero(np.isin(ids, np.unique(asked["doc"])))
    own = table.take(pa.array(rows)).combine_chunks()["text"]
    ids = ids[rows]
    tags = np.concatenate([np.zeros(0, np.uint32), *(ties(buf, offs) for _, _, buf, offs in slices(own, 1 << 22))])
    which, row = rows_of(asked["doc"], asked["tie"], ids, tags)
    once = np.unique(which, return_index=True)[1]  # equal rows of one document: the first will do
    which, row = which[once], row[once]
    order = np.lexsort((asked["at"][which], row))
    asked, row = asked[which[order]], row[order]
    for i, j, buf, offs, base, mine in stretches(own, 1 << 19, 0xFFFF + length):
        lo, hi = np.searchsorted(row, [i, j])
        a, r = asked[lo:hi], row[lo:hi] - i
        start = a["at"].astype(np.int64) - base
        take = np.flatnonzero((start >= 0) & (start < mine)) if base or mine < len(buf) else np.arange(len(a))
        a, r, start = a[take], r[take], start[take]
        if not len(a):
            continue
        sums = prefix_hash(buf)
        s0, n = offs[r] + start, a["n"].astype(np.int64)
        if level:
            key = span_hash(sums, s0, s0 + length)  # of one window
        else:
            anchor = s0 + a["off"].astype(np.int64)
            key = mix((sums[anchor + GRAM] - sums[anchor]) * powers(len(sums))[1][anchor])
        fine = np.isin(key, hot) if len(hot) else np.zeros(len(a), bool)
        windows = np.zeros(int(n[fine].sum()), RUN)
        if len(windows):
            for k in ("doc", "tie"):
                windows[k] = np.repeat(a[k][fine], n[fine])
            begin = spread(s0[fine], n[fine])
            windows["h"], windows["n"], windows["many"] = span_hash(sums, begin, begin + length), 1, 1
            windows["at"] = spread(a["at"][fine].astype(np.int64), n[fine])
        a, s0, n, key = a[~fine], s0[~fine], n[~fine], key[~fine]
        head = np.zeros(len(a), PIECE)
        for k in ("doc", "tie", "at", "n"):
            head[k] = a[k]
        head["key"] = mix(key)
        yield head, gather(buf, s0, n + length - 1), windows


def spans_of(m: np.ndarray, which: np.ndarray, row: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the marks cover: row, begin, end."""
    a = m["at"][which].astype(np.int64)
    z = np.minimum(a + m["n"][which].astype(np.int64) - 1 + length, size[row])
    order = np.lexsort((a, row))
    a, z, row = a[order], z[order], row[order]
    if not len(a):
        return row, a, z
    far = int(size.max()) + 2  # rows laid end to end with room between them
    reach = np.maximum.accumulate(z + row * far)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] + row[1:] * far > reach[:-1]
    first = np.flatnonzero(new)
    return row[first], a[first], np.maximum.reduceat(z, first)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", digests: bool = True) -> DataFrame:
    """Remove each byte that a `length`-byte string covers which also starts earlier (smaller id, or earlier in the same text).

    With `digests`: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the rest. Without:
    all columns of docs, the text replaced by what is left (bytes that no longer form a character are dropped).
    Strings are judged on the input and overlaps count. Null texts are empty; texts shorter than `length`
    keep all; repeated rows of an id with equal texts are one document and do not repeat each other, other texts of one id are
    documents of their own (ordered by crc32 of the text); rows with a null id keep all; very long texts are worked on a stretch
    at a time; an empty table gives an empty result. In digest form other columns are left out. `length` is from GRAM to 65,535.
    """
    if not GRAM <= length <= 0xFFFF:
        raise ValueError(f"length must be {GRAM} at least and 65535 at most")
    spark = docs.sparkSession
    parts = 2 * tasks_for(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.where("doc_id is not null and text is not null")
    out_schema = "part int, kind int, n long, data binary"

    def send(part: list[int], kind: list[int], n: list[int], data: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["part", "kind", "n", "data"])

    def row_batch(kind: int, part: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        p, data = packed(part, of)
        return send(p, [kind] * len(p), [0] * len(p), data)

    def mark_batch(*m: np.ndarray) -> pa.RecordBatch:
        every = np.concatenate(m)
        return row_batch(MARKS, bucket_of(every["doc"], parts), every)

    def run_batches(runs: np.ndarray) -> Iterator[pa.RecordBatch]:
        """One run of each anchor to its range; those that met here are asked about already."""
        one, single, _ = meet(runs)
        yield row_batch(RUNS, by_range(mix(one["h"]), parts), one)
        yield mark_batch(marks(single, True))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            tag = np.concatenate([np.zeros(0, np.uint32), *(ties(buf, offs) for _, _, buf, offs in slices(batch.column(1), 1 << 22))])
            for i, j, buf, offs, base, own in stretches(batch.column(1), 1 << 19, length - 1):
                held.append(runs_of(buf, offs, ids[i:j], tag[i:j], length, base, own))
                if sum(map(len, held)) > FLUSH:
                    yield from run_batches(np.concatenate(held))
                    held.clear()
        if held:
            yield from run_batches(np.concatenate(held))

    def unpack(table: pa.Table, kind: int, of: np.dtype) -> np.ndarray:
        data = table.filter(pa.compute.equal(table["kind"], kind))["data"].to_pylist()
        return np.concatenate([np.zeros(0, of), *(np.frombuffer(d, of) for d in data)])

    def passed_on(table: pa.Table) -> list[pa.RecordBatch]:
        """Marks from the tasks: part is their bucket already."""
        return table.filter(pa.compute.equal(table["kind"], MARKS)).to_batches()

    def met_runs(table: pa.Table) -> list[pa.RecordBatch]:
        runs = unpack(table, RUNS, RUN)
        one, single, met = meet(runs)
        often = one[one["many"] > HOT]
        count = np.zeros(len(often), np.dtype([("h", "u8"), ("many", "u8")]))
        count["h"], count["many"] = often["h"], often["many"]
        return [mark_batch(marks(single, True)), send([0], [COUNTS], [int(one["many"].sum())], [count.tobytes()])]

    def meeting(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([*passed_on(table), *met_runs(table)])

    met = keep(known.mapInArrow(anchors, out_schema).groupBy("part").applyInArrow(meeting, out_schema), "repeats")
    sweep(spark)
    counts = met.where(f"kind = {COUNTS}")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(HOT, total >> 20)

    def hottest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in b.column(0).to_pylist():
                c = np.frombuffer(d, np.dtype([("h", "u8"), ("many", "u8")]))
                yield pa.RecordBatch.from_arrays([pa.array(c["h"][c["many"] > least].view(np.int64))], ["h"])

    found = counts.select("data").mapInArrow(hottest, "h long").toArrow()["h"].to_numpy()  # 2^20 at most, as all have a 2^-20th of the total
    hot = np.unique(found.astype(np.int64).view(U))
    shared = spark.sparkContext.broadcast(hot)

    def with_bucket(df: DataFrame) -> DataFrame:
        def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0)
                part = bucket_of(ids.fill_null(0).to_numpy(), parts)
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *b.columns], ["part", *b.schema.names])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(bucketed, f"part int, {fields}")

    def asker(level: int):
        def ask(texts: pa.Table, told: pa.Table) -> pa.Table:
            m = unpack(told, MARKS, MARK)
            heads, bodies, windows = [np.zeros(0, PIECE)], [np.zeros(0, np.uint8)], [np.zeros(0, RUN)]
            for head, body, single in pieces_of(texts, m[m["ask"] == 1], length, np.zeros(0, U) if level else shared.value, level):
                heads.append(head)
                bodies.append(body)
                windows.append(single)
            head, body, whole = collapse(np.concatenate(heads), np.concatenate(bodies), length)
            del heads, bodies
            size = head["n"].astype(np.int64) + length - 1
            begin = np.cumsum(size) - size
            part = by_range(head["key"], parts)
            order = np.argsort(part, kind="stable")
            cut = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(part)]]) if len(part) else np.zeros(1, int)
            p, data = [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                pick = order[a:b]
                p.append(int(part[pick[0]]))
                data.append(int(b - a).to_bytes(8, "little") + head[pick].tobytes() + gather(body, begin[pick], size[pick]).tobytes())
            return pa.Table.from_batches([send(p, [PIECES] * len(p), [0] * len(p), data), mark_batch(join_spans(whole)), *run_batches(np.concatenate(windows))])

        return ask

    def solve(table: pa.Table) -> pa.Table:
        heads, bodies = [np.zeros(0, PIECE)], [np.zeros(0, np.uint8)]
        for d in table.filter(pa.compute.equal(table["kind"], PIECES))["data"].to_pylist():
            n = int.from_bytes(d[:8], "little")
            heads.append(np.frombuffer(d, PIECE, n, 8))
            bodies.append(np.frombuffer(d, np.uint8, offset=8 + n * PIECE.itemsize))
        m = repeats_among(np.concatenate(heads), np.concatenate(bodies), length)
        return pa.Table.from_batches([*passed_on(table), *met_runs(table), mark_batch(m)])

    texts = with_bucket(known)

    def solved(asked: DataFrame, level: int) -> DataFrame:
        pieces = texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(asker(level), out_schema)
        out = keep(pieces.groupBy("part").applyInArrow(solve, out_schema).where(f"kind = {MARKS}"), "solved")
        sweep(spark)
        return out

    all_marks = solved(met.where(f"kind = {MARKS}"), 0)
    if len(hot):
        all_marks = all_marks.unionByName(solved(all_marks, 1))

    # the documents' own columns travel under numbers: no name of theirs can clash with ours
    full = rows if digests else docs.select(F.col(id_col).cast("long").alias("_id"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)])
    names = ["_id", *docs.columns]
    docs_columns = docs.columns
    text_at = 1 if digests else names.index(text_col)

    def finish(own: pa.Table, told: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        m = unpack(told, MARKS, MARK)
        m = m[m["ask"] == 0]
        id_column = own.column(1)
        blank = id_column.is_null().to_numpy(zero_copy_only=False)
        col = own.column(1 + text_at)
        buf, offs = raw_column(col)
        which, row = rows_of(m["doc"], m["tie"], id_column.fill_null(0).to_numpy(), ties(buf, offs))
        which, row = which[~blank[row]], row[~blank[row]]
        size = np.diff(offs)
        at, a, z = spans_of(m, which, row, size, length)
        raw = memoryview(np.ascontiguousarray(buf)).cast("B") if len(buf) else memoryview(b"")
        first = np.searchsorted(at, np.arange(len(size) + 1)).tolist()
        a, z = a.tolist(), z.tolist()

        def left(k: int) -> Iterator[memoryview]:
            here, end = int(offs[k]), int(offs[k + 1])
            to = here
            for i in range(first[k], first[k + 1]):
                yield raw[to : here + a[i]]
                to = here + z[i]
            yield raw[to:end]

        if not digests:
            old = col.to_pylist()
            text = [o if first[k] == first[k + 1] else b"".join(left(k)).decode("utf-8", "ignore") for k, o in enumerate(old)]
            return pa.Table.from_arrays([pa.array(text, pa.string()) if k == text_at else own.column(1 + k) for k in range(1, 1 + len(docs_columns))], names=docs_columns)
        digest = []
        for k in range(len(size)):
            h = hashlib.sha256()
            for piece in left(k):
                h.update(piece)
            digest.append(h.hexdigest())
        removed = np.bincount(at, np.array(z, np.int64) - np.array(a, np.int64), minlength=len(size)).astype(np.int64)
        return pa.Table.from_arrays([id_column, pa.array(size.astype(np.int64)), pa.array(removed), pa.array(np.diff(first).astype(np.int64)), pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    if digests:
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    else:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return with_bucket(full).groupBy("part").cogroup(all_marks.groupBy("part")).applyInArrow(finish, schema)
