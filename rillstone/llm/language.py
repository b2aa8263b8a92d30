"""Language identification: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, U, WINDOW, mix, prefix_hash, slices, span_hash, stretches, word_hashes, words
from .samples import MOST_BYTES, remainder, within

#: Hashed features; texts of each language that the fit reads at most.
DIMS, SAMPLE_ROWS = 1 << 13, 800
#: Texts that the fit reads in all, so that their features fit the driver; fewer of each language if there are many, but one.
MOST_TEXTS = 4000
#: Texts whose features are held at once, however short they are.
ROWS = 256
# Language families of ISO 639-1 codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nb", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("zh",),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    """A code's family; an unlisted code (its part before - or _) is a family of its own."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, code)


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of unit length per document: damped counts of hashed byte runs of 1 to 4 and of words, lower-cased."""
    n_docs = len(offs) - 1
    if n_docs == 1 and len(buf) > 4 * WINDOW:
        out = sum(_byte_runs(LOWER[buf[a : a + WINDOW + 3]], np.array([0, min(len(buf) - a, WINDOW + 3)]), WINDOW) for a in range(0, len(buf), WINDOW))
        h, first = word_hashes(buf, LOWER), None
    else:
        low = LOWER[buf]
        out = _byte_runs(low, offs, len(buf))
        starts, ends, first = words(low, offs)
        h = span_hash(prefix_hash(low), starts, ends)
    at = (mix(h + U(5)) >> U(64 - 13)).astype(np.int64)
    if first is not None:
        at += np.repeat(np.arange(n_docs, dtype=np.int64) * DIMS, np.diff(first))
    out = out + 2 * np.bincount(at, minlength=len(out)).astype(np.float32)
    x = np.sqrt(out.reshape(n_docs, DIMS))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _byte_runs(low: np.ndarray, offs: np.ndarray, own: int) -> np.ndarray:
    """Counts of each document's runs of 1 to 4 bytes that begin at one of the first `own` bytes, end to end."""
    out = np.zeros((len(offs) - 1) * DIMS, np.float32)
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.int64) * DIMS, np.diff(offs))
    code = low.astype(np.uint32)
    run = code.copy()
    for k in range(1, 5):
        if k > 1:
            if len(run) < 2:
                break
            run = run[:-1] << np.uint32(8) | code[k - 1 :]
        slot = ((run + np.uint32(k)) * np.uint32(2654435761)) >> np.uint32(32 - 13)
        inside = doc[k - 1 :] == doc[: len(run)]
        inside[own:] = False
        at = doc[: len(run)] + slot
        out += np.bincount(at[inside], minlength=len(out)).astype(np.float32)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """L2-loss linear SVM by dual coordinate descent; y is -1 or 1. The last weight is the bias."""
    r = np.random.default_rng(seed)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    a = np.zeros(len(y))
    cost = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)) * c
    for _ in range(epochs):
        for i in r.permutation(len(y)):
            g = y[i] * (w @ x[i] + b) - 1 + a[i] / (2 * cost[i])
            new = max(0.0, a[i] - g / (2.0 + 1 / (2 * cost[i])))
            if new != a[i]:
                d = (new - a[i]) * y[i]
                w += np.float32(d) * x[i]
                b += d
                a[i] = new
    return np.append(w, np.float32(b))


class Languages:
    """families: one against the rest; pairs: languages of one family against each other."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.names = sorted(set(langs))
        x = np.empty((len(texts), DIMS), np.float32)
        for i, j, buf, offs in slices(pa.array(texts, pa.string()), 1 << 18, ROWS):
            x[i:j] = features(buf, offs)
        lang, fam = np.array(langs, object), np.array([family(v) for v in langs], object)
        self.families = sorted(set(fam))
        self.members = [[i for i, v in enumerate(self.names) if family(v) == f] for f in self.families]
        two = len(self.families) == 2
        self.outer = np.array([linear_svm(x, np.where(fam == f, 1, -1)) for f in (self.families[:1] if two else self.families)]) if len(self.families) > 1 else None
        if two:
            self.outer = np.vstack([self.outer, -self.outer])
        self.pairs = [(a, b) for m in self.members for a, b in combinations(m, 2)]
        self.inner = []
        for a, b in self.pairs:
            own = np.flatnonzero((lang == self.names[a]) | (lang == self.names[b]))
            self.inner.append(linear_svm(x[own], np.where(lang[own] == self.names[a], 1, -1)))

    def predict(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into names, and a probability: the family's times the weakest of the winner's duels."""
        x = features(buf, offs)
        n = len(x)
        chance = lambda m: 1 / (1 + np.exp(-np.clip(3 * m, -35, 35)))
        if self.outer is None:
            f, sure = np.zeros(n, np.int64), np.ones(n)
        else:
            m = x @ self.outer[:, :-1].T + self.outer[:, -1]
            f, sure = m.argmax(1), chance(m.max(1))
        votes, weakest = np.zeros((n, len(self.names))), np.ones((n, len(self.names)))
        for (a, b), w in zip(self.pairs, self.inner, strict=True):
            p = chance(x @ w[:-1] + w[-1])
            for k, q in ((a, p), (b, 1 - p)):
                votes[:, k] += (q > 0.5) + q / 1000
                weakest[:, k] = np.minimum(weakest[:, k], q)
        home = np.zeros((len(self.families), len(self.names)), bool)
        for k, m in enumerate(self.members):
            home[k, m] = True
        best = np.where(home[f], votes, -1).argmax(1)
        return best, sure * weakest[np.arange(n), best]


def has_letter(col: pa.Array) -> np.ndarray:
    out = np.zeros(len(col), bool)
    plain = np.zeros(256, bool)
    plain[[*range(65, 91), *range(97, 123)]] = True
    for i, _, buf, offs, _, _ in stretches(col, 1 << 20, 0):
        total = np.concatenate([[0], np.cumsum(plain[buf], dtype=np.int32)])
        out[i : i + len(offs) - 1] |= total[offs[1:]] > total[offs[:-1]]
    for k in np.flatnonzero(~out):
        text = col[int(k)].as_py()
        out[k] = bool(text) and any(ch.isalpha() for ch in text)
    return out


def identify(docs: DataFrame, learn_from: DataFrame | None = None, may_learn: Column | None = None, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """The carried columns (by default the id and held_out) with lang_pred and score (0 to 1) of every whole text.

    Learns from about `sample_rows` texts (`MOST_TEXTS` in all, one of each language at least) of every language, rows
    whose crc32(id) mod 4 is not 2 and whose text and lang are not null. Null texts and texts without a
    letter are `und` with score 0; so is everything if there is nothing to learn from. Repeated rows are
    judged each, very long texts whole but a window at a time, ties go to the first language or family by name; empty
    tables give empty results.
    """
    source = docs if learn_from is None else learn_from
    usable = F.coalesce(remainder(id_col, 4) != 2, F.lit(False)) if may_learn is None else may_learn
    rows = source.where(usable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(17), id_col), 11) * F.lit(2.0**-53)
    counts = rows.groupBy(F.col(lang_col).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least")).collect()
    texts, langs = [], []
    if counts:
        # one text of each language, so that none is missed by chance or for bytes, at its full length unless that is beyond its part of MOST_BYTES
        more = max(1, min(sample_rows, MOST_TEXTS // len(counts))) - 1
        shares = docs.sparkSession.createDataFrame([(r["label"], r["least"], more / r["n"]) for r in counts], "label string, least double, share double")
        dealt = rows.select(F.xxhash64(id_col).alias("h"), draw.alias("draw"), F.col(lang_col).alias("label"), F.col(text_col).alias("text")).join(F.broadcast(shares), "label")
        chars = max(1, MOST_BYTES // (4 * len(counts)))
        heads = dealt.where("draw = least").select("label", F.left("text", F.lit(chars)).alias("text")).groupBy("label").agg(F.min("text").alias("text")).collect()
        # and rows whose hashed id is under their language's share: one scan, about sample_rows of each language
        left = max(0, MOST_BYTES - sum(len(r["text"].encode()) for r in heads))
        got = within(dealt.where("draw > least and draw < share").select("h", "label", "text"), 2 * more * len(counts), left) if more else []
        texts, langs = [*(r["text"] for r in heads), *(r[2] for r in got)], [*(r["label"] for r in heads), *(r[1] for r in got)]
    model = docs.sparkSession.sparkContext.broadcast(Languages(texts, langs) if texts else None)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            col = batch.column(0)
            pick, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            if m is not None:
                for i, j, buf, offs in slices(col, 1 << 18, max(1, min(ROWS, (1 << 21) // len(m.names)))):
                    pick[i:j], score[i:j] = m.predict(buf, offs)
            ok = has_letter(col) & (m is not None)
            names = pa.array([*(m.names if m is not None else []), "und"], pa.string())
            pred = names.take(pa.array(np.where(ok, pick, len(names) - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1 if not text_kept else 0 :], pred, pa.array(np.where(ok, np.clip(score, 0, 1), 0.0))], names=out_names)

    text_kept = text_col in carry
    if carry:
        rest = [F.col(c) for c in carry if c != text_col]
    else:
        rest = [F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col, 4) == 2, F.lit(False)).alias("held_out")]
    given = docs.select(F.col(text_col), *rest)
    kept = given.schema.fields if text_kept else given.schema.fields[1:]
    out_names = [f.name for f in kept] + ["lang_pred", "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double"
    return given.mapInArrow(judged, schema)
