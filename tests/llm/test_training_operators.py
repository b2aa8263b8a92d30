import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, part int, kept boolean, key string, h long"


def docs(spark, texts, source=None, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", (source[i] if source else "s"), None, "x", 1, True, "k", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(r, n, words=400):
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


# ---------------------------------------------------------------- sharding


def test_sharding(spark):
    from rillstone.llm.sharding import shard_documents

    r = random.Random(1)
    texts = [prose(r, r.randrange(1, 40)) for _ in range(600)] + ["same text"] * 300 + [None, "", "é"]
    got = shard_documents(docs(spark, texts), shards=7).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert (got["size"][i], got["text_crc32"][i]) == (len(raw) + 16, zlib.crc32(raw))
    assert got[600:900]["shard"].nunique() == 1
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    per = got.groupby("shard")["size"].sum()
    largest = max(got.groupby("text_crc32")["size"].sum().max(), 0)
    assert per.max() <= got["size"].sum() / 7 + largest + 1
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()


def test_sharding_is_minimax(spark):
    from rillstone.llm import sharding

    r = random.Random(3)
    sizes = [r.randrange(1, 50) for _ in range(40)]
    plan = sharding._plan(spark.createDataFrame(list(enumerate(sizes)), "unit int, bytes long"), 5).toPandas().set_index("unit")["shard"]
    falling = sorted(range(40), key=lambda u: (-sizes[u], u))
    order = [falling[i] for turn in range(5) for i in range(turn, 40, 5)]
    shard, sizes = [plan[u] for u in order], [sizes[u] for u in order]
    loads = [sum(s for s, k in zip(sizes, shard) if k == j) for j in range(5)]
    assert shard == sorted(shard)

    def shards_for(cap):
        n, used = 1, 0
        for s in sizes:
            n, used = (n, used + s) if used + s <= cap else (n + 1, s)
        return n

    assert max(loads) == next(c for c in range(max(sizes), sum(sizes) + 1) if shards_for(c) <= 5)


def test_sharding_around_large_groups(spark):
    from rillstone.llm import sharding

    r = random.Random(4)
    rest = [r.randrange(30, 90) for _ in range(800)]
    for large in ([sum(rest) // 2], [sum(rest) // 2, sum(rest) // 4, sum(rest) // 9, sum(rest) // 9]):  # the first: a third of all
        sizes = rest + large
        plan = sharding._plan(spark.createDataFrame(list(enumerate(sizes)), "unit int, bytes long"), 40).toPandas()
        loads = [sum(sizes[u] for u in g["unit"]) for _, g in plan.groupby("shard")]
        share = sum(rest) / (40 - len(large))
        assert len(loads) == 40 and len(plan) == len(sizes)
        assert min(loads) > 0.9 * share and max(loads) == max(large)
        assert sorted(loads)[-len(large) - 1] < 1.1 * share


def test_sharding_of_nothing(spark):
    from rillstone.llm.sharding import shard_documents

    assert shard_documents(docs(spark, []), shards=4).count() == 0


# ---------------------------------------------------------------- mixing


def fair_targets(sizes, weights, limit=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > limit * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mixing(spark):
    from rillstone.llm.mixing import mix_documents

    r = random.Random(2)
    source = [r.choice(["b", "a", "é", None, "z"]) if i % 3 else "hot" for i in range(900)]
    texts = [prose(r, r.randrange(0, 30)) for _ in source]
    texts[5], texts[6] = None, ""
    d = docs(spark, texts, source)
    got = mix_documents(d).toPandas()
    sizes = {}
    for t, s in zip(texts, source):
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fair_targets(sizes, (1, 2, 3))
    for s, g in got.groupby("source", dropna=False):
        s = None if s is None or s != s else s
        assert g["target"].iloc[0] == pytest.approx(want[s])
        assert g["source_size"].iloc[0] == sizes[s]
        assert abs(g["taken"].sum() - want[s]) <= 31
    assert (got["taken"] <= 3 * got["size"]).all() and (got["taken"] == got["copies"] * got["size"]).all()
    again = mix_documents(d.repartition(7)).toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    assert mix_documents(docs(spark, [])).count() == 0
    assert mix_documents(docs(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0


@pytest.mark.parametrize("given", [False, True])
def test_mixing_takes_the_smallest_keys(spark, monkeypatch, given):
    """Which documents are taken, held against plain Efraimidis-Spirakis sampling."""
    import xxhash

    from rillstone.llm import mixing

    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    monkeypatch.setattr(mixing, "BLOCK_RANGES", 3)
    r = random.Random(22)
    source = [r.choice(["a", "b", "c", None]) if i % 3 else "hot" for i in range(700)]
    texts = [prose(r, r.randrange(0, 30)) for _ in source]
    weight = [r.choice([0.1, 0.5, 1.0, 2.0, 7.5]) for _ in source]
    d = docs(spark, texts, source).join(spark.createDataFrame(list(enumerate(weight)), "doc_id long, w double"), "doc_id")
    got = {x["doc_id"]: x["copies"] for x in mixing.mix_documents(d, quality_col="w" if given else None).collect()}
    size = [len(t.split()) for t in texts]
    q = weight if given else [1 / (1 + abs(len(t) / max(1, n) - 6) / 6) for t, n in zip(texts, size)]
    little = lambda v, n: v.to_bytes(n, "little")
    u = [((xxhash.xxh64_intdigest(little(i, 8), xxhash.xxh64_intdigest(little(42, 4), 42)) >> 11) + 0.5) * 2.0**-53 for i in range(len(texts))]
    key = [-math.log(a) / b for a, b in zip(u, q)]
    per = {s: sum(n for n, t in zip(size, source) if t == s) for s in set(source)}
    for s, target in fair_targets(per, (1, 2, 3)).items():
        own = sorted((k for k in range(len(texts)) if source[k] == s), key=lambda k: key[k])
        epochs = int(target / per[s] + 1e-12)
        rest, before = target - epochs * per[s], 0
        for k in own:
            before += size[k]
            assert got[k] == min(3, epochs + (before - size[k] / 2 <= rest)), (s, k)


def test_mixing_stops_at_three_times(spark):
    from rillstone.llm.mixing import mix_documents

    texts = ["a b"] * 4 + [prose(random.Random(1), 50) for _ in range(40)]
    source = ["z"] * 4 + ["a"] * 40  # z weighs 2 of 3 and would get far more than three times its size
    got = mix_documents(docs(spark, texts, source)).toPandas()
    assert set(got[got["source"] == "z"]["taken"]) == {6}


# ---------------------------------------------------------------- repeated passages


def repeats_oracle(rows, length):
    """Rows (id, text) -> id and text to counts and hash; texts of one id in order of their crc32, equal rows once."""
    seen, out = {}, {}
    for i, _, b in sorted({(i, zlib.crc32((t or "").encode()), (t or "").encode()) for i, t in rows}):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            else:
                seen[w] = 1
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i, b] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check_repeats(spark, texts, length, ids=None):
    from rillstone.llm.suffixes import remove_repeats

    ids = list(range(len(texts))) if ids is None else ids
    got = sorted(tuple(x) for x in remove_repeats(docs(spark, texts, ids=ids), length=length).collect())
    want = repeats_oracle(zip(ids, texts), length)
    assert got == sorted((i, *want[i, (t or "").encode()]) for i, t in zip(ids, texts))


@pytest.mark.parametrize("seed", range(3))
def test_repeats(spark, seed):
    r = random.Random(seed)
    parts = [prose(r, 30, 8) for _ in range(6)] + ["Licensed under some long and well known licence, version 2 of it."]
    texts = [None, "", "short", "ab" * 200, "ü" * 150]
    for _ in range(60):
        t = " ".join(r.choice([r.choice(parts), prose(r, r.randrange(1, 25), 9)]) for _ in range(r.randrange(1, 6)))
        texts.append(t)
    texts += [texts[7], texts[7][:150] + "!" + texts[7][150:]]
    check_repeats(spark, texts, 100)


@pytest.mark.parametrize("length", [40, 60, 254, 294, 295, 400])
def test_repeats_of_any_length(spark, length):
    r = random.Random(length)
    parts = [prose(r, 2 * length // 3, 30) for _ in range(4)]
    texts = [" ".join(r.choice([r.choice(parts), prose(r, 20, 9), r.choice(parts)[: r.randrange(length)]]) for _ in range(4)) for _ in range(20)] + ["ab" * length]
    check_repeats(spark, texts, length)


def test_repeats_under_one_id(spark):
    r = random.Random(12)
    a, b, c = (prose(r, 70, 5000) for _ in range(3))
    check_repeats(spark, [a, a[:200] + " " + c[:150], b, b, a, c + b], 100, ids=[0, 1, 1, 1, 2, 2])


@pytest.mark.parametrize("most", [2, 5])
def test_repeats_of_hot_anchors(spark, monkeypatch, most):
    from rillstone.llm import suffixes

    monkeypatch.setattr(suffixes, "HOT", most)
    r = random.Random(13)
    line = prose(r, 25, 3000)
    texts = [" ".join([prose(r, r.randrange(30), 500), line[r.randrange(9) :], prose(r, r.randrange(30), 500)]) for _ in range(60)] + ["x" * 400, None, line, line]
    check_repeats(spark, texts, 100)


def test_repeats_in_stretches(spark, monkeypatch):
    from rillstone.llm import kernels, suffixes

    r = random.Random(14)
    part = prose(r, 60, 5000)
    texts = [" ".join([prose(r, 300, 5000), part, prose(r, 400, 5000), part, prose(r, 50, 5000)]), part, prose(r, 100, 5000) + " " + part]
    monkeypatch.setattr(kernels, "WINDOW", 512)
    import pyarrow as pa

    ids = np.arange(3)
    whole = [k for _, _, buf, offs in kernels.slices(pa.array(texts)) for k in suffixes.runs_of(buf, offs, ids, suffixes.ties(buf, offs), 100)]
    parted = [k for i, j, buf, offs, base, own in kernels.stretches(pa.array(texts), 1, 99) for k in suffixes.runs_of(buf, offs, ids[i:j], ids[i:j], 100, base, own)]
    windows = lambda runs: sorted((int(x["doc"]), int(x["at"]) + k, int(x["h"]), int(x["at"]) + int(x["off"])) for x in runs for k in range(x["n"]))
    assert windows(whole) == windows(parted) and len(parted) > len(whole)


def test_a_line_in_many_texts_keeps_memory(spark):
    """What one range gets of a 110-byte line in 20,000 texts, sorted in one process."""
    import tracemalloc

    from rillstone.llm import suffixes

    r = np.random.default_rng(15)
    line = r.integers(97, 123, 110).astype(np.uint8)
    n, windows = 20_000, 61
    body = r.integers(97, 123, (n, windows + 99)).astype(np.uint8)
    body[:, 20:130] = line
    head = np.zeros(n, suffixes.PIECE)
    head["doc"], head["n"], head["key"] = np.arange(n), windows, 5
    tracemalloc.start()
    m = suffixes.repeats_among(head[:8192], body[:8192].ravel(), 100)  # as many runs as an anchor may have before its windows spread out
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
    assert int(m["n"].sum()) >= 8191 * 11 and set(m["doc"].tolist()) == set(range(1, 8192))


def test_repeats_as_documents(spark):
    from rillstone.llm.suffixes import remove_repeats

    a = prose(random.Random(4), 60)
    d = docs(spark, [a, "start " + a + " end", None])
    out = {r["doc_id"]: r for r in remove_repeats(d, digests=False).collect()}
    assert out[0]["text"] == a and out[2]["text"] is None
    assert len(out[1]["text"]) < 30 and out[1]["text"].endswith(" end")
    assert out[1].asDict().keys() == {f.name for f in d.schema}
    assert remove_repeats(docs(spark, [])).count() == 0
    twice = remove_repeats(docs(spark, [a, a], ids=[1, 1])).collect()
    assert [r["n_removed"] for r in twice] == [0, 0]
    assert remove_repeats(docs(spark, [a, a], ids=[None, 3])).where("n_removed > 0").count() == 0


# ---------------------------------------------------------------- near-duplicates


def near_oracle(texts, percent=85):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= percent * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                a, b = sorted((comp[i], comp[j]))
                comp = [a if c == b else c for c in comp]
    return {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, comp))}


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates(spark, seed):
    from rillstone.llm.minhash import near_duplicates

    r = random.Random(seed)
    texts = [None, "", "  ", "two words", "Two  words", "three short words"]
    for _ in range(12):
        base = prose(r, r.randrange(30, 200)).split()
        for _ in range(r.randrange(1, 14)):
            w = list(base)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"x{r.randrange(99)}"
            texts.append(" ".join(w))
    texts += [texts[10]] * 20
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_duplicates(docs(spark, texts)).collect()}
    assert got == near_oracle(texts)


def test_near_stage_holds_from_four_fifths(spark):
    import corpus_pipeline as p
    from rillstone.llm.minhash import bands_for

    assert bands_for(85) == 24 and all((1 - (c / 100) ** 6) ** bands_for(c) <= 1.2e-5 for c in (50, 80, 85))
    r = random.Random(21)
    texts = []
    for g in range(30):
        text = prose(r, 200, 5000).split()
        for step in range(4):  # a chain: each differs from the one before by 4 words, a similarity of 0.81 or so
            texts.append(" ".join(text))
            for at in range(20 + 7 * step, 200, 46):
                text[at] = f"x{g}y{step}z{at}"
    want = near_oracle(texts, 80)
    assert want != near_oracle(texts, 85)
    got = {x["doc_id"] for x in p.STAGES[1][1](spark, docs(spark, texts), "").collect()}
    assert got == {i for i, (_, c) in want.items() if i == c}


def test_near_duplicates_of_nothing(spark):
    from rillstone.llm.minhash import near_duplicates

    assert near_duplicates(docs(spark, [])).count() == 0
    rows = near_duplicates(docs(spark, ["a b c d e f", "a b c d e f", None], ids=[4, 4, None])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (4, 4), (4, 4)]


# ---------------------------------------------------------------- packing


def test_packing(spark):
    from tokenizers import Tokenizer

    from rillstone.llm.packing import pack_documents
    from rillstone.llm.queries import tokenizer

    r = random.Random(5)
    texts = [prose(r, r.randrange(0, 200)) for _ in range(150)] + [None, "", "don't <|endoftext|> \x1f ab12,;é", prose(r, 900), "  "] + ["same words here"] * 20
    path = tokenizer("word_bpe_49k.json")
    got = pack_documents(docs(spark, texts), path, tokens=256).toPandas()
    t = Tokenizer.from_file(path)
    total = 0
    for i, text in enumerate(texts):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        own = got[got["doc_id"] == i].sort_values("piece")
        assert own["piece"].tolist() == list(range(math.ceil(len(ids) / 256)))
        for p in own.itertuples():
            part = ids[p.start : p.start + p.length]
            assert p.start == 256 * p.piece and len(part) == p.length and p.ids_crc32 == zlib.crc32(part.tobytes())
    bins = got.groupby("sequence_id")
    for _, g in bins:
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()][:-1] and g["length"].sum() <= 256
    assert bins.ngroups <= math.ceil(total / 256) * 1.05 + 1
    assert pack_documents(docs(spark, []), path).count() == 0


def test_tokens_by_word_equal_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from rillstone.llm.kernels import slices
    from rillstone.llm.packing import WordTokens
    from rillstone.llm.queries import tokenizer

    path = tokenizer("word_bpe_49k.json")
    whole, parts, r = Tokenizer.from_file(path), WordTokens(path), random.Random(1)
    letters = "aB1\u00e9's.,!<|>*-n\u0303\u0338\u0301\u03a3\u03c3\u1e9e \u0130\u200b\u4e2d\u0663\u00bd'd'LL#"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(4000)]
    texts += ["<|ENDOFTEXT|>", "<|endoftext|>", "A<|endoftext|>,b", "don't,", "we'RE!!", "x's,", "=\u0338", "a\u2260", "\x1f a\x1f"]
    for most in (1 << 10, 1 << 20):
        for i, j, buf, offs in slices(pa.array(texts), most):
            ids, at = parts.encode(buf, offs, 0)
            for k, e in zip(range(i, j), whole.encode_batch(texts[i:j], add_special_tokens=False)):
                assert ids[at[k - i] : at[k - i + 1]].tolist() == [*e.ids, 0], texts[k]


@pytest.mark.parametrize(("documents", "attention"), [(3, 10**9), (100, 3000), (2, 2600)])
def test_packing_keeps_every_capacity(documents, attention):
    from rillstone.llm.packing import plan_bins

    r = np.random.default_rng(1)
    lengths, counts = np.unique(r.integers(1, 50, 400), return_counts=True)
    bins, placed = {}, 0
    for length, first, n, per, start, offset in plan_bins(lengths, counts, 100, documents, attention):
        for k in range(n):
            bins.setdefault(start + k // per, []).append((offset + k % per * length, length))
            placed += 1
    assert placed == counts.sum()
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= 100 and len(own) <= documents and sum(n * n for _, n in own) <= attention


# ---------------------------------------------------------------- vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, leaf int, x string")


def odd_rows(dims):
    return [(9001, None, 1, 0, ""), (9002, [0.0] * dims, 1, 0, ""), (9003, [float("nan")] * dims, 1, 0, ""), (9004, [None] * dims, 1, 0, ""), (9005, [1.0], 1, 0, ""), (9006, [float("inf")] * dims, 1, 0, ""), (9007, [0.0] * dims, 1, 0, "")]


def test_vector_links(spark):
    from rillstone.llm.forest import near_duplicate_vectors

    r = np.random.default_rng(3)
    base = r.normal(size=(30, 16))
    rows = []
    for i in range(600):
        v = base[r.integers(30)] + 0.12 * r.normal(size=16) if i % 2 else r.normal(size=16)
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(3)) if i % 10 else None, 0, ""))
    rows += [(700 + i, rows[1][1], rows[1][2], 0, "") for i in range(5)]
    got = {x["vec_id"]: x for x in near_duplicate_vectors(vectors(spark, rows + odd_rows(16)), 0.93).collect()}
    x = np.array([v[1] for v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([-1 if v[2] is None else v[2] for v in rows])
    link = (x @ x.T >= 0.93) & (lab[:, None] == lab[None, :]) & (lab[:, None] >= 0)
    np.fill_diagonal(link, False)
    found = np.array([got[v[0]]["n_links"] for v in rows])
    assert (found <= link.sum(1)).all() and found.sum() >= 0.98 * link.sum()
    for v in odd_rows(16):
        assert tuple(got[v[0]]) == (v[0], 0, v[0], True)
    assert len(got) == len(rows) + 7
    assert near_duplicate_vectors(vectors(spark, [])).count() == 0
    assert near_duplicate_vectors(vectors(spark, odd_rows(4)[:2])).count() == 2


def test_nearest(spark):
    from rillstone.llm.kmtree import nearest

    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=12) * (1 + i % 3)], 0, 0, "") for i in range(1500)]
    rows[7] = (7, rows[3][1], 0, 0, "")
    got = nearest(vectors(spark, rows + odd_rows(12)), F.col("vec_id") % 20 == 0, k=10).toPandas()
    x = np.array([v[1] for v in rows])
    hit = 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -s))[:10]
        own = got[got["query_id"] == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and own["score"].is_monotonic_decreasing and q not in set(own["vec_id"])
        np.testing.assert_allclose(own["score"], s[own["vec_id"].to_numpy()], rtol=1e-12)
        hit += len(set(best) & set(own["vec_id"]))
    assert hit / 750 >= 0.9
    few = nearest(vectors(spark, rows[:4]), F.col("vec_id") == 0, k=10).collect()
    assert len(few) == 3
    assert nearest(vectors(spark, []), F.col("vec_id") == 0).count() == 0


# ---------------------------------------------------------------- classifiers

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def accuracy(spark, got, label):
    return got.join(table(spark, "labels"), "doc_id").where("held_out").select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_toxicity(spark):
    from rillstone.llm.toxicity import score_toxicity

    got = score_toxicity(table(spark, "documents"), table(spark, "labels"))
    assert got.count() == table(spark, "documents").count()
    assert got.where("score between 0 and 1 and predicted = cast(score >= 0.7 as int)").count() == got.count()
    assert got.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1) != F.col("held_out")).count() == 0
    assert accuracy(spark, got, "toxic") > 0.85
    odd = score_toxicity(docs(spark, [None, "", "a b", "a b"]), table(spark, "labels").limit(0)).collect()
    assert [r["score"] for r in odd] == [0.5] * 4


def test_quality(spark):
    from rillstone.llm.quality import score_quality

    got = score_quality(table(spark, "documents"), table(spark, "labels"))
    assert got.where("score between 0 and 1").count() == table(spark, "documents").count()
    assert accuracy(spark, got, "quality") > 0.85
    assert score_quality(docs(spark, [None, "", "x" * 200_000]), table(spark, "labels").limit(0)).count() == 3
    assert score_quality(docs(spark, []), table(spark, "labels")).count() == 0


def test_language(spark):
    from rillstone.llm.language import identify

    d = table(spark, "documents")
    got = identify(d)
    ok = got.join(d, "doc_id").where("held_out").select(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert ok > 0.95
    odd = identify(docs(spark, [None, "", "12 !?", "été", "x"], ids=[1, 2, 3, 4, None]), learn_from=d).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in odd if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert all(r["lang_pred"] != "und" for r in odd if r["doc_id"] in (4, None))
    nothing = identify(docs(spark, ["a b c"]).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [tuple(r)[2:] for r in nothing] == [("und", 0.0)]


def test_ftrl_against_a_plain_version():
    from rillstone.llm import toxicity

    r = random.Random(31)
    texts = [prose(r, r.randrange(0, 12), 15) + (" Bad, thing!" if i % 3 == 0 else "") for i in range(120)]
    y = np.array([float(i % 3 == 0) for i in range(120)])
    w, bias = toxicity.fit(texts, y, bits=12, l1=0.5, epochs=3)
    rows = []
    for t in texts:
        buf = np.frombuffer(t.encode(), np.uint8)
        ids, _ = toxicity.features(buf, np.array([0, len(buf)]), 12)
        words = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        assert len(ids) == 3 * len(words)
        rows.append(sorted(set(ids.tolist())))
    z, n, b, b_n = {}, {}, 0.0, 1e-3
    weight = lambda k: 0.0 if abs(z.get(k, 0)) <= 0.5 else -(z[k] - math.copysign(0.5, z[k])) / (1 + math.sqrt(n[k]) + 0.05)
    for _ in range(3):
        for ids, label in zip(rows, y):
            own = {k: weight(k) for k in ids}
            g = (0.5 / y.mean() if label else 0.5 / (1 - y.mean())) * (1 / (1 + math.exp(-(sum(own.values()) + b))) - label)
            for k in ids:
                old = n.get(k, 0.0)
                n[k] = old + g * g
                z[k] = z.get(k, 0.0) + g - (math.sqrt(n[k]) - math.sqrt(old)) * own[k]
            b_n += g * g
            b -= 0.1 * g / math.sqrt(b_n)
    want = np.zeros(1 << 12)
    for k in z:
        want[k] = weight(k)
    np.testing.assert_allclose(w, want, rtol=1e-4, atol=1e-6)
    assert bias == pytest.approx(b, rel=1e-9)
    import pyarrow as pa

    score = [1 / (1 + math.exp(-(sum(float(w[k]) for k in ids) + bias))) for ids in rows]
    np.testing.assert_allclose(toxicity.score_texts(pa.array(texts), w, bias), score, rtol=1e-5)


def test_svm_against_a_plain_version():
    from rillstone.llm import language

    r = np.random.default_rng(32)
    x = r.normal(size=(60, 8)).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * x[:, 1] > 0.2, 1, -1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = language.linear_svm(x, y, epochs=400)
    cost = np.where(y > 0, 2 / (y > 0).mean(), 2 / (y < 0).mean())
    # the same problem by plain gradient descent: |w|^2 / 2 + sum of cost * max(0, 1 - y (wx + b))^2, the bias among the weights
    full, w = np.hstack([x.astype(float), np.ones((60, 1))]), np.zeros(9)
    for _ in range(60_000):
        slack = np.maximum(0, 1 - y * (full @ w))
        w -= 1e-3 * (w - 2 * (full.T @ (cost * slack * y)))
    np.testing.assert_allclose(got, w, rtol=2e-2, atol=2e-2)


def test_languages_against_plain_duels():
    import pyarrow as pa

    from rillstone.llm import language
    from rillstone.llm.kernels import raw_column

    r = random.Random(33)
    langs = ["en", "de", "nl", "fr", "es", "xx"]
    texts = [" ".join(f"{v[0]}{v[1]}{r.randrange(6)}{v}" if r.random() < 0.7 else f"w{r.randrange(9)}" for _ in range(12)) for v in langs for _ in range(12)]
    model = language.Languages(texts, [v for v in langs for _ in range(12)])
    buf, offs = raw_column(pa.array(texts))
    pick, score = model.predict(buf, offs)
    chance = lambda m: 1 / (1 + math.exp(-max(-35, min(35, 3 * m))))
    for i in range(len(texts)):
        x = language.features(np.frombuffer(texts[i].encode(), np.uint8), np.array([0, len(texts[i])]))[0].astype(float)
        outer = [float(x @ w[:-1] + w[-1]) for w in model.outer]
        f = max(range(len(outer)), key=lambda k: outer[k])
        duels = {k: [] for k in model.members[f]}
        for (a, b), w in zip(model.pairs, model.inner):
            if a in duels:
                p = chance(float(x @ w[:-1] + w[-1]))
                duels[a].append(p)
                duels[b].append(1 - p)
        best = max(duels, key=lambda k: sum((q > 0.5) + q / 1000 for q in duels[k]))
        assert pick[i] == best and model.names[best] in langs
        assert score[i] == pytest.approx(chance(outer[f]) * min(duels[best], default=1.0), rel=1e-4)


def plain_byte_net(p, raw):
    from rillstone.llm.quality import FILTERS, HALF, STRIDE, WIDTH

    halves = max(1, -(-len(raw) // HALF))
    data = raw + bytes(halves * HALF - len(raw))
    best = []
    for h in range(halves):
        values = []
        for at in range(h * HALF, (h + 1) * HALF, STRIDE):
            if at + WIDTH <= len(data):
                values.append(np.concatenate([p["emb"][b] for b in data[at : at + WIDTH]]) @ p["filt"])
        best.append(np.maximum(np.max(values, axis=0) + p["fb"], 0))
    chunks = [np.maximum(best[k], best[k + 1]) if k + 1 < halves else best[k] for k in range(halves)]
    z = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)]) @ p["out"] + p["ob"][0]
    assert len(best[0]) == FILTERS
    return 1 / (1 + math.exp(-z))


def test_byte_net_against_plain_loops():
    import pyarrow as pa

    from rillstone.llm.kernels import raw_column
    from rillstone.llm.quality import ByteNet

    r = np.random.default_rng(34)
    net = ByteNet()
    net.p = {k: r.normal(0, 0.3, v.shape) for k, v in net.p.items()}
    texts = ["", "a", "short text", prose(random.Random(1), 60), prose(random.Random(2), 200), "x" * 256, "y" * 260]
    buf, offs = raw_column(pa.array(texts))
    want = [plain_byte_net(net.p, t.encode()) for t in texts]
    np.testing.assert_allclose(net.predict(buf, offs), want, rtol=1e-9)
    y, cost = np.array([0, 1, 1, 0, 1, 0, 1.0]), np.array([1, 0.5, 1, 1, 2, 1, 1.0])

    def loss():
        p = net.predict(buf, offs)
        return -(cost * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    grads = net.gradients(buf, offs, y, cost)
    for name, v in net.p.items():
        for at in [tuple(r.integers(s) for s in v.shape) for _ in range(12)] + ([(120, 3), (32, 0), (119, 5)] if name == "emb" else []):
            old, step = v[at], 1e-5
            v[at] = old + step
            up = loss()
            v[at] = old - step
            down = loss()
            v[at] = old
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=2e-6), (name, at)


def test_windows_change_nothing(spark, monkeypatch):
    import pyarrow as pa

    from rillstone.llm import kernels, language, packing, quality, toxicity
    from rillstone.llm.queries import tokenizer

    r = random.Random(35)
    texts = [prose(r, 900, 60) + " é Ünd " + "long" * 60, "", "k" * 700, prose(r, 400, 9) + "   ", "1 2 3 " * 300 + "ß"]
    w = np.random.default_rng(1).normal(size=1 << 20).astype(np.float32) * 0.01
    tok, net = packing.WordTokens(tokenizer("word_bpe_49k.json")), quality.ByteNet()
    net.p["out"] = np.random.default_rng(2).normal(size=net.p["out"].shape).astype(np.float32)

    def everything():
        out = []
        for t in texts:
            buf, offs = kernels.raw_column(pa.array([t]))
            out += [toxicity.score_texts(pa.array([t]), w, 0.1), language.features(buf, offs)[0], net.predict(buf, offs), language.has_letter(pa.array([t])), tok.encode(buf, offs, 0)[0], kernels.shingles(buf, offs)[0]]
        return out

    whole = everything()
    for module in (kernels, language, packing, quality, toxicity):
        monkeypatch.setattr(module, "WINDOW", 256)
    for a, b in zip(whole, everything(), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-5)


LONG_TEXT = """
import resource, sys
import numpy as np, pyarrow as pa
from rillstone.llm import kernels, language, minhash, packing, quality, suffixes, toxicity
from rillstone.llm.queries import tokenizer
r = np.random.default_rng(1)
words = np.array([f"w{k}" + "x" * (k % 7) for k in range(50_000)])
text = " ".join(words[r.integers(50_000, size=MB * 130_000)])[: MB << 20]
col = pa.array([text.encode()], pa.binary()); del text
op = sys.argv[1]
if op == "op1":
    toxicity.score_texts(col, r.normal(size=1 << 20).astype(np.float32), 0.0)
for i, j, buf, offs in kernels.slices(col, 1 << 19):
    if op == "op6":
        minhash.signatures(buf, offs, 5, minhash.bands_for(80))
    if op == "op7":
        language.Languages(["a b c"] * 3 + ["x y z"] * 3, ["en"] * 3 + ["fr"] * 3).predict(buf, offs)
    if op == "op9":
        packing.WordTokens(tokenizer("word_bpe_49k.json")).encode(buf, offs, 0)
    if op == "op10":
        quality.ByteNet().predict(buf, offs)
if op == "op4":
    tag = np.zeros(1, np.uint32)
    runs = np.concatenate([suffixes.runs_of(b, o, np.zeros(1, np.int64), tag, 100, base, own) for _, _, b, o, base, own in kernels.stretches(col, 1 << 19, 99)])
    one, single, _ = suffixes.meet(runs); del runs, one
    asked = suffixes.marks(single, True); asked["tie"] = suffixes.ties(*kernels.raw_column(col))[0]
    parts = list(suffixes.pieces_of(pa.table({"doc_id": pa.array([0]), "text": col}), asked, 100, np.zeros(0, np.uint64), 0))
    suffixes.repeats_among(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), 100)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""


@pytest.mark.parametrize("op", ["op1", "op4", "op6", "op7", "op9", "op10"])
def test_a_text_of_64_mb_keeps_memory(op):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", LONG_TEXT.replace("MB", "64"), op], capture_output=True, text=True, timeout=600, env=os.environ | {"PYTHONPATH": root})
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout) < 1500


# ---------------------------------------------------------------- pipeline


def test_pipeline_keeps_texts_of_one_id_apart(spark):
    import corpus_pipeline as p

    r = random.Random(36)
    a, b, c, e = (prose(r, 80, 5000) for _ in range(4))
    near = " ".join(a.split()[:-1])
    d = docs(spark, [a, near, b, c, c, e, e, None], ids=[1, 2, 2, 3, 3, None, 4, 5])
    got = sorted((x["doc_id"], x["text"] or "") for x in p.STAGES[1][1](spark, d, SF).collect())
    assert got == sorted([(1, a), (2, b), (3, c), (4, e), (5, "")])
    mixed = p.STAGES[3][1](spark, docs(spark, [a, b, c, e], ids=[None, None, 7, 7]), SF).groupBy("text").count().collect()
    assert {x["text"]: x["count"] for x in mixed} == {a: 1, b: 1, c: 1, e: 1}


def test_language_learns_every_language(spark):
    from rillstone.llm.language import identify

    r = random.Random(6)
    rows = [(100 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{r.randrange(30)}" for _ in range(20)), f"q{k}") for k in range(70) for i in range(4 + k % 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (800, 1):
        got = identify(d, may_learn=F.lit(True), sample_rows=most).join(d, "doc_id")
        assert got.where("lang_pred = lang").select("lang").distinct().count() == 70, most


def test_pipeline(spark):
    import corpus_pipeline as p

    from rillstone.llm.shared import keep

    names = [n for n, _ in p.STAGES]
    assert len(names) == 5
    d = table(spark, "documents").limit(300)
    extra = d.withColumn("kept", F.lit(1)).unionByName(d.limit(5).withColumn("text", F.lit("12 34")).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("kept", F.lit(1)))
    for name, stage in p.STAGES[:-1]:
        out = keep(stage(spark, extra, SF), "stage")
        assert out.columns == list(p.COLUMNS), name
        extra = out
    packed = p.STAGES[-1][1](spark, extra, SF)
    assert packed.select("doc_id").distinct().count() == extra.select("doc_id").distinct().count()
    assert extra.where(F.col("doc_id") >= 10**6).count() == 0


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as p

    r = random.Random(8)
    rows = [(i, prose(r, 40), None, None, None) for i in range(20)] + [(None, prose(r, 30), "en", "s", 1), (None, prose(r, 30), None, None, None), (3, None, None, None, None), (40, "", "en", "s", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    empty = d.where("false")
    learn = table(spark, "documents").limit(200)
    both = learn.unionByName(d.withColumn("doc_id", F.col("doc_id") + 10**6))
    for name, stage in p.STAGES[:-1]:
        assert stage(spark, empty, SF).count() == 0, name
    assert p.STAGES[-1][1](spark, empty, SF).count() == 0
    first = p.STAGES[0][1](spark, both, SF).where("doc_id is null or doc_id >= 1000000")
    assert first.count() == 22
    second = p.STAGES[1][1](spark, d, SF)
    assert second.where("doc_id is null").count() == 2 and second.count() == 24  # both rows of id 3: their texts differ
    assert p.STAGES[2][1](spark, d, SF).where("doc_id is null").count() == 2
    assert p.STAGES[3][1](spark, d, SF).count() >= 1


def test_language_stage_with_nothing_to_learn(spark):
    import corpus_pipeline as p

    texts = ["a text", "été", "12 !?", "", None]
    got = p.STAGES[0][1](spark, docs(spark, texts).withColumn("lang", F.lit(None).cast("string")), SF).collect()
    assert {(r["doc_id"], r["lang"]) for r in got} == {(0, None), (1, None)}
    held = docs(spark, ["a text"], ids=[next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)])
    assert [r["lang"] for r in p.STAGES[0][1](spark, held, SF).collect()] == ["en"]


def test_nearest_in_several_chunks(spark, monkeypatch):
    from rillstone.llm import kmtree

    r = np.random.default_rng(6)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=8)], 0, 0, "") for i in range(400)]
    whole = kmtree.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, k=5).collect()
    monkeypatch.setattr(kmtree, "CHUNK", 30)
    monkeypatch.setattr(kmtree, "GROUP", (40, 40))
    parted = kmtree.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, k=5).collect()
    key = lambda rs: sorted((x["query_id"], x["rank"], x["vec_id"], round(x["score"], 9)) for x in rs)
    assert key(whole) == key(parted)


def test_nearest_of_clustered_vectors(spark, monkeypatch):
    from rillstone.llm import kmtree
    from rillstone.llm.kmtree import nearest

    monkeypatch.setattr(kmtree, "LEAF", 8)
    monkeypatch.setattr(kmtree, "calibrate", lambda *_: (1, 0.25))  # what tight clusters ask for
    r = np.random.default_rng(5)
    rows = []
    for c in r.normal(size=(6, 8)) * 20:  # tight clusters, one of them copies of a vector
        rows += [c + (r.normal(size=8) * 1e-3 if len(rows) else 0) for _ in range(300)]
    rows += list(r.normal(size=(40, 8)) * 400)  # outliers: leaves of one vector
    ids = [*range(len(rows)), *[len(rows) - 1] * 30]  # and one that stands in the table many times
    rows += [rows[-1]] * 30
    table = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in zip(ids, rows)], "vec_id long, embedding array<double>")
    got = nearest(table, F.col("vec_id") % 7 == 6, k=20).toPandas()
    asked = [i for i in ids if i % 7 == 6]
    per = got.groupby("query_id")["rank"].agg(["count", "max"])
    assert set(per.index) == set(asked) and (per["max"] >= 20).all() and (got["query_id"] != got["vec_id"]).all()
    few = nearest(table.where("vec_id < 12"), F.col("vec_id") == 6, k=20).collect()
    assert len(few) == 11


def test_vectors_when_hardly_one_is_usable(spark):
    from rillstone.llm.forest import near_duplicate_vectors
    from rillstone.llm.kmtree import nearest

    zero = spark.range(60_000).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.0).cast("float"), 8).alias("embedding"), F.lit(1).alias("label"))
    two = vectors(spark, [(70_000, [0.5] * 8, 1, 0, ""), (70_001, [0.5] * 8, 1, 0, "")]).select("vec_id", "embedding", "label")
    both = zero.unionByName(two)
    got = near_duplicate_vectors(both).where("vec_id >= 70000").collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(70_000, 1, 70_000), (70_001, 1, 70_000)]
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in nearest(both, F.col("vec_id") == 70_000).collect()] == [(70_000, 70_001, 2.0)]


def test_vectors_of_several_lengths(spark):
    from rillstone.llm.forest import near_duplicate_vectors
    from rillstone.llm.kmtree import nearest

    r = np.random.default_rng(8)
    rows = [(i, [float(v) for v in r.normal(size=8)], 1, 0, "") for i in range(100)] + [(200 + i, [3.0, 4.0], 1, 0, "") for i in range(2)] + [(300, [1.0, 0.0], 1, 0, "")]
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in near_duplicate_vectors(vectors(spark, rows)).collect()}
    assert (got[200], got[201], got[300]) == ((1, 200), (1, 200), (0, 300)) and len(got) == 103
    found = nearest(vectors(spark, rows), F.col("vec_id").isin(5, 200), k=20).toPandas()
    assert found[found["query_id"] == 200]["vec_id"].tolist() == [201, 300] and len(found) == 22


def test_nearest_of_repeated_queries(spark):
    from rillstone.llm.kmtree import nearest

    r = np.random.default_rng(9)
    rows = [(i, [float(np.float32(v)) for v in r.normal(size=8)], 1, 0, "") for i in range(60)]
    once = nearest(vectors(spark, rows), F.col("vec_id") == 7, k=5).orderBy("rank").collect()
    many = nearest(vectors(spark, rows + [rows[7]] * 3), F.col("vec_id") == 7, k=5).orderBy("rank").collect()
    assert once == many and len({x["vec_id"] for x in many}) == 5


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_of_nearest(spark, clustered):
    from rillstone.llm.kmtree import nearest

    r = np.random.default_rng(10)
    x = r.normal(size=(6000, 16))
    if clustered:
        x = r.normal(size=(60, 16))[r.integers(60, size=6000)] * 3 + 0.3 * x
    got = nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), F.col("vec_id") % 40 == 0, k=10).toPandas()
    q = np.arange(0, 6000, 40)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    true = np.argsort(-s, axis=1)[:, :10]
    own = got.groupby("query_id")["vec_id"].agg(set)
    assert np.mean([len(own[a] & set(b)) for a, b in zip(q, true)]) / 10 >= 0.9


def test_samples_keep_within_bytes(spark):
    from rillstone.llm.samples import within

    d = spark.createDataFrame([(h, h % 2, "x" * 10) for h in range(50)], "h long, label int, text string")
    assert [r[0] for r in within(d, 1000, 95)] == list(range(9))
    assert len(within(d, 1000)) == 50
    assert len(within(d, 1000, 1)) == 1
    assert within(d.where("false"), 10) == []
