import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillstone.functions.similarity import alike, variant
from rillstone.operators import folds, groups, joins, linking, sequences
from rillstone.operators.components import components
from rillstone.sources import io
from rillstone.streaming import incremental


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def naive_components(edges):
    p = {}

    def find(x):
        while p.setdefault(x, x) != x:
            x = p[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            p[max(a, b)] = min(a, b)
    return {x: find(x) for x in p}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(30)] + [(None, 1), (5, 5)]
    got = {x["id"]: x["component_id"] for x in components(frame(spark, edges, "a long, b long")).collect()}
    assert got == naive_components(edges)


def test_components_of_nothing(spark):
    assert components(frame(spark, [], "a long, b long")).count() == 0


def test_links_by_key(spark):
    clara, zoe = ("CLARA", "DAVIS"), ("ZOE", "ZILLAH")
    rows = [(1, "p", ("ANNA", "BROWN"), clara), (2, "p", clara, None), (3, "p", clara, clara), (4, "q", ("XENIA", "YOUNG"), clara), (5, "p", zoe, zoe), (6, "p", None, ("CLARA", "DAVIT")), (7, "p", None, ("CLARA", "DARIT"))]
    d = frame(spark, rows, "id int, part string, own struct<first:string,last:string>, ref struct<first:string,last:string>")
    got = {(r["src"], r["dst"]) for r in linking.key_links(d, "part", "id", "own", "ref").collect()}
    assert got == {(1, 2), (1, 3), (3, 2)}
    assert [(r["id"], r["key"]["last"]) for r in linking.fuzzy_links(d, "part", "id", "own", "ref").collect()] == [(6, "DAVIS")]
    comp = {r["id"]: r["component"] for r in linking.key_components(d, "part", "id", "own", "ref").collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 1, 7: 7}  # 6 refers to DAVIS with one edit
    exact = {r["id"]: (r["component"], r["number"]) for r in linking.key_components(d, "part", "id", "own", "ref", edits=0).collect()}
    assert exact == {1: (1, 1), 2: (1, 1), 3: (1, 1), 4: (4, 1), 5: (5, 2), 6: (6, 3), 7: (7, 4)}
    two = {r["id"]: r["component"] for r in linking.key_components(d, "part", "id", "own", "ref", edits=2).collect()}
    assert two[7] == 1


@pytest.mark.parametrize("name", ["grand_summary", "group_stats", "partition_summary"])
def test_group_queries_broadcast_nothing_that_grows(spark, monkeypatch, name):
    from rillstone.operators import components as rounds
    from rillstone.plans.catalogue import QUERIES

    plans = []

    def seen(df, table, kept=linking.keep):
        plans.append(df)
        return kept(df, table)

    monkeypatch.setattr(linking, "keep", seen)
    monkeypatch.setattr(rounds, "keep", seen)
    plans.append(QUERIES[name](spark, "/root/testdata/sf0.001"))
    lines = [x for d in plans for x in d._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in x]
    assert len(lines) >= 6 and all("strategy=merge" in x for x in lines)


@pytest.mark.parametrize("name", ["group_stats", "partition_summary"])
def test_group_queries_run_without_broadcasts(spark, name):
    from rillstone.plans.catalogue import QUERIES

    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty(30_000)
    old, runs = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), store.executionsList()
    begun = max([runs.apply(i).executionId() for i in range(runs.size())], default=-1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        bus.waitUntilEmpty(30_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    runs = store.executionsList()
    ran = [r.physicalPlanDescription() for r in map(runs.apply, range(runs.size())) if r.executionId() > begun]  # with what was planned anew as it ran
    assert any("SortMergeJoin" in x for x in ran) and not any("Broadcast" in x for x in ran)


@pytest.mark.parametrize("lot", [500_000, 20])
def test_groups_of_one_lot_need_no_rounds(spark, monkeypatch, lot):
    from rillstone.operators import components as rounds

    tables = []

    def seen(df, table, kept=rounds.keep):
        tables.append(table)
        return kept(df, table)

    monkeypatch.setattr(rounds, "keep", seen)
    monkeypatch.setattr(rounds, "LOT", lot)
    chain = [(i, "p", ("K", str(i)), ("K", str(i + 1) if i % 50 else "none")) for i in range(1, 201)]  # links in order, in four parts
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        d = frame(spark, chain, "id long, part string, own struct<first:string,last:string>, ref struct<first:string,last:string>")
        got = {r["id"]: r["component"] for r in linking.key_groups(d, "part", "id", "own", "ref", edits=0).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201)}
    assert ("least" in tables) == (lot < len(chain))  # rounds come only where the edges are more than one lot


@pytest.mark.parametrize("name", ["group_stats", "partition_summary"])
def test_near_keys_are_near_by_bytes(spark, tmp_path, name):
    import duckdb

    from rillstone.plans.catalogue import ORACLES, QUERIES

    texts = ["Elan Dupont\nNo Body", "No One\nÉlan Dupont", "Ève Petit\nNo Body", "No One\nÉve Petit", "Anna Roux\nNo Body", "No One\nAnn Roux"]
    rows = [(i, x, "fr", "src0", len(x)) for i, x in enumerate(texts)]
    frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        want = db.execute(ORACLES[name]).fetchall()
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == sorted(want)
    if name == "group_stats":
        assert sorted(r[-1] for r in want) == ["0", "1", "2;3", "4;5"]


def test_rows_of_one_id_count_once_in_groups(spark):
    d = frame(spark, [(1, "p", ("A", "B"), ("C", "D")), (2, "p", ("C", "D"), None), (2, "p", ("E", "F"), None)], "id long, part string, own struct<first:string,last:string>, ref struct<first:string,last:string>")
    assert sorted((r["id"], r["component"]) for r in linking.key_groups(d, "part", "id", "own", "ref").collect()) == [(1, 1), (2, 1), (2, 1)]


def test_sequence_fit(spark):
    rows = [(1, 0, 5), (1, 1, None), (1, 2, 9), (1, 3, 8), (1, 4, 9), (2, 0, 1), (2, 1, None), (3, 0, 4), (3, 1, 9), (3, 2, 6), (3, 3, 11)]
    got = [(r["fitted"], r["flag"]) for r in sequences.sequence_fit(frame(spark, rows, "p int, i int, n int"), "p", "i", "n").orderBy("p", "i").collect()]
    assert got[:5] == [(5, ""), (6, ""), (7, "mismatch"), (8, ""), (9, "")]
    assert got[5:7] == [(1, ""), (None, "unfitted")]
    assert got[7:] == [(4, ""), (5, "mismatch"), (6, ""), (7, "mismatch")]  # tied offsets: the first seen


def test_vote_repair(spark):
    codes = ["ABC1234567", "ABC2234567", "ABC3234567", "A8C4234567", "ABX5234567", "ABC62345", "QQQ7234567", None, "AB"]
    rows = [(1, i, c) for i, c in enumerate(codes)]
    got = [(r["repaired"], r["flags"]) for r in sequences.vote_repair(frame(spark, rows, "p int, i int, c string"), "p", "c", "i").orderBy("i").collect()]
    assert got[0] == ("ABC1234567", "")
    assert got[3] == ("ABC4234567", "glyph_fixed")
    assert got[4] == ("ABC5234567", "prefix_fixed")
    assert got[5][1] == "bad"
    assert got[6] == ("QQQ7234567", "")
    assert got[7] == ("", "missing")
    assert got[8][1] == "bad"


def test_islands_and_gaps(spark):
    d = frame(spark, [(1, i, v) for i, v in enumerate(["a", None, "a", "b", None, "a"])], "p int, i int, v string")
    assert [r["run"] for r in sequences.islands(d, "p", "i", "v").orderBy("i").collect()] == [1, 1, 1, 2, 2, 3]
    g = frame(spark, [("k", x) for x in (1, 3, 7, 8, 20)], "k string, at int")
    assert [r["run"] for r in sequences.gap_islands(g, ["k"], "at", 3).orderBy("at").collect()] == [1, 1, 1, 1, 2]
    assert [r["run"] for r in sequences.gap_islands(g, ["k"], "at", 1).orderBy("at").collect()] == [1, 1, 2, 2, 3]


@pytest.mark.parametrize("cap", [1, 5, 12, 100])
def test_capacity_chunks(spark, cap):
    r = random.Random(cap)
    rows = [(p, i, float(r.randrange(1, 9))) for p in range(3) for i in range(r.randrange(1, 9))]
    got = sequences.capacity_chunks(frame(spark, rows, "p int, i int, s double"), "p", "i", "s", float(cap)).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby(["p", "chunk"]):
        assert g["s"].sum() <= cap or len(g) == 1
    for _, g in got.sort_values("i").groupby("p"):
        assert g["chunk"].is_monotonic_increasing


def test_ordinal_and_batches(spark):
    d = frame(spark, [(i * 7 % 50,) for i in range(50)], "k int")
    got = sequences.batching(d, ["k"], 20).orderBy("k").collect()
    assert [r["batch"] for r in got] == [i // 20 for i in range(50)]
    assert sequences.adaptive_chunk(100, 4) == 8
    assert sequences.adaptive_chunk(1, 4) == 1


def anchor_oracle(rows, threshold=0.8):
    """Straight from the definition, each run kept as a list of its rows."""
    runs = []
    for v, w in rows:
        if runs:
            run = runs[-1]
            anchor = [next((x[k] for x in run if x[k]), None) for k in (0, 1)]
            if all(a is None or not b or alike(a, b, threshold) for a, b in zip(anchor, (v, w), strict=True)):
                run.append((v, w))
                continue
        runs.append([(v, w)])
    return [i + 1 for i, run in enumerate(runs) for _ in run]


@pytest.mark.parametrize("seed", range(4))
def test_anchor_runs(spark, seed):
    r = random.Random(seed)
    words = [None, "", "northam", "northham", "southam", "west", "wests"]
    rows = [(r.choice(words), r.choice([None, "1", "2"])) for _ in range(40)]
    d = frame(spark, [(1, i, v, w) for i, (v, w) in enumerate(rows)], "p int, i int, v string, w string")
    got = [x["run"] for x in folds.anchor_runs(d, "p", "i", ["v", "w"]).orderBy("i").collect()]
    assert got == anchor_oracle(rows)


def test_a_break_resets_every_anchor(spark):
    d = frame(spark, [(1, 0, "AAAA", "1"), (1, 1, None, "2"), (1, 2, "BBBB", None)], "p int, i int, v string, w string")
    assert [x["run"] for x in folds.anchor_runs(d, "p", "i", ["v", "w"]).orderBy("i").collect()] == [1, 2, 2]


def test_leader_clusters(spark):
    names = ["merton", "merton", "mertan", "marton", "mer", "", None, "melton"]
    d = frame(spark, [(1, i, n) for i, n in enumerate(names)], "p int, i int, n string")
    got = [x["canonical"] for x in folds.leader_clusters(d, "p", "i", "n").orderBy("i").collect()]
    assert got[:3] == ["merton"] * 3
    assert got[3] == "marton"  # shares one leading character only
    assert got[5:7] == ["", ""]
    far = frame(spark, [(1, 0, "merton"), (1, 1, "merton"), (1, 50, "mertan")], "p int, i int, n string")
    assert [x["canonical"] for x in folds.leader_clusters(far, "p", "i", "n").orderBy("i").collect()][2] == "mertan"
    assert variant("merton", "mertan", 0.68, 3) and not variant("", "", 0.68, 3)


def test_club_merge_and_coalesce(spark):
    runs = frame(spark, [(1, 1, 3, "oak", "a", 5.0), (1, 6, 8, "elm", "a", 2.0), (1, 10, 12, "oak", "a", 4.0), (1, 60, 61, "oak", "", 1.0)], "p int, first int, last int, k string, w string, s double")
    assert [r["club"] for r in folds.club_runs(runs, "p", "first", ["k"], ["w"]).orderBy("first").collect()] == [1, 2, 1, 3]
    assert [r["merged"] for r in folds.merge_gaps(runs, "p", "first", "k", "first", "last", "s", 20).orderBy("first").collect()] == [1, 2, 1, 3]
    assert [r["merged"] for r in folds.merge_gaps(runs, "p", "first", "k", "first", "last", "s", 20, 8).orderBy("first").collect()] == [1, 2, 3, 4]
    assert [r["merged"] for r in folds.merge_gaps(runs, "p", "first", "k", "first", "last", "s", -1).orderBy("first").collect()] == [1, 2, 3, 4]
    assert [r["joined"] for r in folds.coalesce_small(runs, "p", "first", "s", "w", 3, 8).orderBy("first").collect()] == [1, 1, 2, 3]


def test_names(spark):
    d = frame(spark, [(1, "oak", "w1", "p"), (2, "oak", "w2", "p"), (3, "elm", "w1", "p"), (4, "ash", "w", "p"), (5, "ash", "w", "q"), (6, "fir", "", ""), (7, "fir", "", "")], "i int, n string, a string, b string")
    got = [r["label"] for r in folds.dedupe_names(d, "n", ["a", "b"]).orderBy("i").collect()]
    assert got == ["oak (w1)", "oak (w2)", "elm", "ash (p)", "ash (q)", "fir", "fir"]
    spelt = frame(spark, [("g", i, v) for i, v in enumerate(["northam", "northham", "", "west", "northam", "wests", None])] + [("h", 9, "")], "k string, i int, v string")
    assert [tuple(r) for r in folds.fuzzy_distinct(spelt, ["k"], "v", "i").collect()] == [("g", ["northam", "west"])]
    assert [tuple(r) for r in folds.fuzzy_distinct(spelt, ["k"], F.left("v", F.lit(1)), "i", name="first").collect()] == [("g", ["n", "w"])]


def test_names_by_similar_qualifiers(spark):
    rows = [(1, "oak", "north end"), (2, "oak", "north  ends"), (3, "oak", "west"), (4, "oak", "oaks"), (5, "elm", "x 12")]
    got = [r["label"] for r in folds.dedupe_names(frame(spark, rows, "i int, n string, q string"), "n", ["q"], order="i", threshold=0.8, tail=r"\s+[0-9]+$").orderBy("i").collect()]
    assert got == ["oak (north end)", "oak (north end)", "oak (west)", "oak", "elm"]


def test_run_names(spark):
    rows = [
        (1, [], ["w"], [], ""), (2, ["v"], ["w"], [], ""), (3, ["v"], ["a", "b"], [], ""), (4, ["v"], list("abcd"), [], ""), (5, ["v"], list("abcd"), [], ""),
        (6, ["m"], ["x"], [], ""), (7, ["m"], ["y"], [], ""), (8, ["a", "b"], [], ["p"], ""), (9, ["a", "b", "c", "d"], [], [], ""), (10, [], [], [], ""), (11, ["s 3"], [], [], ""), (12, ["a", "b"], [], ["p"], "mill"), (13, ["north"], ["northe"], [], ""), (14, ["north"], [], [], ""),
    ]
    d = frame(spark, rows, "i int, v array<string>, w array<string>, a array<string>, q string")
    got = {r["i"]: r["name"] for r in folds.name_runs(d, "i", "v", "w", "a", F.lit("m"), "q", tail=r"\s+[0-9]+$").collect()}
    assert got == {1: "w", 2: "v w", 3: "v a / b", 4: "v 1", 5: "v 2", 6: "x", 7: "y", 8: "p", 9: "a + 3", 10: "(unknown)", 11: "s", 12: "mill", 13: "northe", 14: "north"}


def test_clubs(spark):
    rows = [(1, "oak", "east", [], "oak", ["oak"], "m", ["m"]), (2, "oak", "", [], "", [], "", []), (3, "oak", "west", [], "oaks", ["oaks"], "m", ["m"]), (4, "oak", "wests", ["w"], "oak", ["oak", "b"], "m", ["m"]), (5, "oaks", "east", [], "x", ["x"], "n", ["n"])]
    d = frame(spark, rows, "i int, area string, block string, wards array<string>, place string, places array<string>, addr string, addrs array<string>").withColumn("p", F.lit(1))
    clubs = lambda got: [r["club"] for r in got.orderBy("i").collect()]
    assert clubs(folds.club_by_area(d, "p", "i", "area", "block", "wards")) == [1, 1, 2, 3, 4]
    assert clubs(folds.club_by_building(d, "p", "i", "place", "places", "addr", "addrs")) == [1, 2, 1, 3, 4]
    wards = frame(spark, [(1, 1, "v", "ward 1", ["ward 1"]), (1, 2, "", "ward 1", ["ward 1"]), (1, 3, "v", "ward 1", ["ward 1"]), (1, 4, "v", "ward 1", ["ward 1", "x"])], "p int, i int, v string, w string, ws array<string>")
    assert clubs(folds.club_by_ward(wards, "p", "i", "v", "w", "ws")) == [1, 2, 1, 3]


def test_oversized_parts_are_cut_at_labels_first(spark):
    rows = [(1, 1, 4.0, "a"), (1, 2, 4.0, ""), (1, 3, 4.0, "b"), (1, 4, 9.0, "b"), (1, 5, 20.0, "c"), (1, 6, 1.0, "a"), (2, 1, 5.0, "a"), (2, 2, 5.0, "b")]
    got = sequences.capacity_chunks(frame(spark, rows, "p int, i int, s double, l string"), "p", "i", "s", 10.0, "l").orderBy("p", "i").collect()
    assert [r["chunk"] for r in got] == [1, 1, 2, 3, 4, 5, 1, 1]


def test_lookups_by_containment(spark):
    table = frame(spark, [(1, "New York"), (2, "york"), (3, "Yorkshire"), (4, ""), (5, "A")], "i int, n string")
    got = {r["q"]: r["i"] for r in joins.tiered_lookup(frame(spark, [("York",), ("yo",), ("a",), ("",), ("zz",)], "q string"), table, "q", "n", "i").collect()}
    assert got == {"York": 2, "yo": 1, "a": 5}


def test_sinks_and_guards(spark, tmp_path):
    path = str(tmp_path / "t")
    d = frame(spark, [(1, "a"), (2, None)], "k int, v string")
    assert io.guard_overwrite(spark, path) == path and io.put(d, path)
    with pytest.raises(FileExistsError):
        io.guard_overwrite(spark, path)
    assert io.guard_overwrite(spark, path, force=True) == path
    (tmp_path / "file").write_text("x")
    assert not io.put(d, str(tmp_path / "file" / "below"))
    io.append_log(d, str(tmp_path / "log"))
    io.append_log(d, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    assert joins.within(d.limit(1), d, "k") and not joins.within(d, d.where("k = 1"), "k")


def test_group_statistics(spark):
    d = frame(spark, [("g", 1, 20.0, "A", "m"), ("g", 2, 30.0, "A", "f"), ("g", 3, 500.0, "B", None), ("h", 4, None, "C", "m")], "k string, id int, age double, tok string, c string")
    s = groups.group_stats(d, ["k"], "age", "tok", "c", ["m", "f"], "id", 18, 100)
    rows = {r["k"]: r for r in s.collect()}
    assert (rows["g"]["mean"], rows["g"]["deviation"], rows["g"]["implausible"], rows["g"]["n_other"], rows["g"]["ids"]) == (25.0, 7.07, 1, 1, "1;2;3")
    assert (rows["h"]["mean"], rows["h"]["deviation"]) == (None, 0.0)


def test_mean_of_confidences_has_no_order(spark):
    a = [0.1, 0.2, 0.3, 0.6, 0.7, 0.8, 0.05, 0.05]  # 2.8 of 8 are 0.35
    for values in (a * 60, sorted(a * 60), sorted(a * 60, reverse=True)):
        d = frame(spark, [("k", v) for v in [*values, None, -1.0]], "k string, v double").coalesce(1)
        assert [tuple(r) for r in groups.mean_confidence(d, ["k"], "v").collect()] == [("k", 0.4, 480)]
    odd = frame(spark, [("x", 1e300), ("x", 1e300), ("y", 1 / 3), ("y", 2.0), ("z", None), ("n", float("nan")), ("i", float("inf"))], "k string, v double")
    got = {r["k"]: (r["mean_conf"], r["given"]) for r in groups.mean_confidence(odd, ["k"], "v").collect()}
    assert (got["x"], got["y"], got["z"]) == ((1e300, 2), (1.2, 2), (None, 0))
    assert str(got["n"][0]) == "nan" and got["i"] == (float("inf"), 1)


def test_joins(spark):
    a, b = frame(spark, [(i,) for i in range(0, 40, 3)], "x int"), frame(spark, [(i,) for i in range(0, 40, 4)], "y int")
    got = {tuple(r) for r in joins.band_join(a, b, "x", "y", 5).collect()}
    assert got == {(x, y) for x in range(0, 40, 3) for y in range(0, 40, 4) if abs(x - y) <= 5}
    s = joins.manifest_upsert(frame(spark, [("a", False, 2)], "key string, done boolean, attempts long"), frame(spark, [("a", True, 1), ("b", False, 1)], "key string, done boolean, attempts long"))
    assert sorted(map(tuple, s.collect())) == [("a", True, 3), ("b", False, 1)]
    m = joins.positional_merge(frame(spark, [(1, "x"), (2, "y")], "i int, v string"), frame(spark, [(1, "n", 1), (1, "z", 2)], "i int, v string, at int"), ["i"], ["v"], "at")
    assert sorted((r["i"], r["v"], r["old_v"], r["flag"]) for r in m.collect()) == [(1, "z", "x", "merged"), (2, "y", "y", "missing")]


def test_csv_round_trip(spark, tmp_path):
    f = tmp_path / "in.csv"
    f.write_bytes("﻿a,b\n1,\n\"x\ny\",2\n".encode())
    d = io.read_csv(spark, str(f), ["a", "b", "c"])
    assert sorted(map(tuple, d.collect())) == [("1", "", ""), ("x\ny", "2", "")]
    with pytest.raises(ValueError):
        io.require_columns(d, ["zz"])
    assert io.list_keys(spark, str(tmp_path), "*.csv").count() == 1
    assert [r["text"] for r in io.read_pages(spark.read.format("binaryFile").load(str(f)), io.Plain()).collect()][0].endswith("2\n")
    assert io.read_or_empty(spark, str(tmp_path / "none"), d.schema).count() == 0


def test_nested_round_trip(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 5, None)]
    docs = io.nest_documents(frame(spark, rows, "k int, i int, v string"), ["k"], ["i"], ["v"])
    assert sorted(map(tuple, io.explode_nested(docs.drop("n_items"), "items").collect())) == sorted(rows)


def test_stream_adds_only_what_is_new(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    d = spark.range(5).withColumn("v", F.lit("x"))
    d.write.parquet(src)
    go = lambda: incremental.process_new(spark, src, d.schema, lambda x: x.where("id > 1"), out, ck)
    go()
    go()
    assert spark.read.parquet(out).count() == 3
    spark.range(10, 12).withColumn("v", F.lit("y")).write.mode("append").parquet(src)
    go()
    assert spark.read.parquet(out).count() == 5


def test_rounds():
    left = [9, 5, 5, 5, 5]
    it = iter(left)
    assert incremental.until_complete(lambda: next(it), lambda r: None) == [9, 5, 5, 5]
    done = iter([3, 0])
    assert incremental.until_complete(lambda: next(done), lambda r: None) == [3, 0]


def test_stuck(spark):
    d = frame(spark, [("a", False, 3), ("b", False, 1), ("c", True, 9)], "key string, done boolean, attempts long")
    assert [r["key"] for r in incremental.stuck(d).collect()] == ["a"]
    assert isinstance(d.toPandas(), pd.DataFrame)


def test_ranked_within_frequent_keys(spark):
    rows = [("hot" if i % 3 else None if i % 2 else "x", (i * 37) % 500) for i in range(500)]
    got = sequences.ranked(frame(spark, rows, "k string, i int"), ["k"], ["i"], "n").collect()
    for key in ("hot", None, "x"):
        own = sorted((r["i"], r["n"]) for r in got if r["k"] == key)
        assert [n for _, n in own] == list(range(1, len(own) + 1))


def test_keys_and_headers(spark):
    a, b = frame(spark, [(1,), (2,), (2,)], "k int"), frame(spark, [(2,), (1,)], "k int")
    assert joins.same_keys(a, b, "k") and not joins.same_keys(a, b.where("k = 1"), "k")
    out = joins.header_to_detail(frame(spark, [(1, "own"), (2, "own")], "p int, s string"), frame(spark, [(1, "head"), (2, None)], "p int, s string"), ["p"], ["s"])
    assert sorted(map(tuple, out.collect())) == [(1, "head"), (2, "own")]
