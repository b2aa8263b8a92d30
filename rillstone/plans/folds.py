"""Queries over order-dependent folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import folds

from .registry import query


def _places(t):
    """Events as places: a nullable kind with spelling variants, and a nullable ward."""
    k = F.col("event_id")
    kind = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.concat("event_type", F.lit("s"))).otherwise(F.col("event_type"))
    ward = F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("ward "), F.floor(k / 40) % 4))
    return t("events").select("event_id", "user_id", kind.alias("kind"), ward.cast("string").alias("ward"), "value")


#: The same folds with equality instead of similarity, which SQL can express by recursion along the order.
PLACES = "select event_id, user_id, case when event_id % 7 = 0 then null when event_id % 11 = 0 then event_type || 's' else event_type end as kind, case when event_id % 5 = 0 then null else 'ward ' || ((event_id // 40) % 4) end as ward from events"
OK = "((f.ak = '' or x.kind is null or f.ak = x.kind) and (f.aw = '' or x.ward is null or f.aw = x.ward))"
ANCHORED = f"""
with recursive x as materialized (select *, row_number() over (partition by user_id order by event_id) as i from ({PLACES})),
f as (
  select user_id, event_id, kind, ward, i, coalesce(kind, '') as ak, coalesce(ward, '') as aw, 1 as run from x where i = 1
  union all
  select x.user_id, x.event_id, x.kind, x.ward, x.i,
    case when {OK} and f.ak <> '' then f.ak else coalesce(x.kind, '') end, case when {OK} and f.aw <> '' then f.aw else coalesce(x.ward, '') end, case when {OK} then f.run else f.run + 1 end
  from f join x on x.user_id = f.user_id and x.i = f.i + 1
), runs as materialized (
  select user_id, run, min(event_id) as first, max(event_id) as last, coalesce(arg_min(kind, event_id) filter (where kind is not null), '') as kind, coalesce(arg_min(ward, event_id) filter (where ward is not null), '') as ward, count(*) as size from f group by user_id, run
)
"""


@query()
def anchor_runs_fuzzy(t):
    return folds.anchor_runs(_places(t), "user_id", "event_id", ["kind", "ward"]).select("event_id", "user_id", "run")


@query(ANCHORED + "select event_id, user_id, run from f")
def anchor_runs(t):
    return folds.anchor_runs(_places(t), "user_id", "event_id", ["kind", "ward"], threshold=1.0).select("event_id", "user_id", "run")


def _runs(t):
    runs = folds.anchor_runs(_places(t), "user_id", "event_id", ["kind", "ward"], threshold=1.0)
    return runs.groupBy("user_id", "run").agg(
        F.min("event_id").alias("first"),
        F.max("event_id").alias("last"),
        F.min_by("kind", F.when(F.col("kind").isNotNull(), F.col("event_id"))).alias("kind"),
        F.min_by("ward", F.when(F.col("ward").isNotNull(), F.col("event_id"))).alias("ward"),
        F.count(F.lit(1)).alias("size"),
    )


@query(ANCHORED + "select user_id, run, dense_rank() over (partition by user_id order by head) as club from (select *, case when ward = '' then first else min(first) over (partition by user_id, kind, ward) end as head from runs)")
def club_runs(t):
    return folds.club_runs(_runs(t), "user_id", "first", ["kind"], ["ward"], threshold=1.0).select("user_id", "run", "club")


#: The place of the first representative that a run matches, among those of its kind.
REP = "list_position(list_transform(m.reps, lambda r: r = '' or y.ward = '' or r = y.ward), true)"


@query(
    ANCHORED
    + f""", y as materialized (select *, row_number() over (partition by user_id, kind order by first) as j from runs),
m as (
  select user_id, kind, run, j, first, [ward] as reps, 1 as spot from y where j = 1
  union all
  select y.user_id, y.kind, y.run, y.j, y.first, case when {REP} is null then list_append(m.reps, y.ward) else m.reps end, coalesce({REP}, len(m.reps) + 1)
  from m join y on y.user_id = m.user_id and y.kind = m.kind and y.j = m.j + 1
)
select user_id, run, dense_rank() over (partition by user_id order by head) as club from (select *, case when kind = '' then first else min(first) over (partition by user_id, kind, spot) end as head from m)"""
)
def club_areas(t):
    runs = _runs(t).withColumn("wards", F.array().cast("array<string>"))
    return folds.club_by_area(runs, "user_id", "first", "kind", "ward", "wards", threshold=1.0).select("user_id", "run", "club")


NEAR = "(y.kind <> '' and y.first - m.last - 1 <= 20 and m.held + y.size <= 50)"


@query(
    ANCHORED
    + f""", y as materialized (select *, row_number() over (partition by user_id, kind order by first) as j from runs),
m as (
  select user_id, kind, run, j, last, size as held, first as head from y where j = 1
  union all
  select y.user_id, y.kind, y.run, y.j, y.last, case when {NEAR} then m.held + y.size else y.size end, case when {NEAR} then m.head else y.first end
  from m join y on y.user_id = m.user_id and y.kind = m.kind and y.j = m.j + 1
)
select user_id, run, dense_rank() over (partition by user_id order by head) as merged from m"""
)
def merge_runs(t):
    return folds.merge_gaps(_runs(t), "user_id", "first", "kind", "first", "last", "size", 20, 50).select("user_id", "run", "merged")


JOINS = "(y.ward <> '' and y.ward = m.ward and (m.held < 5 or y.size < 5) and m.held + y.size <= 40)"


@query(
    ANCHORED
    + f""", y as materialized (select *, row_number() over (partition by user_id order by first) as j from runs),
m as (
  select user_id, run, j, ward, size as held, 1 as joined from y where j = 1
  union all
  select y.user_id, y.run, y.j, y.ward, case when {JOINS} then m.held + y.size else y.size end, case when {JOINS} then m.joined else m.joined + 1 end
  from m join y on y.user_id = m.user_id and y.j = m.j + 1
)
select user_id, run, joined from m"""
)
def coalesce_small(t):
    return folds.coalesce_small(_runs(t).withColumn("size", F.col("size").cast("double")), "user_id", "first", "size", "ward", 5, 40).select("user_id", "run", "joined")


@query()
def leader_cluster(t):
    rows = t("part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 4 == 0, F.replace("p_name", F.lit("a"), F.lit("o"))).otherwise(F.col("p_name")).alias("name"))
    return folds.leader_clusters(rows, "p_brand", "p_partkey", "name", window=400).select("p_partkey", "name", "canonical")


@query("select p_brand, string_agg(v, ';' order by f) as kinds from (select p_brand, p_type as v, min(p_partkey) as f from part where p_type <> '' group by all) group by p_brand")
def fuzzy_distinct(t):
    got = folds.fuzzy_distinct(t("part"), ["p_brand"], "p_type", "p_partkey", threshold=1.0, name="kinds")
    return got.select("p_brand", F.array_join("kinds", ";").alias("kinds"))


RUNG = "select *, count(*) over (partition by {n}) as c{i}, case when count(*) over (partition by {n}) > 1 and {q} is not null and {q} <> '' and {q} <> {n} then {n} || ' (' || {q} || ')' else {n} end as t{i} from {f}"


def _ladder() -> str:
    f, n = "part", "p_name"
    for i, q in enumerate(("p_brand", "p_type", "cast(p_size as varchar)")):
        f = f"({RUNG.format(n=n, q=q, i=i, f=f)})"
        f = f"(select *, case when count(*) over (partition by t{i}) < c{i} then t{i} else {n} end as n{i} from {f})"
        n = f"n{i}"
    return f"select p_partkey, {n} as label from {f}"


@query(_ladder())
def dedupe_names(t):
    rows = t("part").select("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("string").alias("size"))
    return folds.dedupe_names(rows, "p_name", ["p_brand", "p_type", "size"]).select("p_partkey", "label")


LISTS = """
select p_partkey, p_brand, p_size, p_name,
  case p_partkey % 4 when 0 then [] when 1 then [p_brand] when 2 then [p_brand, p_name] else [p_brand, p_name, p_type, 'x' || p_size] end as places,
  case p_partkey % 7 when 0 then [] when 1 then ['w' || p_size] when 2 then [p_brand] when 3 then ['a', 'b', 'c', 'd'] else ['w1', 'w' || p_size % 3 + 2] end as wards,
  case when p_partkey % 3 = 0 then [p_type] else [] end as areas, case when p_partkey % 2 = 0 then 'near ' || p_size else '' end as address
from part"""
#: A trailing number goes, as long as a letter stays; a base name here has no more than two.
TAILED = "case when regexp_matches({x}, '[\\pL].* [0-9]+$') then regexp_replace({x}, '(\\s+[0-9]+)+$', '') else {x} end"


@query(f"""
with x as materialized ({LISTS}), s as (select places[1] as p, count(*) as n from x where len(places) = 1 group by all),
b as (select x.*, coalesce(s.n > 1, false) as shared, array_to_string(wards, ' / ') as listed from x left join s on len(places) = 1 and s.p = places[1]),
n as (select *, len(places) = 1 and shared and len(wards) > 3 as many,
  case when len(places) = 0 then coalesce(wards[1], areas[1], '(unknown)')
    when len(places) = 1 and shared and len(wards) between 1 and 3 then case when places[1] = 'Brand#1' or places[1] = listed then listed else places[1] || ' ' || listed end
    when len(places) = 1 then places[1] when len(areas) = 1 then areas[1] when len(places) <= 3 then array_to_string(places, ' / ') else places[1] || ' + ' || (len(places) - 1) end as base from b),
g as (select *, case when len(places) > 3 and len(areas) <> 1 then base else {TAILED.format(x="base")} end || case when many then ' ' || row_number() over (partition by many, places[1] order by p_partkey) else '' end as named from n),
c as (select *, count(*) over (partition by named) as times from g)
select p_partkey, case when times > 1 and len(wards) <> 1 and address <> '' then address else named end as name from c""")
def name_runs(t):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    none = F.array().cast("array<string>")
    places = F.when(k % 4 == 0, none).when(k % 4 == 1, F.array("p_brand")).when(k % 4 == 2, F.array("p_brand", "p_name")).otherwise(F.array("p_brand", "p_name", "p_type", F.concat(F.lit("x"), size)))
    second = F.concat(F.lit("w"), (F.col("p_size") % 3 + 2).cast("string"))
    wards = F.when(k % 7 == 0, none).when(k % 7 == 1, F.array(F.concat(F.lit("w"), size))).when(k % 7 == 2, F.array("p_brand")).when(k % 7 == 3, F.array(*[F.lit(x) for x in "abcd"])).otherwise(F.array(F.lit("w1"), second))
    runs = t("part").select("p_partkey", places.alias("places"), wards.alias("wards"), F.when(k % 3 == 0, F.array("p_type")).otherwise(none).alias("areas"), F.when(k % 2 == 0, F.concat(F.lit("near "), size)).otherwise("").alias("address"))
    return folds.name_runs(runs, "p_partkey", "places", "wards", "areas", F.lit("Brand#1"), "address", threshold=1.0, tail=r"\s+[0-9]+$").select("p_partkey", "name")
