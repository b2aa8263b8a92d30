"""Aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import parse
from rillstone.operators import groups, sequences

from .registry import query

MODE = "select {k}, v as mode, n as mode_count, rows from (select {k}, v, n, sum(n) over (partition by {k}) as rows, row_number() over (partition by {k} order by n desc, f) as r from (select {k}, {v} as v, count(*) as n, min({o}) as f from {t} group by all)) where r = 1"


@query(MODE.format(k="user_id", v="event_type", o="event_id", t="events"))
def group_mode(t):
    return sequences.first_seen_mode(t("events"), ["user_id"], "event_type", "event_id")


@query("select user_id, v as dominant, n, rows from (select user_id, v, n, sum(n) over (partition by user_id) as rows, row_number() over (partition by user_id order by n desc, f) as r from (select user_id, event_type as v, count(*) as n, min(event_id) as f from events group by all)) where r = 1 and n >= 0.3 * rows")
def dominant_value(t):
    return groups.dominant_value(t("events"), ["user_id"], "event_type", "event_id", 0.3)


@query("select p_brand, left(p_name, 3) as prefix, count(*) as n from part group by all having count(*) >= 3")
def frequent_prefix(t):
    return groups.frequent_prefix(t("part"), ["p_brand"], "p_name")


@query("select user_id, string_agg(event_type, ' / ' order by f) as kinds from (select user_id, event_type, min(event_id) as f from events group by all) group by user_id")
def ordered_distinct(t):
    return t("events").groupBy("user_id").agg(F.array_join(groups.ordered_distinct("event_type", "event_id"), " / ").alias("kinds"))


@query("select event_type, count(*) as items, sum(k) as units, round(sum(k * 0.5 / 1e6), 6) as cost, round(avg(k), 2) as mean_units from (select event_type, cast(json_extract_string(props, '$.k') as bigint) as k from events) group by event_type")
def usage_rollup(t):
    k = parse.json_number(F.col("props"), "k")
    return groups.usage_rollup(t("events").select("event_type", k.alias("k")), ["event_type"], "k", 0.5)


@query("select bucket, unnest(range(k + 1, nxt)) as missing from (select bucket, k, lead(k) over (partition by bucket order by k) as nxt from (select distinct l_orderkey // 100 as bucket, l_orderkey as k from lineitem)) where nxt > k + 1")
def serial_gaps(t):
    return groups.serial_gaps(t("lineitem").select(F.floor(F.col("l_orderkey") / 100).alias("bucket"), "l_orderkey"), ["bucket"], "l_orderkey")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def serial_dups(t):
    return groups.serial_dups(t("lineitem"), ["l_orderkey"], "l_linenumber")


RUNS = "(select *, sum(far) over (partition by user_id, event_type order by event_id) as run from (select *, case when event_id - lag(event_id) over (partition by user_id, event_type order by event_id) - 1 <= 300 then 0 else 1 end as far from events))"


SUMMED = f"""
with r as materialized (select *, cast(floor(value / 30) as bigint) as third from {RUNS}),
seen as (select user_id, event_type, run, string_agg(props, ' / ' order by f) as "values" from (select user_id, event_type, run, props, min(event_id) as f from r where props <> '' group by all) group by all),
modes as (select user_id, event_type, run, arg_max(third, (n, -f)) as modal_third from (select user_id, event_type, run, third, count(*) as n, min(event_id) as f from r where third is not null group by all) group by all),
per as (select user_id, event_type, run, min(event_id) as first_at, max(event_id) as last_at, count(*) as members, round(sum(value), 2) as amount, count(*) filter (where value > 90) as flagged, string_agg(event_id, ',' order by event_id) as member_list from r group by all),
summed as (select per.user_id, per.event_type, first_at, last_at, members, amount, flagged, coalesce("values", '') as "values", member_list, modal_third, case when first_at = last_at then '' || first_at else first_at || '-' || last_at end as range,
  'L' || lpad(cast(row_number() over (partition by per.user_id, per.event_type order by first_at) as varchar), 3, '0') as label
  from per left join seen on (seen.user_id, seen.event_type, seen.run) = (per.user_id, per.event_type, per.run) left join modes on (modes.user_id, modes.event_type, modes.run) = (per.user_id, per.event_type, per.run))
"""


def _summed(t):
    runs = sequences.gap_islands(t("events"), ["user_id", "event_type"], "event_id", 300).withColumn("third", F.floor(F.col("value") / 30))
    return groups.run_summary(runs, ["user_id", "event_type"], "run", "event_id", "props", "value", F.col("value") > 90, "third")


@query(SUMMED + "select * from summed")
def run_summary(t):
    return _summed(t)


@query(SUMMED + "select min(amount) as least_amount, max(amount) as most_amount, round(avg(amount), 2) as mean_amount, min(members) as least_members, max(members) as most_members, round(avg(members), 2) as mean_members, arg_min(first_at, (-members, first_at)) as largest_run from summed")
def size_report(t):
    return groups.size_report(_summed(t), "first_at", "amount", "members")


@query("select user_id, round(avg(value) filter (where value >= 0), 1) as mean_conf, count(value) filter (where value >= 0) as given from events group by user_id")
def mean_confidence(t):
    return groups.mean_confidence(t("events"), ["user_id"], "value")
