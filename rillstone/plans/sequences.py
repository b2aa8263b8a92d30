"""Ordered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import sequences as seq

from .registry import query

READ = "case when turn % 5 = 3 then null when turn % 7 = 4 then turn + 9 else turn + conv_id % 4 + 1 end"


@query(f"with x as (select conv_id, turn, {READ} as read, row_number() over (partition by conv_id order by turn) - 1 as i from conversations), o as (select conv_id, read - i as off, count(*) as n, min(i) as f from x where read > 0 group by all), b as (select conv_id, arg_max(off, (n, -f)) as base from o group by conv_id having sum(n) >= 3) select x.conv_id, turn, read, case when base is null then read else base + i end as fitted, case when base is null and read is null then 'unfitted' when base is not null and read is not null and read <> base + i then 'mismatch' else '' end as flag from x left join b on b.conv_id = x.conv_id")
def sequence_fit(t):
    k = F.col("turn")
    read = F.when(k % 5 == 3, F.lit(None).cast("bigint")).when(k % 7 == 4, k + 9).otherwise(k + F.col("conv_id") % 4 + 1)
    return seq.sequence_fit(t("conversations").select("conv_id", "turn", read.alias("read")), "conv_id", "turn", "read").select("conv_id", "turn", "read", "fitted", "flag")


HEADS = ("ABC", "ABD", "XYZ", "KLM")


VOTES = """
with r as (
  select c_custkey, c_nationkey, case when c_custkey % 17 = 0 then null else
    (case when c_custkey % 13 = 0 then translate(h, 'B', '8') else h end) || (case when c_custkey % 9 = 0 then translate(n, '0', 'O') else n end) end as code
  from (select c_custkey, c_nationkey, ['ABC', 'ABD', 'XYZ', 'KLM'][c_nationkey % 2 + case when c_custkey % 11 = 0 then 2 else 1 end] as h, lpad(cast(c_custkey * 7919 as varchar), 7, '0') as n from customer)
), x as (
  select *, case when length(raw) <= 3 then raw else translate(left(raw, 3), '0125867', 'OIZSBGY') || translate(substring(raw, 4), 'OIZSBGY', '0125867') end as c
  from (select *, coalesce(code, '') as raw from r)
), good as (select c_nationkey as p, c_custkey as o, left(c, 3) as h, length(c) - 3 as n from x where regexp_matches(c, '^[A-Z]{2,4}[0-9]{6,9}$')),
common as (select p, h from good group by p, h having count(*) >= 3),
modal as (select p, arg_max(n, (k, -f)) as m from (select p, n, count(*) as k, min(o) as f from good group by p, n) group by p),
y as (
  select x.*, coalesce(m, 0) as m, case when regexp_matches(c, '^[A-Z]+[0-9]+$') then regexp_extract(c, '^([A-Z]+)', 1) else substring(c, 1, greatest(length(c) - coalesce(m, 0), 0)) end as head
  from x left join modal on p = c_nationkey
), z as (select *, substring(c, length(head) + 1) as tail from y),
near as (
  select c_custkey, min(d) as d, count(*) filter (where d = least_d) as n, arg_min(h, (d, h)) as h, bool_or(h = head) as own
  from (select c_custkey, head, h, levenshtein(head, h) as d, min(levenshtein(head, h)) over (partition by c_custkey) as least_d from z join common on p = c_nationkey) group by c_custkey
), w as (
  select z.*, near.h as best, coalesce(not own and near.d <= 2 and near.n = 1 and regexp_matches(tail, '^[0-9]+$') and c <> '', false) as fix, regexp_matches(c, '^[A-Z]{2,4}[0-9]{6,9}$') as form
  from z left join near on near.c_custkey = z.c_custkey
)
select c_custkey, c_nationkey, code, case when fix then best || tail else c end as repaired,
  array_to_string(list_filter([case when c <> raw then 'glyph_fixed' end, case when c = '' then 'missing' end, case when fix then 'prefix_fixed' end, case when c <> '' and not fix and not form then 'bad' end,
    case when case when fix then m > 0 and length(tail) <> m else form and m > 0 and length(c) - 3 <> m end then 'length' end], lambda f: f is not null), ';') as flags
from w
"""


@query(VOTES)
def vote_repair(t):
    k = F.col("c_custkey")
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (F.col("c_nationkey") % 2 + F.when(k % 11 == 0, 2).otherwise(1)).cast("int"))
    code = F.when(k % 17 == 0, F.lit(None)).otherwise(F.concat(F.when(k % 13 == 0, F.translate(head, "B", "8")).otherwise(head), F.when(k % 9 == 0, F.translate(F.lpad((k * 7919).cast("string"), 7, "0"), "0", "O")).otherwise(F.lpad((k * 7919).cast("string"), 7, "0"))))
    rows = t("customer").select("c_custkey", "c_nationkey", code.alias("code"))
    return seq.vote_repair(rows, "c_nationkey", "code", "c_custkey")


BLANKED = "(select event_id, user_id, case when event_id % 7 = 0 then null else event_type end as kind from events)"


def _blanked(t):
    return t("events").select("event_id", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("kind"))


@query(f"select event_id, user_id, kind, sum(case when kind <> before then 1 else 0 end) over (partition by user_id order by event_id) + 1 as run from (select *, last_value(kind ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as before from {BLANKED})")
def islands(t):
    return seq.islands(_blanked(t), "user_id", "event_id", "kind")


@query("select event_id, user_id, event_type, sum(far) over (partition by user_id, event_type order by event_id) as run from (select *, case when event_id - lag(event_id) over (partition by user_id, event_type order by event_id) - 1 <= 200 then 0 else 1 end as far from events)")
def gap_islands(t):
    return seq.gap_islands(t("events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], "event_id", 200)


@query("select o_orderkey, (row_number() over (order by o_orderdate, o_orderkey) - 1) // 30 as batch from orders")
def batching(t):
    return seq.batching(t("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 30).select("o_orderkey", "batch")


@query("select p_partkey, p_name || case when n = 0 then '' else ' ' || n end as label from (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) - 1 as n from part)")
def running_suffix(t):
    return seq.running_suffix(t("part").select("p_partkey", "p_name"), "p_name", "p_partkey", "label").select("p_partkey", "label")


@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey) as r from orders) where r = 1")
def keep_first(t):
    return seq.keep_first(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey")


@query("select p_partkey, case when row_number() over (partition by p_name order by p_partkey) > 1 then p_name || '__' || p_partkey else p_name end as file from part")
def collision_suffix(t):
    return seq.collision_suffix(t("part").select("p_partkey", "p_name"), "p_name", "p_partkey", "p_partkey", "file").select("p_partkey", "file")


@query("select p_partkey, row_number() over (partition by p_brand order by p_size // 10, p_retailprice, p_partkey) as place from part")
def grid_order(t):
    rows = t("part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return seq.grid_order(rows, "p_brand", F.floor(F.col("p_size") / 10), "p_retailprice", "p_partkey").select("p_partkey", "place")


@query("select o_orderkey, (i // 12) as sheet, (i % 12) // 4 as grid_row, i % 4 as grid_col from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i from orders)")
def grid_layout(t):
    d = seq.ordinal(t("orders").select("o_orderkey"), ["o_orderkey"], "n").withColumn("i", F.col("n") - 1)
    return d.select("o_orderkey", F.floor(F.col("i") / 12).alias("sheet"), F.floor(F.col("i") % 12 / 4).alias("grid_row"), (F.col("i") % 4).alias("grid_col"))


@query("with recursive x as (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_orderkey) as i from orders), f as (select o_custkey, o_orderkey, o_totalprice, i, o_totalprice as used, 1 as chunk from x where i = 1 union all select x.o_custkey, x.o_orderkey, x.o_totalprice, x.i, case when f.used + x.o_totalprice > 500000 then x.o_totalprice else f.used + x.o_totalprice end, case when f.used + x.o_totalprice > 500000 then f.chunk + 1 else f.chunk end from f join x on x.o_custkey = f.o_custkey and x.i = f.i + 1) select o_custkey, o_orderkey, o_totalprice, chunk from f")
def capacity_chunks(t):
    return seq.capacity_chunks(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey", "o_totalprice", 500000.0)


PIECES = """
with a as (select o_custkey as c, o_orderkey as k, o_totalprice as s, case when o_orderkey % 6 = 0 then null else o_orderstatus end as l from orders),
b as (select *, last_value(l ignore nulls) over (partition by c order by k rows between unbounded preceding and 1 preceding) as before from a),
p as (select *, sum(case when l <> before then 1 else 0 end) over (partition by c order by k) as piece from b),
x as materialized (select *, sum(s) over (partition by c) as whole, sum(s) over (partition by c, piece) as part, count(*) over (partition by c, piece) as n, row_number() over (partition by c, piece order by k) as i from p)"""


@query(PIECES.replace("with a", "with recursive a") + """,
f as (
  select c, k, s, piece, whole, part, n, i, s as used, 1 as fill from x where i = 1
  union all
  select x.c, x.k, x.s, x.piece, x.whole, x.part, x.n, x.i, case when f.used + x.s > 300000 then x.s else f.used + x.s end, case when f.used + x.s > 300000 and x.whole > 300000 and x.part > 300000 then f.fill + 1 else f.fill end
  from f join x on x.c = f.c and x.piece = f.piece and x.i = f.i + 1
)
select c as o_custkey, k as o_orderkey, dense_rank() over (partition by c order by case when whole <= 300000 then 0 else piece + 1 end, fill) as chunk from f""")
def split_oversized(t):
    rows = t("orders").select("o_custkey", "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus")).alias("kind"))
    return seq.capacity_chunks(rows, "o_custkey", "o_orderkey", "o_totalprice", 300000.0, "kind").select("o_custkey", "o_orderkey", "chunk")
