"""Queries that parse, price, flag and arbitrate."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import parse
from rillstone.operators import rules

from .registry import query


@query("select page_id, regexp_extract(url, '^[a-z]+://([^/:]+)', 1) as host, coalesce(nullif(regexp_extract(url, '([0-9]+)$', 1), ''), nullif(regexp_extract(url, '([^/]+)/?$', 1), '')) as last_part from pages")
def regex_capture(t):
    u = F.col("url")
    return t("pages").select("page_id", F.regexp_extract(u, "^[a-z]+://([^/:]+)", 1).alias("host"), parse.capture(u, "([0-9]+)$", "([^/]+)/?$").alias("last_part"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as plain, cast(json_extract(props, '$.k') as bigint) as nested from events")
def json_extract(t):
    x = F.concat(F.lit("answer: "), "props", F.lit(" end"))
    response = F.to_json(F.struct(F.lit("done").alias("status"), F.lit("no object here").alias("text"), F.array(F.struct(F.struct(F.array(F.struct(x.alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    paths = ("$.output_text", "$.text", "$.candidates[*].content.parts[*].text")
    return t("events").select("event_id", parse.first_json(x, "k bigint")["k"].alias("plain"), parse.first_json(response, "k bigint", *paths)["k"].alias("nested"))


@query("select event_id, case event_id % 6 when 0 then 3 when 1 then 7 when 2 then 12 when 3 then 0 when 4 then -2 else coalesce(try_cast(json_extract_string(props, '$.k') as bigint), 0) end as n from events")
def json_coalesce(t):
    cases = ['{"a": 3.7, "k": 1}', '{"a": "-5", "k": 7}', '{"a": true, "k": "12"}', '{"a": null, "k": "1.5"}', '{"a": -2.9}']
    made = F.coalesce(*[F.when(F.col("event_id") % 6 == i, F.lit(c)) for i, c in enumerate(cases)], F.col("props"))
    return t("events").select("event_id", parse.json_number(made, "a", "k", default=0).alias("n"))


@query("select o_orderkey, round(case when coalesce(given, 0) = 0 and coalesce(made, 0) + coalesce(thoughts, 0) = 0 then total * 3.0 else (coalesce(given, 0) - least(coalesce(cached, 0), coalesce(given, 0))) * 0.5 + least(coalesce(cached, 0), coalesce(given, 0)) * 0.05 + (coalesce(made, 0) + coalesce(thoughts, 0)) * 3.0 end / 1e6, 6) as cost from (select o_orderkey, case when o_orderkey % 3 > 0 then o_orderkey * 10 when o_orderkey % 2 = 0 then 0 end as given, case when o_orderkey % 2 = 0 then o_orderkey * 4 end as cached, case when o_orderkey % 3 > 0 then o_custkey when o_orderkey % 5 = 0 then 0 end as made, case when o_orderkey % 7 = 0 then o_custkey * 2 end as thoughts, o_orderkey + o_custkey as total from orders)")
def tiered_cost(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    given, made = F.when(k % 3 > 0, k * 10).when(k % 2 == 0, 0), F.when(k % 3 > 0, c).when(k % 5 == 0, 0)
    cost = parse.tiered_cost(given, F.when(k % 2 == 0, k * 4), made, k + c, F.when(k % 7 == 0, c * 2))
    return t("orders").select("o_orderkey", F.round(cost, 6).alias("cost"))


BOXES = "select user_id, cast(event_id % 97 * 10 as int) as x, cast(event_id % 53 * 20 as int) as y, cast(event_id % 41 * 11 + 5 as int) as w, cast(event_id % 37 * 5 + 3 as int) as h, event_id from events"


@query(f"select user_id, string_agg(x || ',' || y, ';' order by round_even(y / 20.0, 0), x, y, w, h) as cards from (select distinct user_id, x, y, w, h from ({BOXES})) where w > 0.2 * 1000 and w < 0.4 * 1000 and h > 0.04 * 1000 and h < 0.16 * 1000 group by user_id")
def card_boxes(t):
    cards = parse.card_boxes(F.col("boxes"), F.struct(F.lit(1000).alias("w"), F.lit(1000).alias("h")))
    got = _boxes(t).select("user_id", F.array_join(F.transform(cards, lambda b: F.concat_ws(",", b["x"], b["y"])), ";").alias("cards"))
    return got.where("cards <> ''")


def _boxes(t):
    k = F.col("event_id")
    box = F.struct((k % 97 * 10).cast("int").alias("x"), (k % 53 * 20).cast("int").alias("y"), (k % 41 * 11 + 5).cast("int").alias("w"), (k % 37 * 5 + 3).cast("int").alias("h"))
    return t("events").groupBy("user_id").agg(F.array_sort(F.collect_set(box)).alias("boxes"))


INSIDE = f"(select distinct user_id, x, y, w, h from ({BOXES}) where x > 50 and y > 40 and x + w < 850 and y + h < 640)"


@query(f"""
with s as (select user_id, arg_max(x || ',' || y || ',' || w || ',' || h, (w, -x, -y, -h)) as serial from {INSIDE} where w > 0.15 * 800 and w < 0.5 * 800 and h < 0.3 * 600 and y - 40 < 0.3 * 600 group by user_id),
p as (select user_id, arg_max(x, (h, -x, -y, -w)) as photo_x from {INSIDE} where w > 0.10 * 800 and w < 0.35 * 800 and h > 0.45 * 600 group by user_id)
select u.user_id, coalesce(serial, '50,40,280,108') as serial, coalesce(photo_x, 642) as photo_x from (select distinct user_id from events) u left join s on s.user_id = u.user_id left join p on p.user_id = u.user_id""")
def card_regions(t):
    card = F.struct(F.lit(50).alias("x"), F.lit(40).alias("y"), F.lit(800).alias("w"), F.lit(600).alias("h"))
    r = parse.card_regions(card, F.col("boxes"))
    return _boxes(t).select("user_id", F.concat_ws(",", *[r["serial"][c] for c in "xywh"]).alias("serial"), r["photo_x"].alias("photo_x"))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(c, total - a - b) as third, case when total is null or coalesce(c, total - a - b) is null then '?' when a + b + coalesce(c, total - a - b) = total then 'Y' else 'N' end as adds_up from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey as a, l_suppkey as b, case when l_linenumber % 2 = 0 then l_orderkey % 3 end as c, case when l_linenumber % 5 > 0 then l_partkey + l_suppkey + 1 end as total from lineitem)")
def identity_check(t):
    n = F.col("l_linenumber")
    third, ok = parse.identity_check([F.col("l_partkey"), F.col("l_suppkey"), F.when(n % 2 == 0, F.col("l_orderkey") % 3)], F.when(n % 5 > 0, F.col("l_partkey") + F.col("l_suppkey") + 1))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", third.alias("third"), ok.alias("adds_up"))


FLAGS = "array_to_string(list_filter([case when value < 10 then 'low' end, case when value > 90 then 'high' end, case when event_type = 'error' then 'error' end, case when user_id % 10 = 0 then 'tenth' end], lambda x: x is not null), ';')"


def _flagged(t):
    f = parse.flags((F.col("value") < 10, "low"), (F.col("value") > 90, "high"), (F.col("event_type") == "error", "error"), (F.col("user_id") % 10 == 0, "tenth"))
    return t("events").select("event_id", "event_type", "value", f.alias("flags"))


@query(f"select event_id, {FLAGS} as flags, case when contains(';' || {FLAGS} || ';', ';error;') then 'checked' else 'plain' end as origin from events")
def flag_assembly(t):
    return _flagged(t).select("event_id", F.array_join("flags", ";").alias("flags"), F.when(F.array_contains("flags", "error"), "checked").otherwise("plain").alias("origin"))


@query(f"select flag, count(*) as n from (select unnest(string_split({FLAGS}, ';')) as flag from events) where flag <> '' group by flag")
def flag_histogram(t):
    return _flagged(t).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query("with x as (select p_partkey, p_name as a, case when p_partkey % 4 = 0 then replace(p_name, 'a', 'o') else p_name end as b, upper(split_part(p_name, ' ', 1)) || ' ' || p_brand as other, cast(p_size as double) as ca, 25.0 as cb, case when p_partkey % 5 > 0 then '' || p_size else '' end as na, case when p_partkey % 6 = 0 then null when p_partkey % 3 = 0 then '9' || p_size else '' || p_size end as nb from part), s as (select *, string_split(upper(other) || ' ' || upper(b), ' ') as pool from x), c as (select *, len(list_filter(string_split(upper(a), ' '), lambda w: list_contains(pool, w))) as sa, len(list_filter(string_split(upper(b), ' '), lambda w: list_contains(pool, w))) as sb, coalesce(na <> '' and nb <> '' and na <> nb, false) as nd from s) select p_partkey, case when a <> b and (sb > sa or (sa = sb and cb > ca)) then b else a end as reading, case when nd and cb > ca then nb else na end as number, concat_ws(';', case when a <> b then 'name_arbitrated' end, case when nd then 'number_arbitrated' end) as flags from c")
def arbitrate_readings(t):
    a, k = F.col("p_name"), F.col("p_partkey")
    b = F.when(k % 4 == 0, F.replace(a, F.lit("a"), F.lit("o"))).otherwise(a)
    other = F.concat(F.upper(F.split_part(a, F.lit(" "), F.lit(1))), F.lit(" "), "p_brand")
    sure = (F.col("p_size").cast("double"), F.lit(25.0))
    got, differed = parse.arbitrate(a, b, [other, b], *sure)
    size = F.col("p_size").cast("string")
    number, also = parse.arbitrate_simple(F.when(k % 5 > 0, size).otherwise(""), F.when(k % 6 == 0, None).when(k % 3 == 0, F.concat(F.lit("9"), size)).otherwise(size), *sure)
    return t("part").select("p_partkey", got.alias("reading"), number.alias("number"), F.array_join(parse.flags((differed, "name_arbitrated"), (also, "number_arbitrated")), ";").alias("flags"))


@query("select round(avg(cast(p_name = case when p_partkey % 4 = 0 then replace(p_name, 'a', 'o') else p_name end as int)), 4) as name_rate, round(avg(cast(p_brand = case when p_partkey % 7 = 0 then 'x' else p_brand end as int)), 4) as brand_rate, count(*) as n from part")
def field_accuracy(t):
    truth = t("part").select("p_partkey", "p_name", "p_brand")
    read = truth.select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, F.replace("p_name", F.lit("a"), F.lit("o"))).otherwise(F.col("p_name")).alias("p_name"), F.when(F.col("p_partkey") % 7 == 0, "x").otherwise(F.col("p_brand")).alias("p_brand"))
    return rules.field_accuracy(read, truth, "p_partkey", {"p_name": "name_rate", "p_brand": "brand_rate"})


OPENING = "(?:The|To|De|En|Un|La|Der)(?: .*)?"

#: A field ends up as the lines of its last labelled line, up to the next labelled one.
FOLDED = f"""
with l as (select doc_id, i, trim(ls[i]) as x from (select doc_id, string_split(text, chr(10)) as ls from documents), unnest(range(1, len(ls) + 1)) r(i)),
k as (select *, case when regexp_matches(x, '^(.* [|] .*)$') then 'table' when regexp_matches(x, '^({OPENING})$') then 'opening' end as kind from l),
g as (select *, count(kind) over (partition by doc_id order by i) as grp from k),
e as (select doc_id, kind, max(grp) as grp from g where kind is not null group by all),
v as (select g.doc_id, e.kind, string_agg(x, ' ' order by i) filter (where x <> '') as val from g join e on g.doc_id = e.doc_id and g.grp = e.grp group by all)
select d.doc_id, coalesce(max(val) filter (where kind = 'table'), '') as table_text, coalesce(max(val) filter (where kind = 'opening'), '') as opening_text from documents d left join v on v.doc_id = d.doc_id group by d.doc_id
"""


@query(FOLDED)
def line_fold(t):
    # documents have no labels of their own: a short opening word and a bar make two kinds of line
    lines = F.split("text", "\n")
    out = parse.line_fold(lines, [("table", "^(.* [|] .*)$"), ("opening", f"^({OPENING})$")])
    return t("documents").select("doc_id", out["table"].alias("table_text"), out["opening"].alias("opening_text"))


@query("select event_id, event_type, value from events where (value is null or value < 20 or contains(event_type, 'err')) and (event_type <> '' or props <> '')")
def rule_filter(t):
    return t("events").where(rules.parse_rule("conf<20,flags:err", conf="value", flags="event_type", numeric=True)).where((F.col("event_type") != "") | (F.col("props") != "")).select("event_id", "event_type", "value")
