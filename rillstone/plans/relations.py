"""Queries over sources, joins, sets and incremental state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rillstone.operators import joins
from rillstone.sources import io

from .registry import query


@query("select 'with' as side, count(*) as n, sum(o_orderkey) as keys from orders where o_orderkey in (select l_orderkey from lineitem) union all select 'without', count(*), sum(o_orderkey) from orders where o_orderkey not in (select l_orderkey from lineitem)")
def semi_anti(t):
    o, k = t("orders"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    one = lambda how, side: o.join(k, "o_orderkey", how).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(side).alias("side"), "n", "keys")
    return one("left_semi", "with").unionByName(one("left_anti", "without"))


@query("select l_orderkey, l_linenumber from (select distinct l_orderkey, l_linenumber from lineitem) except select l_orderkey, l_linenumber from lineitem where l_returnflag = 'R'")
def pending_work(t):
    planned = t("lineitem").select("l_orderkey", "l_linenumber").distinct()
    return joins.pending_work(planned, t("lineitem").where("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"])


@query("select 'both' as op, count(*) as n from (select o_custkey from orders intersect select c_custkey from customer) union all select 'only', count(*) from (select c_custkey from customer except select o_custkey from orders) union all select 'distinct', count(distinct o_custkey) from orders")
def set_ops(t):
    c, o = t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey"))
    n = lambda df, op: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
    return n(o.intersect(c), "both").unionByName(n(c.exceptAll(o.distinct()).distinct(), "only")).unionByName(n(o.distinct(), "distinct"))


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def missing_report(t):
    return t("orders").select("o_orderkey", "o_custkey").join(t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("select o_orderpriority, count(*) as expected, count(*) filter (where l is null) as missing, coalesce(string_agg(o_orderkey, ' ' order by o_orderkey) filter (where l is null), '') as missing_keys from orders left join (select distinct l_orderkey as l from lineitem) on l = o_orderkey group by o_orderpriority")
def coverage(t):
    return joins.coverage(t("orders"), t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderpriority", "o_orderkey")


@query("select q, n_name, n_nationkey from (select q, n_name, n_nationkey, row_number() over (partition by q order by case when lower(n_name) = lower(q) then 0 else 1 end, n_nationkey) as r from (select distinct left(n_name, 3) as q from nation) join nation on contains(lower(n_name), lower(q))) where r = 1")
def tiered_lookup(t):
    q = t("nation").select(F.left("n_name", F.lit(3)).alias("q")).distinct()
    return joins.tiered_lookup(q, t("nation").select("n_name", "n_nationkey"), "q", "n_name", "n_nationkey")


@query("select s_nationkey, arg_max(s_suppkey, (s_acctbal > 5000, s_acctbal, -s_suppkey)) as s_suppkey from supplier group by s_nationkey")
def best_by_score(t):
    return joins.best_by(t("supplier"), "s_nationkey", [F.col("s_acctbal") > 5000, F.col("s_acctbal"), -F.col("s_suppkey")], ["s_suppkey"])


@query("select n_nationkey, coalesce(r_name, cast(n_regionkey as varchar)) as region from nation left join region on r_regionkey = n_regionkey and r_regionkey <> 2")
def map_lookup(t):
    m = t("region").where("r_regionkey <> 2").select(F.col("r_regionkey").cast("string").alias("variant"), F.col("r_name").alias("standard"))
    return joins.map_lookup(t("nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("region")), m, "region")


@query("select o.o_orderkey, o.o_custkey % 10 as batch, coalesce(a.status, o.o_orderstatus) as o_orderstatus, o.o_orderstatus as old_o_orderstatus, case when a.k is null then 'missing' else 'merged' end as flag from orders o left join (select l_orderkey as k, arg_max(l_linestatus, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey * 10 + cast(l_linestatus = 'O' as int)) as status from lineitem group by l_orderkey) a on a.k = o.o_orderkey")
def positional_merge(t):
    # what ties has the same status
    answers = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"), (F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey") * F.lit(10**6) + F.col("l_suppkey") * 10 + (F.col("l_linestatus") == "O").cast("int")).alias("at"))
    req = t("orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("batch"), "o_orderstatus")
    return joins.positional_merge(req, answers, ["o_orderkey"], ["o_orderstatus"], "at")


@query("select a.event_id as a_id, b.event_id as b_id from events a join events b on a.user_id = b.user_id and b.event_id > a.event_id and b.event_id - a.event_id <= 40")
def band_join(t):
    e = t("events")
    a, b = e.select(F.col("event_id").alias("a_id"), F.col("user_id").alias("a_user")), e.select(F.col("event_id").alias("b_id"), F.col("user_id").alias("b_user"))
    return joins.band_join(a, b, "a_id", "b_id", 40, [("a_user", "b_user")]).where("b_id > a_id").select("a_id", "b_id")


@query("select o_orderkey, unnest(range(3, (o_custkey % 9) - 2 + 1)) as page_no from orders where o_custkey % 9 - 2 >= 3")
def page_tasks(t):
    return io.page_tasks(t("orders").select("o_orderkey", "o_custkey"), F.col("o_custkey") % 9).select("o_orderkey", "page_no")


@query("select o_orderkey, i as pos, o_orderkey * 10 + i as a, chr(cast(97 + i as int)) as b from orders, range(0, 3) r(i)")
def zip_arrays(t):
    k = F.col("o_orderkey")
    z = F.arrays_zip(F.array(*[k * 10 + i for i in range(3)]).alias("a"), F.array(*[F.lit(x) for x in "abc"]).alias("b"))
    out = t("orders").select("o_orderkey", F.posexplode(z).alias("pos", "z"))
    return out.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), F.col("z").getField("a").alias("a"), F.col("z").getField("b").alias("b"))


@query("select cast(event_id as varchar) as event_id, event_type, '' as section, coalesce(props, '') as props from events")
def conform_schema(t):
    return io.conform_schema(t("events"), ["event_id", "event_type", "section", "props"])


@query("select event_id, event_type, case when event_id % 2 = 1 then user_id end as user_id from events")
def incremental_union(t):
    e = t("events")
    old, new = e.where("event_id % 2 = 0").select("event_id", "event_type"), e.where("event_id % 2 = 1").select("event_id", "event_type", "user_id")
    return old.unionByName(new, allowMissingColumns=True)


@query("select user_id, bool_or(event_type = 'purchase') as done, count(*) as attempts from events group by user_id")
def manifest_upsert(t):
    rows = t("events").select("user_id", (F.col("event_type") == "purchase").alias("done"), F.lit(1).cast("bigint").alias("attempts"), "event_id")
    return joins.manifest_upsert(rows.where("event_id % 3 = 0").drop("event_id"), rows.where("event_id % 3 <> 0").drop("event_id"), "user_id")


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem")
def explode_nested(t):
    docs = io.nest_documents(t("lineitem"), ["l_orderkey"], ["l_linenumber"], ["l_partkey", "l_quantity"])
    return io.explode_nested(docs.select("l_orderkey", "items"), "items").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("select o_orderkey, o_orderdate, count(l_orderkey) as n_items, coalesce(string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ';' order by l_linenumber, l_partkey, l_suppkey), '') as items from orders left join lineitem on l_orderkey = o_orderkey group by all")
def nest_documents(t):
    docs = io.nest_documents(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], [])
    out = t("orders").select("o_orderkey", "o_orderdate").join(docs, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    cell = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"], x["l_suppkey"])), ";")
    return out.select("o_orderkey", "o_orderdate", F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"), F.coalesce(cell, F.lit("")).alias("items"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def top_k(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("select c_custkey, c_name, row_number() over (order by cast(regexp_replace(c_name, '[^0-9]', '', 'g') as bigint) % 1000, c_custkey) as place from customer")
def numeric_sort(t):
    from rillstone.functions.text import digits_int
    from rillstone.operators.sequences import ordinal

    c = t("customer").withColumn("n", digits_int(F.col("c_name")) % 1000)
    return ordinal(c.select("c_custkey", "c_name", "n"), ["n", "c_custkey"], "place").select("c_custkey", "c_name", "place")


@query("select page_id, try_cast(nullif(regexp_replace(regexp_extract(url, '([^/]*?)([.][^./]*)?$', 1), '[^0-9]', '', 'g'), '') as bigint) as number from pages")
def stem_numbers(t):
    from rillstone.functions.text import stem_number

    return t("pages").select("page_id", stem_number(F.col("url")).alias("number"))


@query("select 10 as files, 45 as numbers, 10 as sized")
def listing_keys(t):
    """Files of a folder with numbered names, listed without reading them."""
    from rillstone.functions.text import stem_number
    from rillstone.sources.working import shared_dir

    spark = t("region").sparkSession
    folder = f"{shared_dir(spark)}/listing-{uuid.uuid4().hex}"
    for i in range(10):
        io.write_text(spark, f"{folder}/part_{i}.txt", f"file {i}")
    io.write_text(spark, f"{folder}/other.csv", "x")
    keys = io.list_keys(spark, folder, "*.txt")
    return keys.agg(F.count(F.lit(1)).alias("files"), F.sum(stem_number(F.col("path"))).alias("numbers"), F.count_if(F.col("length") > 0).alias("sized"))


@query("select 'missing' as side, k as key from (select unnest(range(0, 60, 7)) as k) where k not in (select n_nationkey from nation) union all select 'found', n_nationkey from nation where n_nationkey % 7 = 0")
def subset_report(t):
    wanted = t("nation").sparkSession.range(0, 60, 7).select(F.col("id").alias("n_nationkey"))
    got, lost = joins.subset(t("nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey")), wanted, "n_nationkey")
    return lost.select(F.lit("missing").alias("side"), F.col("n_nationkey").alias("key")).unionByName(got.select(F.lit("found").alias("side"), F.col("n_nationkey").alias("key")))


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 25)")
def pending_copies(t):
    there = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.when(F.col("l_quantity") > 25, 1).otherwise(0)).alias("length"))
    return joins.pending_work(t("orders").select("o_orderkey"), there, ["o_orderkey"], "length")


@query("select o_orderpriority, missing, row_number() over (order by missing desc, o_orderpriority) as place from (select o_orderpriority, count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as missing from orders group by all)")
def most_missing(t):
    per = joins.coverage(t("orders"), t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderpriority", "o_orderkey")
    return joins.most_missing(per.select("o_orderpriority", "missing"), "missing", "o_orderpriority")


@query("select user_id as key, attempts, row_number() over (order by attempts, user_id) as place from (select user_id, bool_or(event_type = 'purchase' and value > 95) as done, count(*) as attempts from events group by all) where not done")
def next_attempts(t):
    rows = t("events").select(F.col("user_id").alias("key"), ((F.col("event_type") == "purchase") & (F.col("value") > 95)).alias("done"), F.lit(1).cast("bigint").alias("attempts"))
    state = joins.manifest_upsert(rows, rows.limit(0))
    return joins.next_attempts(state).select("key", "attempts", "place")


@query("select event_id, (row_number() over (order by event_id) - 1) // 10 as batch from events where value is null or value < 30 or contains(event_type, 'err')")
def retry_batches(t):
    from rillstone.operators.rules import retry_batches

    return retry_batches(t("events"), "conf<30,flags:err", ["event_id"], 10, conf="value", flags="event_type", numeric=True).select("event_id", "batch")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, n from (select *, count(*) over (partition by l_orderkey) as n from lineitem)")
def nested_files(t):
    """A JSON document per order, written and read again."""
    from rillstone.sources.working import shared_dir

    spark = t("lineitem").sparkSession
    path = f"{shared_dir(spark)}/nested-{uuid.uuid4().hex}"
    docs = io.nest_documents(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], [])
    io.write_nested(docs, path)
    return io.read_nested(spark, path, "items", docs.schema, lines=True).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("n_items").alias("n"))


@query("select n_nationkey as key, n_name from nation")
def cached_table(t):
    """Built once for a set of keys, taken from the cache the second time, built anew for another set."""
    from rillstone.sources.working import shared_dir

    spark, nation = t("nation").sparkSession, t("nation").select(F.col("n_nationkey").alias("key"), "n_name")
    path, keys = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}", nation.select("key")
    io.cached(keys.where("key > 5"), "key", path, lambda k: k.join(nation, "key"))
    io.cached(keys, "key", path, lambda k: k.join(nation, "key"))
    return io.cached(keys, "key", path, lambda k: k.withColumn("n_name", F.lit("built again")))


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, o_orderpriority from lineitem left join orders on o_orderkey = l_orderkey")
def header_to_detail(t):
    heads = t("orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.header_to_detail(rows, heads, ["l_orderkey"], ["o_orderdate", "o_orderpriority"])


@query("select doc_id, 'line' as kind, i as no, ls[i] as body from (select doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '') as ls from documents), unnest(range(1, len(ls) + 1)) r(i) union all select doc_id, 'page', len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '')), null from documents")
def expand_pages(t):
    return io.expand_pages(t("documents"), "doc_id", "text")
