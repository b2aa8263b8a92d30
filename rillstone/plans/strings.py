"""Text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import similarity, text

from .registry import query

UP = "upper(replace(trim(regexp_replace({c}, '\\s+', ' ', 'g')), 'ß', 'SS'))"


@query(f"select doc_id, {UP.format(c='text')} as normal from documents")
def text_normalize(t):
    return t("documents").select("doc_id", text.normalize(F.col("text")).alias("normal"))


@query(f"select doc_id, case when len(k) >= 2 then k[1] end as first_token, case when len(k) >= 2 then k[len(k)] end as last_token from (select doc_id, string_split({UP.format(c='text')}, ' ') as k from documents)")
def token_key(t):
    k = text.first_last(F.col("text"))
    return t("documents").select("doc_id", k["first"].alias("first_token"), k["last"].alias("last_token"))


@query("select doc_id, trim(trim(regexp_replace(translate(text, '०१२३४५६७८९', '0123456789'), '\\s+', ' ', 'g')), ' -–:।.') as bare from documents")
def strip_charset(t):
    return t("documents").select("doc_id", text.strip_charset(F.col("text"), " -–:।.").alias("bare"))


CLEAN = "trim(trim(regexp_replace(coalesce(x, ''), '\\s+', ' ', 'g')), ' :;.।|_=+*?¢~`''\"-')"


@query(f"select p_partkey, case when v = '' and contains(coalesce(x, ''), '-') then '-' else v end as cleaned from (select p_partkey, x, {CLEAN} as v from (select p_partkey, case p_partkey % 4 when 0 then ' - ' when 1 then null when 2 then '*' || p_name || ' |' else p_name end as x from part))")
def clean_value(t):
    k = F.col("p_partkey") % 4
    x = F.when(k == 0, F.lit(" - ")).when(k == 1, F.lit(None).cast("string")).when(k == 2, F.concat(F.lit("*"), "p_name", F.lit(" |"))).otherwise(F.col("p_name"))
    return t("part").select("p_partkey", text.clean_value(x).alias("cleaned"))


@query("select p_partkey, trim(trim(regexp_replace(regexp_replace(regexp_replace(p_name || ', ,room ' || p_size, 'room\\s*[0-9]+', ' ', 'g'), '\\s*,(\\s*,)+', ', ', 'g'), '\\s+', ' ', 'g')), ', ') as stripped from part")
def regex_strip(t):
    return t("part").select("p_partkey", text.regex_strip(F.concat("p_name", F.lit(", ,room "), "p_size"), [r"room\s*[0-9]+"]).alias("stripped"))


@query("select c_custkey, cast(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') as bigint) as number from customer")
def digits_int(t):
    return t("customer").select("c_custkey", text.digits_int(F.col("c_name")).alias("number"))


@query("select s_suppkey, try_cast(nullif(regexp_replace(translate(x, 'OoDQIl|/SBZ', '00001117582'), '[^0-9]', '', 'g'), '') as bigint) as number from (select s_suppkey, translate(cast(s_suppkey * 7919 as varchar), '015', 'OlS') as x from supplier)")
def digits_repair(t):
    x = F.translate((F.col("s_suppkey") * 7919).cast("string"), "015", "OlS")
    return t("supplier").select("s_suppkey", text.digits_repair(x).alias("number"))


@query("select p_partkey, regexp_replace(upper(p_brand || '/' || p_type), '[^A-Z0-9/]', '', 'g') as code from part")
def alnum_code(t):
    return t("part").select("p_partkey", text.alnum_code(F.concat("p_brand", F.lit("/"), "p_type"), "/").alias("code"))


@query("select c_custkey, case when length(x) <= 3 then x else translate(left(x, 3), '0125867', 'OIZSBGY') || translate(substring(x, 4), 'OIZSBGY', '0125867') end as code from (select c_custkey, translate(left(upper(c_name), 3), 'OISBC', '0158C') || translate(cast(c_custkey as varchar), '0128', 'OIZB') as x from customer)")
def positional_repair(t):
    x = F.concat(F.translate(F.left(F.upper("c_name"), F.lit(3)), "OISBC", "0158C"), F.translate(F.col("c_custkey").cast("string"), "0128", "OIZB"))
    return t("customer").select("c_custkey", text.positional_repair(x).alias("code"))


@query("select event_id, regexp_extract(props || ' at ' || cast(round(value, 2) as varchar), '-?\\d+\\.\\d+', 0) as decimal_text from events")
def extract_decimal(t):
    v = F.col("value")
    # the number as DuckDB prints a rounded double: no exponent here, one digit at least behind the point
    return t("events").select("event_id", text.extract_decimal(F.concat("props", F.lit(" at "), F.round(v, 2).cast("string"))).alias("decimal_text"))


@query("select p_partkey, array_to_string(list_transform(string_split(trim(x), ' '), lambda w: case when regexp_matches(w, '[|!\\[\\]]') then regexp_replace(w, '[|!\\[\\]]', case when regexp_replace(w, '[^\\pL]', '', 'g') <> '' and regexp_replace(w, '[^\\pL]', '', 'g') = upper(regexp_replace(w, '[^\\pL]', '', 'g')) then 'I' else 'l' end, 'g') else w end), ' ') as words from (select p_partkey, translate(p_name || ' ' || upper(p_name), 'lI', '|!') as x from part)")
def word_transform(t):
    x = F.translate(F.concat("p_name", F.lit(" "), F.upper("p_name")), "lI", "|!")
    return t("part").select("p_partkey", text.word_transform(x).alias("words"))


TYPES = ("ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE")


@query("with v as (select unnest(['ECONOMY','STANDARD','PROMO','SMALL','MEDIUM','LARGE']) as w), x as (select p_partkey, case when p_partkey % 3 = 0 then 'x' || substring(p_type, 2) else p_type end as s from part), d as (select p_partkey, s, w, levenshtein(lower(s), lower(w)) as d from x, v), r as (select p_partkey, s, min(d) as best, arg_min(w, d) as w, count(*) filter (where d = m) as n from (select *, min(d) over (partition by p_partkey) as m from d) group by p_partkey, s) select p_partkey, case when best <= 2 and n = 1 then w else s end as snapped from r")
def vocab_snap(t):
    x = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("x"), F.substr("p_type", F.lit(2)))).otherwise(F.col("p_type"))
    return t("part").select("p_partkey", text.vocab_snap(x, TYPES).alias("snapped"))


TAIL = r"\s*[.#:-]?\s*(no\.?)?\s*[0-9]+\s*$"


CUT = f"trim(regexp_replace(x, '{TAIL}', ''))"


@query(f"with recursive f as (select p_partkey, case when p_partkey % 5 = 0 then 'ward ' || p_size when p_partkey % 5 = 1 then p_name || ' 1 2 3 4 5 6 7 8 9' else p_name || ' no ' || p_size || ' - 0' || p_partkey % 7 end as x, 0 as i from part union all select p_partkey, {CUT}, i + 1 from f where {CUT} <> x and regexp_matches({CUT}, '[\\pL]') and lower({CUT}) <> 'ward') select p_partkey, arg_max(x, i) as base from f group by p_partkey")
def fixpoint_strip(t):
    k = F.col("p_partkey")
    x = F.when(k % 5 == 0, F.concat(F.lit("ward "), "p_size")).when(k % 5 == 1, F.concat("p_name", F.lit(" 1 2 3 4 5 6 7 8 9"))).otherwise(F.concat("p_name", F.lit(" no "), "p_size", F.lit(" - 0"), k % 7))
    return t("part").select("p_partkey", text.fixpoint_strip(x, TAIL, ("ward",)).alias("base"))


@query("select page_id, trim(case when greatest(case when contains(url, '/') then length(url) - instr(reverse(url), '/') + 1 else 0 end, case when contains(url, '.') then length(url) - instr(reverse(url), '.') + 1 else 0 end) > 0 then substring(url, greatest(case when contains(url, '/') then length(url) - instr(reverse(url), '/') + 1 else 0 end, case when contains(url, '.') then length(url) - instr(reverse(url), '.') + 1 else 0 end) + 1) else '' end) as rest, trim(left(url, greatest(case when contains(url, '/') then length(url) - instr(reverse(url), '/') + 1 else 0 end, case when contains(url, '.') then length(url) - instr(reverse(url), '.') + 1 else 0 end))) as head from pages")
def keyword_cut(t):
    url = F.col("url")
    return t("pages").select("page_id", text.keyword_cut(url, ["/", "."]).alias("rest"), text.keyword_cut(url, ["/", "."], before=True).alias("head"))


@query("select page_id, trim(split_part(url, '/', 1)) as head, trim(split_part(url, '/', -1)) as tail from pages")
def split_tail(t):
    head, tail = text.split_tail(F.col("url"), "/")
    return t("pages").select("page_id", head.alias("head"), tail.alias("tail"))


NAMES = "(select distinct p_name as name from part)"


def _pairs(t):
    """Pairs of a closed list of part names."""
    n = t("part").select(F.col("p_name").alias("name")).distinct()
    return n.select(F.col("name").alias("a")).join(n.select(F.col("name").alias("b")), F.col("a") < F.col("b"))


@query(f"select x.name as a, y.name as b, cast(len(list_filter(range(0, least(length(x.name), length(y.name)) + 1), lambda i: left(x.name, i) = left(y.name, i))) - 1 as bigint) as shared from {NAMES} x join {NAMES} y on x.name < y.name")
def prefix_len(t):
    return _pairs(t).select("a", "b", text.prefix_len(F.col("a"), F.col("b")).cast("bigint").alias("shared"))


@query(f"select x.name as a, y.name as b from {NAMES} x join {NAMES} y on x.name < y.name and levenshtein(x.name, y.name) <= 6")
def edit_within(t):
    return _pairs(t).where(text.edit_within(F.col("a"), F.col("b"), 6))


@query(f"select x.name as a, y.name as b, cast(levenshtein(x.name, y.name) as bigint) as edits from {NAMES} x join {NAMES} y on x.name < y.name")
def edit_distance(t):
    return _pairs(t).select("a", "b", F.levenshtein("a", "b").cast("bigint").alias("edits"))


@query()
def ratio_match(t):
    a, b = F.col("a"), F.col("b")
    return _pairs(t).where(similarity.may_match(a, b, 0.6)).withColumn("ratio", F.round(similarity.ratio(a, b), 4)).where("ratio >= 0.6")


@query("select o_orderkey, unnest(list_distinct(list_concat(range(o_orderkey % 5, o_orderkey % 9 + 1), [o_orderkey % 11 + 20]))) as item from orders")
def range_expand(t):
    k = F.col("o_orderkey")
    x = F.concat((k % 5).cast("string"), F.lit("-"), (k % 9).cast("string"), F.lit(", x, 3-, "), (k % 11 + 20).cast("string"))
    return t("orders").select("o_orderkey", F.explode(F.array_distinct(text.range_list(x))).alias("item"))
