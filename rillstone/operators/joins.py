"""Join-shaped operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import ordinal

#: Rows that a lookup side may have to be broadcast.
SMALL = 10_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a side of at most SMALL rows; leave a larger one to the optimizer."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def pending_work(planned: DataFrame, done: DataFrame, keys: Sequence[str], size: str | None = None) -> DataFrame:
    """What is planned and not done; with `size`, a column of `done`, an empty result counts as not done."""
    full = done if size is None else done.where(F.col(size) > 0)
    return planned.join(full.select(*keys).distinct(), list(keys), "left_anti")


def subset(df: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is wanted, and the wanted keys that no row has."""
    keys = wanted.select(key).distinct()
    return df.join(keys, key, "left_semi"), keys.join(df.select(key), key, "left_anti")


def map_lookup(df: DataFrame, mapping: DataFrame, column: str, source: str = "variant", target: str = "standard") -> DataFrame:
    """The column replaced by the mapping's value; values that it lacks stay."""
    m = mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    return df.join(small(m), F.col(column) == F.col("_from"), "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def positional_merge(requests: DataFrame, answers: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """Answers merged back to their requests; the last of several wins, what they replace stays as old_*, none is flagged."""
    last = answers.groupBy(*keys).agg(*[F.max_by(f, order).alias(f"_{f}") for f in fields], F.lit(True).alias("_hit"))
    out = requests.join(last, list(keys), "left")
    for f in fields:
        out = out.withColumn(f"old_{f}", F.col(f)).withColumn(f, F.coalesce(f"_{f}", f)).drop(f"_{f}")
    return out.withColumn("flag", F.when(F.col("_hit"), "merged").otherwise("missing")).drop("_hit")


def band_join(a: DataFrame, b: DataFrame, left: str, right: str, width: int, on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Pairs whose ordinals differ by `width` at most: an equi-join on buckets of that width and the two beside them."""
    x = a.withColumn("_k", F.explode(F.array(*[F.floor(F.col(left) / width) + d for d in (-1, 0, 1)])))
    y = b.withColumn("_l", F.floor(F.col(right) / width))
    cond = (F.col("_k") == F.col("_l")) & (F.abs(F.col(left) - F.col(right)) <= width)
    for p, q in on:
        cond = cond & (F.col(p) == F.col(q))
    return x.join(y, cond).drop("_k", "_l")


def tiered_lookup(queries: DataFrame, table: DataFrame, query: str, name: str, order: str, gram: int = 3) -> DataFrame:
    """For each query the table's first row by (exact match, then containment, then order), whatever the case.

    A query meets the names that hold its first `gram` characters, by an equi-join on runs of characters; a blank query
    meets none.
    """
    key = F.left(F.lower(query), F.lit(gram))
    low = F.lower(name)
    starts = F.sequence(F.lit(1), F.char_length(low))
    grams = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(gram), F.char_length(low) - i + 1)), lambda k: F.substr(low, i, k)))))
    names = table.where(F.char_length(name) > 0).withColumn("_gram", F.explode(grams))
    hits = queries.where(F.char_length(query) > 0).withColumn("_key", key).join(names, F.col("_key") == F.col("_gram")).where(F.contains(F.lower(name), F.lower(query)))
    best = F.struct(F.when(F.lower(name) == F.lower(query), 0).otherwise(1).alias("tier"), F.col(order).alias("at"))
    fields = [c for c in table.columns if c not in queries.columns]
    return hits.groupBy(*queries.columns).agg(F.min_by(F.struct(*fields), best).alias("_b")).select(*queries.columns, *[F.col(f"_b.{f}").alias(f) for f in fields])


def coverage(expected: DataFrame, present: DataFrame, group: str, key: str) -> DataFrame:
    """Per group how many keys are expected and missing, and which."""
    have = present.select(F.col(key).alias("_have")).distinct()
    seen = expected.join(have, F.col(key) == F.col("_have"), "left")
    gone = F.col("_have").isNull()
    return seen.groupBy(group).agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(gone).alias("missing"), F.array_join(F.array_sort(F.collect_list(F.when(gone, F.col(key)))), " ").alias("missing_keys")
    )


def best_by(df: DataFrame, group: str, score: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """Each group's row with the largest composite score."""
    s = F.struct(*[c.alias(f"s{i}") for i, c in enumerate(score)])
    best = F.max_by(F.struct(*fields), s)
    return df.groupBy(group).agg(best.alias("_b")).select(group, *[F.col(f"_b.{f}").alias(f) for f in fields])


def manifest_upsert(state: DataFrame, news: DataFrame, key: str = "key") -> DataFrame:
    """(key, done, attempts): attempts add up, done stays done."""
    return state.unionByName(news).groupBy(key).agg(F.max("done").alias("done"), F.sum("attempts").alias("attempts"))


def within(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether all keys of a are keys of b."""
    return a.select(F.col(key)).join(b.select(F.col(key)), key, "left_anti").where(F.col(key).isNotNull()).isEmpty()


def same_keys(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables hold the same set of keys, as a cache must to stay valid."""
    return within(a, b, key) and within(b, a, key)


def most_missing(groups: DataFrame, missing: str, order: str, name: str = "place") -> DataFrame:
    """Groups by falling number of missing keys, ties in the order given, numbered from 1."""
    return ordinal(groups.withColumn("_less", -F.col(missing)), ["_less", order], name).drop("_less")


def next_attempts(state: DataFrame, key: str = "key", name: str = "place") -> DataFrame:
    """What is not done, the least attempted first, numbered from 1."""
    return ordinal(state.where("not done"), ["attempts", key], name)


def header_to_detail(details: DataFrame, headers: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Each page's header fields on all its rows; a row's own value stays where the header has none."""
    h = headers.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    out = details.join(h, list(keys), "left")
    for f in fields:
        own = F.col(f) if f in details.columns else F.lit(None)
        out = out.withColumn(f, F.coalesce(F.col(f"_{f}"), own)).drop(f"_{f}")
    return out
