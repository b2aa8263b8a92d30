"""Grouped statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import first_seen_mode, ranked


def group_stats(df: DataFrame, keys: Sequence[str], number: str, token: str, category: str, names: Sequence[str], ident: str, low: float, high: float) -> DataFrame:
    """Per group: members, distinct tokens, mean (1 place) and sample deviation (2 places, 0 for one) of the plausible
    numbers, implausible ones, a count for each named category and for the rest, and the ordered ids."""
    ok = F.col(number).between(low, high)
    good = F.when(ok, F.col(number))
    named = [F.count_if(F.col(category) == n).alias(f"n_{n}") for n in names]
    other = F.count_if(F.coalesce(~F.col(category).isin(*names), F.lit(True))).alias("n_other")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_distinct(token).alias("tokens"),
        F.round(F.avg(good), 1).alias("mean"),
        F.round(F.coalesce(F.stddev_samp(good), F.lit(0.0)), 2).alias("deviation"),
        F.count_if(F.col(number).isNotNull() & ~ok).alias("implausible"),
        *named,
        other,
        F.array_join(F.array_sort(F.collect_list(ident)), ";").alias("ids"),
    )


def partition_summary(stats: DataFrame, part: str, totals: Sequence[str] = ()) -> DataFrame:
    """Over the groups of a part: rows, groups, mean size and mean deviation, and the sums of further counts."""
    return stats.groupBy(part).agg(
        F.sum("members").alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.round(F.sum("members") / F.count(F.lit(1)), 2).alias("mean_size"),
        F.round(F.avg("deviation"), 2).alias("mean_deviation"),
        *[F.sum(c).alias(f"total_{c}") for c in totals],
    )


def grand_summary(stats: DataFrame, ident: str) -> DataFrame:
    """Over all groups, and over those of several members; sizes, the largest group (the first of equals) and whether
    it is suspiciously large: more than 25 rows and a fifth of all."""
    many = F.col("members") > 1
    return stats.agg(
        F.sum("members").alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(many).alias("groups_of_many"),
        F.max("members").alias("largest"),
        F.round(F.avg("tokens"), 2).alias("mean_tokens"),
        F.round(F.avg(F.when(many, F.col("tokens"))), 2).alias("mean_tokens_of_many"),
        F.round(F.avg(F.when(many, F.col("deviation"))), 2).alias("mean_deviation_of_many"),
        F.min("members").alias("smallest"),
        F.max_by(ident, F.struct("members", -F.col(ident))).alias("largest_group"),
        (F.max("members") > F.greatest(F.lit(25), F.floor(F.sum("members") / 5))).alias("oversize"),
    )


def size_report(runs: DataFrame, ident: str, amount: str, members: str) -> DataFrame:
    """Least, largest and mean amount and member count of runs, and the run with the most members (the first of equals)."""
    sizes = [g for c in (amount, members) for g in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}"), F.round(F.avg(c), 2).alias(f"mean_{c}"))]
    return runs.agg(*sizes, F.min_by(ident, F.struct(-F.col(members), F.col(ident))).alias("largest_run"))


def usage_rollup(df: DataFrame, keys: Sequence[str], units: str, per_million: float) -> DataFrame:
    """Per key: items, units, what these cost and the mean of an item."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"), F.sum(units).alias("units"), F.round(F.sum(F.col(units) * per_million / 1e6), 6).alias("cost"), F.round(F.avg(units), 2).alias("mean_units")
    )


def ordered_distinct(value: str | Column, order: str) -> Column:
    """Distinct values, of a column or of any expression, in the order of their first occurrence; nulls and blanks go."""
    v = F.col(value) if isinstance(value, str) else value
    pairs = F.collect_list(F.when(v.isNotNull() & (v.cast("string") != ""), F.struct(F.col(order).alias("at"), v.alias("v"))))
    return F.array_distinct(F.transform(F.array_sort(pairs), lambda x: x["v"]))


def dominant_value(df: DataFrame, keys: Sequence[str], value: str, order: str, share: float = 0.5) -> DataFrame:
    """The first-seen mode of each group if it has `share` of all its rows, blanks included."""
    per = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    usable = F.col(value).isNotNull() & (F.col(value).cast("string") != "")
    one = per.groupBy(*keys).agg(F.sum("n").alias("rows"), F.max_by(F.struct(value, "n"), F.when(usable, F.struct("n", -F.col("first")))).alias("m"))
    return one.where(F.col("m.n") >= share * F.col("rows")).select(*keys, F.col(f"m.{value}").alias("dominant"), F.col("m.n").alias("n"), "rows")


def frequent_prefix(df: DataFrame, keys: Sequence[str], code: str, length: int = 3, least: int = 3) -> DataFrame:
    return df.groupBy(*keys, F.left(code, F.lit(length)).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def serial_gaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Numbers between a group's least and largest that it lacks: holes are read off neighbours, never off a full range."""
    d = df.select(*keys, number).where(F.col(number).isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy(number)
    hole = d.withColumn("_next", F.lead(number).over(w)).where(F.col("_next") > F.col(number) + 1)
    return hole.select(*keys, F.explode(F.sequence(F.col(number) + 1, F.col("_next") - 1)).alias("missing"))


def serial_dups(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    return df.groupBy(*keys, number).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def run_summary(df: DataFrame, keys: Sequence[str], run: str, at: str, value: str, amount: str, flagged: Column, modal: str) -> DataFrame:
    """Runs numbered in order of their first member: bounds, members in order, values in the order seen, sums, flags and
    the first-seen mode of `modal` (blanks don't count)."""
    per = df.groupBy(*keys, run).agg(
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.count(F.lit(1)).alias("members"),
        F.round(F.sum(amount), 2).alias("amount"),
        F.count_if(flagged).alias("flagged"),
        F.array_join(ordered_distinct(value, at), " / ").alias("values"),
        F.array_join(F.array_sort(F.collect_list(at)), ",").alias("member_list"),
    )
    usable = F.when(F.col(modal).cast("string") != "", F.col(modal))
    modes = first_seen_mode(df.withColumn("_m", usable), [*keys, run], "_m", at).select(*keys, run, F.col("mode").alias(f"modal_{modal}"))
    spread = F.concat_ws("-", "first_at", F.when(F.col("last_at") != F.col("first_at"), F.col("last_at")))
    numbered = ranked(per, keys, ["first_at"], "_nth").join(modes, [*keys, run], "left")
    return numbered.withColumn("range", spread).withColumn("label", F.concat(F.lit("L"), F.lpad(F.col("_nth").cast("string"), 3, "0"))).drop(run, "_nth")


def exact_mean(value: Column) -> Column:
    """Mean of doubles that doesn't depend on their order, so that a mean halfway between two roundings stays there.

    Decimals of ten places at most are summed as such; if a group holds a double that is none, all of it is summed in doubles.
    """
    d = value.cast("double")
    exact = d.try_cast("decimal(28,10)")
    total = F.try_sum(F.when(exact.cast("double") == d, exact))
    whole = F.count(d) == F.count_if(exact.cast("double") == d)
    return F.coalesce(F.when(whole, total.cast("double") / F.count(d)), F.avg(d))


def mean_confidence(df: DataFrame, keys: Sequence[str], conf: str) -> DataFrame:
    """Mean of the confidences that were given (0 and more), with how many there were."""
    given = F.when(F.col(conf) >= 0, F.col(conf))
    return df.groupBy(*keys).agg(F.round(exact_mean(given), 1).alias("mean_conf"), F.count(given).alias("given"))
