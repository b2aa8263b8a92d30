"""Selection rules, and how often fields agree with a reference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import batching


def parse_rule(rule: str, conf: str = "conf", flags: str = "flags", differs: str = "differs", numeric: bool = False) -> Column:
    """A comma list of terms, any of which selects a row: conf<N, flags:TEXT (substring), disagree, all.

    A blank or non-numeric confidence counts as 0 and is selected. Unknown terms raise at once. With `numeric` the
    confidence is a number already, and its comparison reaches the scan.
    """
    terms = []
    for term in (x.strip() for x in rule.split(",") if x.strip()):
        if term == "all":
            terms.append(F.lit(True))
        elif term == "disagree":
            terms.append(F.coalesce(F.col(differs).cast("boolean"), F.lit(False)))
        elif term.startswith("flags:") and term[6:]:
            terms.append(F.col(flags).contains(term[6:]) & F.col(flags).isNotNull())
        elif term.startswith("conf<"):
            n = float(term[5:])
            if numeric:
                terms.append((F.col(conf) < n) | F.col(conf).isNull() if n > 0 else F.col(conf) < n)
            else:
                terms.append(F.coalesce(F.col(conf).cast("string").try_cast("double"), F.lit(0.0)) < n)
        else:
            raise ValueError(f"unknown term {term!r} in rule {rule!r}")
    if not terms:
        raise ValueError("an empty rule selects nothing")
    return reduce(lambda a, b: a | b, terms)


def field_accuracy(read: DataFrame, truth: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Exact-match rate of each field (named by the mapping) over rows that both sides have."""
    other = truth.select(F.col(key), *[F.col(f).alias(f"_{f}") for f in fields])
    rates = [F.round(F.avg((F.col(f) == F.col(f"_{f}")).cast("int")), 4).alias(n) for f, n in fields.items()]
    return read.join(other, key).agg(*rates, F.count(F.lit(1)).alias("n"))


def retry_batches(df: DataFrame, rule: str, order: Sequence[str], size: int, **columns: str | bool) -> DataFrame:
    """The rows that a rule selects, once more in batches of `size`."""
    return batching(df.where(parse_rule(rule, **columns)), order, size)
