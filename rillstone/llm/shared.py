"""What the training-data operators share with the rest of the library, and the size of packed shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rillstone.operators.components import components
from rillstone.sources.working import forget, keep, shared_dir, sweep

__all__ = ["components", "forget", "keep", "shared_dir", "sweep", "tasks_for"]


def tasks_for(df: DataFrame) -> int:
    """Number of partitions for packed shuffles: follows the input's own partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, 2 * df.rdd.getNumPartitions())
