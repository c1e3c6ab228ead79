"""Rows kept between the jobs of one function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

#: Whether adaptive execution may merge the small partitions of a kept frame, which is planned when it is first asked to be kept.
MERGED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def kept_rows(df: DataFrame, level: StorageLevel) -> DataFrame:
    """``df`` persisted in partitions that follow its size.

    By default a kept frame has as many partitions as its shuffle, however small, and each job over it
    writes that number of shuffle files for each of them. The session's setting is left as it was.
    """
    conf = df.sparkSession.conf
    before = conf.get(MERGED)
    conf.set(MERGED, "true")
    try:
        return df.persist(level)
    finally:
        conf.set(MERGED, before)
