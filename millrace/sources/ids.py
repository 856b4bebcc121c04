"""Dense numbers for values: each value keeps the number that it got first (A5, K2).

Spark's bitmap aggregates count distinct whole numbers exactly and mergeably, if these are dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import BucketedTable, staged

#: What ``monotonically_increasing_id`` gives: a task's number above, its rows' numbers below.
ROW_BITS = 33


class DenseIds:
    """The numbers of the values of one column, from one without gaps, in a table bucketed by value."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32) -> None:
        self.spark = spark
        self.table = BucketedTable(spark, path, ["value"], buckets)

    def number(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """``df`` with the number of ``column`` as ``name``; null has none.  New values get the next numbers.

        Only the buckets of the values are read.  No order decides the numbers of new values, so they
        are written before they are used.
        """
        values = df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
        with staged(values, "values") as seen:
            self._learn(seen)
        known = self.table.read()
        if known is None:
            return df.withColumn(name, F.lit(None).cast("long"))
        numbers = known.select(F.col("value").alias("_value"), F.col("number").alias(name))
        return df.join(numbers, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")

    def _learn(self, seen: DataFrame) -> None:
        known, first, fresh = self.table.schema(), 1, seen
        if known is not None:
            fresh = seen.join(self.table.near(seen).select("value"), "value", "left_anti")
            first = self.table.read().agg(F.max("number")).first()[0] + 1
        with staged(fresh.withColumn("place", F.monotonically_increasing_id()), "fresh") as rows:
            task, row = F.shiftright("place", ROW_BITS), F.col("place").bitwiseAND((1 << ROW_BITS) - 1)
            # one row for each task that found new values
            counts = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()
            if not counts:
                return
            bases = []
            for r in counts:
                bases.append((r["task"], first))
                first += r["n"]
            base = self.spark.createDataFrame(bases, "task long, base long")
            numbered = rows.withColumn("task", task).join(base, "task").select("value", (F.col("base") + row).alias("number"))
            with staged(numbered, "numbers") as batch:
                self.table.merge(batch, ["value"], lambda old, new: new if old is None else old.unionByName(new))
