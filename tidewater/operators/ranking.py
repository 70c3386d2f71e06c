"""Exact ``rank()`` within a group without putting the group in one task.

``rank() OVER (PARTITION BY g ORDER BY v DESC)`` sorts a whole group in one
task; a group holding a third of the data would stall the job.  Here:

1. rows collapse to distinct (g, v) with their multiplicity (map-side
   partial aggregation, so repeated values cost nothing in the shuffle);
2. these are range-partitioned on (g, v desc) and written once, each with the
   number of its range; ranges are of equal size, so a large group takes many;
3. a value's count of larger values within its own (g, range) comes from a
   window over that range alone;
4. a range's offset (rows of the group in all ranges before it) comes from a
   table of one row per group and range it touches;
5. rank = 1 + offset + larger in range, joined back on (g, v).

No join is on the group alone.  NULL values rank last, as with
``DESC NULLS LAST``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import scratch_dir


def rank_desc(df: DataFrame, group_col: str, value_col: str, out_col: str = "rank") -> DataFrame:
    g, v = group_col, value_col
    spark = df.sparkSession
    path = scratch_dir(spark, "ranges") + "/values"
    (df.groupBy(g, v).agg(F.count("*").alias("_c")).repartitionByRange(F.col(g), F.col(v).desc_nulls_last())
     .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    values = spark.read.parquet(path)
    larger = (Window.partitionBy(g, "_range").orderBy(F.col(v).desc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    local = values.withColumn("_gt", F.coalesce(F.sum("_c").over(larger), F.lit(0)))
    before = Window.partitionBy(g).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = (values.groupBy(g, "_range").agg(F.sum("_c").alias("_n"))
              .select(F.col(g).alias("_g"), F.col("_range").alias("_r"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    ranks = (local.join(offset, local[g].eqNullSafe(offset["_g"]) & (local["_range"] == offset["_r"]))
             .select(F.col(g).alias("_g"), F.col(v).alias("_v"), (F.col("_off") + F.col("_gt") + 1).alias(out_col)))
    return (df.join(ranks, df[g].eqNullSafe(ranks["_g"]) & df[v].eqNullSafe(ranks["_v"]))
            .drop("_g", "_v"))
