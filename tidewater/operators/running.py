"""Running sums and moving frames over ordered groups, without a group in one task.

A window by group puts each group in one task; one user with a third of all
rows would stall the job.  Here rows are range-partitioned on (group, order) and
written with the number of their range.  A running sum within (group, range) is
bounded by a range; what the group had in earlier ranges is carried as an
offset.  Only a group that crosses a border has one, so there are fewer offsets
than ranges and they can be broadcast.  Moving frames number the rows of a
group the same way, cut it into blocks of equal length, and give each block the
last rows of the one before (its halo).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import scratch_dir

BLOCK_ROWS = 65_536
_RANGE, _POS, _BLOCK = "_range", "_pos", "_block"


def running_sums(df: DataFrame, group, order, sums: dict[str, str]) -> DataFrame:
    """``df`` with running sums within each group in the order of ``order``, this row included.

    ``sums`` is new column -> column to add up; as with SQL's SUM nulls are
    skipped, and the sum is null until the first value.  ``order`` must be total
    within a group; nulls come first, in groups as in order.  A null group is a group.
    """
    group, order = [group] if isinstance(group, str) else list(group), [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    path = scratch_dir(spark, "running") + "/ranges"
    df.repartitionByRange(*group, *order).withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    here = Window.partitionBy(*group, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    names = list(sums)
    totals = rows.groupBy(*group, _RANGE).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    carried = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(_RANGE).alias("_r"),
                            F.count("*").over(before).alias("_earlier"), *[F.sum(n).over(before).alias(f"_c{i}") for i, n in enumerate(names)])
    carried = F.broadcast(carried.filter("_earlier > 0"))  # at most one group goes on from the range before
    local = rows.withColumns({n: F.sum(c).over(here) for n, c in sums.items()})
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = local.join(carried, [*same, F.col(_RANGE) == F.col("_r")], "left")
    kinds = {n: local.schema[n].dataType for n in names}
    both = [F.when(F.col(n).isNotNull() | F.col(f"_c{i}").isNotNull(), F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_c{i}"), F.lit(0)))
            .cast(kinds[n]).alias(n) for i, n in enumerate(names)]
    return joined.select(*df.columns, *both)


def moving_sums(df: DataFrame, group, order, rows: int, sums: dict[str, str], counts: dict[str, str] | None = None,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with sums (and counts of non-null values) over the last ``rows`` rows of the group, this one included."""
    group, order = [group] if isinstance(group, str) else list(group), [order] if isinstance(order, str) else list(order)
    size = max(block_rows, rows)
    placed = running_sums(df.withColumn("_one", F.lit(1).cast("long")), group, order, {_POS: "_one"}).drop("_one")
    at = F.col(_POS) - 1
    block, last = F.floor(at / size).cast("long"), at % size >= size - (rows - 1)
    blocks = F.when(last, F.array(block, block + 1)).otherwise(F.array(block))  # the last rows are also the next block's halo
    spread = placed.withColumn(_BLOCK, F.explode(blocks))
    w = Window.partitionBy(*group, _BLOCK).orderBy(_POS).rowsBetween(-(rows - 1), Window.currentRow)
    out = spread.withColumns({**{n: F.sum(c).over(w) for n, c in sums.items()}, **{n: F.count(c).over(w) for n, c in (counts or {}).items()}})
    return out.filter(F.col(_BLOCK) == block).drop(_BLOCK, _POS)
