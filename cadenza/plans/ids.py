"""Dense, deterministic id assignment without a single-partition window.

A SERIAL column hands out ``max(id) + 1, + 2, ...``. A global
``row_number() OVER (ORDER BY ...)`` would pull every row into one task, so
instead rows are range-partitioned and sorted by the order columns; each
row's position inside its partition comes from
``monotonically_increasing_id`` and each partition's offset from the row
counts of the partitions before it (one tiny row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_PART, _MONO, _N, _OFF = "_ids_part", "_ids_mono", "_ids_n", "_ids_off"


def assign_ids(
    df: DataFrame,
    order_cols: list[str],
    id_col: str,
    start_after: Column | int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = ``start_after`` + 1-based rank of the row by ``order_cols``.

    ``order_cols`` should order rows totally (end with a unique column):
    shuffle blocks arrive in no fixed order, so ties would make the ids
    depend on the run. ``start_after`` may be a column (e.g. a scalar
    subquery such as the current maximum id).

    The tagged rows are checkpointed to the shared checkpoint folder before
    they are counted and numbered: each evaluation of a range repartition
    samples its own bounds, so two reads of an unmaterialised input could
    disagree on which rows share a partition. The checkpoint fixes partition
    contents once, survives executor loss, and cuts the lineage.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = reliable_checkpoint(
        ranged.withColumn(_PART, F.spark_partition_id()).withColumn(_MONO, F.monotonically_increasing_id())
    )
    # One row per partition, so this window and its broadcast are bounded by n.
    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    local = F.col(_MONO) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    return (
        tagged.join(F.broadcast(offsets), _PART)
        .withColumn(id_col, (base + F.col(_OFF) + local + 1).cast("bigint"))
        .drop(_PART, _MONO, _OFF)
    )
