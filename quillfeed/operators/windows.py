"""Per-group ordinals that survive a hot group.

``row_number().over(partitionBy(k))`` sends every row of a key to one task; with
one publisher holding a third of all articles that task sorts a third of the
data. ``group_row_number(..., strategy="range")`` instead range-partitions on
(key, order): a hot key is split over many contiguous partitions, each task
numbers its slice locally, and a small (key, partition) count table supplies
the offset of every slice. Everything stays in JVM expressions; the numbered
slices are checkpointed once so the count and the numbering read the same data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def group_row_number(
    df: DataFrame,
    keys: list[str],
    order: list[Column | str],
    out: str = "rn",
    strategy: str = "range",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its ``keys`` group by ``order``.

    ``order`` must be a total order inside a group (add a unique tiebreak) so
    the numbering is deterministic and recomputation after executor loss agrees.
    """
    order_cols = _cols(order)
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(out, F.row_number().over(w))
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")

    sort_cols = [F.col(k) for k in keys] + order_cols
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges neighbours, so every partition is still one contiguous range.
    repart = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    ranged = (
        repart
        .sortWithinPartitions(*sort_cols)
        .withColumn("_qf_pid", F.spark_partition_id())
        .withColumn("_qf_mid", F.monotonically_increasing_id())
    )
    # Both the slice counts and the numbered rows must see the same partition
    # contents: materialise once into the shared checkpoint folder (reliable,
    # survives executor loss; no recomputation with a re-sampled range).
    ranged = cut_lineage(ranged)
    slices = ranged.groupBy(*keys, "_qf_pid").agg(
        F.min("_qf_mid").alias("_qf_m0"), F.count(F.lit(1)).alias("_qf_cnt")
    )
    before = Window.partitionBy(*keys).orderBy("_qf_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_qf_off", F.coalesce(F.sum("_qf_cnt").over(before), F.lit(0)))
    r, s = ranged.alias("_qf_r"), slices.alias("_qf_s")
    cond = [F.col(f"_qf_r.{k}").eqNullSafe(F.col(f"_qf_s.{k}")) for k in keys]
    cond.append(F.col("_qf_r._qf_pid") == F.col("_qf_s._qf_pid"))
    joined = r.join(s, cond).select("_qf_r.*", "_qf_s._qf_m0", "_qf_s._qf_off")
    return joined.withColumn(
        out, (F.col("_qf_mid") - F.col("_qf_m0") + F.lit(1) + F.col("_qf_off")).cast("long")
    ).drop("_qf_pid", "_qf_mid", "_qf_m0", "_qf_off")
