"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "quillfeed", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for the plans in this package.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the
    cluster configuration; locally we pin UTC, AQE and a small partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20, max_partitions: int = 200_000) -> dict:
    """Session settings sized from the input volume of a run.

    Shuffle partitions are chosen so each holds about ``target_partition_bytes``
    of input; the range numbering of WIN1 and the final sort use this count
    (AQE can merge range partitions but never split them). File splits are
    512 MB so a 100 TB scan is ~200k tasks. AQE skew handling stays on for
    joins on hot keys."""
    parts = max(200, min(max_partitions, -(-int(input_bytes) // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``. Only a local master may
    leave it unset (tests); it then gets a fresh scratch folder. On a cluster a
    machine's own folder would be another one on each machine, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="quillfeed-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a parquet table in the shared checkpoint
    folder and continue from that table.

    Equivalent to a reliable checkpoint (it survives executor loss and cuts
    the lineage), but computed in a single job: ``Dataset.checkpoint`` counts
    the plan and then recomputes it to write the checkpoint files. Reading it
    back also gives the optimizer real file statistics."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/quillfeed-cut/{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)  # gone when the application ends
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
