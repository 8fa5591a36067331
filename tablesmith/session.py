"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "tablesmith") -> SparkSession:
    """Local-mode session used by tests and the bench. Cluster jobs build their own."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` as set on the session.

    Only when nothing is set on a ``local[...]`` master (as in tests) do we pick a
    scratch folder of our own; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tablesmith-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared folder, e.g. for an export or a table version."""
    tail = "/".join(p.strip("/") for p in parts if p)
    path = f"{shared_dir(spark)}/tablesmith/{tail}" if tail else f"{shared_dir(spark)}/tablesmith"
    return f"{path}/{uuid.uuid4().hex}" if unique else path


MB = 1024 * 1024


def scale_settings(input_bytes: int, *, partition_bytes: int = 256 * MB, broadcast_bytes: int = 64 * MB) -> dict[str, str]:
    """SQL settings sized for an input of ``input_bytes``.

    Shuffle partitions start at about ``partition_bytes`` of input each (so a
    reduce task's share fits executor memory and spills rarely), AQE then
    coalesces small ones and splits skewed ones at run time; scan splits are
    ``partition_bytes`` too. Apply with ``apply_settings``.
    """
    parts = max(200, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and return it with a fresh lineage.

    For long chains of row/column changes applied in a loop: a reliable
    checkpoint survives executor loss (it is written to the cluster's shared
    folder, never kept on the executors).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df):
    """``df`` computed once into the shared folder: (the stored rows, their folder)."""
    path = work_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, through Hadoop's file systems."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jpath, True)
