"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Sessions we build ourselves (tests, bench). On a cluster the caller owns the session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "inkstream",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root folder for written tables, stream checkpoints and lineage cuts: ``spark.checkpoint.dir``,
    else the folder given to ``setCheckpointDir``. Only a session on a local master that has neither
    (tests, a laptop) gets a scratch folder; anywhere else executors would not see it, so it raises."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir (or setCheckpointDir) to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="inkstream-"))
        root = sc.getCheckpointDir()
    return "file://" + root[5:] if root.startswith("file:/") and not root.startswith("file://") else root


_OWNERS: list[list[str]] = []


@contextmanager
def owned_folders(spark: SparkSession):
    """Folders made by ``fresh_path`` (and so by ``materialize``) inside the block are intermediate:
    they are removed at its end. Use the results inside the block, or write them elsewhere."""
    made: list[str] = []
    _OWNERS.append(made)
    try:
        yield made
    finally:
        _OWNERS.remove(made)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder (never reused)."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared folder and reading it back.

    One pass over the input (``Dataset.checkpoint`` computes its input twice unless persisted),
    survives executor loss (the files are on shared storage), and the read-back has exact size
    statistics for the planner."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
