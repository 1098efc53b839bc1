"""Session helpers shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, seen by all executors.

    It is the one the session names in ``spark.checkpoint.dir``. Only a local session
    that names none gets a throw-away folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-ckpt-"))
        else:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return sc.getCheckpointDir()


#: Rows that one task may aggregate, sort or list.
TASK_ROWS = 2**20


def spread(df: DataFrame, rows: int, *keys: str, per_task: int | None = None) -> DataFrame:
    """The table by its keys over as many partitions as that many rows need; small tables stay as they are.

    Spark joins small partitions up to a size on disk, which in memory may be twenty times as large;
    a number of partitions that was asked for is kept.
    """
    parts = -(-rows // (per_task or TASK_ROWS))
    return df.repartition(max(parts, shuffle_width(df.sparkSession)), *keys) if parts > 1 else df


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Compute a table once and cut its lineage, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
