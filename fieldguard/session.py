"""Session helpers: checkpointing and size-checked broadcasts."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side may hold at most this many rows (a few hundred bytes each).
MAX_BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: the one the session names.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="fieldguard-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Lineage ends at the table: lost executors cost a re-read, several uses cost one computation,
    and its size is known to the optimizer. The folder is the cluster's to clean.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/settled-{uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Settle a table expected to be small and broadcast it only if its row count proves it.

    Beyond ``max_rows`` the table is returned without a hint: the join then shuffles both
    sides and adaptive execution splits skewed keys.
    """
    settled = settle(df)
    if settled.limit(max_rows + 1).count() > max_rows:
        return settled
    return F.broadcast(settled)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Spread rows for a partitioned write: few folders per task, hot folders over many tasks.

    Adaptive execution splits and merges the shuffled blocks by their measured size.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])
