"""Session helpers: settings for the engine, shared work folder, input spread."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Settings the engine is tuned with.  They are plain Spark options: pass them to
# your own builder, or use ``build_session`` for local runs.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # pages are large rows: small scan splits keep parse tasks short and retries cheap
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks."""
    builder = SparkSession.builder.master(master).appName("vitrine")
    settings = {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """New folder for written tables, under the cluster's shared checkpoint folder.

    Only an unset ``spark.checkpoint.dir`` on a local master falls back to a
    machine-local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master  # "local-cluster[...]" has executors of its own
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="vitrine-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


SPREAD_BELOW = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores for a small input; ``df`` is a scan.

    A file with one row group is one task however many cores there are.  Only inputs
    of fewer than ``SPREAD_BELOW`` splits are shuffled (some 100 MB at most), so no
    shuffle of page sources is added at scale.  Hash partitioning keeps retries
    deterministic.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SPREAD_BELOW):
        return df
    return df.repartition(cores, *keys)


def even(df: DataFrame, *keys: str) -> DataFrame:
    """Deal short rows that cause much work evenly over the cores; ``df`` is a scan.

    A few MB of a table can be a million pages: splits by size would leave cores idle.
    Inputs of four splits a core and more are left alone.
    """
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *keys)


def stored(df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, dict]:
    """Write an intermediate result that is read more than once, and read it back.

    The table lies in the shared work folder, so a lost executor costs a task
    retry and not a recomputation.  ``totals`` are aggregates measured during the
    same write; ``rows`` is always among them.
    """
    path = work_folder(df.sparkSession, name)
    seen = Observation()
    measures = {"rows": F.count(F.lit(1)), **totals}
    df.observe(seen, *[value.alias(key) for key, value in measures.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


# A join side is sent whole to every task only up to this measured size.
BROADCAST_BYTES = 64 << 20


def join_side(df: DataFrame) -> DataFrame:
    """A lookup table for a join against pages: broadcast if small, else shuffled.

    The table is stored, and its size measured by the same pass; file sizes say
    little about compressed text.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    table, seen = stored(df, "side", bytes=size)
    return F.broadcast(table) if seen["bytes"] <= BROADCAST_BYTES else table.hint("merge")
