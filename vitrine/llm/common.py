"""Shared folder, written tables and Arrow steps used by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

SLICE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only where the setting is missing and the master is local (tests), a temporary
    folder is made and set for this session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a task and not the whole chain, and
    gives the planner the true size of the table: Spark broadcasts it only when the
    files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_path = path
    return table


# A stored table is sent whole to every task only up to this size on disk.
BROADCAST_BYTES = 4 << 20


def sized(table: DataFrame) -> DataFrame:
    """A table made by ``stored`` as a join side: broadcast if its files are small, else as it is."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    small = files.getContentSummary(path).getLength() <= BROADCAST_BYTES
    return F.broadcast(table) if small else table.hint("merge")


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB: texts are long rows.  A size the user has set is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # the default
        spark.conf.set(key, "4m")


def per_text(
    df: DataFrame,
    text_col: str,
    schema: str,
    make: Callable[[], Callable[[list], dict]],
    keep: list[str],
    binary: bool = False,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Row-wise step over texts, one Arrow batch at a time, without a shuffle.

    ``make()`` is called once per task and returns ``texts -> {new column: values}``.
    Columns in ``keep`` pass through unread; the text is sent once, also if it is among them.  A batch is worked in slices of about
    ``slice_bytes`` of text (one text at least), which bounds the memory of a task.
    """
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    fields = [df.schema[c] for c in keep]
    out = T.StructType(fields + T._parse_datatype_string(schema).fields)
    arrow = to_arrow_schema(out)
    names, n_kept = out.names, len(keep)
    at = keep.index(text_col) if text_col in keep else n_kept
    own = "__text"
    while own in {c.lower() for c in keep}:  # a name of its own
        own += "_"
    sent = [df[c] for c in keep] + ([] if text_col in keep else [df[text_col].alias(own)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            slices = np.cumsum(sizes.astype(np.int64)) // slice_bytes
            cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                part = batch.slice(start, stop - start)
                column = part.column(at)
                texts = (column.cast(pa.binary()) if binary else column).to_pylist()
                made = work(texts)
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(n_kept)]
                columns += [pa.array(made[n], arrow.field(n).type) for n in names[n_kept:]]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.select(*sent).mapInArrow(run, out)
