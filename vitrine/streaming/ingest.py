"""Incremental ingest: new page files become records in an append-only table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators.products import records_and_failures
from vitrine.plans.rules import Rules
from vitrine.sinks.write import Folder, write_outcomes


def read_page_stream(
    spark: SparkSession, folder: str, schema, glob: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Stream of page rows from Parquet files dropped into ``folder``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def read_table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Stream of page rows from the table at ``path``: a folder of files, whatever their names, or one file."""
    if Folder(spark, path).is_folder():
        return read_page_stream(spark, path, schema, "*", files_per_batch)
    folder, _, name = path.rpartition("/")  # a stream reads folders only
    return read_page_stream(spark, folder, schema, name, files_per_batch)


def ingest(
    pages: DataFrame, project: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> StreamingQuery:
    """Start one catch-up run: all files seen since the last one, then stop.

    ``project`` is any batch projection of this package; it is stateless, so the
    stream needs no watermark.  Rows appear exactly once per source file, and
    duplicates across files stay.
    """
    return (
        project(pages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_records(pages: DataFrame, rules: Rules, table: str, checkpoint: str, as_of=None) -> StreamingQuery:
    """Start one catch-up run that turns page files into whole records and a list of failed pages.

    Every batch is parsed once and written once, as ``table/batch=<id>`` split by outcome; a batch that
    is repeated after a crash replaces its own folder, so its rows appear once.  Read the table with
    ``sinks.write.read_records`` and ``read_failures``.  ``as_of`` stamps the records (default:
    the time of the batch).
    """
    def write(batch: DataFrame, number: int) -> None:
        write_outcomes(records_and_failures(batch, rules, as_of), table, number)

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
