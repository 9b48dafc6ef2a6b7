"""Writing product records as Parquet, JSON Lines and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from vitrine.functions.text import stamp
from vitrine.functions.sql import lit
from vitrine.operators.labels import run_label

FORMATS = ("json", "csv")


def output_path(spark: SparkSession, root: str, categories: DataFrame, as_of, prefix: str = "products") -> str:
    """``root/prefix_label_stamp`` for a run over ``categories`` at time ``as_of``."""
    moment = F.lit(as_of).cast("timestamp")
    name = run_label(categories).withColumn("m", moment).selectExpr(
        f"concat_ws('_', {lit(prefix)}, label, {stamp('m')}) AS name"
    )
    return f"{root.rstrip('/')}/{name.first()['name']}"


def write_products(products: DataFrame, path: str, formats=FORMATS) -> dict[str, int]:
    """Write records to ``path/parquet`` and, from there, to the asked formats.

    The pages are parsed once: JSON and CSV are made from the Parquet table.  An
    empty run writes nothing.  Returns the row count of each written format.
    """
    unknown = set(formats) - {"json", "csv", "parquet"}
    if unknown:
        raise ValueError(f"unknown format: {sorted(unknown)}")
    spark = products.sparkSession
    written = {"parquet": _write(products, lambda df: df.write.parquet(f"{path}/parquet"))}
    if not written["parquet"]:
        _remove(spark, f"{path}/parquet", path)
        return {}
    table = spark.read.parquet(f"{path}/parquet")
    if "json" in formats:
        written["json"] = _write(table, lambda df: df.write.json(f"{path}/json"))
    if "csv" in formats:
        # CSV has no arrays: lists become JSON text
        lists = {f.name: F.to_json(f.name) for f in table.schema if f.dataType.typeName() == "array"}
        flat = table.withColumns(lists) if lists else table
        written["csv"] = _write(flat, _csv(f"{path}/csv"))
    return written


# Folders of the two outcomes below a table written by ``write_outcomes``.
OUTCOME, GOOD, FAILED = "outcome", "record", "failure"


def write_outcomes(pages_out: DataFrame, path: str, batch: int | None = None) -> None:
    """Write ``records_and_failures`` once, split by outcome, under ``path`` (one folder per batch).

    Writing the same batch again replaces its folder and nothing else.
    """
    outcome = F.when(F.col("reason").isNull(), GOOD).otherwise(FAILED)
    folder = path if batch is None else f"{path}/batch={batch}"
    pages_out.withColumn(OUTCOME, outcome).write.mode("overwrite").partitionBy(OUTCOME).parquet(folder)


def read_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """The records under ``path``; ``schema`` is that of ``records_and_failures``."""
    table = _outcomes(spark, path, schema).filter(F.col(OUTCOME) == GOOD)
    return table.select(*[f.name for f in schema if f.name not in ("page_id", "reason")])


def read_failures(spark: SparkSession, path: str, schema) -> DataFrame:
    """``page_id, url, reason`` of the failed pages under ``path``."""
    return _outcomes(spark, path, schema).filter(F.col(OUTCOME) == FAILED).select("page_id", "url", "reason")


def _outcomes(spark, path, schema):
    from pyspark.sql import types as T

    folders = [T.StructField("batch", T.LongType()), T.StructField(OUTCOME, T.StringType())]
    return spark.read.schema(T.StructType([*schema, *folders])).parquet(path)


class Folder:
    """A folder or file of whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.path = self._paths(path)
        self._files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self.path)

    def is_folder(self) -> bool:
        return self.exists() and self._files.getFileStatus(self.path).isDirectory()

    def names(self) -> list[str]:
        return [entry.getPath().getName() for entry in self._files.listStatus(self.path)]

    def make(self) -> None:
        self._files.mkdirs(self.path)

    def mark_done(self) -> None:
        self._files.create(self._paths(self.path, "_SUCCESS"), True).close()

    def move_to(self, target: str) -> None:
        if not self._files.rename(self.path, self._paths(target)):
            raise OSError(f"could not rename {self.path} to {target}")

    def remove(self) -> None:
        self._files.delete(self.path, True)


def _remove(spark: SparkSession, made: str, folder: str) -> None:
    """Take back the output of an empty run, and its folder if nothing else is in it."""
    Folder(spark, made).remove()
    if not Folder(spark, folder).names():
        Folder(spark, folder).remove()


def _csv(path):
    def write(df):
        df.write.option("header", True).option("escape", '"').option("encoding", "UTF-8").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)

    return write


def _write(df: DataFrame, write) -> int:
    """Run a write and report its row count from the same pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def read_products_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a CSV output back with its record schema."""
    from pyspark.sql import types as T

    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.dataType.typeName() == "array" else f.dataType) for f in schema]
    )
    table = (
        spark.read.schema(flat).option("header", True).option("escape", '"').option("multiLine", True)
        .option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    )
    lists = {
        f.name: F.from_json(f.name, f.dataType) for f in schema if f.dataType.typeName() == "array"
    }
    return table.withColumns(lists) if lists else table
