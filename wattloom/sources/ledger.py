"""A stored set of landed files that were read, so that a run opens only others.

A file is known by its path, length and modification time: one that is replaced under
its name is another file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.schemas import LEDGER
from wattloom.sources.tables import read_table_or_empty


def landed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path``, ``file`` (the path as row metadata spell it), ``file_name``, ``length``
    and ``modified`` of all files that paths or globs match. None is opened: a scan
    without the content column only lists."""
    paths = [paths] if isinstance(paths, str) else paths
    listed = spark.read.format("binaryFile").load(paths)
    return listed.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.regexp_extract("path", "[^/]*$", 0).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def unread(files: DataFrame, ledger: DataFrame) -> list[Row]:
    """The files that the ledger lacks: as many short rows as a run has files to read."""
    return files.join(ledger, ["file", "length", "modified"], "left_anti").collect()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_table_or_empty(spark, LEDGER, path).select("file", "length", "modified")


def add_to_ledger(spark: SparkSession, path: str, files: list[Row]) -> None:
    """Note files as read, in one small file. Call it after their rows are written: a
    run that fails before reads them again."""
    if files:
        rows = [(row["file"], row["length"], row["modified"]) for row in files]
        spark.createDataFrame(rows, LEDGER.schema).coalesce(1).write.mode("append").parquet(path)


def of_newest_file(rows: DataFrame, files: list[Row], keys: list[str], file: str) -> DataFrame:
    """For each key only the rows of the file that was modified last, of equally old
    ones the last by name. So what a key holds does not depend on whether its deliveries
    are read in one run or in several.

    The list of files, which the driver holds, is broadcast: a shuffle by file would bring
    all rows of a file to one task."""
    ages = rows.sparkSession.createDataFrame([(row["file"], row["modified"]) for row in files], "_aged string, _modified timestamp")
    dated = rows.join(F.broadcast(ages), F.col(file) == F.col("_aged"))
    age = F.struct("_modified", file)
    newest = F.max(age).over(Window.partitionBy(*keys))
    return dated.withColumn("_newest", newest).filter(F.col("_newest") == age).select(*rows.columns)
