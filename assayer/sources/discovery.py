"""Find CSV files without reading them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.relations import small_relation


def discover_csv(spark: SparkSession, folder: str, recursive: bool = True, pattern: str = "*.csv") -> DataFrame:
    """(path, name, bytes) in order of path; nothing if the folder is missing."""
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", str(recursive).lower())
            .option("pathGlobFilter", pattern)
            .load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return small_relation(spark, {"path": "string", "name": "string", "bytes": "bigint"}, [])
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes")).orderBy(
        "path"
    )


def find_file(spark: SparkSession, folder: str, name: str) -> str:
    """The file of that name with the smallest path anywhere below the folder.

    A table that was written by many tasks is a folder of files; where no file has the name, the folder of that name with the
    smallest path is found, if it holds a file.
    """
    found = discover_csv(spark, folder, pattern=name).agg(F.min("path").alias("path")).first()["path"]
    if found is None:
        parts = discover_csv(spark, folder, pattern="*").where(F.element_at(F.split("path", "/"), -2) == name)
        part = parts.agg(F.min("path").alias("path")).first()["path"]
        found = part and part.rsplit("/", 1)[0]
    if found is None:
        raise FileNotFoundError(f"{name} not found below {folder}")
    return found
