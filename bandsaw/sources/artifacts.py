"""Result tables: artefacts, status, ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bandsaw.functions import paths
from bandsaw.sources.files import read_files
from bandsaw.sources.headers import problem, with_headers


def written_images(artifacts: DataFrame, kinds: int) -> DataFrame:
    """(image_id, whole) from an artefact table: whole if every band of all kinds is there. Reads no pixels."""
    per_kind = artifacts.groupBy("image_id", "kind").agg(F.count("*").alias("n"), F.max("bands").alias("bands"))
    return per_kind.groupBy("image_id").agg((F.count_if(F.col("n") == F.col("bands")) == kinds).alias("whole"))


def status_of(files: DataFrame, written: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row per file: path, ok, stage, message. Failures are data, not exceptions.

    ``written`` is what ``written_images`` found in the result, ``errors`` (image_id, stage, message)
    what steps told. Other files without a result are looked at again, at their first
    bytes, to tell why.
    """
    marked = files.withColumn("image_id", F.xxhash64("rel_path")).join(written, "image_id", "left")
    if errors is None:
        marked = marked.withColumns({"stage": F.lit(None).cast("string"), "message": F.lit(None).cast("string")})
    else:
        marked = marked.join(errors.groupBy("image_id").agg(F.min(F.struct("stage", "message")).alias("e")).select("image_id", "e.*"), "image_id", "left")
    told = marked.filter("stage IS NOT NULL").select("path", F.lit(False).alias("ok"), "stage", "message")
    marked = marked.filter("stage IS NULL")
    done = marked.filter("whole").select("path", F.lit(True).alias("ok"), F.lit("write").alias("stage"), F.lit("written").alias("message"))
    cut = marked.filter("NOT whole").select("path", F.lit(False).alias("ok"), F.lit("write").alias("stage"), F.lit("results are missing").alias("message"))
    failed = with_headers(marked.filter("whole IS NULL").select("path", "length"))
    message = F.coalesce(problem(), F.lit("not a readable image of 1, 3 or 4 channels"))
    failed = failed.select("path", F.lit(False).alias("ok"), F.lit("decode").alias("stage"), message.alias("message"))
    return told.unionByName(done).unionByName(cut).unionByName(failed)


def status_summary(status: DataFrame) -> DataFrame:
    return status.groupBy("stage", "ok").agg(F.count("*").alias("n"))


def write_artifacts(artifacts: DataFrame, path: str, one_class: bool = False) -> None:
    """Replace the artefact table, or only the classes present with ``one_class``."""
    mode = "dynamic" if one_class else "static"
    writer = artifacts.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("category", "kind").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written above. The schema is given, because no files are written for no rows and
    because a class named ``001`` is still text; the class of files at the root is empty, not null."""
    table = spark.read.schema(schema).parquet(path)
    return table.withColumn("category", F.coalesce("category", F.lit("")))


def ingest_images(spark: SparkSession, source: str, target: str, named_set: str | None = "images") -> DataFrame:
    """Copy a tree of image files into a table partitioned by class; gives the table."""
    files = read_files(spark, source, named_set=named_set)
    kept = files.select("path", "rel_path", "category", "stem", "ext", "modificationTime", "length", "content")
    kept.write.mode("overwrite").partitionBy("category").parquet(target)
    return read_table(spark, target, kept.schema)


def file_rows(artifacts: DataFrame) -> DataFrame:
    """Directory and name for every artefact band: beside its image, under a name that no other file's result has."""
    return artifacts.withColumns({"rel_dir": F.col("category"), "name": paths.png_named(F.col("rel_path"), F.col("kind"))})
