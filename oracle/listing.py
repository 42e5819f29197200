"""A file listing over the whole ``part`` table, the same text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROOT = "hdfs://h:9000/data/set/"
_BASE = "/data/set"

# One file per part and, for images that have one, its mask. Every seventh image has no mask;
# "a.b.jpg" and ".jpg" occur once per directory, many times over.
FILES = """
SELECT path, CAST(p_size AS BIGINT) * 1000 + n % 997 AS length FROM (
  SELECT n, p_size, concat('hdfs://h:9000/data/set/', dir, '/', name, ext) AS path FROM named
  UNION ALL
  SELECT n, p_size, concat('hdfs://h:9000/data/set/', dir, '/', name, '_mask', ext) AS path FROM named
  WHERE n % 7 <> 0 AND is_pair
) f
"""
NAMED = """
SELECT n, p_size,
  CASE WHEN n % 25 IN (1, 2) THEN concat('odd/', n)
       WHEN n % 4 = 0 THEN 'benign' WHEN n % 4 = 1 THEN 'malignant' WHEN n % 4 = 2 THEN 'normal' ELSE 'benign/a/b' END AS dir,
  CASE WHEN n % 25 = 0 THEN concat('notes (', n, ')') WHEN n % 25 = 1 THEN '' WHEN n % 25 = 2 THEN 'a.b'
       WHEN n % 25 = 6 THEN concat('scan ', n) WHEN n % 25 = 7 THEN concat('scan_', n - 1)
       ELSE concat('image (', n, ')') END AS name,
  CASE WHEN n % 25 = 0 THEN '.txt' WHEN n % 25 = 3 THEN '.gif' WHEN n % 25 = 4 THEN '.webp' WHEN n % 25 = 5 THEN '.tiff'
       WHEN n % 25 IN (6, 7) THEN '.JPG' WHEN n % 25 = 8 THEN '.png' ELSE '.jpg' END AS ext,
  n % 25 > 7 AS is_pair
FROM (SELECT CAST(p_partkey AS BIGINT) AS n, p_size FROM part) p
"""
LISTING = f"WITH named AS ({NAMED}) {FILES}"


def fixture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(LISTING.replace("FROM part)", "FROM {part})"), part=part)
