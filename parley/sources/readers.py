"""Readers of files and services that aren't Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..shipping import ship
from .database import Database, PushedDatabase


def segments(spark: SparkSession, path: str) -> DataFrame:
    """JSON transcripts with nested words, the schema given rather than guessed."""
    return spark.read.schema(schemas.SEGMENTS).option("multiLine", True).json(path)


def roster_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A roster with or without its header; short rows are filled up, the status defaults to unverified."""
    raw = spark.read.schema(schemas.ROSTER).option("sep", "\t").option("mode", "PERMISSIVE").csv(path)
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    filled = raw.select(*(text(c).alias(c) for c in raw.columns)).filter("name <> '' and name <> 'name'")
    return filled.withColumn("employment_status", F.when(F.col("employment_status") == "", "unverified").otherwise(F.col("employment_status")))


def roster_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, whose first name may begin with a byte order mark."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return raw.toDF(*(c.lstrip("﻿").strip().lower() for c in raw.columns))


def users_json(spark: SparkSession, path: str, company: str) -> DataFrame:
    """One JSON object of objects by id, to a row per user of the company."""
    text = spark.read.option("wholetext", True).text(path)
    users = F.from_json("value", "map<string, struct<name: string, email: string>>")
    rows = text.select(F.explode(users).alias("id", "u")).select("id", F.trim("u.name").alias("name"), F.lower("u.email").alias("email"))
    return rows.filter(F.col("email").endswith("@" + company) & (F.col("name") != ""))


def sqlite(spark: SparkSession, path: str, table: str, schema: str | None = None, partitions: int = 8) -> DataFrame:
    """A table of one or more SQLite files, read only, in key ranges. Filters are pushed down where the session allows it
    for data sources in Python (spark.sql.python.filterPushdown.enabled)."""
    ship(spark)
    kind = PushedDatabase if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true" else Database
    spark.dataSource.register(kind)
    reader = spark.read.format(kind.name()).option("path", path).option("table", table).option("partitions", partitions)
    return (reader.schema(schema) if schema else reader).load()


def jdbc(spark: SparkSession, url: str, table: str, driver: str, key: str, low: int, high: int, partitions: int = 8) -> DataFrame:
    """S10 for other databases: key ranges by JDBC; needs the driver on the class path."""
    options = {"url": url, "driver": driver, "dbtable": table, "partitionColumn": key, "lowerBound": low, "upperBound": high, "numPartitions": partitions}
    return spark.read.format("jdbc").options(**options).load()


def recordings(spark: SparkSession, folder: str, kinds: str = "*.m4a") -> DataFrame:
    """The files of a folder with size and time, their bytes not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", kinds).option("recursiveFileLookup", True).load(folder).select("path", "modificationTime", "length")
