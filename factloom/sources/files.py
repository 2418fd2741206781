"""Source trees, symbol listings and XML as DataFrames."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.schema import TAG

ANDROID = "{http://schemas.android.com/apk/res/android}"


def read_texts(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path below root, text) of all files below root whose name matches, read whole; bad UTF-8 becomes replacement characters."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return read.select(relative_to(F.col("path"), root).alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path below root, length) of all files; contents are not read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return read.select(relative_to(F.col("path"), root).alias("path"), "length")


def relative_to(path: Column, root: str) -> Column:
    """The path below root; a path elsewhere stays as it is."""
    bare = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^file:/+", "/")
    prefix = root.removeprefix("file:").rstrip("/") + "/"
    return F.when(F.startswith(bare, F.lit(prefix)), F.substring(bare, len(prefix) + 1, 1 << 20)).otherwise(bare)


def read_tags(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """Symbol records of JSON lines: blank and malformed lines are skipped, other records than tags too.

    ``path`` of a record becomes relative to root; ``seq`` keeps the order of lines.
    """
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id()).where("trim(value) != ''")
    parsed = lines.select("seq", F.from_json("value", TAG, {"mode": "PERMISSIVE"}).alias("t")).where("t._type = 'tag'")
    tags = parsed.select("t.*", "seq").drop("_type")
    return tags.withColumn("path", relative_to(F.col("path"), root)) if root else tags


def xml_permissions(files: DataFrame) -> DataFrame:
    """(path, name, error) of (path, text): a row for each named ``permission`` element, or for what made a file unreadable."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, text in zip(batch["path"], batch["text"]):
                try:
                    root = ET.fromstring((text or "").encode())
                except ET.ParseError as e:
                    rows.append((path, None, str(e)))
                    continue
                names = [e.get(f"{ANDROID}name") for e in root.iter("permission") if e is not root]
                rows += [(path, n, None) for n in names if n]
            yield pd.DataFrame(rows, columns=["path", "name", "error"])

    return files.where(F.contains("text", F.lit("permission"))).select("path", "text").mapInPandas(run, "path string, name string, error string")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """A written plan document as one row."""
    return spark.read.option("multiLine", "true").json(path)
