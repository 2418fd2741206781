"""Digests of a file tree, and their differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.integrity import map_diff
from factloom.sources.files import relative_to

# Folders and suffixes that are no part of a payload.
EXCLUDED_FOLDERS = (".git", ".pytest_cache", ".venv", "__pycache__", "backups", "data", "raw", "venv")
EXCLUDED_SUFFIXES = (".db", ".db-shm", ".db-wal", ".pyc", ".pyo", ".tar", ".tar.gz", ".zip")


def digests(spark: SparkSession, root: str, folders: tuple[str, ...] = ()) -> DataFrame:
    """(path, digest) of the files below root, or below some of its folders; in no order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = files.select(relative_to(F.col("path"), root).alias("path"), F.sha2("content", 256).alias("digest"))
    parts = F.split("path", "/")
    kept = ~F.arrays_overlap(F.slice(parts, 1, F.size(parts) - 1), F.array(*map(F.lit, EXCLUDED_FOLDERS)))
    for suffix in EXCLUDED_SUFFIXES:
        kept = kept & ~F.endswith("path", F.lit(suffix))
    return found.where(kept & (F.get(parts, F.lit(0)).isin(*folders) if folders else F.lit(True)))


def validated(manifest: dict) -> dict[str, str]:
    """The digests of a payload manifest; ``ValueError`` if it is not one."""
    files = manifest.get("files")
    if manifest.get("schema_version") != 1 or not isinstance(manifest.get("source_commit"), str) or not isinstance(files, dict):
        raise ValueError("not a payload manifest")
    for path, digest in files.items():
        if path.startswith("/") or ".." in path.split("/") or not (isinstance(digest, str) and len(digest) == 64 and set(digest) <= set("0123456789abcdef")):
            raise ValueError(f"bad entry {path!r}")
    return files


def drift(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """(path, change) of files added, removed or modified since the manifest."""
    expected = spark.createDataFrame(list(validated(manifest).items()), "path string, digest string")
    return map_diff(expected, digests(spark, root), "path", "digest")
