"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import ensure_checkpoint_dir, settle, small_or_shuffled
from factloom.llm.decontaminate import decontaminate
from factloom.llm.lines import dedup_lines
from factloom.llm.packing import pack_documents
from factloom.llm.quality import fit_quality, score_quality
from factloom.llm.queries import public_vocabulary
from factloom.llm.simhash import simhash_groups
from factloom.session import ship, table

LEAST_LINE = 24
#: Of near_dedup: words of a shingle, and bits in which fingerprints of copies may differ.
WORDS, DISTANCE = 5, 6


def aside(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with its own columns of these names under others, so that an operator's outputs can't replace them."""
    return docs.withColumnsRenamed({n: f"_own_{n}" for n in names if n in docs.columns})


def back(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` alone, under their names."""
    return done.select(*[F.col(f"`_own_{c}`" if f"_own_{c}" in done.columns else f"`{c}`").alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote rejects (score under 0.3) go.

    Null and empty texts get the training rows' share of label 1 as score, rows
    without an id are scored as any other, repeated rows alike; an empty table
    stays empty; columns named as the operator's outputs keep what they hold.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return back(score_quality(aside(docs, "score", "predicted", "held_out"), model).where("predicted = 1"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents that have nothing but white space left after that.

    ``n_chars`` follows the text, if there is such a column. Rows with a null id or
    text stay as they are; rows that repeat an id lose the same lines; an empty
    table stays empty.
    """
    done = dedup_lines(aside(docs, "removed"), least=LEAST_LINE, least_equal=1)
    left = F.coalesce("text", F.lit("")).rlike(r"\S")
    changed = F.size("removed") > 0
    done = done.where(~changed | left)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(done, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document of the smallest id stays.

    Shingles have WORDS words, and fingerprints link at DISTANCE or fewer of 64
    differing bits. Texts without words are copies of each other. Rows without an
    id stay, as do rows that repeat the id that stays; an empty table stays empty.
    """
    copies = settle(simhash_groups(docs, WORDS, DISTANCE).where("doc_id != component_id").select(F.col("doc_id").alias("_copy")).distinct())
    return docs.join(small_or_shuffled(copies, copies.count() * 16), docs["doc_id"] == copies["_copy"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, rows without an id stay, an empty table stays empty."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences of 2048 tokens; null and empty texts give a piece of the end token."""
    return pack_documents(docs, public_vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: All stages but parts of the fourth are beyond SQL; the tests compare line_dedup, decontaminate and pack with brute force,
#: near_dedup with the operator, whose links are compared with brute force, and quality with the labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    ship(spark)
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs, files = table(spark, sf_dir, "documents"), spark._jvm.org.apache.hadoop.fs.Path
    last = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}.parquet")
        docs = spark.read.parquet(f"{folder}/{name}.parquet")
        if last:  # read to the end, and not needed any more
            path = files(f"{folder}/{last}.parquet")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        last = name
    return docs
