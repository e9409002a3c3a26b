"""A small corpus pipeline over the operators of ``wardmill.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and hands the reread table on. All but the last stage return the columns of ``documents``. Every stage works on what its
predecessor kept: the classifiers are fitted on labelled rows that are still there, frequencies and classes are those of the
documents that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import decontaminate, mixing, quality, toxicity, weighted_minhash
from wardmill.llm.queries import learned_from
from wardmill.llm.shared import importable_in_tasks, stored

TOXIC, GOOD = 0.5, 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of at least 0.5."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), use=learned_from())
    return toxicity.with_scores(docs, model, name="__score").where(F.col("__score") < TOXIC).drop("__score")


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a quality score of at least 0.3."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), use=learned_from())
    return toxicity.with_scores(docs, model, name="__score").where(F.col("__score") >= GOOD).drop("__score")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate class, with all its texts. Rows without an id stay.

    Rows of one id and one text are one; its other columns are those of the row with the smallest hash, whatever the order.
    """
    found = weighted_minhash.near_duplicates(docs)
    kept = found.where("kept and id is not null").select(F.col("id").alias("doc_id")).distinct()
    columns = [n for n in docs.columns if n not in ("doc_id", "text")]
    plain = ["source", "lang", "n_chars"]
    rows = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    rows = rows.groupBy("doc_id", "text").agg(F.min_by(F.struct(*columns), F.xxhash64(*[F.col(n).cast("string") for n in plain])).alias("__row"))
    return rows.select("doc_id", "text", "__row.*").unionByName(docs.where("doc_id is null")).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which the benchmark's windows cover at least one word in twenty."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name="__hits")
    return found.where(~decontaminate.is_contaminated("__hits")).drop("__hits")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document its words and how many of them the mix takes, repeats counted."""
    mixture = mixing.mix(docs)
    own = lambda values, kind: mixing.pick(values, F.col("src"), kind)
    return mixture.taken().select(F.col("id").alias("doc_id"), "size", own([s.words for s in mixture.sources], "bigint").alias("source_size"),
                                  own([s.target for s in mixture.sources], "double").alias("target"), "taken")


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: The fitted classifiers and sampled hashes are beyond SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable_in_tasks(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
