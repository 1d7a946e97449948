"""From raw documents to training shards: five stages, each on what the one before kept.

1. toxicity: documents the model calls toxic go;
2. near duplicates: one document of each group stays;
3. decontamination: documents that hold a benchmark item go;
4. mixing: documents enter as many copies as the mix of sources takes;
5. sharding: the mix in random order over eight shards.

A stage takes (spark, docs, sf_dir), with the rows of the stage before, and returns
the columns of ``documents``; the last adds ``shard`` and ``slot``. ``run`` writes every
stage to the shared scratch folder and reads it again, so a lost executor costs part of one
stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.llm import mixing, setsketch, sharding, spaced_seeds, toxicity
from renown.llm.queries import held_out
from renown.session import stage

N_SHARDS = 8
ORACLE_SQL = None  # neither the restoration of disguised words nor the random order has a form in SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a score below one half; null and empty texts are kept.

    The model learns from the labels that are not held out. Without labels it
    rejects nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = toxicity.fit(docs, labels)
    # a base share of one half or more would judge texts without any evidence
    scored = toxicity.score(docs, model)
    return scored.where((F.col("score") < 0.5) | (F.size("evidence") == 0)).select("record.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies.

    Groups are linked by five-word shingles with a similarity of 0.8 or more. Rows that repeat an id
    and a text are copies of each other and leave one row; documents without words are kept, and
    so are documents with a null id unless their group has one with an id.
    """
    found = setsketch.near_duplicates(docs, n=5, percent=80)
    keep = stage(found.where("kept").select(F.col("doc_id").alias("_key"), "tie", "n_shingles"), "pipeline-kept")
    once = keep.groupBy("_key", "tie").agg(F.max("n_shingles").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    text_hash = F.xxhash64("text")
    kept = docs.withColumn("_tie", text_hash).join(
        once, F.col("doc_id").eqNullSafe(F.col("_key")) & (F.col("_tie") == F.col("tie")), "inner"
    )
    if once.where((F.col("_rows") > 1) & (F.col("_n") > 0)).isEmpty():
        return kept.select(*docs.columns)
    alone = kept.where((F.col("_rows") == 1) | (F.col("_n") == 0))
    first = kept.where((F.col("_rows") > 1) & (F.col("_n") > 0)).groupBy("_key", "_tie").agg(
        F.first(F.struct(*docs.columns)).alias("_first")
    )
    return alone.select(*docs.columns).unionByName(first.select("_first.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no benchmark item occurs; null and empty texts are kept."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return spaced_seeds.contamination(docs, benchmark).where(F.size("hits") == 0).select("record.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat every document as often as the mix takes it; sources weigh 3, 1, 2 in turn."""
    mixed = mixing.mix(docs).where("copies > 0")
    return mixed.select("record", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("record.*")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in one random order, cut into shards of equal row counts."""
    placed = sharding.shard(docs, N_SHARDS)
    columns = [F.col("record")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*columns, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
