"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written as Parquet and read again, which also cuts the lineage.  All but the last
return the columns of ``documents``:

1. quality: documents that fail the repetition rules go,
2. near duplicates: of each group linked by similar shingle sets the smallest id stays,
3. decontamination: documents with a benchmark window go,
4. mixing: documents repeat as often as their source's rate says,
5. token files: ORC with one row per document left, read back with start, length and checksum.

NULL and empty texts fail stage 1.  Rows with a NULL id are judged one by one and stay in
stage 2; of rows that share an id one stays, that with the smallest text hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalens.llm import decontaminate, mixture, ngram_join, repetition, token_orc
from stratalens.llm.queries import MIX_SEED, tokenizer_path
from stratalens.llm.shared import new_folder, only, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.judge(docs, into="__judged").where("__judged.kept").drop("__judged")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grouped, _ = ngram_join.similar_documents(docs)
    gone = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    kept = only(docs, gone, "doc_id", "left_anti")
    repeated = kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    one = (
        only(kept, repeated, "doc_id").groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min_by(F.struct(*kept.columns), F.xxhash64("text")).alias("__row")).select("__row.*")
    )
    return only(kept, repeated, "doc_id", "left_anti").unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    windows = decontaminate.windows(table(spark, sf_dir, "benchmark"))
    return decontaminate.mark_hits(docs, windows, into="__hits").where("__hits.n_hit = 0").drop("__hits")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sizes = docs.select("source", mixture.word_count(F.col("text")).alias("size"))
    drawn = mixture.drawn_number(F.col("doc_id"), F.col("text"), MIX_SEED)
    return mixture.emit(mixture.draw(docs, mixture.targets(sizes), drawn, into="__mix"), into="__mix")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    # Small tables: executors still hold what the stages before took.
    token_orc.write_tokens(docs, path, tokenizer_path(), slice_bytes=1 << 19, most_words=150_000, most_cores=50_000)
    return token_orc.with_checksum(token_orc.read_tokens(spark, path))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

# Suffix-array verdicts, shingle components and token ids have no SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
