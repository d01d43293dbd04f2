"""Stages that turn raw documents into training shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next stage's documents. All but the last return the columns of documents; an empty table gives
an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.llm import decontaminate, mixing, repair, simhash, toxicity
from concordia.llm.common import discard, few_files, let_go, new_path, release, staged_so_far, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, doesn't reject.

    A null text is an empty one and stays; repeated rows stay or go alike; rows without an id are judged by
    their texts; without labels of both classes all stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return few_files(toxicity.kept(docs, model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, and of rows that share it one by a key of the row.

    Rows without an id link like any other and stay where no row of their group has an id. Empty and null
    texts are one group. Rows that are equal in every column are one.
    """
    return few_files(simhash.one_of_each(docs))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; null and blank items are held by none; repeated rows stay or go alike.
    """
    return few_files(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them.

    Texts without words are taken never; a null source is one of its own; rows that share an id are taken
    each for itself.
    """
    return few_files(mixing.emitted(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids in the token files.

    A null text has the end id alone; rows without an id come first; rows that share an id each have a row.
    repair.shards_path() of the result says where the files are.
    """
    return few_files(repair.written_and_read(docs))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL can express neither the models nor the files: the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; repair.shards_path() of it says where its token shards are.

    What a stage staged for itself is removed when the stage is written; the shards stay.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        mark = staged_so_far()
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, mark, keep=path)
        if before is not None:
            discard(spark, before)
        let_go(spark)
        before = path
    return docs
