"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, codes, decontaminate, lines, mixing, periods, pii, quality, repair, simhash, sql, substring, toxicity
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.judged(toxicity.score(docs, model), toxicity.THRESHOLD)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document."""
    scores = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.judged(scores, quality.THRESHOLD)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, with up to the error budget of edits."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and the smallest id of its group of near duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's token ids, read back from compressed files."""
    return repair.written_and_read(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted texts."""
    turns = chat.table_turns(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_chats(chat.with_hostile(turns)))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document, with the terms beside it that give it away."""
    return pii.find(table(spark, sf_dir, "documents"), copies=False).drop("text_key")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that repeat passages of documents with smaller ids, and what is kept."""
    return substring.digests(table(spark, sf_dir, "documents")).drop("removed")


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that stay in another one, and what is kept."""
    return lines.digests(lines.dedup(table(spark, sf_dir, "documents")))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of each document's words, with planted ones, and what collapsing them keeps."""
    return periods.digests(periods.collapse(periods.with_planted(table(spark, sf_dir, "documents"))))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors, and their errors."""
    return codes.with_label_errors(codes.compress(table(spark, sf_dir, "embeddings")))


_ALL = (
    op1_toxicity, op2_quality, op3_mixing, op4_decontaminate, op5_simhash, op6_repair, op7_chat, op8_ann, op9_pii, op10_substring,
    op11_lines, op12_periods, op13_codes,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = sql.ORACLES
