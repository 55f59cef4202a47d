"""From raw documents to token ids: each stage's rows are written and read again by the next."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tristrata.llm import bpe, language, lines, mixing, neardocs, queries
from tristrata.llm.rows import fresh
from tristrata.sources import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Rejected: no letter at all, or too unlike the language's own texts.

    Null and empty texts have no letter and go; a long text is judged whole; repeated rows share their
    fate; an empty table stays empty; all columns, whatever their names, are handed on as they are.
    """
    return language.recognised(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their repeated lines taken out; ``n_chars`` follows, and what has no line left goes.

    The first line of a group (smallest id, null ids last, then line number) stays. Null and empty texts
    have no line and go; rows that repeat an id and a text keep the same lines; an empty table stays
    empty; other columns are handed on as they are.
    """
    counts = tuple(fresh(docs.columns, "n_lines", "n_removed"))
    left = lines.drop_lines(docs, counts=counts).where(F.col(counts[0]) > F.col(counts[1]))
    return left.where(F.col("text").rlike("[^ \n]")).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class.

    Texts without five words are near only to equal ones, null counting as empty; of equal rows one
    stays; an empty table stays empty; columns are handed on as they are.
    """
    return neardocs.keep_one(docs).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Texts without a word have no size and come along with the rest of their place; null sources are a
    source of their own, the last; rows that repeat an id and a text are taken together; an empty table
    stays empty; columns are handed on as they are.
    """
    return mixing.apply_mix(docs).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text.

    Null and empty texts have no ids; strings of special tokens become those tokens; every row, also a
    repeated one, is encoded whole; an empty table stays empty; columns other than the named are left.
    """
    both = bpe.round_trip(docs, queries.vocabulary(), ["doc_id", "source", "text"])
    return both.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_documents", drop_near_documents),
    ("mix_sources", mix_sources),
    ("encode", encode_tokens),
]

ORACLE_SQL = None  # profiles, shingles and merges are beyond SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
