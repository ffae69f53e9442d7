"""A training corpus in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``, further
columns of the input with their own values too, whatever their names. Every stage gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import lines, mixing, ngram, packing, quality
from corvane.llm._spark import discard, stored, table
from corvane.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; those it rejects (score under 0.5) go.

    Null and empty texts are scored as texts without words; equal texts, so repeated rows too, share their
    fate; rows with a null id are scored like others; without positive labels every score is 0.5 and all stay.
    """
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, net, name="__score").where("__score >= 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, exactly or nearly, an earlier line; documents left without any line go.

    Null and empty texts and rows with a null id stay as they are; repeated rows (one id, one text) keep
    the same lines each; of equal lines the one of smallest id and place stays; ``n_chars`` follows the text.
    """
    out = lines.dedup(docs, counts=("__n_lines", "__n_removed")).where(~((F.col("__n_removed") > 0) & (F.trim("text", F.lit(" \t\r\n\f\v")) == "")))
    return out.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near copies.

    Null and empty texts are alone and stay; of repeated rows one stays; rows with a null id stay.
    """
    return ngram.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: a row for each pass over a document, with the words taken.

    Documents without words (null and empty texts) are never taken; repeated rows are documents of their own; a null
    source is a source; ``n_chars`` follows the text.
    """
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length with their token ids; a null or empty text is one end id."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what they write between them goes to the shared folder and is removed when read."""
    docs, done = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, before = stored(stage(spark, docs, sf_dir), name), done
        done = docs
        if before is not None:
            discard(before)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
