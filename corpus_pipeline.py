"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, whatever further ones there are.  Between stages
the rows are written as Parquet to the shared folder and read again.

Rows with a null text or id go through like others, as each stage states; an empty
table gives an empty one, except that a classifier needs labelled rows to judge by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldmill.llm import line_dedup, mixing, ngram_join, packing, quality_classifier
from yieldmill.session import materialise

ORACLE_SQL = None  # trees, packing and the mix of their output have no SQL form


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null texts are scored as empty ones."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has, equal or within one word, go.

    A document that loses its last line with a word goes; one without id or text stays
    as it is.
    """
    return recounted(line_dedup.dedup(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar five-word shingles one stays.

    It is the one with the smallest id; rows that repeat it are one document.  Texts
    without words and rows without id stay.
    """
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order.

    A text without words is in no mix; a null source is a source, null ids are mixed too.
    """
    return recounted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the training sequences they stand in.

    The mix is read in the order it was written: by the number of the part in the
    file's name, then by row.  Texts without words give one row without a sequence.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("int")
    return packing.pack(docs, order=[part, F.col("_metadata.file_name"), F.col("_metadata.row_index")])


STAGES = [
    ("quality classifier", drop_poor),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
