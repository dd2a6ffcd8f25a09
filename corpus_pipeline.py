"""A corpus from documents to packed sequences, stage by stage.

Each stage takes what its predecessor kept, as a table, and returns the documents it
keeps in the columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitframe.llm import line_dedup, ngram_join, packing, toxicity
from hitframe.llm.common import table, tokenizer_path
from hitframe.llm.queries import BYTE_VOCABULARY
from hitframe.sources.stages import materialise


def _without(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of which the key is not gone.

    The keys are written first, so that their size is known before the texts are
    moved to them: a small list goes to the texts instead.
    """
    return docs.join(materialise(gone.select(key).distinct(), "gone-keys"), key, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples do not vote toxic.

    Rows without an id go by their text, so that they can be rejected as well. Of
    rows that repeat an id none stays if one is rejected.
    """
    key = "_key"
    while key in docs.columns:
        key += "_"
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", key)
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    toxic = toxicity.score(keyed, labels, key=key).where("predicted = 1")
    return _without(keyed, toxic, key).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others said before.

    A document of which no line is left has said nothing new and goes; one that had
    no text before stays as it is.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    lines = line_dedup.dedup_lines(docs, carry=tuple(rest))
    said = (F.col("n_dropped") == 0) | (F.trim("text") != "")
    kept = lines.where(said).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares its word shingles: the smallest id.

    Rows without an id stay, as none can be told from another.
    """
    groups = ngram_join.jaccard_components(docs)
    return _without(docs, groups.where("doc_id != component_id")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token sequences of fixed size, every document whole."""
    return packing.pack_documents(docs, tokenizer_path(BYTE_VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("packing", pack_sequences),
]

# Neither the nearest examples nor MinHash candidates can be put as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
