"""Exact duplicates by digest, content compared at every stage, safe for hot copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitframe.sources.stages import materialise

from .common import without_blanks

_LAST_ID = "9223372036854775807"
_STEP = "100000000000000000000"  # above every value of _LAST_ID - id


def _sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _rank(key: str, text: str) -> Column:
    """Longest text first, then smallest id, as one decimal.

    A decimal fits the fixed-width buffer of a hash aggregate; a struct would
    make Spark sort the contents instead.
    """
    points = f"CAST(length(coalesce(`{text}`, '')) AS DECIMAL(10,0)) * CAST({_STEP} AS DECIMAL(21,0))"
    place = f"CAST({_LAST_ID} AS DECIMAL(20,0)) - CAST(coalesce(`{key}`, {_LAST_ID}) AS DECIMAL(20,0))"
    return F.expr(f"CAST({points} + {place} AS DECIMAL(38,0))")


def _winner_id(rank: str) -> Column:
    place = f"CAST({_LAST_ID} AS DECIMAL(20,0)) - CAST({rank} % CAST({_STEP} AS DECIMAL(21,0)) AS DECIMAL(20,0))"
    return F.expr(f"nullif(CAST({place} AS BIGINT), {_LAST_ID})")


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    salts: int = 64,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """One row per document with the document that stands for its copies.

    Texts are equal if they are identical without white space. Three stages, each
    grouping by digest *and* content: within the task (partial aggregate), by
    digest and salt, and over the salts. A group of any size thus sends one row per
    task and salt, then one per salt. Documents find their winner by the digest
    alone; digests with more than one content, should there be any, are joined by
    content again.

    Null texts count as empty, and all empty texts are one group. A null id ranks
    after all others and ``keep_id`` is null only for a group of such rows. Rows
    that repeat an id with equal text are counted as often as they come and are
    marked alike. Other columns are not read. An empty table gives an empty one.
    """
    content = without_blanks(F.col(text))
    rows = docs.select(
        F.col(key).alias("_id"),
        content.alias("_content"),
        digest(content).alias("_digest"),
        _rank(key, text).alias("_rank"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).alias("_salt"),
    )
    salted = rows.groupBy("_digest", "_content", "_salt").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_rank").alias("_rank")
    )
    classes = salted.groupBy("_digest", "_content").agg(
        F.sum("_n").alias("_n"), F.max("_rank").alias("_rank")
    )
    winners = materialise(
        classes.groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_contents"),
            F.sum("_n").alias("group_size"),
            F.max("_rank").alias("_rank"),
        ),
        "digest-winners",
    )
    members = rows.select("_id", "_digest").join(
        winners.where("_contents = 1").drop("_contents"), "_digest"
    )
    clashes = winners.where("_contents > 1").select("_digest")
    if not clashes.isEmpty():
        apart = classes.join(clashes, "_digest", "left_semi").withColumnRenamed("_n", "group_size")
        members = members.unionByName(
            rows.drop("_rank")
            .join(apart, ["_digest", "_content"])
            .select(*members.columns)
        )
    keep = _winner_id("_rank")
    return members.select(
        F.col("_id").alias(key),
        keep.alias("keep_id"),
        "group_size",
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )
