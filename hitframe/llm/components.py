"""Distributed union-find: connected components by labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitframe.session import drop_paths, scratch_scope
from hitframe.sources.stages import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, root)`` for every id in a link; the root is the smallest id reachable.

    In each round an id takes the smallest label among its own and its neighbours'
    (a grouped minimum, so a hub combines before the shuffle), then the label of
    that label, which halves long chains. Labels are written to the shared folder
    after each round; the driver sees only whether any of them changed. Nulls link
    nothing. Only the last labels stay in the shared folder.
    """
    with scratch_scope() as made:
        labels = _last_labels(links, a, b)
    drop_paths(links.sparkSession, made[:-1])
    return labels


def _last_labels(links: DataFrame, a: str, b: str) -> DataFrame:
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = materialise(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
    labels = materialise(
        both.groupBy("u").agg(F.min("v").alias("_v")).select(
            F.col("u").alias("id"), F.least("u", "_v").alias("root")
        ),
        "labels",
    )
    while True:
        offered = (
            both.join(labels.withColumnRenamed("id", "u"), "u")
            .groupBy(F.col("v").alias("id"))
            .agg(F.min("root").alias("_offer"))
        )
        taken = labels.join(offered, "id").select("id", F.least("root", "_offer").alias("_to"), "root")
        onward = labels.select(F.col("id").alias("_to"), F.col("root").alias("_next"))
        jumped = materialise(
            taken.join(onward, "_to").select(
                "id",
                F.least("_to", "_next").alias("root"),
                (F.least("_to", "_next") < F.col("root")).alias("_changed"),
            ),
            "labels",
        )
        labels = jumped.drop("_changed")
        if jumped.where("_changed").isEmpty():
            return labels
