"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import keep


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``.

    ``label`` is the smallest node reachable. Each round hooks every label to
    the smallest label it is linked with, follows the hooks to their ends and
    rewrites the links between labels; links inside one label go. The rounds
    grow with the logarithm of the number of nodes. Everything is an
    aggregate with partial sums or a join that adaptive execution can split,
    so a node with very many links is no hot task.
    """
    both = links.select("a", "b").unionAll(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    labels, between = _round(spark, both)
    while not between.isEmpty():
        hooks, between = _round(spark, between)
        labels = keep(spark, relabel(labels, "label", hooks), "labels")
    return labels


def _round(
    spark: SparkSession, between: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(node, label) after one round, and the links between unlike labels."""
    hooks = between.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
    hooks = keep(spark, hooks.select("node", F.least("node", "to").alias("label")), "hooks")
    while True:
        ahead = hooks.select(F.col("node").alias("label"), F.col("label").alias("further"))
        followed = keep(
            spark,
            hooks.join(ahead, "label").select(
                "node",
                F.col("further").alias("label"),
                (F.col("further") != F.col("label")).alias("moved"),
            ),
            "hooks",
        )
        hooks = followed.drop("moved")
        if followed.where("moved").isEmpty():
            break
    moved = relabel(relabel(between, "a", hooks), "b", hooks)
    return hooks, keep(spark, moved.where("a <> b").distinct(), "links")


def relabel(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``rows`` with the labels of the nodes in ``column``, if they have any."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias("_new"))
    return rows.join(named, column, "left").select(
        *[
            F.coalesce("_new", column).alias(c) if c == column else F.col(c)
            for c in rows.columns
        ]
    )
