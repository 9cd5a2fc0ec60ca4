"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..scratch import materialize, materialize_counted


def components(links: DataFrame) -> DataFrame:
    """``id, label`` of every end of the links ``a, b``; the label is the component's least id.

    In each round every node moves to the least of itself and its neighbours, and links
    follow their ends, so chains shrink by half or more; rounds end when no link is left.
    Counts and minima are combined in each task, so a node with many links is no task.
    """
    ends, left = materialize_counted(links.select("a", "b").where("a <> b").distinct())
    labels = ends.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("label", F.col("id"))
    while left:
        both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = F.min("b").alias("least")
        moves = materialize(both.groupBy("a").agg(least).select(F.col("a").alias("id"), F.least("a", "least").alias("to")))
        to_a, to_b = (moves.select(F.col("id").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        # Some joins of written tables for all rounds together, so it is worked out once at the end.
        labels = labels.join(moves.withColumnRenamed("id", "label"), "label", "left").select(
            "id", F.coalesce("to", "label").alias("label")
        )
        ends, left = materialize_counted(
            ends.join(to_a, "a")
            .join(to_b, "b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .where("a <> b")
            .distinct()
        )
    return materialize(labels)
