"""Connected components of a table of links, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(id, label) of every id that stands in a link (a, b); ``label`` is the smallest id reachable.

    Each round every id takes the smallest label among its own and its neighbours', and then
    the label of its label, so that paths shorten twofold; both ends' maximum goes down map-side.
    The rounds end when no label changes.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct().toDF("a", "b"), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("n_id")).agg(F.min("label").alias("near")))
        step = labels.join(near, F.col("id") == F.col("n_id")).select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("j_id"), F.col("label").alias("j_label"))
        step = stored(step.join(jump, F.col("next") == F.col("j_id"), "left")
                      .select("id", "label", F.least("next", "j_label").alias("next")), "labels")
        changed = step.where("next != label").limit(1).count()
        labels = step.select("id", F.col("next").alias("label"))
        if not changed:
            return labels
