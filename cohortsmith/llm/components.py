"""Connected components by contraction, on links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of the links (columns a, b): one label per component.

    Each round every vertex moves to its least neighbour and the links move along; links within
    one vertex vanish.  Vertices are hashes, so chains of descending values are short and the
    number of rounds is logarithmic.  Only a link count per round reaches the driver."""
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    label = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
                          .select("v", F.least("v", "m").alias("to")), "step")
        if label is None:
            label = step.withColumnRenamed("to", "label")
        else:
            label = stored(label.join(step.select(F.col("v").alias("label"), "to"), "label", "left")
                                .select("v", F.coalesce("to", "label").alias("label")), "label")
        moved = (links.join(step.select(F.col("v").alias("a"), F.col("to").alias("_a")), "a")
                      .join(step.select(F.col("v").alias("b"), F.col("to").alias("_b")), "b")
                      .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
                      .filter("a <> b").distinct())
        links = stored(moved, "links")
        if links.isEmpty():
            return label
