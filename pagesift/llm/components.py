"""Connected components of links, by minimum labels and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(v, p) for every end of ``links`` (a, b): p is the smallest member of v's component.

    Each round a node takes the smallest label around it and then the label of that label.
    Minima are combined before the shuffle, and the other side of each join has one row per
    node, so the adaptive skew join deals a node with very many links to several tasks. Null
    ends are left out.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("p")), "labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("b"), "p"), "b").groupBy("a").agg(F.min("p").alias("m"))
        least = labels.join(around.withColumnRenamed("a", "v"), "v", "left").select(
            "v", F.col("p").alias("old"), F.least("p", "m").alias("p")
        )
        least = materialize(least, "labels")
        up = least.select(F.col("v").alias("p"), F.col("p").alias("q"))
        jumped = materialize(
            least.join(up, "p", "left").select("v", "old", F.coalesce("q", "p").alias("p")), "labels"
        )
        labels = jumped.select("v", "p")
        if jumped.where("p <> old").isEmpty():
            return labels
