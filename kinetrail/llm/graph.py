"""Connected components of a graph whose links are rows; nothing of its size reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kinetrail.llm.common import staged, unstage


def components(links: DataFrame) -> DataFrame:
    """(v, label) for each vertex of the links (a, b): label is the least vertex of its component.

    Alternates two steps until no label changes: every vertex takes the least label among its neighbours', then the label of
    that label. Hubs cost a row a link; group-wise minima are summed up before the shuffle. Null ends are ignored."""
    spark = links.sparkSession
    both = links.where("a IS NOT NULL AND b IS NOT NULL").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")
    both = staged(both.distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n")).select("v", F.least("v", "n").alias("label")), "labels")
    while True:
        offered = both.join(labels.select(F.col("v").alias("b"), F.col("label").alias("offer")), "b").groupBy(F.col("a").alias("v")).agg(F.min("offer").alias("offer"))
        near = labels.join(offered, "v").select("v", F.col("label").alias("was"), F.least("label", "offer").alias("near"))
        jump = labels.select(F.col("v").alias("near"), F.col("label").alias("far"))
        seen = Observation()
        found = near.join(jump, "near", "left").select("v", "was", F.least("near", F.coalesce("far", "near")).alias("label"))
        new = staged(found.observe(seen, F.count_if(F.col("label") != F.col("was")).alias("changed")), "labels")
        unstage(spark, labels)
        labels = new.select("v", "label")
        labels._kinetrail_path = new._kinetrail_path
        if not seen.get["changed"]:
            unstage(spark, both)
            return labels
