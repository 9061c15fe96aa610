"""Connected components of links between documents, by label exchange and pointer jumping in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) for every id in ``links`` (a, b); no row for other ids.

    Each round gives every id the smallest label next to it, then the label of that label, so a chain of
    n ids takes about log n rounds. Links between ids of one label are dropped as the rounds go. Labels
    are tables in the shared folder; only the number of changed labels reaches the driver.
    """
    both = links.where("a <> b").select("a", "b").union(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        # the smallest label beside an id; copies of a hot id's links are combined before they are shuffled
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id", "left").select("id", F.col("component").alias("was"), F.least("component", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("next"))
        after = stored(lower.join(jump, "low", "left").select("id", "was", F.least("low", "next").alias("component")), "labels")
        if after.where("component <> was").isEmpty():
            return after.select("id", "component")
        labels = after.select("id", "component")
