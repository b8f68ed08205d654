"""Connected components of links, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``links``; the component is its smallest
    id. Every round each id takes the least label among its neighbours and then
    that label's own label, so the rounds grow with the logarithm of the longest
    path. Each round's labels are a written table; only a count reaches the driver.

    A link with a null end and one from an id to itself are no links; repeated links
    count once; without links the result is empty."""
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                    .select(F.col("a").alias("id"), "label", F.lit(True).alias("changed")), "labels")
    while True:
        old = labels.select("id", "label")
        near = (both.join(old.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "id"))
        new = old.join(near, "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = old.select(F.col("id").alias("label"), F.col("label").alias("top"))
        before, labels = labels, stored(new.join(up, "label").select("id", F.col("top").alias("label"),
                                                     (F.col("top") < F.col("was")).alias("changed")), "labels")
        discard(before)
        if not labels.where("changed").limit(1).count():
            out = stored(labels.select("id", F.col("label").alias("component")), "components")
            discard(both, labels)
            return out
