"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import written


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, for every node of ``links`` (``a``, ``b``).

    Each round takes the smallest label among neighbours and then the label of that label, so long chains halve; rounds end
    when no label changes. A round is a written table. Labels are summed up before they are shuffled, so a node with very
    many neighbours is no single task's work. No links give no rows. With ``rounds``, it ends after so many at the latest:
    nodes with one label are connected then, but a component may have several.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = written(both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "links")
    labels = written(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    changed, done = True, 0
    while changed and done != rounds:
        there = labels.select(F.col("u").alias("v"), F.col("label").alias("near"))
        near = both.join(there, "v").groupBy("u").agg(F.min("near").alias("near"))
        taken = labels.join(near, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = labels.select(F.col("u").alias("label"), F.col("label").alias("over"))
        jumped = taken.join(above, "label").select("u", F.least("label", "over").alias("label"), "old")
        labels = written(jumped, "labels")
        changed = bool(labels.filter("label != old").limit(1).count())
        labels, done = labels.select("u", "label"), done + 1
    return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
