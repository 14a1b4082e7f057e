"""Connected components of an undirected graph, by minimum labels with shortcuts.

Links, labels and components stay in tables of the shared folder; the driver sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import drop_scratch, scratch


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label's own label. Both
    sides of every join are plain scans, so adaptive execution can split a node with very many
    links; the minimum is aggregated before its shuffle. Null ends are ignored. The rounds needed
    grow about with the logarithm of the longest path.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = scratch(ends.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(ends.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "links")
    labels = scratch(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")), "labels")
    while True:
        heard = both.join(labels, both["u"] == labels["node"]).select(F.col("v").alias("node"), "root")
        nearest = scratch(heard.unionByName(labels.select("node", "root")).groupBy("node").agg(F.min("root").alias("root")), "near")
        hop = nearest.select(F.col("node").alias("at"), F.col("root").alias("next"))
        new = scratch(nearest.join(hop, nearest["root"] == hop["at"], "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        was = labels.select("node", F.col("root").alias("was"))
        changed = new.join(was, "node").where(F.col("root") != F.col("was")).limit(1).count()
        drop_scratch(labels)
        drop_scratch(nearest)
        labels = new
        if not changed:
            drop_scratch(both)
            return labels
