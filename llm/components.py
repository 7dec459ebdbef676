"""Connected components by joins: least labels with pointer jumping, written between rounds; families of keys' members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statbank.session import discard, materialized


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, component): every linked node with the smallest node that it reaches.

    Each round takes the least label among neighbours, then the label of that label, so the number of
    rounds grows with the logarithm of a chain's length. Labels are combined before they are shuffled;
    a hub's links are ordinary rows. No links give no rows.
    """
    both = materialized(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component"))
    labels = materialized(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        above = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        step = materialized(
            step.join(above, "component").select("node", "old", F.least("component", "above").alias("component")), "labels"
        )
        if step.where("old <> component").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")


def stars(members: DataFrame, of_use: str = "true") -> DataFrame:
    """members (key, node) -> distinct (a, b): each member of a key that is of use with the key's least one."""
    shared = members.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("b"), F.expr(of_use).alias("use"))
    shared = shared.where("size > 1 AND use").select("key", "b")
    return members.join(shared, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def families(live: DataFrame) -> DataFrame:
    """live (key, node, least: the key's least node), written -> node, family: which nodes keys bring together.

    A node takes the least node of all its keys as label; then only the keys' different labels are linked, so
    the links of a large group are contracted before components are sought.
    """
    labels = materialized(live.groupBy("node").agg(F.min("least").alias("label")), "labels")
    contracted = materialized(live.select("key", "node").join(labels, "node").select("key", F.col("label").alias("node")).distinct(), "contracted")
    found = components(stars(contracted)).select(F.col("node").alias("label"), "component")
    discard(contracted)
    return labels.join(found, "label", "left").select("node", F.coalesce("component", "label").alias("family"))
