"""Inherited cluster tables: member lists, first-member labels, redundancy leaders.

Member tables are in the long form ``DF[line_no, label, pos, member]`` of
:func:`contactforge.sources.delimited.read_cluster_members`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def cluster_first_member(members: DataFrame) -> DataFrame:
    """Label of each cluster on its first member only; for a repeated member the last line's label."""
    first = members.filter(F.col("pos") == 0)
    return first.groupBy(F.col("member").alias("id")).agg(F.max_by("label", "line_no").alias("label"))


def redundancy_leader(members: DataFrame) -> DataFrame:
    """Member to its leader and whether it is the leader itself; the last line wins."""
    chosen = members.groupBy(F.col("member").alias("id")).agg(F.max_by("label", "line_no").alias("leader_id"))
    flag = F.when(F.col("id") == F.col("leader_id"), "yes").otherwise("no")
    return chosen.withColumn("is_leader", flag)


def inherit_clusters(pairs: DataFrame, sequence: DataFrame, interface: DataFrame, binding: DataFrame, redundant: DataFrame) -> DataFrame:
    """The five inherited columns for every pair, blank when unknown."""
    out = pairs.select("id")
    for name, members in (("sequence-cluster", sequence), ("interface-cluster", interface), ("binding-cluster", binding)):
        out = out.join(cluster_first_member(members).withColumnRenamed("label", name), "id", "left")
    out = out.join(redundancy_leader(redundant).select("id", "is_leader", "leader_id"), "id", "left")
    return out.fillna("")
