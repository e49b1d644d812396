"""Connected components of links between ids, by label passing with shortcuts on written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> bool:
    """Joins the sets of i and j in place; label holds the smallest member of each one's set. Whether anything changed."""
    changed = False
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return changed
        changed = True
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := label[label], label):
            label[:] = further


def connected_components(links: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """id, component (smallest id reachable) of every id in links (a, b).

    Each round points every id to the smallest label around it and then to that label's label, so a chain of n links
    takes about log n rounds. Minima are taken before the shuffle, so an id with very many links is no burden.
    """
    both = links.select("a", "b").where("a <> b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
    edges = scratch.save(both.distinct())
    labels = scratch.save(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")))
    for _ in range(most_rounds):
        around = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m"))
        hooked = scratch.save(labels.join(around, "id", "left").select("id", "label", F.least("label", "m").alias("near")))
        # The smallest label that any member of a label's set has met is the label of that label from now on. Both sides
        # are written before they are joined: then the join's own shuffle can split a label that many ids share.
        roots = scratch.save(hooked.groupBy("label").agg(F.min("near").alias("root")))
        moved = scratch.save(hooked.join(roots, "label").select("id", F.least("near", "root").alias("label"), (F.least("near", "root") != F.col("label")).alias("changed")))
        scratch.drop(labels, hooked, roots)
        labels = moved.select("id", "label")
        labels._scratch_path = moved._scratch_path
        if not moved.where("changed").limit(1).count():
            scratch.drop(edges)
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError(f"no end after {most_rounds} rounds")
