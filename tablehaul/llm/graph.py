"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.shared import stage


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links i-j connect it to."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _toward_min(links: DataFrame, down: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest of them; ``down``: the node's smaller ones."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    sides = turned if down else links.unionByName(turned)
    least = sides.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    met = sides.join(least, "a")
    if down:
        own = least.select(F.col("a").alias("b"), F.col("m").alias("a"))
        out = met.select(F.col("m").alias("a"), "b").unionByName(own.select("a", "b"))
    else:
        out = met.where("b > a").select(F.col("m").alias("a"), "b")
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of the links ``(a, b)``: the smallest node it reaches.

    Alternates between hanging a node's larger neighbours and its smaller neighbours on the
    smallest one, until each node hangs on the smallest node of its component. Each round is
    written to the shared folder. Links with a null end are left out, as are loops; no links
    give no rows.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stage(links.distinct(), "links")
    while True:
        after = stage(_toward_min(_toward_min(links, down=False), down=True), "links")
        stars = after.groupBy("b").agg(F.count("*").alias("n"), F.min("a").alias("a"))
        roots = after.select("a").distinct()
        open_ends = stars.where("n > 1").select("b").union(
            roots.join(stars.select(F.col("b").alias("a")), "a", "left_semi")
        )
        if open_ends.isEmpty():
            break
        links = after
    inner = after.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return inner.unionByName(roots.select(F.col("a").alias("id"), F.col("a").alias("component")))
