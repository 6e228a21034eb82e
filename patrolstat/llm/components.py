"""Connected components of an edge table by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label``: every node of ``edges`` with the smallest node it can reach.

    Each round maps a node to its smallest neighbour or itself, and goes on with
    the images: their edges, and an edge from each image to its own image.
    Edges inside an image vanish, paths halve, and the smallest node of a
    component always stays, so the rounds shrink and end when no edge is left.
    Round results are written below the checkpoint folder.  Null ends are
    ignored; no edges give no rows.
    """
    def ordered(e: DataFrame) -> DataFrame:
        return e.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    e = cut(ordered(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")))
    labels: DataFrame | None = None
    while True:
        near = e.select("u", "v").union(e.select("v", "u")).groupBy("u").agg(F.min("v").alias("m"))
        image = cut(near.select(F.col("u").alias("node"), F.least("u", "m").alias("to")))
        if labels is None:
            labels = image.select("node", F.col("to").alias("label"))
        else:
            labels = cut(labels.join(image.withColumnRenamed("node", "at"), F.col("label") == F.col("at"), "left")
                         .select("node", F.coalesce("to", "label").alias("label")))
        across = (e.join(image.select(F.col("node").alias("u"), F.col("to").alias("iu")), "u")
                  .join(image.select(F.col("node").alias("v"), F.col("to").alias("iv")), "v"))
        up = image.select(F.col("to").alias("node")).distinct().join(image, "node")
        e = cut(ordered(across.select(F.col("iu").alias("u"), F.col("iv").alias("v"))
                        .union(up.select(F.col("node").alias("u"), F.col("to").alias("v")))))
        if not e.limit(1).count():
            return labels
