"""Connected components of links that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.scratch import drop_path, fresh_path, write_out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of a link (a, b): root is the component's least node.

    Each round takes the least root among neighbours and then the root's root, so
    that long chains shorten by half; rounds are written tables.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.selectExpr("b AS a", "a AS b")).distinct()
    both = write_out(both, "links")
    path = fresh_path(spark, "roots")
    first = both.groupBy("a").agg(F.min("b").alias("b"))
    roots = write_out(first.selectExpr("a AS node", "least(a, b) AS root"), "roots", path)
    while True:
        near = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near.withColumnRenamed("a", "node"), "node").selectExpr(
            "node", "root AS old", "least(root, near) AS root"
        )
        jump = roots.selectExpr("node AS root", "root AS next")
        new_path = fresh_path(spark, "roots")
        moved = write_out(
            lower.join(jump, "root").selectExpr("node", "old", "least(root, next) AS root"),
            "roots",
            new_path,
        )
        done = moved.where("root <> old").isEmpty()
        drop_path(spark, path)
        roots, path = moved.select("node", "root"), new_path
        if done:
            return roots
