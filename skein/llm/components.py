"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.storage import discard, fresh_path


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link: root is the smallest node of its component.

    Each round points nodes at the smallest neighbour they know, first from above and then from below, and is written
    to the shared folder, so that plans stay short and rounds survive lost executors. Minima are pre-aggregated
    before they are shuffled. Self links and repeated links are allowed; nulls are not links.
    """
    spark = links.sparkSession
    pair = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    def settled(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = fresh_path(spark, "components")
        df.filter("u != v").select(pair.alias("p")).select("p.u", "p.v").distinct().write.parquet(path)
        table = spark.read.schema("u long, v long").parquet(path)
        return table, path, tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    given = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u != v")
    edges, path, mark = settled(given)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, both["u"] == low["w"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.join(below, large["u"] == below["w"])
        after, new_path, new_mark = settled(joined.select("u", F.col("m").alias("v")).union(joined.select("v", "m")))
        discard(spark, path)
        edges, path = after, new_path
        if new_mark == mark:
            break
        mark = new_mark
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
