"""Connected components of a graph of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import cleared, few_files, noted, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``: label is the least node reachable.

    Each round points every node's greater neighbours, then its smaller ones, at the least
    node among them. A grouped minimum and an equi-join do a round; both combine or split a
    node with many links. The join is by sorting, since labels take few bytes in files however
    many nodes have them. Rounds end when the edges no longer change, after about the logarithm
    of the longest path.
    """
    spark, before = links.sparkSession, []
    files = few_files(spark)
    with noted(before):
        edges = written(
            links.where("a <> b").select(
                F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
            ).distinct().coalesce(files), "edges",
        )
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).where("u <> v").distinct()
        now_written: list[str] = []
        with noted(now_written):
            large = written(large.coalesce(files), "edges")
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            edges = written(
                large.join(low.hint("merge"), "u").select(
                    F.col("v").alias("u"), F.col("m").alias("v")
                ).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
                .coalesce(files), "edges",
            )
        now = tuple(edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first())
        cleared(spark, before)  # the edges of the round before have been read
        before = now_written
        if now == mark:
            break
        mark = now
    found = written(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    ).coalesce(files), "labels")
    cleared(spark, before)
    return found
