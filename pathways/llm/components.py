"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique
from pathways.session import remove, scratch_path


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component for every node of edges (a, b): the smallest node it reaches.

    Each round joins every node to the smallest of its neighbours, first for
    larger, then for smaller neighbours; rounds grow with the logarithm of the
    longest path. Edges are written after each round, so lineage stays short.
    """
    spark = edges.sparkSession

    def save(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "edges")
        df.write.parquet(path)
        return spark.read.schema("a long, b long").parquet(path), path

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else e
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = join_unique(both, least, ["a"], "inner")
        if larger:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            out = out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    tidy = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path = save(tidy)
    sign = None
    for _ in range(most_rounds):
        new, new_path = save(star(star(now, True), False))
        remove(spark, path)
        now, path = new, new_path
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(told) == sign:
            break
        sign = tuple(told)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
