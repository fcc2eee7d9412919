"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges ``a, b`` with ``a > b``.

    Large: every node points its larger neighbours to its least one. Small: every node points its
    smaller neighbours and itself there. Least neighbours come from a combined aggregation and are
    joined back by key, so a node of very many edges is split like any skewed join key.
    """
    near = edges.union(edges.select("b", "a")) if large else edges
    least = near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    if large:
        least = least.select("node", F.least("node", "m").alias("m"))
        moved = near.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least)
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node that has an edge and is not its component's least node.

    ``edges`` has two columns of ids, in any order and repeated at will; nulls and loops are
    dropped. ``component`` is the least id reachable. No edges, no rows.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = written(edges.where("a > b").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
        edges = written(_star(_star(edges, large=True), large=False), "edges")
