"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import checkpointed


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step over directed pairs (u, v): every node links the neighbours it looks at to the smallest node
    around it. The minimum is a partial aggregate and is joined back, so no node's neighbours are gathered."""
    low = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    near = edges.join(low, "u")
    if larger_only:
        return near.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(low.where("u <> m").select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that stands in a link; the component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al. 2014) until nothing changes; each round is written to
    the checkpoint folder, so lineage stays short. NULL ends and self links are ignored; an empty table gives none.
    """
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    pairs = checkpointed(ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    n, stamp = _digest(pairs)
    while n:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, larger_only=True).distinct()
        pairs = checkpointed(_stars(large, larger_only=False).distinct())
        n, again = _digest(pairs)
        if again == stamp:
            break
        stamp = again
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component")).distinct()


def _digest(pairs: DataFrame) -> tuple[int, tuple]:
    r = pairs.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return int(r[0]), tuple(r)
