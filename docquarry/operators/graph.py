"""Connected components over an edge table, by randomised hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.plans.lineage import cut, passing

MAX_ROUNDS = 60


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Returns (id, component_id) for every node of `edges`; component_id is the smallest id reachable.

    Each round orders the live nodes, hooks each one to the first node among its neighbours and itself (twice:
    parent of the parent), then replaces edge ends by parents and drops loops and repeats. Even rounds order
    by id, which folds stars around small ids at once; odd rounds order by a fresh random priority, under
    which live nodes shrink by a constant factor whatever the shape, long chains included. All of it is
    joins and map-side-combined minimums, so the centre of a large star costs its task one row per map task,
    and skewed joins can be split.

    Self-loops make a node known without linking it. No edges give no rows. Null ends are ignored.
    """
    with passing(edges.sparkSession) as keep:
        pairs = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v")).where(
            F.col("u").isNotNull() & F.col("v").isNotNull()
        )
        ends = cut(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
        labels = ends.select(F.col("u").alias("id"), F.col("u").alias("root")).distinct()
        live = ends.where("u <> v")
        for step in range(MAX_ROUNDS):
            if live.isEmpty():
                break
            rank = lambda c: F.struct((F.xxhash64(F.col(c), F.lit(step)) if step % 2 else F.lit(0).cast("long")).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
            near = live.groupBy("u").agg(F.min(rank("v")).alias("near"))
            first = near.select("u", F.least(F.col("near"), rank("u"))["n"].alias("p"))
            second = first.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = cut(first.join(second, "p").select("u", F.col("pp").alias("p")))
            labels = cut(
                labels.join(parent.withColumnRenamed("u", "root"), "root", "left").select("id", F.coalesce("p", "root").alias("root"))
            )
            live = cut(
                live.join(parent, "u")
                .select(F.col("p").alias("pu"), "v")
                .join(parent.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
                .where("pu <> pv")
                .select(F.col("pu").alias("u"), F.col("pv").alias("v"))
                .distinct()
            )
        else:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
        smallest = labels.groupBy("root").agg(F.min("id").alias("component_id"))
        return keep(labels.join(smallest, "root").select("id", "component_id"))
