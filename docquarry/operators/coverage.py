"""Which sections a set of questions draws on: ancestors, coverage, shares and quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.operators import parse, views
from docquarry.plans.lineage import cut, passing

QUOTA = 0.35


def top_ancestors(nodes: DataFrame) -> DataFrame:
    """(id, top) for nodes (id, parent_id): the last node reached going up while the parent is known; on a cycle,
    and below one, the smallest id of the cycle. Pointers are doubled each round, so a chain of n takes log2(n)
    joins; what hasn't ended when 2 ** rounds exceeds the number of nodes has gone round a cycle."""
    with passing(nodes.sparkSession) as keep:
        rows = nodes.select("id", "parent_id").distinct()
        up = rows.join(rows.select(F.col("id").alias("k")).distinct(), F.col("parent_id") == F.col("k"), "left")
        hop = cut(up.select("id", F.coalesce("k", "id").alias("top"), F.coalesce("k", "id").alias("low"), F.col("k").isNull().alias("ended")))
        for _ in range(hop.count().bit_length() + 1):
            if hop.where("not ended").isEmpty():
                return keep(hop.select("id", "top"))
            ahead = hop.select(F.col("id").alias("top"), F.col("top").alias("next"), F.col("low").alias("then"), F.col("ended").alias("there"))
            hop = cut(hop.join(ahead, "top").select("id", F.col("next").alias("top"), F.least("low", "then").alias("low"), F.col("there").alias("ended")))
        # each node of a cycle has seen all of it; a chain that leads into one points at a node of it
        cycle = hop.select(F.col("id").alias("top"), F.col("low").alias("cycle"))
        return keep(hop.join(cycle, "top").select("id", F.when(F.col("ended"), F.col("top")).otherwise(F.col("cycle")).alias("top")))


def coverage(nodes: DataFrame, used: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by top section (doc_id, top, n, share), and one row a document (doc_id, roots, covered, ratio, used,
    total, max_share), from nodes (doc_id, id, level, parent_id) and used ids (id).

    Shares are of all used sections that have a top, those of level 0 included; counts are of tops above it."""
    tops = top_ancestors(nodes).withColumnRenamed("id", "i")
    placed = used.select(F.col("id").alias("i")).distinct().join(tops, "i").join(nodes.select("doc_id", F.col("id").alias("top"), F.col("level").alias("top_level"), F.col("parent_id").alias("up")), "top")
    root = (F.col("top_level") > 0) & F.col("up").isNull()
    totals = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("used"), F.countDistinct(F.when(root, F.col("top"))).alias("covered"))
    counts = placed.where(root).groupBy("doc_id", "top").agg(F.count(F.lit(1)).alias("n")).join(totals.select("doc_id", "used"), "doc_id")
    counts = counts.select("doc_id", "top", "n", (F.col("n") / F.col("used")).alias("share"))
    base = nodes.groupBy("doc_id").agg(F.count_if((F.col("level") > 0) & F.col("parent_id").isNull()).alias("roots"), F.count(F.lit(1)).alias("total"))
    most = counts.groupBy("doc_id").agg(F.max("share").alias("max_share"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    report = base.join(totals, "doc_id", "left").join(most, "doc_id", "left").select(
        "doc_id", "roots", zero("covered").alias("covered"), F.when(F.col("roots") > 0, zero("covered") / F.col("roots")).otherwise(0.0).alias("ratio"),
        zero("used").alias("used"), "total", F.coalesce("max_share", F.lit(0.0)).alias("max_share"),
    )
    return counts, report


def violations(counts: DataFrame, quota: float = QUOTA) -> DataFrame:
    return counts.where(F.col("share") > quota)


def _nodes(spark, d):
    tree = parse.section_tree(parse.sections(views.md_docs(spark, d)))
    return tree.select("doc_id", F.col("section_id").alias("id"), "level", "parent_id", "idx")


def _both(spark, d):
    nodes = cut(_nodes(spark, d))
    return coverage(nodes, nodes.where("idx % 4 <> 1").select("id"))


def q_coverage(spark, d):
    return _both(spark, d)[1].withColumns({"ratio": F.round("ratio", 9), "max_share": F.round("max_share", 9)})


def q_violations(spark, d):
    return violations(_both(spark, d)[0]).withColumn("share", F.round("share", 9))


def q_ancestors(spark, d):
    return top_ancestors(_nodes(spark, d))


NODES = f"""{parse.SECTIONS},
nodes as (
  select x.doc_id, x.idx, x.doc_id || '_sec' || x.idx as id, x.level::int as level,
    case when x.level > 0 then x.doc_id || '_sec' || (select max(y.idx) from sections y where y.doc_id = x.doc_id and y.idx < x.idx and y.level > 0 and y.level < x.level) end as parent_id
  from sections x)"""
_TREE = f"""{NODES},
up as (with recursive r as (select id, id as top, parent_id from nodes union all select r.id, n.id, n.parent_id from r join nodes n on n.id = r.parent_id) select id, top from r where parent_id is null),
placed as (select n.doc_id, u.top, t.level as top_level from nodes n join up u using (id) join nodes t on t.id = u.top where n.idx % 4 <> 1),
counts as (select doc_id, top, count(*) as n, count(*) / any_value(used) as share from placed join (select doc_id, count(*) as used from placed group by doc_id) using (doc_id) where top_level > 0 group by doc_id, top)"""

QUERIES = {"section_coverage": q_coverage, "quota_violations": q_violations, "top_ancestors": q_ancestors}
ORACLES = {
    "section_coverage": f"""with {_TREE}
select doc_id, b.roots, coalesce(c.covered, 0) as covered, round(case when roots > 0 then coalesce(c.covered, 0) / roots else 0 end, 9) as ratio, coalesce(c.used, 0) as used, b.total, round(coalesce(m.max_share, 0), 9) as max_share
from (select doc_id, count(*) filter (level > 0 and parent_id is null) as roots, count(*) as total from nodes group by doc_id) b
left join (select doc_id, count(*) as used, count(distinct top) filter (top_level > 0) as covered from placed group by doc_id) c using (doc_id)
left join (select doc_id, max(share) as max_share from counts group by doc_id) m using (doc_id)""",
    "quota_violations": f"with {_TREE} select doc_id, top, n, round(share, 9) as share from counts where share > {QUOTA}",
    "top_ancestors": f"with {_TREE} select id, top from up",
}
