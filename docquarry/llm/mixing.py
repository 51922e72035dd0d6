"""Mixing sources to target weights: iterative proportional fitting, then Poisson sampling (DataFrame
functions only).

Tokens (runs without white space) are summed by cell (source, language, topic). Raking scales the cells to
the target share of each source, then of each language, then of each topic, `rounds` times over. A cell's
sampling probability is min(1, s * fitted / tokens), with s solved so that the expected tokens come to the
budget: cells that reach 1 are set aside, and the rest share what is left. A document
is kept when the hash of its id, as a number in [0, 1), is below its cell's probability, so the sample does
not depend on partitioning, order or reruns.

Only the cell table is iterated on. It holds a row for each combination that occurs, after map-side sums,
so one source with a third of the rows costs no more than another; it is spread over tasks by its own size.

Targets: for each of the three columns either a mapping value -> weight (values not named get 0), or an
exponent e, which asks for shares in proportion to tokens ** e (1 keeps the mix, 0 makes it uniform).

Defined results: null source or language is a value of its own (empty string), as is the topic of null
text; documents without tokens have probability 0 and are not kept; texts are read whole; equal ids get equal
decisions (repeated rows stay or go together); cells that tie are scaled alike; an empty table gives no rows;
other columns pass through, whatever their names, except that columns named topic, tokens, p and kept are
replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import cut, passing, small, table

DIMENSIONS = ("source", "lang", "topic")
TARGETS: Mapping[str, float | Mapping[str, float]] = {"source": 0.5, "lang": 0.7, "topic": 0.7}
BUDGET = 0.5
ROUNDS = 12
#: Cells a task: the cell table is dealt over more tasks only when it has more than that.
CELLS_A_TASK = 200_000
#: Rounds of raking between two checkpoints.
ROUNDS_A_CUT = 4


def topic_of(text: Column) -> Column:
    """The form of a text, as its topic: the first of these rules that holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(low.contains("license") | low.contains("copyright"), "legal")
        .when(low.contains(" | "), "table")
        .when(low.contains("@"), "contact")
        .when(low.contains("###") | low.contains("!!"), "noise")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def described(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """(source, lang, topic, tokens) of every document, beside all its columns as the struct `row`."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        (topic_of(F.col("text")) if topic is None else topic).alias("topic"),
        tokens_of(F.col("text")).alias("tokens"),
    )


def fitted(rows: DataFrame, targets: Mapping[str, float | Mapping[str, float]], rounds: int) -> DataFrame:
    """(source, lang, topic, tokens, w): the cells of described() rows with their raked weights."""
    cells = cut(rows.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("tokens")))
    parts = max(1, cells.count() // CELLS_A_TASK)
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    cells = (cells.coalesce(1) if parts == 1 else cells.repartition(parts, "source")).withColumn("w", F.col("tokens"))
    for d in DIMENSIONS:
        asked = targets[d]
        if isinstance(asked, Mapping):
            raw = F.coalesce(*(F.when(F.col(d) == k, F.lit(float(v))) for k, v in asked.items()), F.lit(0.0))
        else:
            raw = F.pow("tokens", F.lit(float(asked)))
        margins = cells.groupBy(d).agg(F.sum("tokens").alias("tokens")).select(d, raw.alias("raw"))
        goal = F.col("raw") / F.lit(margins.agg(F.sum("raw")).first()[0] or 1.0) * total
        cells = cells.join(margins.select(d, goal.alias(f"{d}_goal")), d)
    cells = cut(cells)
    for i in range(rounds):
        cells = cells.coalesce(1) if parts == 1 else cells
        for d in DIMENSIONS:
            margin = F.sum("w").over(Window.partitionBy(d))
            cells = cells.withColumn("w", F.when(margin > 0, F.col("w") * F.col(f"{d}_goal") / margin).otherwise(0.0))
        if (i + 1) % ROUNDS_A_CUT == 0 or i + 1 == rounds:
            cells = cut(cells)
    return cells.select(*DIMENSIONS, "tokens", "w")


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """(source, lang, topic, p) with expected tokens of budget * all tokens. Cells whose probability would exceed 1
    are set aside and the rest is scaled again, until no further one does: sums only, and one row to the driver
    each time."""
    ratio = cells.withColumn("r", F.col("w") / F.col("tokens"))
    scale, aside = 0.0, -1
    while True:
        free = F.col("r") * scale < 1
        row = ratio.agg(F.sum("tokens").alias("t"), F.sum(F.when(~free, F.col("tokens"))).alias("full"), F.sum(F.when(free, F.col("w"))).alias("w"), F.count_if(~free).alias("n")).first()
        if row["n"] == aside or not row["w"]:
            break
        aside, scale = row["n"], ((row["t"] or 0.0) * budget - (row["full"] or 0.0)) / row["w"]
    return ratio.select(*DIMENSIONS, F.least(F.lit(1.0), F.col("r") * scale).alias("p"))


def mix(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, budget: float = BUDGET, rounds: int = ROUNDS, topic: Column | None = None) -> DataFrame:
    """All rows and columns of docs with topic, tokens, p and kept."""
    rows = described(docs, topic)
    with passing(docs.sparkSession) as keep:
        chances = keep(probabilities(fitted(rows, targets, rounds), budget))
    drawn = F.conv(F.substring(F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    joined = rows.join(F.broadcast(chances) if small(chances, CELLS_A_TASK) else chances, list(DIMENSIONS), "left")
    p = F.when(F.col("tokens") > 0, F.col("p")).otherwise(0.0)
    added = ("topic", "tokens", "p", "kept")
    own = (F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in added)
    return joined.select(*own, "topic", "tokens", p.alias("p"), (drawn < p).alias("kept"))


def shares(mixed: DataFrame) -> DataFrame:
    """(dimension, value, tokens, share): what a mixed table is expected to hold of each value, to set against the
    targets. Cells that are taken whole can keep them from being met."""
    value = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in DIMENSIONS)))
    summed = mixed.select(value.alias("v"), (F.col("p") * F.col("tokens")).alias("t")).groupBy("v").agg(F.sum("t").alias("tokens"))
    all_ = mixed.agg(F.sum(F.col("p") * F.col("tokens"))).first()[0] or 1.0
    return summed.select("v.dimension", "v.value", "tokens", (F.col("tokens") / all_).alias("share"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "topic", "tokens", F.round("p", 6).alias("p"), "kept")


def sql(targets: Mapping[str, float] = TARGETS, budget: float = BUDGET, rounds: int = ROUNDS) -> str:
    goals = ", ".join(f"raw_{d} / (select sum(x) from (select distinct {d}, raw_{d} as x from raws)) * total as goal_{d}" for d in DIMENSIONS)
    raws = ", ".join(f"pow(sum(tokens) over (partition by {d}), {targets[d]}) as raw_{d}" for d in DIMENSIONS)
    steps, last = [], "goals"
    for i in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"{d}{i} as materialized (select * replace (w * goal_{d} / sum(w) over (partition by {d}) as w) from {last})")
            last = f"{d}{i}"
    return f"""
with d as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, lower(coalesce(text, '')) as low,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n from documents),
t as (
  select *, case when contains(low, 'license') or contains(low, 'copyright') then 'legal' when contains(low, ' | ') then 'table'
    when contains(low, '@') then 'contact' when contains(low, '###') or contains(low, '!!') then 'noise' else 'prose' end as topic from d),
cells as (select source, lang, topic, sum(n)::double as tokens, sum(n)::double as w from t where n > 0 group by all),
raws as (select *, sum(tokens) over () as total, {raws} from cells),
goals as materialized (select source, lang, topic, tokens, w, {goals} from raws),
{", ".join(steps)},
ratios as (select source, lang, topic, tokens, w, w / tokens as r from {last}),
scaled as (
  select *, row_number() over o as k,
    (sum(tokens) over () * {budget} - coalesce(sum(tokens) over (order by r desc, source, lang, topic rows between unbounded preceding and 1 preceding), 0))
      / sum(w) over (order by r desc, source, lang, topic rows between current row and unbounded following) as s
  from ratios window o as (order by r desc, source, lang, topic)),
chances as (select source, lang, topic, least(1.0, r * (select arg_min(s, k) from scaled where s * r <= 1)) as p from scaled),
told as (select doc_id, topic, n as tokens, case when n > 0 then p else 0 end as p from t left join chances using (source, lang, topic))
select doc_id, topic, tokens, round(p, 6) as p,
  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint / {1 << 52}.0 < p as kept from told
"""


SQL = sql()
