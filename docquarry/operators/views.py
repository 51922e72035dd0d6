"""Views over the sample tables that give the document operators what they work on, in Spark and as SQL.

md_docs: documents as Markdown (every fifth line a heading). items: conversations as parsed page items.
qa: consecutive user and assistant turns as questions and answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Only ASCII changes case in the fixtures: engines differ on letters such as ß.
_LOW, _UP = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, md)."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.when(i % 5 == 0, F.concat(F.repeat(F.lit("#"), (i % 3 + 1).cast("int")), F.lit(" "), x)).otherwise(x),
    )
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.array_join(lines, "\n\n").alias("md"))


MD = """md_docs as (
  select doc_id::varchar as doc_id, array_to_string(list_transform(string_split(text, chr(10)),
    lambda x, i: case when (i - 1) % 5 = 0 then repeat('#', ((i - 1) % 3 + 1)::int) || ' ' || x else x end), chr(10) || chr(10)) as md
  from documents)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ord, type, page_idx, text, image_caption, img_path): two turns make a page."""
    rows = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "text").when(F.col("role") == "assistant", "table").otherwise("image")
    return rows.select(
        F.col("conv_id").cast("string").alias("doc_id"),
        F.col("turn").alias("ord"),
        kind.alias("type"),
        F.floor(F.col("turn") / 2).cast("int").alias("page_idx"),
        "text",
        F.when(kind == "image", F.col("text")).alias("image_caption"),
        F.when(kind == "image", F.concat(F.lit("out/images/"), F.col("conv_id").cast("string"), F.lit(".png"))).alias("img_path"),
    )


ITEMS = """items as (
  select conv_id::varchar as doc_id, turn as ord, case role when 'user' then 'text' when 'assistant' then 'table' else 'image' end as type,
    (turn // 2)::int as page_idx, text, case when role not in ('user', 'assistant') then text end as image_caption,
    case when role not in ('user', 'assistant') then 'out/images/' || conv_id::varchar || '.png' end as img_path
  from conversations)"""


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, conv_id, question, answer): some questions end in a question mark, some repeat with other case
    and punctuation, some answers are the unanswerable token."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    pairs = table(spark, sf_dir, "conversations").withColumns({"answer": F.lead("text").over(order), "next": F.lead("role").over(order)})
    pairs = pairs.where((F.col("role") == "user") & (F.col("next") == "assistant"))
    mark = F.when(F.col("conv_id") % 3 == 0, "?").otherwise("")
    base = pairs.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        "conv_id",
        F.concat("text", mark).alias("question"),
        F.when(F.col("conv_id") % 7 == 6, "UNANSWERABLE").otherwise(F.col("answer")).alias("answer"),
    )
    again = base.where("conv_id % 4 = 0").select((F.col("ord") + 1_000_000).alias("ord"), "conv_id", F.concat(F.translate("question", _LOW, _UP), F.lit(" !")).alias("question"), "answer")
    return base.unionByName(again)


QA = f"""qa_pairs as (
  select conv_id, turn, role, text, lead(text) over (partition by conv_id order by turn) as answer, lead(role) over (partition by conv_id order by turn) as next from conversations),
qa_base as (
  select conv_id * 1000 + turn as ord, conv_id, text || case when conv_id % 3 = 0 then '?' else '' end as question,
    case when conv_id % 7 = 6 then 'UNANSWERABLE' else answer end as answer
  from qa_pairs where role = 'user' and next = 'assistant'),
qa as (
  select * from qa_base union all
  select ord + 1000000, conv_id, translate(question, '{_LOW}', '{_UP}') || ' !', answer from qa_base where conv_id % 4 = 0)"""
