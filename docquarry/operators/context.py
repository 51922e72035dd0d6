"""Context streams of parsed blocks, labels of an item's sources, and service addresses.

blocks are rows (doc_id, ord, type, content), content a struct of title_content and paragraph_content (arrays of
type and content), html, math_content and image_source (path). Blocks without content add nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import checks, views

PART = "array<struct<type:string,content:string>>"
CONTENT = f"struct<title_content:{PART},paragraph_content:{PART},html:string,math_content:string,image_source:struct<path:string>>"


def block_text(kind: Column, content: Column) -> Column:
    """The text of a title, paragraph (inline formulas included), table or formula; empty for other blocks."""
    words = lambda c: T.strip(T.text(c))
    said = lambda parts, *kinds: F.array_join(
        F.filter(F.transform(F.filter(parts, lambda p: p["type"].isin(*kinds)), lambda p: words(p["content"])), lambda s: s != ""), " "
    )
    return T.text(
        F.when(kind == "title", said(content["title_content"], "text"))
        .when(kind == "paragraph", said(content["paragraph_content"], "text", "equation_inline", "equation_interline"))
        .when(kind == "table", words(content["html"]))
        .when(kind == "equation_interline", words(content["math_content"]))
    )


def context_streams(blocks: DataFrame) -> DataFrame:
    """(doc_id, stream, markers): the texts of a document's blocks in order, each image file marked where it is first
    met; markers (at, file) hold the characters before each mark, counted before the stream is stripped. All
    windows and the aggregate share one shuffle by document."""
    path = F.regexp_replace(T.strip(T.text(F.col("content")["image_source"]["path"])), "/+$", "")
    rows = blocks.repartition("doc_id").select("doc_id", "ord", F.substring_index(path, "/", -1).alias("file"), block_text(F.col("type"), F.col("content")).alias("said"))
    rows = rows.withColumn("fresh", (F.col("file") != "") & (F.row_number().over(Window.partitionBy("doc_id", "file").orderBy("ord")) == 1))
    mark = F.when(F.col("fresh"), F.concat(F.lit("![img](images/"), "file", F.lit(")\n"))).otherwise("")
    body = F.when(F.col("said") != "", F.concat("said", F.lit("\n\n"))).otherwise("")
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("piece", F.concat(mark, body)).withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    told = rows.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("ord", "piece"))).alias("p"), F.array_sort(F.collect_list(F.when(F.col("fresh"), F.struct("at", "file")))).alias("markers")
    )
    return told.select("doc_id", T.strip(F.array_join(F.transform("p", lambda x: x["piece"]), "")).alias("stream"), "markers")


def source_labels(evidence: Column, most: Column) -> Column:
    """The first `most` labels of the sections in evidence (section_id, doc_title, doc_filename): titles, else file
    names without suffix; labels that differ in case or punctuation alone count once, those without letters not at all."""
    name = lambda e: T.file_title(F.substring_index(T.strip(T.text(e["doc_filename"])), "/", -1))
    label = lambda e: F.coalesce(F.nullif(T.strip(T.text(e["doc_title"])), F.lit("")), name(e))
    named = F.transform(F.filter(evidence, lambda e: T.text(e["section_id"]) != ""), lambda e: F.struct(label(e).alias("label"), T.identifier(label(e)).alias("key")))
    listed = F.filter(named, lambda x: x["key"] != "")
    keys = F.transform(listed, lambda x: x["key"])
    once = F.filter(listed, lambda x, i: F.array_position(keys, x["key"]) == i + 1)
    return F.slice(F.transform(once, lambda x: x["label"]), 1, most)


def source_hint(labels: Column, lang: Column) -> Column:
    """The labels as a remark in the language of the question; empty without labels."""
    joined = F.array_join(labels, " + ")
    chinese = F.concat(F.lit("（文件："), joined, F.lit("）"))
    return F.when(F.size(labels) == 0, "").when(lang.isin("zh", "zh-Hant"), chinese).otherwise(F.concat(F.lit("(Files: "), joined, F.lit(")")))


def joined_url(base: Column, suffix: Column) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(suffix, F.lit("/")))


def chat_endpoint(base: Column) -> Column:
    """The address of chat completions below a base address, which may end in /v1 or be that address already."""
    plain = F.rtrim(base, F.lit("/"))
    whole, version = F.lit("chat/completions"), F.lit("v1/chat/completions")
    return F.when(F.endswith(plain, F.lit("/chat/completions")), plain).when(F.endswith(plain, F.lit("/v1")), joined_url(plain, whole)).otherwise(joined_url(plain, version))


def q_streams(spark, d):
    """The turns of conversations as blocks of every kind; every second one names an image file."""
    kind = F.element_at(F.array(*map(F.lit, ("title", "paragraph", "table", "equation_interline", "image"))), ((F.col("conv_id") + F.col("turn")) % 5 + 1).cast("int"))
    part = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("content"))
    parts = F.array(part("text", F.concat(F.lit(" "), "text")), part("note", F.lit("left out")), part("equation_inline", F.lit(" x ")))
    image = F.when(F.col("turn") % 2 == 1, F.struct(F.concat(F.lit("out/images/"), (F.col("turn") % 4).cast("string"), F.lit(".png")).alias("path")))
    content = F.struct(parts.alias("title_content"), parts.alias("paragraph_content"), F.col("text").alias("html"), F.col("text").alias("math_content"), image.alias("image_source"))
    rows = views.table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("ord"), kind.alias("type"), content.cast(CONTENT).alias("content"))
    told = context_streams(rows)
    return told.select("doc_id", F.md5("stream").alias("stream_md5"), F.length("stream").cast("long").alias("n_chars"), F.array_join(F.transform("markers", lambda m: F.concat_ws(":", m["at"].cast("string"), m["file"])), ",").alias("markers"))


def q_labels(spark, d):
    n, source = F.col("doc_id"), F.coalesce("source", F.lit("none"))
    entry = lambda section, title, file: F.struct(F.lit(section).alias("section_id"), title.alias("doc_title"), file.alias("doc_filename"))
    evidence = F.array(
        entry("", F.lit("No section"), F.lit("a.pdf")), entry("s1", F.when(n % 3 == 0, "  ").otherwise(F.concat(F.lit("Src "), source)), F.concat(F.lit("in/"), source, F.lit(".v1.pdf"))),
        entry("s2", F.concat(F.lit(" SRC-"), source), F.lit(None).cast("string")), entry("s3", F.lit(None).cast("string"), F.concat(F.lit("file"), (n % 7).cast("string"), F.lit(".pdf"))),
    )
    labels = views.table(spark, d, "documents").select("doc_id", source_labels(evidence, F.when(n % 2 == 0, 2).otherwise(1)).alias("labels"))
    return labels.select("doc_id", F.array_join("labels", "|").alias("labels"), source_hint(F.col("labels"), F.when(n % 5 == 0, "zh").otherwise("en")).alias("hint"))


def q_endpoints(spark, d):
    tail = F.element_at(F.array(*map(F.lit, ("", "//", "/v1/", "/v1/chat/completions"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return views.table(spark, d, "documents").select("doc_id", chat_endpoint(F.concat(F.lit("http://h.example/"), F.col("doc_id").cast("string"), tail)).alias("endpoint"))


_TRIMMED = checks._SP.format("coalesce(text, '')")
QUERIES = {"context_streams": q_streams, "source_labels": q_labels, "chat_endpoints": q_endpoints}
ORACLES = {
    "context_streams": f"""with b as (select conv_id::varchar as doc_id, turn as ord, (conv_id + turn) % 5 as k, {_TRIMMED} as t, case when turn % 2 = 1 then turn % 4 || '.png' else '' end as file from conversations),
s as (select doc_id, ord, file, case when k = 1 then concat_ws(' ', nullif(t, ''), 'x') when k < 4 then t else '' end as said, file <> '' and row_number() over (partition by doc_id, file order by ord) = 1 as fresh from b),
p as (select *, case when fresh then '![img](images/' || file || ')' || chr(10) else '' end || case when said <> '' then said || chr(10) || chr(10) else '' end as piece from s),
a as (select *, coalesce(sum(length(piece)) over (partition by doc_id order by ord rows between unbounded preceding and 1 preceding), 0)::bigint as pos from p),
g as (select doc_id, string_agg(piece, '' order by ord) as text, coalesce(string_agg(pos || ':' || file, ',' order by ord) filter (fresh), '') as markers from a group by doc_id)
select doc_id, md5({_TRIMMED}) as stream_md5, length({_TRIMMED}) as n_chars, markers from g""",
    "source_labels": """with s as (select doc_id, coalesce(source, 'none') as s from documents),
l as (select doc_id, case when doc_id % 3 = 0 then s || '.v1' else 'Src ' || s end as one, case when doc_id % 2 = 0 then case when doc_id % 3 = 0 then 'SRC-' || s else 'file' || doc_id % 7 end end as two from s)
select doc_id, concat_ws('|', one, two) as labels, case when doc_id % 5 = 0 then '（文件：' || concat_ws(' + ', one, two) || '）' else '(Files: ' || concat_ws(' + ', one, two) || ')' end as hint from l""",
    "chat_endpoints": "select doc_id, 'http://h.example/' || doc_id || '/v1/chat/completions' as endpoint from documents",
}
