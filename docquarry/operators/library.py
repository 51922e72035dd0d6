"""The document library: lookups, availability, reads over several documents with their assets, and acceptance of
generated items.

assets are rows (doc_id, kind, page, name): kind is image, page or crop, page a page number from 0 (null for
images), name a file name. Ids of sections and chunks begin with their document's id and an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import checks, parse, search, views
from docquarry.plans.lineage import cut

IMAGES, PAGES, CROPS_A_PAGE = 3, 2, 2
ATTEMPTS = 5
MOST_COUNTS = 30


def get_document(store: DataFrame, doc_id: str) -> DataFrame:
    """The row of one document; an unknown id is a KeyError."""
    found = store.where(F.col("doc_id") == doc_id).limit(1)
    if found.isEmpty():
        raise KeyError(f"no document {doc_id}")
    return found


def available(store: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Documents whose canonical_path and index_path are among the artifacts (path)."""
    known = artifacts.select("path").distinct()
    for name in ("canonical_path", "index_path"):
        store = store.join(known.withColumnRenamed("path", name), name, "left_semi")
    return store


def owner(id_: Column) -> Column:
    """The document that the id of a section or chunk begins with."""
    return F.substring_index(id_, "_", 1)


def used_documents(used: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, n): how many of the used section ids (id) belong to each document, by their prefix."""
    counted = used.select(owner(F.col("id")).alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return docs.select("doc_id").distinct().join(counted, "doc_id")


def section_info(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """(section_id, title, level, parent_id, start_char, end_char, chunk_ids, page_idxs) of every section; chunks
    (section_id, chunk_id, start_char, page_idx) in the order of the text, pages each once."""
    held = chunks.groupBy("section_id").agg(
        F.array_sort(F.collect_list(F.struct("start_char", "chunk_id"))).alias("c"), F.array_sort(F.collect_set("page_idx")).alias("page_idxs")
    )
    none = lambda kind: F.array().cast(f"array<{kind}>")
    return found.join(held, "section_id", "left").select(
        "section_id", "title", "level", "parent_id", "start_char", "end_char",
        F.coalesce(F.transform("c", lambda x: x["chunk_id"]), none("string")).alias("chunk_ids"), F.coalesce("page_idxs", none("int")).alias("page_idxs"),
    )


def page_number(name: Column, kind: Column) -> Column:
    """The page (from 0) that a file is of: page_0007.png and page_7.png are page 6, p6.png is page 6, and so is
    crop_3_p0007_1.png; null for others."""
    padded = F.regexp_extract(name, "^page_([0-9]+)\\.png$", 1)
    plain = F.regexp_extract(name, "^p([0-9]+)\\.png$", 1)
    crop = F.regexp_extract(name, "^crop_.*_p([0-9]{4})_.*\\.png$", 1)
    number = lambda c: F.nullif(c, F.lit("")).cast("int")
    return F.when(kind == "page", F.coalesce(number(padded) - 1, number(plain))).when(kind == "crop", number(crop) - 1)


def _pattern(name: Column) -> Column:
    """Which of the names of a page is taken first."""
    return F.when(F.rlike(name, F.lit("^page_[0-9]{4}\\.png$")), 0).when(F.startswith(name, F.lit("page_")), 1).otherwise(2)


def page_assets(assets: DataFrame, kind: str, most: int) -> DataFrame:
    """(doc_id, page, names): the first files of a kind for each page."""
    of_page = Window.partitionBy("doc_id", "page").orderBy(_pattern(F.col("name")) if kind == "page" else F.lit(0), "name")
    rows = assets.where((F.col("kind") == kind) & F.col("page").isNotNull()).withColumn("k", F.row_number().over(of_page)).where(F.col("k") <= most)
    return rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("k", "name"))).alias("s")).select("doc_id", "page", F.transform("s", lambda x: x["name"]).alias("names"))


def with_assets(reads: DataFrame, assets: DataFrame) -> DataFrame:
    """reads (id, doc_id, page_idxs, image_urls, text, ...) with image_paths (of the first images, those that exist),
    page_image_paths (one for each of the first pages), crop_paths (the first of each of these pages) and
    has_table. An item's lists are looked up by equi-joins on document and page or name, and put in order again."""
    first_pages = reads.select("id", "doc_id", F.posexplode(F.slice(F.filter("page_idxs", lambda p: p.isNotNull()), 1, PAGES)).alias("p", "page"))
    names = F.transform(F.slice("image_urls", 1, IMAGES), lambda u: F.substring_index(u, "/", -1))
    images = reads.select("id", "doc_id", F.posexplode(names).alias("p", "name")).join(assets.where("kind = 'image'").select("doc_id", "name").distinct(), ["doc_id", "name"])
    listed = images.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "name"))).alias("s")).select("id", F.transform("s", lambda x: x["name"]).alias("image_paths"))
    out = reads.join(listed, "id", "left")
    for column, kind, most in (("page_image_paths", "page", 1), ("crop_paths", "crop", CROPS_A_PAGE)):
        met = first_pages.join(page_assets(assets, kind, most), ["doc_id", "page"]).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "names"))).alias("s"))
        out = out.join(met.select("id", F.flatten(F.transform("s", lambda x: x["names"])).alias(column)), "id", "left")
    none = F.array().cast("array<string>")
    added = {c: F.coalesce(c, none) for c in ("image_paths", "page_image_paths", "crop_paths")}
    return out.withColumns(added | {"has_table": T.looks_like_table(F.col("text"))})


def chunk_assets(chunks: DataFrame, assets: DataFrame, most: int = CROPS_A_PAGE) -> DataFrame:
    """(chunk_id, page_images, crops) of chunks (chunk_id, doc_id, page_idx): the page's image and first crops."""
    out = chunks.select("chunk_id", "doc_id", F.col("page_idx").alias("page"))
    for column, kind, n in (("page_images", "page", 1), ("crops", "crop", most)):
        out = out.join(page_assets(assets, kind, n).withColumnRenamed("names", column), ["doc_id", "page"], "left")
    none = F.array().cast("array<string>")
    return out.select("chunk_id", F.coalesce("page_images", none).alias("page_images"), F.coalesce("crops", none).alias("crops"))


def multimodal_items(reads: DataFrame) -> DataFrame:
    """(items, multimodal): how many items (item, has_table, image_urls) have a read with a table or an image."""
    each = reads.groupBy("item").agg(F.max(F.coalesce("has_table", F.lit(False)) | (F.coalesce(F.size("image_urls"), F.lit(0)) > 0)).alias("rich"))
    return each.agg(F.count(F.lit(1)).alias("items"), F.count_if("rich").alias("multimodal"))


def accepted(attempts: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """(slot, attempt, reason) of each slot from its attempts (slot, attempt, reason, supported, unique, difficulty_ok):
    the first of the first `most` that no check rejects (reason is null) and the judge accepts in all three; where
    there is none, attempt is null and reason the last one's, judge_flags if it was the judge's."""
    judged = F.expr("coalesce(supported and unique and difficulty_ok, false)")
    rows = attempts.where(F.col("attempt") <= most).withColumn("why", F.coalesce("reason", F.when(~judged, "judge_flags")))
    told = rows.groupBy("slot").agg(F.min(F.when(F.col("why").isNull(), F.col("attempt"))).alias("attempt"), F.max_by("why", "attempt").alias("last"))
    return told.select("slot", "attempt", F.when(F.col("attempt").isNull(), F.col("last")).alias("reason"))


def next_keywords(attempts: DataFrame) -> DataFrame:
    """(slot, attempt, terms): what guides the try after one that the judge rejected, from its issues and question."""
    flagged = attempts.where(F.expr("reason is null and not coalesce(supported and unique and difficulty_ok, false)"))
    return flagged.select("slot", "attempt", T.text_keywords(F.concat_ws(" ", F.concat_ws(" ", "issues"), "question")).alias("terms"))


def top_counts(counts: DataFrame, key: str, most: int = MOST_COUNTS) -> DataFrame:
    """The largest counts (key, n), ties by key."""
    return counts.orderBy(F.desc("n"), key).limit(most)


def parse_counts(results: DataFrame) -> DataFrame:
    """(total, succeeded, failed) of a batch (status)."""
    good = F.coalesce(F.col("status") == "success", F.lit(False))
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"))


def newest(tasks: DataFrame) -> DataFrame:
    """Of each document's tasks (doc_id, name, ...) the one with the greatest name."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("name"))
    return tasks.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def plain_newlines(c: Column) -> Column:
    return F.replace(F.replace(T.text(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _store(spark, d):
    n = F.col("doc_id")
    path = lambda kind: F.concat(F.lit(f"{kind}/"), n.cast("string"))
    return views.table(spark, d, "documents").select(n.cast("string").alias("doc_id"), path("canonical").alias("canonical_path"), F.when(n % 5 != 0, path("index")).alias("index_path"), "lang")


def q_available(spark, d):
    paths = views.table(spark, d, "documents").where("doc_id % 3 <> 0").select(F.explode(F.array(F.concat(F.lit("canonical/"), "doc_id"), F.concat(F.lit("index/"), "doc_id"))).alias("path"))
    return available(_store(spark, d), paths).select("doc_id", "lang")


def q_used(spark, d):
    found = parse.sections(views.md_docs(spark, d)).where("idx % 3 = 1").select(F.col("section_id").alias("id"))
    return used_documents(found, _store(spark, d))


def q_section_info(spark, d):
    found = cut(parse.section_tree(parse.sections(views.md_docs(spark, d))))
    chunks = parse.markdown_chunks(found).withColumn("page_idx", F.floor(F.col("start_char") / 1500).cast("int"))
    told = section_info(found, chunks)
    return told.select("section_id", "level", "parent_id", F.array_join("chunk_ids", ",").alias("chunk_ids"), F.array_join("page_idxs", ",").alias("pages"))


def _assets(spark, d):
    """Images, pages and crops of each conversation, under names of every pattern."""
    n = F.col("conv_id")
    rows = views.table(spark, d, "conversations").select(n.cast("string").alias("doc_id"), n, F.floor(F.col("turn") / 2).cast("int").alias("p")).distinct()
    pad = lambda: F.lpad((F.col("p") + 1).cast("string"), 4, "0")
    page = F.when(n % 3 == 0, F.concat(F.lit("page_"), pad(), F.lit(".png"))).when(n % 3 == 1, F.concat(F.lit("page_"), (F.col("p") + 1).cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("p"), F.col("p").cast("string"), F.lit(".png")))
    crop = lambda i: F.concat(F.lit(f"crop_{i}_p"), pad(), F.lit(f"_{i}.png"))
    item = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    listed = F.array(item("page", page), item("crop", crop(2)), item("crop", crop(1)), item("crop", crop(3)), item("image", F.concat("doc_id", F.lit(".png"))))
    return rows.select("doc_id", F.explode(listed).alias("a")).select("doc_id", "a.*").withColumn("page", page_number(F.col("name"), F.col("kind"))).distinct()


def q_reads(spark, d):
    """The pages of each conversation as reads of two pages."""
    chunks = parse.page_chunks(views.items(spark, d))
    reads = chunks.select(F.col("chunk_id").alias("id"), "doc_id", F.array("page_idx", F.col("page_idx") + 1).alias("page_idxs"), "image_urls", "text")
    told = with_assets(cut(reads), cut(_assets(spark, d)))
    return told.select("id", *(F.array_join(c, ",").alias(c) for c in ("image_paths", "page_image_paths", "crop_paths")), "has_table")


def q_chunk_assets(spark, d):
    told = chunk_assets(parse.page_chunks(views.items(spark, d)), cut(_assets(spark, d)))
    return told.select("chunk_id", F.array_join("page_images", ",").alias("page_images"), F.array_join("crops", ",").alias("crops"))


def q_multimodal(spark, d):
    pages = parse.page_chunks(views.items(spark, d)).where("page_idx % 2 = 0")
    return multimodal_items(pages.select(F.col("doc_id").alias("item"), F.lit(False).alias("has_table"), "image_urls"))


def _attempts(spark, d):
    n = F.col("turn")
    return views.table(spark, d, "conversations").select(
        F.col("conv_id").alias("slot"), (n + 1).alias("attempt"), F.when(n % 3 == 0, "too_long").alias("reason"), ((n + F.col("conv_id")) % 2 == 0).alias("supported"), F.lit(True).alias("unique"),
        (F.col("conv_id") % 7 != 0).alias("difficulty_ok"), F.array(F.lit("Unclear scope")).alias("issues"), F.lit("Which plan has a waiting period?").alias("question"),
    )


def q_accepted(spark, d):
    return accepted(_attempts(spark, d))


def q_next_keywords(spark, d):
    return next_keywords(_attempts(spark, d)).select("slot", "attempt", F.array_join("terms", "|").alias("terms"))


def q_top_counts(spark, d):
    counts = parse.sections(views.md_docs(spark, d)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return top_counts(counts, "doc_id")


def q_parse_counts(spark, d):
    return parse_counts(views.table(spark, d, "documents").select(F.when(F.col("doc_id") % 6 == 0, "failed").when(F.col("doc_id") % 11 != 0, "success").alias("status")))


def q_newest(spark, d):
    return newest(views.table(spark, d, "events").select((F.col("event_id") % 97).alias("doc_id"), F.concat(F.lit("task-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("name")))


_PAD = "lpad((p + 1)::varchar, 4, '0')"
_ASSETS = f"""asset_pages as (select distinct conv_id::varchar as doc_id, conv_id, (turn // 2)::int as p from conversations),
page_files as (select doc_id, p, case conv_id % 3 when 0 then 'page_' || {_PAD} || '.png' when 1 then 'page_' || (p + 1) || '.png' else 'p' || p || '.png' end as name from asset_pages),
crop_files as (select doc_id, p, 'crop_1_p' || {_PAD} || '_1.png,crop_2_p' || {_PAD} || '_2.png' as names from asset_pages)"""
_PAGES = parse.ORACLES["page_chunks"].rpartition("select doc_id || '_p'")[0].removeprefix("with ").rstrip()
_ATTEMPTS = "a as (select conv_id as slot, turn + 1 as attempt, turn % 3 = 0 as bad, (turn + conv_id) % 2 = 0 and conv_id % 7 <> 0 as ok from conversations)"

QUERIES = {
    "available_docs": q_available, "used_documents": q_used, "section_info": q_section_info, "multi_doc_read": q_reads, "chunk_assets": q_chunk_assets, "multimodal_items": q_multimodal,
    "accepted_items": q_accepted, "next_keywords": q_next_keywords, "top_counts": q_top_counts, "parse_counts": q_parse_counts, "newest_tasks": q_newest,
}
ORACLES = {
    "available_docs": "select doc_id::varchar as doc_id, lang from documents where doc_id % 5 <> 0 and doc_id % 3 <> 0",
    "used_documents": f"with {parse.SECTIONS} select doc_id, count(*) as n from sections where idx % 3 = 1 group by doc_id",
    "section_info": f"""with {search.CHUNKS},
held as (select section_id, string_agg(chunk_id, ',' order by start_char, chunk_id) as chunk_ids from chunks group by section_id),
pages as (select section_id, string_agg(p::varchar, ',' order by p) as pages from (select distinct section_id, start_char // 1500 as p from chunks) group by section_id)
select x.doc_id || '_sec' || x.idx as section_id, x.level::int as level,
  case when x.level > 0 then x.doc_id || '_sec' || (select max(y.idx) from sections y where y.doc_id = x.doc_id and y.idx < x.idx and y.level > 0 and y.level < x.level) end as parent_id,
  coalesce(h.chunk_ids, '') as chunk_ids, coalesce(p.pages, '') as pages
from sections x left join held h on h.section_id = x.doc_id || '_sec' || x.idx left join pages p on p.section_id = x.doc_id || '_sec' || x.idx""",
    "multi_doc_read": f"""with {_PAGES}, {_ASSETS},
r as (select doc_id, page_idx, images, text from o)
select r.doc_id || '_p' || r.page_idx as id, case when r.images <> '' then r.doc_id || '.png' else '' end as image_paths,
  concat_ws(',', a.name, b.name) as page_image_paths, concat_ws(',', c.names, e.names) as crop_paths,
  len(list_filter(string_split(r.text, chr(10)), lambda x: trim(x) <> '')) >= 2 and len(list_filter(list_filter(string_split(r.text, chr(10)), lambda x: trim(x) <> '')[1:8], lambda x: contains(x, '|'))) > 0
    and len(list_filter(list_filter(string_split(r.text, chr(10)), lambda x: trim(x) <> '')[1:8], lambda x: regexp_matches(x, '^[|]?[ \\t]*-{{3,}}'))) > 0 as has_table
from r left join page_files a on a.doc_id = r.doc_id and a.p = r.page_idx left join page_files b on b.doc_id = r.doc_id and b.p = r.page_idx + 1
left join crop_files c on c.doc_id = r.doc_id and c.p = r.page_idx left join crop_files e on e.doc_id = r.doc_id and e.p = r.page_idx + 1""",
    "chunk_assets": f"""with {_PAGES}, {_ASSETS}
select o.doc_id || '_p' || page_idx as chunk_id, coalesce(a.name, '') as page_images, coalesce(c.names, '') as crops
from o left join page_files a on a.doc_id = o.doc_id and a.p = page_idx left join crop_files c on c.doc_id = o.doc_id and c.p = page_idx""",
    "multimodal_items": f"with {_PAGES} select count(*) as items, count(*) filter (rich) as multimodal from (select doc_id, bool_or(images <> '') as rich from o where page_idx % 2 = 0 group by doc_id)",
    "accepted_items": f"""with {_ATTEMPTS}, w as (select *, case when bad then 'too_long' when not ok then 'judge_flags' end as why from a where attempt <= {ATTEMPTS}),
g as (select slot, min(attempt) filter (why is null) as attempt, arg_max(coalesce(why, ''), attempt) as last from w group by slot)
select slot, attempt, case when attempt is null then last end as reason from g""",
    "next_keywords": f"with {_ATTEMPTS} select slot, attempt, 'Unclear|scope|Which|plan|has|waiting|period' as terms from a where not bad and not ok",
    "top_counts": f"with {parse.SECTIONS} select doc_id, count(*) as n from sections group by doc_id order by n desc, doc_id limit {MOST_COUNTS}",
    "parse_counts": "select count(*) as total, count(*) filter (doc_id % 6 <> 0 and doc_id % 11 <> 0) as succeeded, count(*) filter (doc_id % 6 = 0 or doc_id % 11 = 0) as failed from documents",
    "newest_tasks": "select event_id % 97 as doc_id, max('task-' || lpad(event_id::varchar, 9, '0')) as name from events group by 1",
}
