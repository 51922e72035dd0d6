"""Captions, image references, context windows and page crops of parsed documents; scalar functions in use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import views
from docquarry.sources import files

CROP_PAD, CROP_LEAST = 6, 10


def caption_map(items: DataFrame) -> DataFrame:
    """(doc_id, key, caption): the last caption under an image's path, file name and images/ name."""
    named = items.where((F.col("type") == "image") & (T.strip(T.text(F.col("image_caption"))) != "") & (T.text(F.col("img_path")) != ""))
    base = F.substring_index("img_path", "/", -1)
    rows = named.select("doc_id", "ord", T.strip(F.col("image_caption")).alias("caption"), F.explode(F.array_distinct(F.array("img_path", base, F.concat(F.lit("images/"), base)))).alias("key"))
    return rows.groupBy("doc_id", "key").agg(F.max_by("caption", "ord").alias("caption"))


def merge_captions(newer: DataFrame, older: DataFrame) -> DataFrame:
    """(doc_id, key, caption) of both maps; the newer one wins."""
    joined = newer.withColumnRenamed("caption", "n").join(older.withColumnRenamed("caption", "o"), ["doc_id", "key"], "full")
    return joined.select("doc_id", "key", F.coalesce("n", "o").alias("caption"))


def image_anchors(items: DataFrame) -> DataFrame:
    """(doc_id, ord, before, after): for each image the nearest text before and after it."""
    order = Window.partitionBy("doc_id").orderBy("ord")
    said = F.when((F.col("type") == "text") & (T.strip(T.text(F.col("text"))) != ""), T.strip(F.col("text")))
    near = items.select(
        "doc_id", "ord", "type", F.last(said, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first(said, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
    )
    return near.where("type = 'image'").drop("type")


def token_window(text: Column, at: int, width: int) -> Column:
    """The tokens around a character position: up to `width` before it and after it, joined by spaces."""
    n = F.size(T.context_tokens(F.substring(text, 1, at)))
    start = F.greatest(n - width, F.lit(0))
    return F.array_join(F.slice(T.context_tokens(text), start + 1, n - start + width), " ")


def crop_boxes(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """(page_idx, ord, left, top, right, bottom, name) in pixels for blocks (page_idx, ord, type, x0, y0, x1, y1), given
    page sizes (page_idx, width, height): the page's extent is that of its blocks; boxes are padded, kept on
    the page, dropped below 10 pixels, and named by a counter for each page and type."""
    page = Window.partitionBy("page_idx")
    rows = blocks.join(sizes, "page_idx").withColumns({"sx": F.col("width") / F.max("x1").over(page), "sy": F.col("height") / F.max("y1").over(page)})
    low = lambda c, s: F.greatest(F.lit(0), F.floor(F.col(c) * F.col(s)).cast("int") - CROP_PAD)
    high = lambda c, s, most: F.least(F.col(most), F.floor(F.col(c) * F.col(s)).cast("int") + CROP_PAD)
    boxed = rows.select("page_idx", "ord", "type", low("x0", "sx").alias("left"), low("y0", "sy").alias("top"), high("x1", "sx", "width").alias("right"), high("y1", "sy", "height").alias("bottom"))
    kept = boxed.where((F.col("right") - F.col("left") >= CROP_LEAST) & (F.col("bottom") - F.col("top") >= CROP_LEAST))
    number = F.row_number().over(Window.partitionBy("page_idx", "type").orderBy("ord"))
    return kept.select("page_idx", "ord", "left", "top", "right", "bottom", F.concat_ws("_", F.concat(F.lit("page"), F.lpad(F.col("page_idx").cast("string"), 4, "0")), "type", F.lpad(number.cast("string"), 3, "0")).alias("name"))


def _documents(spark, d):
    return views.table(spark, d, "documents")


def q_identity(spark, d):
    return _documents(spark, d).select("doc_id", T.short_hash(F.col("text").cast("binary")).alias("id"))


def q_scalars(spark, d):
    x = F.col("text")
    return _documents(spark, d).select(
        "doc_id", F.md5(T.identifier(x)).alias("identifier_md5"), F.substring(T.safe_name(x), 1, 60).alias("safe"), T.one_line(x, 100).alias("excerpt"),
        T.file_title(F.concat("source", F.lit(".v1.pdf"))).alias("title"), T.mime_type(F.concat("source", F.lit(".JPG"))).alias("mime"),
        T.relative_path(F.concat(F.lit("https://h.example/../a/"), "source", F.lit("?q=1#f"))).alias("path"), F.md5(T.alt_text(x)).alias("alt_md5"),
    )


def q_captions(spark, d):
    x = F.element_at(F.split("text", "\n"), 1)
    plain = F.when(F.col("doc_id") % 5 == 0, "An image").when(F.col("doc_id") % 7 == 0, F.concat(x, F.lit(" a.png"))).otherwise(x)
    return _documents(spark, d).select("doc_id", T.meaningful_caption(plain, F.lit("fig1.png"), "en").alias("ok"))


def q_window(spark, d):
    return _documents(spark, d).select("doc_id", token_window(F.col("text"), 200, 6).alias("window"))


def q_crops(spark, d):
    n = F.col("doc_id")
    blocks = _documents(spark, d).select((n % 50).alias("page_idx"), n.alias("ord"), F.when(n % 2 == 0, "image").otherwise("table").alias("type"), (n % 13).cast("double").alias("x0"), (n % 17).cast("double").alias("y0"), (n % 13 + n % 29).cast("double").alias("x1"), (n % 17 + n % 31).cast("double").alias("y1"))
    sizes = spark.range(50).select(F.col("id").alias("page_idx"), F.lit(800).alias("width"), F.lit(1000).alias("height"))
    return crop_boxes(blocks, sizes)


def q_lines(spark, d):
    """The events' JSON properties as a scan that skips what isn't an object."""
    n = F.col("event_id")
    value = F.when(n % 10 == 0, "not json").when(n % 10 == 1, "[1]").when(n % 10 == 2, " ").otherwise(F.col("props"))
    lines = views.table(spark, d, "events").select(F.lit("f").alias("file"), n.alias("ord"), value.alias("value"))
    return files.parse_json_lines(lines, "k long").select("ord", "row.k")


def q_anchors(spark, d):
    return image_anchors(views.items(spark, d)).select("doc_id", "ord", F.md5("before").alias("before_md5"), F.md5("after").alias("after_md5"))


_FLAT = "regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '^ | $', '', 'g')"
_SAFE = "regexp_replace(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g')"
_CTX = "'[A-Za-z0-9_一-鿿]+|[^A-Za-z0-9_一-鿿\\s]'"
QUERIES = {"doc_identity": q_identity, "scalars": q_scalars, "caption_ok": q_captions, "token_window": q_window, "crop_boxes": q_crops, "jsonl_scan": q_lines, "image_anchors": q_anchors}
ORACLES = {
    "doc_identity": "select doc_id, substr(sha256(text), 1, 16) as id from documents",
    "scalars": f"""select doc_id, md5(regexp_replace(lower(text), '[^0-9A-Za-z一-鿿]+', '', 'g')) as identifier_md5, substr(case when {_SAFE} = '' then 'dataset' else {_SAFE} end, 1, 60) as safe,
  case when length({_FLAT}) <= 100 then {_FLAT} else rtrim(substr({_FLAT}, 1, 99)) || '…' end as excerpt, source || '.v1' as title, 'image/jpeg' as mime, 'a/' || source as path,
  md5(substr(regexp_replace({_FLAT}, '[\\[\\]]', '', 'g'), 1, 220)) as alt_md5 from documents""",
    "caption_ok": """with c as (select doc_id, case when doc_id % 5 = 0 then 'An image' when doc_id % 7 = 0 then string_split(text, chr(10))[1] || ' a.png' else string_split(text, chr(10))[1] end as t from documents)
select doc_id, trim(t) <> '' and not regexp_matches(lower(t), '^(an?|the)\\s+(image|figure|diagram|chart|photo|screenshot|illustration|table|formula|equation)$') and not regexp_matches(lower(t), '\\.(png|jpe?g|webp|gif|bmp|tiff?)\\b')
  and not regexp_matches(lower(t), '\\b[0-9a-f]{24,}\\b') and not regexp_matches(t, '^[0-9a-fA-F]{16,}$') and length(regexp_replace(lower(t), '[^a-z]', '', 'g')) >= 3 as ok from c""",
    "token_window": f"""with n as (select doc_id, regexp_extract_all(text, {_CTX}) as t, len(regexp_extract_all(substr(text, 1, 200), {_CTX})) as n from documents)
select doc_id, array_to_string(t[greatest(n - 6, 0) + 1 : n + 6], ' ') as window from n""",
    "crop_boxes": f"""with b as (select doc_id % 50 as page_idx, doc_id as ord, case when doc_id % 2 = 0 then 'image' else 'table' end as type, (doc_id % 13)::double as x0, (doc_id % 17)::double as y0, (doc_id % 13 + doc_id % 29)::double as x1, (doc_id % 17 + doc_id % 31)::double as y1 from documents),
s as (select *, 800 / max(x1) over (partition by page_idx) as sx, 1000 / max(y1) over (partition by page_idx) as sy from b),
p as (select page_idx, ord, type, greatest(0, floor(x0 * sx)::int - {CROP_PAD}) as "left", greatest(0, floor(y0 * sy)::int - {CROP_PAD}) as top, least(800, floor(x1 * sx)::int + {CROP_PAD}) as "right", least(1000, floor(y1 * sy)::int + {CROP_PAD}) as bottom from s)
select page_idx, ord, "left", top, "right", bottom, 'page' || lpad(page_idx::varchar, 4, '0') || '_' || type || '_' || lpad((row_number() over (partition by page_idx, type order by ord))::varchar, 3, '0') as name
from p where "right" - "left" >= {CROP_LEAST} and bottom - top >= {CROP_LEAST}""",
    "jsonl_scan": "select event_id as ord, (props->>'$.k')::bigint as k from events where event_id % 10 > 2",
    "image_anchors": f"""with {views.ITEMS}, w as (
  select doc_id, ord, type, last_value(case when type = 'text' then trim(text) end ignore nulls) over (partition by doc_id order by ord rows between unbounded preceding and 1 preceding) as b,
    first_value(case when type = 'text' then trim(text) end ignore nulls) over (partition by doc_id order by ord rows between 1 following and unbounded following) as a from items)
select doc_id, ord, md5(b) as before_md5, md5(a) as after_md5 from w where type = 'image'""",
}
