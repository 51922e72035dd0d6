"""Reading parsed documents and line-delimited JSON; writing tables and JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T

ITEM = "struct<type:string,page_idx:string,text:string,image_caption:string,caption:string,img_path:string,image_path:string>"


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(doc_id, path, content, length) of the files below a path; doc_id is from the bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(T.short_hash(F.col("content")).alias("doc_id"), "path", "content", "length")


def read_texts(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(path, md): whole files as UTF-8; bytes that aren't are dropped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit("")).alias("md"))


def parse_json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Rows (file, ord, value) to (file, ord, row): lines that aren't JSON objects are left out."""
    held = lines.where(T.strip(T.text(F.col("value"))) != "").withColumn("v", F.try_parse_json("value"))
    objects = held.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    return objects.select("file", "ord", F.from_json(F.to_json("v"), schema).alias("row"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, ord, row) of line-delimited JSON; ord follows the lines of a file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord"), "value")
    return parse_json_lines(lines, schema)


def read_items(documents: DataFrame) -> DataFrame:
    """(doc_id, ord, type, page_idx, text, image_caption, img_path) from rows (doc_id, content_list): a JSON array
    of items, or of pages that are arrays of items. What isn't an object is dropped, captions that aren't
    strings are ignored, and items without a whole page number are kept with a null page."""
    parsed = documents.select("doc_id", F.try_parse_json("content_list").alias("v"))
    nested = F.startswith(F.schema_of_variant(F.try_variant_get("v", "$[0]", "variant")), F.lit("ARRAY"))
    flat = F.when(nested, F.flatten(F.try_variant_get("v", "$", "array<array<variant>>"))).otherwise(F.try_variant_get("v", "$", "array<variant>"))
    rows = parsed.select("doc_id", F.posexplode(flat).alias("ord", "i")).where(F.startswith(F.schema_of_variant("i"), F.lit("OBJECT")))
    string = lambda p: F.when(F.schema_of_variant(F.try_variant_get("i", p, "variant")) == "STRING", F.try_variant_get("i", p, "string"))
    some = lambda *ps: F.coalesce(*(F.nullif(string(p), F.lit("")) for p in ps))
    return rows.select(
        "doc_id", "ord", F.coalesce(string("$.type"), F.lit("")).alias("type"), F.try_variant_get("i", "$.page_idx", "int").alias("page_idx"), string("$.text").alias("text"),
        some("$.image_caption", "$.caption").alias("image_caption"), some("$.img_path", "$.image_path").alias("img_path"),
    )


def with_default_section(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, md, sections): documents stored without sections get one over the whole text."""
    kind = documents.schema["sections"].dataType.simpleString()
    whole = F.array(F.struct(F.concat("doc_id", F.lit("_sec0")).alias("section_id"), F.lit("").alias("title"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).cast("long").alias("start_char"), F.length(T.text(F.col("md"))).cast("long").alias("end_char")))
    return documents.withColumn("sections", F.when(F.size(F.coalesce("sections", F.array().cast(kind))) == 0, whole.cast(kind)).otherwise(F.col("sections")))


def merged(existing: DataFrame, changes: DataFrame, key: str = "doc_id", order: str = "updated_at") -> DataFrame:
    """One row a key: the latest of existing and changed rows, to write as the store's next snapshot."""
    rows = existing.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("__new"), F.desc(order)))
    return rows.withColumn("__n", last).where("__n = 1").drop("__n", "__new")


def write_json_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def write_json_array(rows: DataFrame, path: str) -> int:
    """Streams rows into one JSON array in a file of the driver, a partition at a time."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for row in rows.toLocalIterator():
            out.write((",\n" if n else "\n") + json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
            n += 1
        out.write("\n]\n")
    return n
