"""Benchmark decontamination with a distributed positional inverted index (DataFrame functions only).

Each document is read once into the index: a row of its term hashes, a term's place in it being its position.
The terms of the benchmark are counted over the whole index. Of every window of `window` benchmark words the
`rarest` least frequent terms are taken as its anchors; a window with a term that no document holds cannot
occur. Of the index, the postings (term, document, position) of anchor terms are listed. Shifting a posting by
the anchor's offset in its item gives the place where the item would have to start; places that collect as
many anchors as one window has are where the shifted lists intersect. The documents that hold such places are
read again, and verified word by word, which gives exact phrase matches.

Postings of frequent words are never listed unless a window has nothing rarer, hits are combined before the
shuffle, and a table on benchmark terms is broadcast only after it was counted (`held` rows at most; beyond,
joins shuffle). Each place is verified as a row of its own, so a document with many places needs no large row.
`proximity()` answers the other query of the index: documents that hold all terms of a phrase within a given
span.

Defined results: null text has no words and matches nothing; items without words match nothing; an item
shorter than the window is one window; texts are processed whole, however long; repeated rows give repeated
results; rows with a null id are rows like others; items of one id count once; null item ids name no item, but
their windows count; empty tables give no rows, or no hits; other columns pass through, except that columns
named n_words, n_hit, hits, items and contaminated are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import cut, fresh, let, only, passing, small, table, words

WINDOW = 10
RAREST = 3
#: Rows of a table on benchmark terms up to which it is broadcast (some 50 MB); beyond, joins shuffle.
HELD = 1_000_000


def _held(df: DataFrame, held: int) -> DataFrame:
    return F.broadcast(df) if small(df, held) else df


def _key() -> Column:
    """Equal rows share a key. That different ones may do no harm: places are verified row by row."""
    return F.xxhash64("doc_id", "text")


def units(benchmark: DataFrame) -> DataFrame:
    """One row for each different word sequence of the benchmark: unit, items, w (its words)."""
    split = only(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    return split.where(F.size("w") > 0).groupBy("w").agg(F.collect_set("item_id").alias("items")).withColumn("unit", F.xxhash64("w"))


def index(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, terms): the hashes of a document's terms in order."""
    read = let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.transform(w, lambda x: F.hash(x)).alias("terms")))
    return only(docs, "doc_id", "text").select("doc_id", _key().alias("key"), read.alias("r")).select("doc_id", "key", "r.n_words", "r.terms")


def anchors(unit: DataFrame, tf: DataFrame, window: int, rarest: int) -> DataFrame:
    """(term, unit, offset, need): the rarest terms of each window that can occur."""
    spread = unit.select("unit", F.posexplode("w").alias("offset", "word")).select("unit", "offset", F.hash("word").alias("term")).join(tf, "term", "left")
    rows = spread.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("offset", F.coalesce("tf", F.lit(0)).alias("tf"), "term"))).alias("t"))
    length = F.least(F.lit(window), F.size("t"))
    picked = F.transform(
        F.sequence(F.lit(0), F.size("t") - length),
        lambda s: F.array_sort(F.transform(F.slice("t", s + 1, length), lambda x: F.struct(x["tf"].alias("tf"), x["offset"].alias("offset"), x["term"].alias("term")))),
    )
    live = F.filter(picked, lambda a: F.get(a, F.lit(0))["tf"] > 0)
    chosen = F.array_distinct(F.flatten(F.transform(live, lambda a: F.slice(a, 1, rarest))))
    return rows.select("unit", F.least(F.lit(rarest), length).alias("need"), F.explode(chosen).alias("a")).select("a.term", "unit", "a.offset", "need")


def candidates(indexed: DataFrame, unit: DataFrame, window: int, rarest: int, held: int) -> DataFrame:
    """(key, unit, shift): places where as many anchors meet as one window has."""
    vocabulary = unit.select(F.explode("w").alias("word")).select(F.hash("word").alias("term")).distinct()
    met = indexed.select(F.explode("terms").alias("term")).join(_held(vocabulary, held), "term")
    tf = cut(met.groupBy("term").agg(F.count(F.lit(1)).alias("tf")))
    anchor = cut(anchors(unit, tf, window, rarest))
    hits = indexed.select("key", F.posexplode("terms").alias("pos", "term")).join(_held(anchor, held), "term")
    places = hits.groupBy("key", "unit", (F.col("pos") - F.col("offset")).alias("shift")).agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need"))
    return places.where("n >= need").select("key", "unit", "shift")


def _starts(part: Column, item: Column, shift: Column, low: Column, window: int) -> Column:
    """Document positions where windows of an item occur; part holds the document's words from `low` on, the
    item's first word would stand at `shift`."""
    length = F.least(F.lit(window), F.size(item))
    first, last = low - shift, F.least(F.size(item) - length, F.size(part) + low - shift - length)
    inside = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    same = lambda s: F.slice(part, s - first + 1, length) == F.slice(item, s + 1, length)
    return F.transform(F.filter(inside, same), lambda s: shift + s)


def verified(docs: DataFrame, found: DataFrame, unit: DataFrame, window: int, held: int) -> DataFrame:
    """(key, hits, items) of the documents that hold a window: the positions of its words, in order, and the ids
    of the items, sorted as strings."""
    keyed = only(docs, "doc_id", "text").withColumn("key", _key())
    read = keyed.join(_held(found.select("key").distinct(), held), "key", "left_semi").dropDuplicates(["key"]).select("key", words(F.col("text")).alias("w"))
    place = read.join(found, "key").join(_held(unit.withColumnRenamed("w", "item"), held), "unit")
    low = F.greatest(F.lit(0), F.col("shift"))
    place = place.select("key", "items", "item", "shift", low.alias("low"), F.slice("w", low + 1, F.size("item")).alias("part"))
    starts = _starts(F.col("part"), F.col("item"), F.col("shift"), F.col("low"), window)
    place = place.select("key", "items", F.least(F.lit(window), F.size("item")).alias("length"), starts.alias("starts")).where(F.size("starts") > 0)
    within = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("length") - 1)))
    hits = place.select("key", F.explode(F.array_distinct(within)).alias("pos")).distinct().groupBy("key").agg(F.array_sort(F.collect_list("pos")).alias("hits"))
    items = place.select("key", F.explode_outer("items").alias("item")).distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return hits.join(items, "key")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_words) of every row, and what verified() found; both are written tables."""
    with passing(docs.sparkSession) as keep:
        unit = cut(units(benchmark))
        indexed = cut(index(docs))
        found = cut(candidates(indexed, unit, window, rarest, held))
        return keep(indexed.select("doc_id", "key", "n_words")), keep(verified(docs, found, unit, window, held))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, held: int = HELD) -> DataFrame:
    """Every row of docs with n_words, n_hit, hits (positions of words inside a benchmark window), items
    (ids of items with occurring windows, sorted as strings) and contaminated."""
    sizes, told = contamination(docs, benchmark, window, rarest, held)
    docs = docs.drop("n_words", "n_hit", "hits", "items", "contaminated")
    key = fresh(docs, "key")
    found = sizes.select("key", "n_words").dropDuplicates(["key"]).join(told, "key", "left").withColumnRenamed("key", key)
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>"))
    joined = docs.withColumn(key, _key()).join(found, key)
    return joined.select(
        *(F.col(f"`{c}`") for c in docs.columns), "n_words", F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        none(F.col("hits"), "int").alias("hits"), none(F.col("items"), "string").alias("items"), F.col("hits").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, held: int = HELD) -> DataFrame:
    """The rows of docs that hold no window of the benchmark, with their own columns."""
    _, told = contamination(docs, benchmark, window, rarest, held)
    key = fresh(docs, "key")
    return docs.withColumn(key, _key()).join(_held(told.select(F.col("key").alias(key)), held), key, "left_anti").drop(key)


def proximity(docs: DataFrame, phrase: str, span: int) -> DataFrame:
    """(doc_id, start): the document positions from which on all different terms of the phrase occur within
    `span` words. It lists the postings of the phrase's terms alone; each end of a span is met once, with the
    latest place of every term before it."""
    terms = [r.term for r in docs.sparkSession.range(1).select(F.explode(F.array_distinct(words(F.lit(phrase)))).alias("term")).collect()]
    listed = only(docs, "doc_id", "text").withColumn("key", _key()).select("doc_id", "key", F.posexplode(words(F.col("text"))).alias("pos", "term")).where(F.col("term").isin(terms))
    onward = Window.partitionBy("key", "doc_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.greatest(F.lit(-1), F.lit(-1), *(F.min(F.when(F.col("term") == t, F.col("pos"))).over(onward) for t in terms))
    every = F.lit(True)
    for t in terms:
        every = every & F.min(F.when(F.col("term") == t, F.col("pos"))).over(onward).isNotNull()
    return listed.withColumn("last", F.when(every, last)).where(F.col("last") < F.col("pos") + span).select("doc_id", F.col("pos").alias("start"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, told = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return sizes.join(told, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id::varchar as item_id, {_WORDS} as w from benchmark),
iw as (
  select distinct item_id, least({WINDOW}, len(w)) as n, array_to_string(w[s + 1 : s + least({WINDOW}, len(w))], ' ') as win
  from (select *, unnest(range(len(w) - least({WINDOW}, len(w)) + 1)) as s from i where len(w) > 0)),
sizes as (select distinct n from iw),
dw as (
  select doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') as win
  from (select d.doc_id, d.w, n, unnest(range(greatest(len(w) - n + 1, 0))) as s from d, sizes)),
occ as (select doc_id, s, dw.n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from occ) group by doc_id),
its as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id from occ) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join its using (doc_id)
"""
