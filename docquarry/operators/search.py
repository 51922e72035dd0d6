"""Full-text index, ranked and plain search, and section reading over chunks.

Each document is an index of its own: frequencies and lengths are those of its chunks. Scores are BM25, negative,
so that lower is better. A term with a space is a phrase. The index is written once: the words of each chunk as
one text, and their number. A search brings the terms asked of a document to its chunks, where words and phrases
are counted in their rows, so that no word becomes a row of its own.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, lower-cased. Accents aren't folded,
and punctuation beyond ASCII belongs to its word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import parse, views
from docquarry.plans.lineage import cut

K1, B = 1.2, 0.75
MOST_TERMS = 12
CHUNKS_A_SECTION = 8
#: Between words. Java takes eight times as long to find words by the negated class.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"


def tokens(c: Column) -> Column:
    """The words of a text, lower-cased, in order."""
    return F.array_remove(F.split(F.lower(c), BETWEEN + "+"), "")


def index_tokens(chunks: DataFrame) -> DataFrame:
    """Adds tokens of the searchable fields: ids, title and text."""
    fields = F.concat_ws(" ", "chunk_id", "section_id", "section_title", "text")
    return chunks.withColumn("tokens", tokens(fields))


def postings(tokenised: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, term, positions) of index_tokens() rows, one a chunk. A chunk's tokens are sorted in its
    row, where each run of a term is its postings: nothing shuffles."""
    entries = F.sort_array(F.transform("tokens", lambda t, i: F.struct(t.alias("term"), i.alias("pos"))))

    def starts(es: Column) -> Column:
        return F.array_compact(F.transform(es, lambda e, i: F.when((i == 0) | (e["term"] != F.get(es, i - 1)["term"]), i)))

    def listed(es: Column, at: Column) -> Column:
        run = lambda i, k: F.slice(es, i + 1, F.coalesce(F.get(at, k + 1), F.size(es)) - i)
        return F.transform(at, lambda i, k: F.struct(F.get(es, i)["term"].alias("term"), F.transform(run(i, k), lambda e: e["pos"]).alias("positions")))

    rows = tokenised.select("doc_id", "chunk_id", F.explode(T.let(entries, lambda es: T.let(starts(es), lambda at: listed(es, at)))).alias("x"))
    return rows.select("doc_id", "chunk_id", "x.term", "x.positions")


@dataclass
class Index:
    """chunks: (doc_id, chunk_id, section_id, len, words), words as by spaced(); stats: (doc_id, n, mean), chunks of
    a document and their mean length."""

    chunks: DataFrame
    stats: DataFrame


def spaced(words: Column) -> Column:
    """Words as one text, each between two spaces of its own."""
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def build(chunks: DataFrame) -> Index:
    """The index of chunks, written as tables. Words stay in their chunk's row, in order: that is the list of
    postings of a chunk, and what isn't asked for goes no further than where it is read. As one text they take
    less room in a shuffle than as an array."""
    held = cut(index_tokens(chunks).select("doc_id", "chunk_id", "section_id", F.size("tokens").alias("len"), spaced(F.col("tokens")).alias("words")))
    return Index(held, cut(held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("mean"))))


def query_terms(terms: Column) -> Column:
    """Token sequences of the first terms that aren't blank."""
    kept = F.slice(F.filter(F.transform(terms, T.strip), lambda t: t != ""), 1, MOST_TERMS)
    return F.filter(F.transform(kept, tokens), lambda t: F.size(t) > 0)


def frequency(words: Column, sequence: Column, text: Column) -> Column:
    """Places of a sequence, of which text is spaced(), in spaced words. One that repeats a word may overlap itself,
    so every place is tried. Words hold no ASCII but letters and digits, so a text is a pattern of itself; patterns
    skip ahead, where replace() compares at every byte."""
    plain = F.regexp_count(words, text)
    starts = lambda ws: F.size(F.filter(ws, lambda w, i: (w == F.get(sequence, F.lit(0))) & (F.slice(ws, i + 1, F.size(sequence)) == sequence)))
    return F.when(F.size(F.array_distinct(sequence)) == F.size(sequence), plain).otherwise(T.let(F.split(F.trim(words), "  "), starts))


def ranked(asked: DataFrame, index: Index) -> DataFrame:
    """(query, doc_id, chunk_id, section_id, score) for rows (query, doc_id, terms) against their documents."""
    terms = asked.select("query", "doc_id", F.posexplode(query_terms(F.col("terms"))).alias("j", "sequence"))
    words = terms.select("query", "doc_id", "j", F.size("sequence").alias("need"), F.posexplode("sequence").alias("at", "term"))
    # the sequences asked of a document travel to its chunks, each once, and are counted in a chunk's row
    by = terms.groupBy("doc_id", "sequence").agg(F.collect_list(F.struct("query", "j")).alias("by"))
    asks = by.groupBy("doc_id").agg(F.collect_list(F.struct("sequence", spaced(F.col("sequence")).alias("text"), "by")).alias("asks"))
    told = F.transform("asks", lambda a: F.struct(frequency(F.col("words"), a["sequence"], a["text"]).alias("tf"), a["by"].alias("by")))
    met = index.chunks.join(asks, "doc_id").select("doc_id", "chunk_id", "section_id", "len", F.explode(F.filter(told, lambda x: x["tf"] > 0)).alias("x"))
    counts = met.select("doc_id", "chunk_id", "section_id", "len", "x.tf", F.inline("x.by"))
    hits = counts.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("query", "doc_id", "j"))).join(index.stats, "doc_id")
    idf = F.greatest(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    return hits.groupBy("query", "doc_id", "chunk_id", "section_id").agg((-F.sum(part)).alias("score"))


def top(found: DataFrame, limit: int, each: bool = False) -> DataFrame:
    """The best hits of each query, and of each document of it if `each`."""
    keys = ("query", "doc_id") if each else ("query",)
    order = Window.partitionBy(*keys).orderBy("score", "chunk_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def search_documents(asked: DataFrame, index: Index, limit: int) -> DataFrame:
    """Over several documents: the best max(3, limit) of each, then the best `limit` of those."""
    return top(top(ranked(asked, index), max(3, limit), each=True).drop("rank"), limit)


def plain_search(chunks: DataFrame, terms: list[str], limit: int) -> DataFrame:
    """Without ranking: chunks whose text contains the terms, joined by spaces, case ignored; score 0, and
    the text around the first place as snippet. % and _ are wildcards."""
    q = " ".join(t.strip() for t in terms if t.strip())
    at = F.position(F.lit(q.lower()), F.lower("text"))
    around = F.substr(F.col("text"), F.greatest(at - 120, F.lit(1)), F.least(at, F.lit(121)) + len(q) + 239)
    return chunks.where(F.col("text").ilike(f"%{q}%")).select("chunk_id", "section_id", F.lit(0.0).alias("score"), F.when(at > 0, around).otherwise(F.substring("text", 1, 360)).alias("snippet")).orderBy("chunk_id").limit(limit)


def snippet(text: Column, terms: Column, width: int = 12) -> Column:
    """A run of `width` words from the first that a term holds, with such words in brackets."""


    def told(x: Column) -> Column:
        at = F.filter(F.transform(x["asked"], lambda t: F.array_position(x["low"], t)), lambda i: i > 0)
        start = F.coalesce(F.array_min(at), F.lit(1)).cast("int")
        window = lambda i: F.struct(i.alias("start"), F.slice(x["words"], i, width).alias("words"), F.slice(x["low"], i, width).alias("low"), F.size(x["words"]).alias("n"), x["asked"].alias("asked"))
        return T.let(start, window)

    def marked(x: Column) -> Column:
        body = F.zip_with(x["words"], x["low"], lambda w, l: F.when(F.array_contains(x["asked"], l), F.concat(F.lit("["), w, F.lit("]"))).otherwise(w))
        return F.concat(F.when(x["start"] > 1, "…").otherwise(""), F.array_join(body, " "), F.when(x["n"] >= x["start"] + width, "…").otherwise(""))

    # one space between words, so that the text without punctuation splits into as many
    split = lambda c: F.split(c, " ")
    plain = lambda flat: F.regexp_replace(F.lower(flat), BETWEEN.replace("\\x2F", "\\x1F\\x21-\\x2F") + "+", "")
    both = T.let(T.collapse(text), lambda flat: F.when(flat != "", F.struct(split(flat).alias("words"), split(plain(flat)).alias("low"))))
    none = F.array().cast("array<string>")
    parts = F.struct(F.coalesce(both["words"], none).alias("words"), F.coalesce(both["low"], none).alias("low"), F.array_distinct(F.flatten(query_terms(terms))).alias("asked"))
    return F.when(text.isNotNull(), T.let(T.let(parts, told), marked))


def read_sections(chunks: DataFrame, wanted: DataFrame, most: int = 8000) -> DataFrame:
    """(section_id, section_title, chunk_ids, text, image_urls, start_char, end_char) of the wanted section ids:
    the first chunks of each, texts joined by blank lines and cut after `most` characters."""
    kept = chunks.join(wanted.select("section_id").distinct(), "section_id", "left_semi")
    kept = kept.withColumn("k", F.row_number().over(Window.partitionBy("section_id").orderBy("start_char", "chunk_id"))).where(F.col("k") <= CHUNKS_A_SECTION)
    row = F.struct("k", "chunk_id", T.strip(F.col("text")).alias("text"), "image_urls")
    read = kept.groupBy("section_id").agg(
        F.first("section_title").alias("section_title"), F.array_sort(F.collect_list(row)).alias("r"), F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char")
    )
    body = F.array_join(F.filter(F.transform("r", lambda x: x["text"]), lambda t: t != ""), "\n\n")
    read = read.withColumn("text", body).where("text <> ''")
    return read.select(
        "section_id",
        "section_title",
        F.transform("r", lambda x: x["chunk_id"]).alias("chunk_ids"),
        F.when(F.length("text") > most, F.concat(F.substring("text", 1, most), F.lit(parse.TRUNCATED))).otherwise(F.col("text")).alias("text"),
        F.array_distinct(F.flatten(F.transform("r", lambda x: x["image_urls"]))).alias("image_urls"),
        "start_char",
        "end_char",
    )


def toolkit_stats(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("section_id").alias("sections"))


TERMS = ["the", "ing", "that the", "le", "und", "que", "sec1"]


def _chunks(spark, d):
    return parse.markdown_chunks(parse.sections(views.md_docs(spark, d)))


def _asked(index):
    return index.stats.select(F.lit("q").alias("query"), "doc_id", F.array(*map(F.lit, TERMS)).alias("terms"))


def q_bm25(spark, d):
    index = build(_chunks(spark, d))
    found = top(ranked(_asked(index), index), 3, each=True)
    return found.select("doc_id", "chunk_id", "section_id", F.round("score", 6).alias("score"), "rank")


def q_multi(spark, d):
    index = build(_chunks(spark, d))
    return search_documents(_asked(index), index, 25).select("chunk_id", F.round("score", 6).alias("score"), "rank")


def q_postings(spark, d):
    return postings(index_tokens(_chunks(spark, d))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.size("positions")).alias("tokens"), F.countDistinct("term").alias("terms"))


def q_plain(spark, d):
    return plain_search(_chunks(spark, d), ["the", "an"], 40).select("chunk_id", "section_id", "score", F.md5("snippet").alias("snippet_md5"))


def q_snippet(spark, d):
    return _chunks(spark, d).select("chunk_id", snippet(F.col("text"), F.array(*map(F.lit, TERMS))).alias("snippet"))


def q_read(spark, d):
    chunks = cut(_chunks(spark, d))
    wanted = chunks.where("heading_level = 2").select("section_id")
    return read_sections(chunks, wanted).select("section_id", "section_title", F.size("chunk_ids").cast("long").alias("n"), F.md5("text").alias("text_md5"), "start_char", "end_char")


def q_stats(spark, d):
    return toolkit_stats(_chunks(spark, d))


CHUNKS = parse.ORACLES["md_chunks"].replace("md5(t) as text_md5", "t as text, doc_id, title as section_title, level as heading_level").replace("md5(text), (start", "text, doc_id, title, level, (start").replace("buf, pos, c from r where i", "buf, pos, c from r where i")
_HEAD, _, _TAIL = CHUNKS.rpartition("select doc_id || '_s' || idx || '_c0'")
_TAIL = "select doc_id || '_s' || idx || '_c0'" + _TAIL.replace("from packed", "from (select p.*, s.title, s.level from packed p join s using (doc_id, idx))")
CHUNKS = f"{_HEAD.rstrip().removeprefix('with ')}, chunks as ({_TAIL})"
_TOK = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_RANKED = f"""{CHUNKS},
tok as (select doc_id, chunk_id, section_id, regexp_extract_all(lower(concat_ws(' ', chunk_id, section_id, section_title, text)), {_TOK}) as w from chunks),
terms as (select unnest(range({len(TERMS)})) as j, unnest({TERMS!r}) as term),
counted as (
  select doc_id, chunk_id, section_id, len(w) as len, j,
    len(list_filter(range(1, len(w) + 1), lambda i: w[i : i + len(string_split(term, ' ')) - 1] = string_split(term, ' '))) as tf from tok, terms),
stats as (select doc_id, count(*) as n, avg(len(w)) as mean from tok group by doc_id),
hit as (select *, count(*) over (partition by doc_id, j) as df from counted where tf > 0),
scored as (
  select doc_id, chunk_id, section_id, -sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * len / mean))) as score
  from hit join stats using (doc_id) group by all),
each as (select *, row_number() over (partition by doc_id order by score, chunk_id) as rank from scored)"""

QUERIES = {"bm25_topk": q_bm25, "multi_doc_topk": q_multi, "postings": q_postings, "plain_search": q_plain, "snippets": q_snippet, "read_sections": q_read, "toolkit_stats": q_stats}
ORACLES = {
    "bm25_topk": f"with {_RANKED} select doc_id, chunk_id, section_id, round(score, 6) as score, rank from each where rank <= 3",
    "multi_doc_topk": f"with {_RANKED} select chunk_id, round(score, 6) as score, r as rank from (select *, row_number() over (order by score, chunk_id) as r from each where rank <= 25) where r <= 25",
    "postings": f"with {_RANKED} select doc_id, count(distinct (chunk_id, t)) as pairs, count(*) as tokens, count(distinct t) as terms from (select doc_id, chunk_id, unnest(w) as t from tok) group by doc_id",
    "plain_search": f"""with {CHUNKS}
select chunk_id, section_id, 0.0::double as score, md5(substr(text, greatest(instr(lower(text), 'the an') - 120, 1)::bigint, (least(instr(lower(text), 'the an'), 121) + 6 + 239)::bigint)) as snippet_md5
from chunks where text ilike '%the an%' order by chunk_id limit 40""",
    "read_sections": f"""with {CHUNKS},
k as (select *, row_number() over (partition by section_id order by start_char, chunk_id) as k from chunks where section_id in (select section_id from chunks where heading_level = 2)),
rd as (select section_id, any_value(section_title) as section_title, count(*) as n, string_agg(text, chr(10) || chr(10) order by k) as text, min(start_char) as start_char, max(end_char) as end_char from k where k <= 8 group by section_id)
select section_id, section_title, n, md5(case when length(text) > 8000 then substr(text, 1, 8000) || chr(10) || '…(truncated)…' else text end) as text_md5, start_char, end_char from rd""",
    "toolkit_stats": f"with {CHUNKS} select doc_id, count(*) as chunks, count(distinct section_id) as sections from chunks group by doc_id",
}
