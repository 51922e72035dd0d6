"""Reachability tests, audits, quality reports, joins of questions with their debug rows, and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import checks, parse, search, views
from docquarry.plans.lineage import cut


def reachability(asked: DataFrame, index: search.Index, limit: int = 10, searches: int = 2, reads: int = 2) -> DataFrame:
    """(ord, ok, searches, reads) for rows (ord, question, used_doc_ids, evidence_section_ids): up to two
    keyword sets are searched in each used document; the second counts only if the first found no gold
    section. Both run as one search over rows (item, set, document), which are written once."""
    base = T.keywords(F.col("question"))
    sets = F.slice(F.array(base, T.more_keywords(F.col("question"), base)), 1, searches)
    rows = asked.select("ord", F.posexplode(sets).alias("k", "terms"), "used_doc_ids").where(F.size("terms") > 0)
    rows = rows.select("ord", "k", "terms", F.explode(F.array_distinct("used_doc_ids")).alias("doc_id"))
    rows = cut(rows.join(index.stats.select("doc_id"), "doc_id", "left_semi").withColumn("query", F.concat_ws(":", F.col("ord").cast("string"), F.col("k").cast("string"))))
    hits = search.top(search.ranked(rows.select("query", "doc_id", "terms"), index), limit, each=True)
    found = hits.groupBy("query", "doc_id").agg(F.collect_set("section_id").alias("hit"))
    told = rows.join(found, ["query", "doc_id"], "left").join(asked.select("ord", F.col("evidence_section_ids").alias("gold")), "ord")
    each = told.groupBy("ord", "k").agg(
        F.count(F.lit(1)).alias("s"),
        F.count(F.when(F.lit(reads > 0), F.col("hit"))).alias("r"),
        F.max(F.coalesce(F.arrays_overlap("hit", "gold"), F.lit(False))).alias("found"),
    )
    before = Window.partitionBy("ord").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    counted = each.withColumn("done", F.coalesce(F.max("found").over(before), F.lit(False))).where("not done")
    total = counted.groupBy("ord").agg(F.max("found").alias("ok"), F.sum("s").alias("searches"), F.sum("r").alias("reads"))
    zero = F.lit(0).cast("long")
    return asked.select("ord").join(total, "ord", "left").select("ord", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("searches", zero).alias("searches"), F.coalesce("reads", zero).alias("reads"))


def reach_report(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"), F.avg(F.col("ok").cast("double")).alias("ok_rate"), F.avg("searches").alias("avg_searches"), F.avg("reads").alias("avg_reads"))


def histogram(items: DataFrame, column: str, skip_empty: bool = True, default: str = "") -> DataFrame:
    value = F.coalesce(F.col(column), F.lit(default))
    counted = items.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("value <> ''") if skip_empty else counted


def reason_counts(items: DataFrame, reasons: str = "reasons", most: int = 30) -> DataFrame:
    """(reason, n): the most frequent; ties by first occurrence (ord)."""
    rows = items.select("ord", F.posexplode(reasons).alias("p", "reason"))
    counted = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "p")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(most).select("reason", "n")


def quality_report(items: DataFrame) -> DataFrame:
    """One row of counts and rates from rows (reasons, supported, unique, difficulty_ok). Judge rates are over the
    items that pass the gate."""
    gate = F.size("reasons") == 0
    judged = lambda *names: F.count_if(gate & F.expr(" and ".join(f"coalesce({n}, false)" for n in names)))
    passed = F.count_if(gate)
    rate = lambda c, n: F.coalesce(F.try_divide(c, n), F.lit(0.0))
    strict, aligned = judged("supported", "unique", "difficulty_ok"), judged("supported", "unique")
    return items.agg(
        F.count(F.lit(1)).alias("total"), passed.alias("gate_pass"), rate(passed, F.count(F.lit(1))).alias("gate_pass_rate"),
        strict.alias("judge_pass"), rate(strict, passed).alias("judge_pass_rate"), aligned.alias("aligned_pass"), rate(aligned, passed).alias("aligned_pass_rate"),
    )


def averages(items: DataFrame) -> DataFrame:
    """Mean numbers of different evidence sections and used documents, and items with table or image reads."""
    kinds = lambda c: F.size(F.array_distinct(F.filter(c, lambda x: x != "")))
    return items.agg(F.avg(kinds("evidence_section_ids")).alias("avg_evidence_sections"), F.avg(F.size(F.array_distinct(F.transform("evidence", lambda e: e["doc_id"])))).alias("avg_used_docs"))


def join_debug(questions: DataFrame, debug: DataFrame, last: bool) -> DataFrame:
    """questions (ord, question) with the fields of the debug row (ord, question_plain, ...) of the same question:
    the last of several (exact text) or the first (strict key). Debug rows are reduced to one a key first."""
    key = (lambda c: T.strip(T.text(F.col(c)))) if last else (lambda c: T.question_key(F.col(c)))
    pick = F.max_by if last else F.min_by
    fields = F.struct(*[c for c in debug.columns if c not in ("ord", "question_plain")])
    one = debug.select(key("question_plain").alias("k"), "ord", fields.alias("debug")).groupBy("k").agg(pick("debug", "ord").alias("debug"))
    return questions.withColumn("k", key("question")).join(one, "k", "left").drop("k")


def write_new(existing: DataFrame, items: DataFrame) -> DataFrame:
    """Items (ord, question, answer) that a writer would append: none empty, none whose key exists, the first of
    each key. An empty key is no key."""
    kept = items.where((T.strip(T.text(F.col("question"))) != "") & (T.strip(T.text(F.col("answer"))) != "")).withColumn("k", F.nullif(T.question_key(F.col("question"), "writer"), F.lit("")))
    fresh = kept.join(existing.select(T.question_key(F.col("question"), "writer").alias("k")).distinct(), "k", "left_anti")
    first = F.row_number().over(Window.partitionBy("k").orderBy("ord"))
    return fresh.withColumn("n", first).where("k is null or n = 1").drop("n", "k")


def export_corpus(chunks: DataFrame, most: int = 520) -> DataFrame:
    """Corpus rows (id, title, body, doc_id, section_id, fact): fact is one line of the text."""
    return chunks.where(~T.blank(F.col("text"))).select(
        F.col("chunk_id").alias("id"), F.col("section_title").alias("title"), F.col("text").alias("body"), "doc_id", "section_id", T.one_line(F.col("text"), most).alias("fact")
    )


def export_qa(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """(ord, query, answer, evidence, difficulty, kind) from items (ord, question, answer, cited, citation_map,
    evidence_chunk_ids, difficulty, kind): evidence are the corpus rows of the first chunk of each cited entry in
    order, else of the evidence chunks, each once. Unanswerable items keep neither evidence nor labels."""
    plain = items.where((T.strip(T.text(F.col("question"))) != "") & (T.strip(T.text(F.col("answer"))) != ""))
    cited = F.transform(F.regexp_extract_all(T.text(F.col("cited")), F.lit("\\[([0-9]+)\\]"), F.lit(1)), lambda x: x.cast("int"))
    of = lambda e: F.get(F.filter("citation_map", lambda m: m["eid"] == e), F.lit(0))["chunk_ids"]
    chosen = F.filter(F.transform(cited, lambda e: F.get(of(e), F.lit(0))), lambda c: c.isNotNull())
    ids = F.array_distinct(F.when(F.size(chosen) > 0, chosen).otherwise(F.coalesce("evidence_chunk_ids", F.array().cast("array<string>"))))
    none = T.strip(F.col("answer")).isin(*T.UNANSWERABLE)
    rows = plain.withColumns({"ids": F.when(none, F.array().cast("array<string>")).otherwise(ids), "none": none})
    met = rows.select("ord", F.posexplode("ids").alias("p", "id")).join(corpus.select("id", "doc_id", "fact"), "id")
    packed = met.groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("p", "id", "doc_id", "fact"))).alias("evidence"))
    label = lambda c: F.when(~F.col("none"), F.col(c)).alias(c)
    return rows.join(packed, "ord", "left").select("ord", F.col("question").alias("query"), "answer", F.coalesce("evidence", F.array().cast(packed.schema["evidence"].dataType)).alias("evidence"), label("difficulty"), label("kind"))


def show(items: DataFrame, n: int = 3, kind: str | None = None, difficulty: str | None = None, width: int = 260) -> DataFrame:
    """The first n items as one-line texts."""
    kept = items.where(F.lit(True) if kind is None else F.col("kind") == kind).where(F.lit(True) if difficulty is None else F.col("difficulty") == difficulty)
    return kept.orderBy("ord").limit(n).select("ord", T.one_line(F.col("question"), width).alias("question"), T.one_line(F.col("answer"), width).alias("answer"))


def sample(items: DataFrame, k: int, seed: str) -> DataFrame:
    """k items by the order of a hash of seed and ord: the same ones on any partitioning."""
    return items.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col("ord").cast("string"))), "ord").limit(k)


def _items(spark, d):
    return checks.debug_items(spark, d).withColumn("reasons", checks.gate_reasons())


def _asked(found):
    found = found.where("idx = 1")
    words = F.split(T.collapse(F.col("body")), " ")
    return found.select(F.col("doc_id").cast("long").alias("ord"), F.array_join(F.slice(words, 2, 9), " ").alias("question"), F.array("doc_id").alias("used_doc_ids"), F.array("section_id").alias("evidence_section_ids"))


def _reach(spark, d):
    found = cut(parse.sections(views.md_docs(spark, d)))
    return reachability(cut(_asked(found)), search.build(parse.markdown_chunks(found)), limit=2)


def q_reach(spark, d):
    return _reach(spark, d)


def q_reach_report(spark, d):
    r = reach_report(_reach(spark, d))
    return r.select("total", "ok", *(F.round(c, 9).alias(c) for c in ("ok_rate", "avg_searches", "avg_reads")))


def q_keywords(spark, d):
    x = F.col("text")
    base = T.keywords(x)
    return views.table(spark, d, "documents").select("doc_id", F.array_join(base, "|").alias("keywords"), F.array_join(T.more_keywords(x, base), "|").alias("more"), F.array_join(T.text_keywords(x), "|").alias("plain"))


def q_histograms(spark, d):
    items = _items(spark, d)
    return histogram(items, "difficulty").withColumn("by", F.lit("difficulty")).unionByName(histogram(items, "kind", False, "qa").withColumn("by", F.lit("kind")))


def q_reasons(spark, d):
    return reason_counts(_items(spark, d))


def q_quality(spark, d):
    judged = _items(spark, d).withColumns({"supported": F.col("ord") % 9 != 0, "unique": F.col("ord") % 13 != 0, "difficulty_ok": F.col("ord") % 5 != 0})
    r = quality_report(judged)
    return r.select(*(F.round(c, 9).alias(c) if c.endswith("rate") else F.col(c) for c in r.columns))


def q_averages(spark, d):
    """Items whose evidence names one to three documents."""
    n = F.col("ord")
    entry = lambda i: F.struct((n + i).cast("string").alias("doc_id"))
    several = F.transform(F.sequence(F.lit(0), (n % 5).cast("int")), lambda i: entry(i % 3))
    r = averages(_items(spark, d).withColumn("evidence", several))
    return r.select(*(F.round(c, 9).alias(c) for c in r.columns))


def _debug(spark, d):
    return views.qa(spark, d).select("ord", F.col("question").alias("question_plain"), (F.col("ord") % 100).alias("tag"))


def _join(last):
    def query(spark, d):
        joined = join_debug(views.qa(spark, d).select("ord", F.lower("question").alias("question")) if not last else views.qa(spark, d).select("ord", "question"), _debug(spark, d), last)
        return joined.select("ord", F.col("debug.tag").alias("tag"))

    return query


def q_writer(spark, d):
    rows = views.qa(spark, d)
    return write_new(rows.where("conv_id % 10 = 0"), rows).select("ord")


def q_show(spark, d):
    return show(views.qa(spark, d), 50)


def q_sample(spark, d):
    return sample(views.qa(spark, d), 40, "seed").select("ord")


def q_corpus(spark, d):
    chunks = parse.markdown_chunks(parse.sections(views.md_docs(spark, d)))
    return export_corpus(chunks).select("id", "title", "section_id", "fact")


def q_export(spark, d):
    found = cut(parse.sections(views.md_docs(spark, d)))
    corpus = export_corpus(parse.markdown_chunks(found))
    n = F.col("doc_id").cast("long")
    cite = lambda e, i: F.struct(F.lit(e).alias("eid"), F.array(F.concat("doc_id", F.lit(f"_s{i}_c0"))).alias("chunk_ids"))
    items = found.where("idx = 0").select(
        n.alias("ord"), F.concat("title", F.lit("?")).alias("question"), F.when(n % 6 == 5, "無法回答").otherwise("a").alias("answer"),
        F.when(n % 3 == 0, "x. [2] y. [1] [2]").when(n % 3 == 1, "z. [9]").alias("cited"), F.array(cite(1, 0), cite(2, 1)).alias("citation_map"),
        F.array(F.concat("doc_id", F.lit("_s0_c0"))).alias("evidence_chunk_ids"), F.lit("hard").alias("difficulty"), F.lit("qa").alias("kind"),
    )
    return export_qa(items, corpus).select("ord", "answer", F.array_join(F.transform("evidence", lambda e: e["id"]), ",").alias("evidence"), "difficulty", "kind")


_ITEMS = checks.ORACLES["gate_reasons"].removeprefix("with ").rpartition("select ord, array_to_string")[0]
_REASONS = f"with {_ITEMS.rstrip()}, rr as (select ord, list_filter(rs, lambda x: x is not null) as reasons from r)"
_STOPS = "[" + ", ".join(f"'{w}'" for w in T.QUERY_STOP) + "]"
_TITLES = "[" + ", ".join(f"'{w}'" for w in T.TITLE_STOP) + "]"
_DIST = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"


def _kw(text: str, most: int) -> str:
    toks = f"list_filter(regexp_extract_all(lower({text}), '[A-Za-z]{{2,}}|[一-鿿]{{2,}}|\\p{{Nd}}+(?:\\.\\p{{Nd}}+)?'), lambda t: not list_contains({_STOPS}, t))"
    return f"({_DIST.replace('{0}', toks)})[1:{most}]"


_KEYWORDS = """w as (select {id}, {base} as b, {wide} as v, {text} as text from {source}),
p as (select *, list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1]) as g from w),
k as (select *, list_concat(b, g) as bg from p)"""
_PLAIN = "list_filter(regexp_extract_all(text, '[0-9A-Za-z一-鿿]{2,14}'), lambda t: not list_contains(" + _TITLES + ", t))"
_MORE = f"({_DIST.replace('{0}', 'bg')})[1:10]"
_REACH = f"""with {search.CHUNKS},
tok as (select doc_id, chunk_id, section_id, regexp_extract_all(lower(concat_ws(' ', chunk_id, section_id, section_title, text)), {search._TOK}) as w from chunks),
asked as (select doc_id::bigint as ord, doc_id, doc_id || '_sec1' as gold, array_to_string(string_split(regexp_replace(regexp_replace(body, '\\s+', ' ', 'g'), '^ | $', '', 'g'), ' ')[2:10], ' ') as question from sections where idx = 1),
{_KEYWORDS.format(id="ord, doc_id, gold", base=_kw("question", 8), wide=_kw("question", 10), text="question", source="asked").replace("w as (", "kw as (", 1).replace("from w)", "from kw)").replace("p as (", "kp as (").replace("from p)", "from kp)").replace("k as (select *, list_concat", "kk as (select *, list_concat")},
setted as (select ord, doc_id, gold, 0 as k, b as terms from kk union all select ord, doc_id, gold, 1, {_MORE} from kk),
terms as (select ord, doc_id, k, unnest(terms) as term, unnest(range(len(terms))) as j from setted),
counted as (
  select t.ord, t.k, t.j, c.doc_id, c.chunk_id, c.section_id, len(c.w) as len,
    len(list_filter(range(1, len(c.w) + 1), lambda i: c.w[i : i + len(regexp_extract_all(term, {search._TOK})) - 1] = regexp_extract_all(term, {search._TOK}))) as tf from terms t join tok c using (doc_id)),
stats as (select doc_id, count(*) as n, avg(len(w)) as mean from tok group by doc_id),
hit as (select *, count(*) over (partition by ord, k, doc_id, j) as df from counted where tf > 0),
scored as (
  select ord, k, doc_id, chunk_id, section_id, -sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * {search.K1 + 1} / (tf + {search.K1} * (1 - {search.B} + {search.B} * len / mean))) as score
  from hit join stats using (doc_id) group by all),
best as (select * from (select *, row_number() over (partition by ord, k, doc_id order by score, chunk_id) as rank from scored) where rank <= 2),
each as (select s.ord, s.k, 1 as s, (count(b.chunk_id) > 0)::int as r, coalesce(bool_or(b.section_id = s.gold), false) as found from setted s left join best b using (ord, k) where len(s.terms) > 0 group by s.ord, s.k),
reached as (
  select a.ord, coalesce(bool_or(found), false) as ok, coalesce(sum(s), 0)::bigint as searches, coalesce(sum(r), 0)::bigint as reads
  from asked a left join (select * from each e where k = 0 or not exists (select 1 from each f where f.ord = e.ord and f.k = 0 and f.found)) using (ord) group by a.ord)"""

QUERIES = {
    "reachability": q_reach, "reach_report": q_reach_report, "keywords": q_keywords, "histograms": q_histograms, "reason_top": q_reasons, "quality_report": q_quality,
    "audit_averages": q_averages, "debug_join_last": _join(True), "debug_join_first": _join(False), "writer_new": q_writer, "show_items": q_show, "hash_sample": q_sample,
    "export_corpus": q_corpus, "export_qa": q_export,
}
ORACLES = {
    "reachability": f"{_REACH} select ord, ok, searches, reads from reached",
    "reach_report": f"{_REACH} select count(*) as total, count(*) filter (ok) as ok, round(avg(ok::int), 9) as ok_rate, round(avg(searches), 9) as avg_searches, round(avg(reads), 9) as avg_reads from reached",
    "keywords": f"""with t as (select doc_id, text, list_filter(regexp_extract_all(lower(text), '[A-Za-z]{{2,}}|[一-鿿]{{2,}}|\\p{{Nd}}+(?:\\.\\p{{Nd}}+)?'), lambda t: not list_contains({_STOPS}, t)) as w from documents),
u as (select doc_id, unnest(w) as x, unnest(range(len(w))) as i from t),
f as (select doc_id, x, row_number() over (partition by doc_id order by min(i)) as k from u group by doc_id, x),
wide as (select doc_id, list(x order by k) filter (k <= 8) as b, list(x order by k) filter (k <= 10) as v from f group by doc_id),
k as (select doc_id, text, coalesce(b, []) as b, list_concat(coalesce(b, []), list_transform(range(1, len(coalesce(v, []))), lambda i: v[i] || ' ' || v[i + 1])) as bg from t left join wide using (doc_id)),
pu as (select doc_id, unnest(p) as x, unnest(range(len(p))) as i from (select doc_id, list_filter(regexp_extract_all(text, '[0-9A-Za-z一-鿿]{{2,14}}'), lambda t: not list_contains({_TITLES}, t)) as p from documents)),
pf as (select doc_id, x, row_number() over (partition by doc_id order by min(i)) as k from pu group by doc_id, x),
pl as (select doc_id, string_agg(x, '|' order by k) as plain from pf where k <= 10 group by doc_id)
select doc_id, array_to_string(b, '|') as keywords, array_to_string({_MORE}, '|') as more, coalesce(plain, '') as plain from k left join pl using (doc_id)""",
    "histograms": f"with {checks.SECTION_ITEMS} select difficulty as value, count(*) as n, 'difficulty' as by from debug_items group by 1 union all select kind, count(*), 'kind' from debug_items group by 1",
    "reason_top": f"{_REASONS} select reason, n from (select reason, count(*) as n, min((ord, p)) as first from (select ord, unnest(reasons) as reason, unnest(range(len(reasons))) as p from rr) group by reason order by n desc, first limit 30)",
    "quality_report": f"""{_REASONS}, j as (select len(reasons) = 0 as gate, ord % 9 <> 0 as s, ord % 13 <> 0 as u, ord % 5 <> 0 as f from rr)
select count(*) as total, count(*) filter (gate) as gate_pass, round(count(*) filter (gate) / count(*), 9) as gate_pass_rate, count(*) filter (gate and s and u and f) as judge_pass,
  round(coalesce(count(*) filter (gate and s and u and f) / nullif(count(*) filter (gate), 0), 0), 9) as judge_pass_rate, count(*) filter (gate and s and u) as aligned_pass,
  round(coalesce(count(*) filter (gate and s and u) / nullif(count(*) filter (gate), 0), 0), 9) as aligned_pass_rate from j""",
    "audit_averages": f"with {checks.SECTION_ITEMS} select round(avg(k), 9) as avg_evidence_sections, round(avg(least(ord % 5 + 1, 3)), 9) as avg_used_docs from debug_items",
    "debug_join_last": f"with {views.QA}, one as (select trim(question) as k, arg_max(ord % 100, ord) as tag from qa group by 1) select q.ord, one.tag from qa q left join one on trim(q.question) = one.k",
    "debug_join_first": f"with {views.QA}, s as (select ord, regexp_replace(regexp_replace(lower(trim(question)), '\\s+', ' ', 'g'), '{T.PUNCTUATION.replace(chr(39), chr(39) * 2)}', '', 'g')[1:500] as k from qa), one as (select k, arg_min(ord % 100, ord) as tag from s group by 1) select s.ord, one.tag from s left join one using (k)",
    "writer_new": f"with {views.QA}, s as (select ord, conv_id, nullif(regexp_replace(lower(trim(question)), '\\s+', ' ', 'g')[1:500], '') as k from qa where trim(question) <> '' and trim(answer) <> '') select min(ord) as ord from s where k is not null and k not in (select k from s where conv_id % 10 = 0 and k is not null) group by k union all select ord from s where k is null",
    "show_items": f"with {views.QA}, s as (select * from qa order by ord limit 50), f as (select ord, trim(regexp_replace(question, '\\s+', ' ', 'g')) as q, trim(regexp_replace(answer, '\\s+', ' ', 'g')) as a from s) select ord, case when length(q) <= 260 then q else rtrim(q[1:259]) || '…' end as question, case when length(a) <= 260 then a else rtrim(a[1:259]) || '…' end as answer from f",
    "hash_sample": f"with {views.QA} select ord from qa order by md5('seed:' || ord), ord limit 40",
    "export_corpus": f"with {search.CHUNKS}, f as (select *, trim(regexp_replace(text, '\\s+', ' ', 'g')) as t from chunks) select chunk_id as id, section_title as title, section_id, case when length(t) <= 520 then t else rtrim(t[1:519]) || '…' end as fact from f",
    "export_qa": f"""with {search.CHUNKS}, c as (select chunk_id from chunks where trim(text) <> ''),
i as (select doc_id::bigint as ord, case when doc_id::bigint % 6 = 5 then '無法回答' else 'a' end as answer, case when doc_id::bigint % 6 = 5 then [] when doc_id::bigint % 3 = 0 then [doc_id || '_s1_c0', doc_id || '_s0_c0'] else [doc_id || '_s0_c0'] end as ids from sections where idx = 0 and trim(title || '?') <> ''),
e as (select ord, string_agg(id, ',' order by p) as ids from (select ord, unnest(ids) as id, unnest(range(len(ids))) as p from i) where id in (select chunk_id from c) group by ord)
select i.ord, i.answer, coalesce(e.ids, '') as evidence, case when answer = 'a' then 'hard' end as difficulty, case when answer = 'a' then 'qa' end as kind from i left join e using (ord)""",
}
