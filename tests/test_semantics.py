"""Literal cases of the document operators."""

import json
import time
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docquarry import catalog
from docquarry.functions import sandbox
from docquarry.functions import text as T
from docquarry.operators import checks, context, coverage, dedup, generate, parse, report, search
from docquarry.sources import files
from docquarry.streaming import audit


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column).first()[0]


def test_sections_and_tree(spark):
    docs = spark.createDataFrame([("d", "intro\n\n# A\n\ntext a\n\n## B\n\ntext b\n\n# C\n\ntext c\n"), ("e", "no heading"), ("f", ""), ("g", None)], "doc_id string, md string")
    found = parse.section_tree(parse.sections(docs)).orderBy("doc_id", "idx")
    assert [tuple(r) for r in found.where("doc_id = 'd'").select("title", "level", "parent_id", "start_char", "end_char").collect()] == [
        ("", 0, None, 0, 7), ("A", 1, None, 7, 20), ("B", 2, "d_sec1", 20, 34), ("C", 1, None, 34, 46),
    ]
    assert found.where("doc_id in ('e', 'f', 'g') and level = 0 and idx = 0").count() == 3


def _equals_sql(spark, name, folder):
    """Whether a query over the tables in a folder gives the rows of its SQL."""
    duck = duckdb.connect()
    for file in folder.glob("*.parquet"):
        duck.sql(f"create view {file.stem} as select * from '{file}/*.parquet'")
    frame = catalog.queries()[name](spark, str(folder))
    relation = duck.sql(catalog.oracle_sql()[name])
    order = [relation.columns.index(c) for c in frame.columns]
    return sorted((tuple(r) for r in frame.collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)


def test_documents_of_blank_lines(spark, tmp_path):
    texts = ["", " ", "\n", "\n\n\n", "  \n ", "\n" * 11, "\na b", "#", "\n\n\n\n\n", "a\n\n\n\n\n\n", "the a\nb\nc\nd\ne\nf\n\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    names = ("sections", "section_tree", "outline", "section_info", "section_coverage", "quota_violations", "template_questions")
    assert [n for n in names if not _equals_sql(spark, n, tmp_path)] == []


def test_all_headings_are_asked_for(spark, tmp_path):
    spark.createDataFrame([(0, "\n".join(f"line {i}" for i in range(400)))], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert generate.q_templates(spark, str(tmp_path)).count() == 80 and _equals_sql(spark, "template_questions", tmp_path)
    blank = spark.createDataFrame([("d", "# "), ("e", None)], "doc_id string, md string")
    assert sorted(r.question for r in generate.template_questions(blank, ["the"]).collect()) == ["What is this document about?"] * 2


def test_packing(spark):
    docs = spark.createDataFrame([("d", "aaaa\n\nbbbb\n\ncccccccccccc\n\nd")], "doc_id string, md string")
    found = parse.markdown_chunks(parse.sections(docs), 10).orderBy("start_char")
    assert [tuple(r) for r in found.select("chunk_id", "text", "start_char", "end_char").collect()] == [
        ("d_s0_c0", "aaaa", 0, 4), ("d_s0_c1", "bbbb", 4, 8), ("d_s0_c2", "cccccccccccc", 8, 20), ("d_s0_c3", "d", 20, 21),
    ]


def test_number_tokens_and_keywords(spark):
    assert one(spark, T.number_tokens(F.col("x")), x="in 2024.5 a1 -3.5% 10-12 1,234 5%6") == ["202", "5", "-3.5%", "10", "12", "1,234", "5%", "6"]
    base = ["waiting", "period", "plan", "2", "2024.5"]
    question = "What is the waiting period for Plan A2 in 2024.5?"
    assert one(spark, T.keywords(F.col("x")), x=question) == base
    assert one(spark, T.more_keywords(F.col("x"), T.keywords(F.col("x"))), x=question) == [*base, "waiting period", "period plan", "plan 2", "2 2024.5"]


def test_question_keys(spark):
    rows = spark.createDataFrame([(q,) for q in ("What is X?", "what is x?", "What  is X", "what is x", "", None)], "question string")
    assert one(spark, T.names_location(F.col("x")), x="见第１２页") and one(spark, T.number_tokens(F.col("x")), x="约１２％") == ["１２"]
    assert [dedup.duplicate_counts(rows, v).first().duplicate_questions for v in ("audit", "writer", "strict")] == [1, 2, 3]


def test_table_flags(spark):
    for text, strict, loose in (("| a | b |\n|---|---|\n| 1 | 2 |", True, True), ("a | b\nc | d", False, True), ("a", False, False)):
        assert one(spark, T.looks_like_table(F.col("x")), x=text) is strict
        assert one(spark, T.has_rows(F.col("x")), x=text) is loose


def test_languages(spark):
    assert one(spark, T.language(F.col("x")), x="plain") == "en"
    assert one(spark, T.language(F.col("x")), x="这里为国东发应与条责权险综简") == "zh"
    assert one(spark, T.language(F.col("x")), x="這裡為國東發應與條責權險綜簡") == "zh-Hant"
    assert one(spark, T.service_language(F.col("x")), x="图" * 30) == "zh"


def test_citations(spark):
    allowed = F.array(F.lit(1).cast("long"))
    cases = {
        "Ok. [1]": None, "Ok [1].": "missing_sentence_end_citation", "Ok. [2]": "unknown_eid:2", "Ok. (1)": "uses_non_square_bracket_citation_mark",
        "Ok.": "missing_citations", "Ok. [1] [x]": "malformed_brackets", "": "empty_answer_with_citations",
    }
    for text, fault in cases.items():
        assert one(spark, T.citation_fault(F.col("x"), allowed), x=text) == fault


def test_citation_repair(spark):
    def repaired(text, owners, hard, multi_doc):
        rows = spark.createDataFrame([(0, text, list(owners.items()), hard, multi_doc)], "ord int, answer string, entries array<struct<eid:int,doc_id:string>>, hard boolean, multi_doc boolean")
        return generate.repair_citations(rows).first().cited

    assert repaired("Alpha is 3.5. Beta holds.", {1: None, 2: None}, True, False) == "Alpha is 3.5. Beta holds. [1] [2]"
    assert repaired("One. Two.", {1: "a", 2: "a", 3: "b"}, True, True) == "One. [1] Two. [3]"
    assert repaired("No end", {}, True, True) == "No end"
    assert repaired("No end", {1: "a", 2: "a", 3: "b"}, True, True) == "No end [1] [2] [3]"
    assert repaired("One. [9] Two", {0: "z", 2: "a", 1: "b"}, False, False) == "One. [1] Two"
    assert repaired("一。二！", {4: "a"}, True, True) == "一。 [4]二！ [4]"
    assert repaired(" ", {1: "a"}, True, True) == "" and repaired(None, {1: "a"}, True, True) == ""


def test_coverage(spark):
    nodes = spark.createDataFrame([("d", "s0", 0, None), ("d", "s1", 1, None), ("d", "s2", 2, "s1"), ("d", "s3", 1, None)], "doc_id string, id string, level int, parent_id string")
    used = spark.createDataFrame([("s0",), ("s2",), ("s3",), ("unknown",)], "id string")
    counts, told = coverage.coverage(nodes, used)
    assert told.first().asDict() == {"doc_id": "d", "roots": 2, "covered": 2, "ratio": 1.0, "used": 3, "total": 4, "max_share": 1 / 3}
    assert sorted((r.top, r.n) for r in counts.collect()) == [("s1", 1), ("s3", 1)]
    assert coverage.violations(counts).count() == 0 and coverage.violations(counts, 0.3).count() == 2


def test_ancestors_of_long_chains_and_cycles(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(300)] + [("x", "gone")]
    rows += [("b2", "b1"), ("b1", "b2"), ("c3", "c1"), ("c1", "c2"), ("c2", "c3"), ("a0", "c2"), ("s", "s"), *((f"q{i}", f"q{(i + 1) % 4}") for i in range(4))]
    found = {r.id: r.top for r in coverage.top_ancestors(spark.createDataFrame(rows, "id string, parent_id string")).collect()}
    assert {found[f"n{i}"] for i in range(300)} == {"n0"} and found["x"] == "x"
    assert [found[i] for i in ("b1", "b2", "c1", "c2", "c3", "a0", "s")] == ["b1", "b1", "c1", "c1", "c1", "c1", "s"]
    assert {found[f"q{i}"] for i in range(4)} == {"q0"}


def test_schedule():
    keys = ("easy", "unanswerable", "hard_single", "hard_multi")
    assert [[generate.slot_counts(n)[k] for k in keys] for n in (100, 10, 2)] == [[10, 15, 37, 38], [1, 2, 3, 4], [0, 0, 1, 1]]
    assert generate.slot_counts(10, several=False)["hard_multi"] == 0


def test_simhash_of_empty_and_equal_texts(spark):
    rows = spark.createDataFrame([(0, ""), (1, None), (2, "alpha beta"), (3, "Alpha  beta"), (4, "gamma delta epsilon")], "ord long, text string")
    signed = dedup.signatures(rows)
    sig = {r.ord: r.sig for r in signed.collect()}
    assert sig[0] == sig[1] == -1 and sig[2] == sig[3]
    told = dedup.cluster_report(dedup.clusters(signed)).first()
    assert (told.clusters, told.duplicate_items, told.largest_cluster_size, told.top_clusters) == (3, 2, 2, "2:0,2:2")


EVIDENCE = "array<struct<doc_id:string,section_id:string,chunk_id:string,page_idxs:array<int>,start_char:bigint>>"


def test_spans_differ_by_check(spark):
    row = [("hard", [("d", "s1", "c1", None, 0), ("d", "s2", "c2", None, 25000)], "q?", "a", "t", ["s1", "s2"], "qa", None)]
    items = spark.createDataFrame(row, f"difficulty string, evidence {EVIDENCE}, question string, answer string, evidence_text string, evidence_section_ids array<string>, kind string, derived struct<tool:string,inputs:map<string,string>,code:string,result_text:string,exec_status:string>")
    got = items.select(
        checks.evidence_ok(F.col("difficulty"), F.col("evidence")).alias("a"), checks.verified_locally(*map(F.col, ("question", "answer", "difficulty", "evidence", "evidence_text"))).alias("b"),
        checks.gate_reasons().alias("c"), checks.gate_reasons(multi_doc=True).alias("d"),
    ).first()
    assert got.a is True and got.b == "hard_page_span_too_small" and got.c == [] and got.d == ["hard_requires_multi_doc"]


def test_search_prefers_rare_terms_and_finds_phrases(spark):
    chunks = spark.createDataFrame([("d", f"c{i}", "s", "t", t, []) for i, t in enumerate(["red fox", "red hen", "fox red", "blue"])], "doc_id string, chunk_id string, section_id string, section_title string, text string, image_urls array<string>")
    ask = lambda *terms: spark.createDataFrame([("q", "d", list(terms))], "query string, doc_id string, terms array<string>")
    hits = lambda *terms: [r.chunk_id for r in search.search_documents(ask(*terms), search.build(chunks), 5).orderBy("rank").collect()]
    assert hits("red fox") == ["c0"] and hits("blue", "red")[0] == "c3" and hits(" ", "absent") == []


def test_signature_sums_are_made_over_few_rows():
    rows, each = 4000, 80
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, rows * each)
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.ListArray.from_arrays(np.arange(0, rows * each + 1, each, dtype=np.int32), pa.array(hashes))], ["ord", "hashes"])
    tracemalloc.start()
    told = np.concatenate([b.column(1).to_numpy() for b in dedup.majority_bits(iter([batch]))])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    bits = lambda row: sum(1 << i for i in range(64) if 2 * sum(int(h) >> i & 1 for h in row) >= each)
    assert len(told) == rows and peak < 50_000_000
    assert all(int(told[i]) % 2**64 == bits(hashes[i * each : (i + 1) * each]) for i in (0, 499, 500, 3999))


def test_postings_stay_in_their_rows(spark):
    rows = spark.createDataFrame([("d", "c1", ["b", "a", "b"]), ("d", "c2", []), ("e", "c3", ["a"])], "doc_id string, chunk_id string, tokens array<string>")
    told = search.postings(rows)
    assert sorted(tuple(r) for r in told.collect()) == [("d", "c1", "a", [1]), ("d", "c1", "b", [0, 2]), ("e", "c3", "a", [0])]
    assert "Exchange" not in told._jdf.queryExecution().executedPlan().toString()


def test_snippets(spark):
    told = lambda text, *terms: one(spark, search.snippet(F.col("x"), F.array(*map(F.lit, terms)), 3), x=text)
    assert told("a - b\n(Fox)! d e", "fox") == "…[(Fox)!] d e" and told(" \u2003a  b\tc d", "fox", "the fox") == "a b c…"
    assert told("The red, fox", "red fox", "the") == "[The] [red,] [fox]" and told("", "a") == "" and told("x \u03a3\u0391\u03a3 y", "\u03c3\u03b1\u03c2") == "…[\u03a3\u0391\u03a3] y"
    assert spark.sql("select cast(null as string) as x").select(search.snippet(F.col("x"), F.array(F.lit("a")))).first()[0] is None
    begun = time.monotonic()
    assert told("word " * 1_000_000 + "fox", "fox", "hen", "red hen") == "…[fox]" and time.monotonic() - begun < 20


def test_space_and_names_as_by_patterns(spark):
    texts = ["", " ", "a", " \u00a0a  b\u2003\u3000\n", "\x1c\x1fa\x85\u2028b \n\n c\u202f", "._a-b c/d,e_.", "Caf\u00e9 \u4e00\u9fff\ua000 \u212a9\U0001f600^`_[x]", "\u200b x \x00", "..__", "K\u0130 \r\n \n z"]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    x, space = F.col("x"), f"[{T.SPACE}]"
    strip = lambda c: F.regexp_replace(c, f"^{space}+|{space}+$", "")
    safe = F.regexp_replace(F.regexp_replace(strip(x), "[^A-Za-z0-9._-]+", "_"), "^[._]+|[._]+$", "")
    pairs = [
        (T.strip(x), strip(x)), (T.collapse(x), strip(F.regexp_replace(x, f"{space}+", " "))), (T.safe_name(x), F.when(safe == "", "dataset").otherwise(safe)),
        (T.identifier(x), F.regexp_replace(F.lower(strip(x)), "[^0-9A-Za-z一-鿿]+", "")), (search.tokens(x), F.regexp_extract_all(F.lower(x), F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), F.lit(0))),
    ]
    assert all(a == b for row in rows.select(F.array(*(F.struct(a.cast("string"), b.cast("string")) for a, b in pairs))).collect() for a, b in row[0])


def test_pages_are_placed_in_sections(spark):
    docs = spark.createDataFrame([("d", "# A\n\nalpha alpha alpha alpha\n\n# B\n\nbeta beta beta beta beta"), ("e", None)], "doc_id string, md string")
    rows = [("d", 0, 0, "alpha alpha alpha alpha"), ("d", 1, 1, "beta beta beta beta beta"), ("d", 2, 2, "nowhere to be found at all"), ("e", 0, 3, "x"), ("f", 0, 0, "no document of this id")]
    items = spark.createDataFrame([(*r[:2], "text", *r[2:], None, None) for r in rows], "doc_id string, ord int, type string, page_idx int, text string, image_caption string, img_path string")
    told = parse.place_pages(parse.page_chunks(items), items, docs, parse.sections(docs)).collect()
    assert {(r.chunk_id, r.section_id, r.section_title, r.heading_level) for r in told} == {
        ("d_p0", "d_sec0", "A", 1), ("d_p1", "d_sec1", "B", 1), ("d_p2", "d_sec0", "Page 3", 0), ("e_p3", "e_sec0", "Page 4", 0), ("f_p0", "f_sec0", "Page 1", 0),
    }


def test_sandbox():
    assert sandbox.run_program("result = INPUTS['a'] + 1", {"a": 2})["result_text"] == "3"
    for code in ("import os", "open('/etc/passwd')", "1 / 0", "x = 'a' * 10**9"):
        assert sandbox.run_program(code, {})["status"] == "error"
    assert sandbox.run_program("", {})["status"] == "rejected"
    assert sandbox.run_program("while True: pass", {}, sandbox.Limits(seconds=1))["status"] in ("timeout", "error")


def test_json_pieces():
    assert generate.first_json('x {"a": {"b": 1}} y') == '{"a": {"b": 1}}' and generate.first_json("none") is None and generate.first_json("{") is None


def test_items_of_both_forms(spark):
    flat = [{"type": "text", "page_idx": 1, "text": "a"}, 5, {"type": "image", "page_idx": "x", "image_caption": ["l"], "caption": "c", "img_path": "p/q.png"}]
    docs = spark.createDataFrame([("f", json.dumps(flat)), ("n", json.dumps([flat, [flat[0]]])), ("b", "not json"), ("z", None)], "doc_id string, content_list string")
    found = files.read_items(docs)
    assert [tuple(r) for r in found.where("doc_id = 'f'").orderBy("ord").collect()] == [("f", 0, "text", 1, "a", None, None), ("f", 2, "image", None, None, "c", "p/q.png")]
    assert found.where("doc_id = 'n'").count() == 3 and found.count() == 5


def test_stores_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_bytes(b"x\xffy")
    (tmp_path / "in" / "a.jsonl").write_text('{"a": 1}\n\nnope\n[1]\n{"a": 2}\n')
    assert files.read_texts(spark, str(tmp_path / "in")).first().md == "xy"
    assert len(files.list_files(spark, str(tmp_path / "in"), "*.md").first().doc_id) == 16
    assert [r.row.a for r in files.read_json_lines(spark, str(tmp_path / "in" / "a.jsonl"), "a int").orderBy("ord").collect()] == [1, 2]
    old = spark.createDataFrame([("d", 1.0, "old"), ("e", 1.0, "kept")], "doc_id string, updated_at double, v string")
    new = spark.createDataFrame([("d", 2.0, "new")], "doc_id string, updated_at double, v string")
    assert sorted(r.v for r in files.merged(old, new).collect()) == ["kept", "new"]
    assert files.write_json_array(old.orderBy("doc_id"), str(tmp_path / "o.json")) == 2
    assert [r["v"] for r in json.loads((tmp_path / "o.json").read_text())] == ["old", "kept"]
    files.write_json_lines(old, str(tmp_path / "lines"))
    files.write_json_lines(new, str(tmp_path / "lines"), append=True)
    assert spark.read.json(str(tmp_path / "lines")).count() == 3
    whole = files.with_default_section(spark.createDataFrame([("d", "abc", [])], "doc_id string, md string, sections array<struct<section_id:string,title:string,level:int,parent_id:string,start_char:bigint,end_char:bigint>>"))
    assert whole.first().sections[0].end_char == 3


def test_streaming_audit(spark, tmp_path):
    rows = spark.sql("select * from values ('A?', timestamp'2024-01-01'), ('a?', timestamp'2024-01-01'), ('b', timestamp'2024-01-02') as t(question, at)")
    rows.write.parquet(str(tmp_path / "q"))
    out = audit.first_questions(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "q")))
    query = out.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("seen").count() == 2 == audit.first_questions(rows).count()


def test_replies_are_replayed(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "q")], "ord long, prompt string")
    recorded = prompts.where("ord = 1").select(F.md5("prompt").alias("prompt_md5"), F.lit('ok {"a":1}').alias("reply"))
    assert {r.ord: r.reply for r in generate.answer_rows(prompts, recorded).collect()} == {1: '{"a":1}', 2: None}


def test_captions(spark):
    for text, ok in (("A dog", True), ("An image", False), ("x.png", False), ("0123456789abcdef0123456789abcdef", False), ("", False), ("fig1.png shows", False)):
        assert one(spark, T.meaningful_caption(F.col("x"), F.lit("fig1.png"), "en"), x=text) is ok


def test_writer_keeps_first_of_each_key(spark):
    rows = spark.createDataFrame([(1, "Q?", "a"), (2, "q?", "b"), (3, "R", ""), (4, "S", "c")], "ord long, question string, answer string")
    old = spark.createDataFrame([("s",)], "question string")
    assert [r.ord for r in report.write_new(old, rows).collect()] == [1]


def test_citation_queries_read_whole_texts(spark, tmp_path):
    text = "x" * 400 + ". End [stray]."
    spark.createDataFrame([(6, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert checks.q_citations(spark, str(tmp_path)).first().fault == "malformed_brackets"
    assert "x" * 400 in str(generate.q_repair(spark, str(tmp_path)).first())


def test_context_streams(spark):
    part = lambda kind, text: {"type": kind, "content": text}
    image = {"image_source": {"path": " out/fig.png "}}
    rows = [
        ("a", 2, "image", image), ("a", 0, "title", {"title_content": [part("text", " Head "), part("text", " "), part("equation_inline", "no")]}), ("a", 1, "image", image),
        ("a", 3, "paragraph", {"paragraph_content": [part("text", "so "), part("equation_interline", "x"), part("note", "no")]} | image), ("a", 4, "list", {"html": "no"}), ("b", 0, "title", None),
    ]
    blocks = spark.createDataFrame(rows, f"doc_id string, ord int, type string, content {context.CONTENT}")
    told = {r.doc_id: (r.stream, [tuple(m) for m in r.markers]) for r in context.context_streams(blocks).collect()}
    assert told == {"a": ("Head\n\n![img](images/fig.png)\nso x", [(6, "fig.png")]), "b": ("", [])}
    assert context.context_streams(blocks.limit(0)).count() == 0
    assert context.context_streams(blocks)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_labels_and_endpoints(spark):
    kind = "array<struct<section_id:string,doc_title:string,doc_filename:string>>"
    rows = [(0, [("s", None, " d/One.pdf"), ("s", "ONE!", None), ("", "Two", None), ("s", "??", None), ("s", "Three", "x")]), (1, []), (2, [(None, "No", None)])]
    labels = context.source_labels(F.col("e"), F.lit(2))
    frame = spark.createDataFrame(rows, f"i int, e {kind}").select("i", labels.alias("l"), *(context.source_hint(labels, F.lit(x)).alias(x.replace("-", "")) for x in ("en", "zh-Hant")))
    told = {r.i: (r.l, r.en, r.zhHant) for r in frame.collect()}
    assert told == {0: (["One", "Three"], "(Files: One + Three)", "（文件：One + Three）"), 1: ([], "", ""), 2: ([], "", "")}
    bases = ["http://h", "http://h//", "http://h/v1/", "http://h/v1/chat/completions"]
    ends = spark.createDataFrame([(b,) for b in bases], "b string").select(context.chat_endpoint(F.col("b")).alias("e")).collect()
    assert {r.e for r in ends} == {"http://h/v1/chat/completions"}


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_section_offsets_are_summed_in_their_rows(spark):
    md = "".join(f"# h{i}\n{'y' * (i % 7)}\n" for i in range(600))
    found = parse.sections(spark.createDataFrame([("d", md), ("e", None), ("f", "#\n\nab\nc"), ("g", "x #\n")], "doc_id string, md string"))
    assert "Exchange" not in _plan(parse.markdown_chunks(found))
    rows = found.where("doc_id = 'd'").orderBy("idx").collect()
    assert len(rows) == 600 and all(md[r.start_char : r.end_char] == r.body for r in rows) and rows[-1].end_char == len(md)
    assert sorted((r.doc_id, r.title, r.level, r.start_char, r.end_char) for r in found.where("doc_id > 'd'").collect()) == [("e", "", 0, 0, 0), ("f", "ab", 1, 0, 7), ("g", "", 0, 0, 4)]
    sums = lambda *xs: one(spark, T.running_sums(F.array(*map(F.lit, xs)), 2))
    assert [sums(1), sums(1, 2), sums(1, 2, 3), sums(1, 2, 3, 4, 5)] == [[1], [1, 3], [1, 3, 6], [1, 3, 6, 10, 15]]


def test_one_line_reads_what_makes_the_line(spark):
    texts = ["", None, " \n ", "abcde", "a  b \n c", " " * 30 + "abcdefgh", "ab " * 30, "a" * 5 + " " * 20 + "b", "a" * 4 + " " * 20 + "bc", "a" * 6 + " ", "ab  cd\u2003 ", "a\u3000\u3000b c d e f g"]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", T.one_line(F.col("x"), 6).alias("line"), T.blank(F.col("x")).alias("blank")).collect()
    flat = [" ".join((t or "").split()) for t in texts]
    assert [r.line for r in rows] == [f if len(f) <= 6 else f[:5].rstrip() + "\u2026" for f in flat]
    assert [r.blank for r in rows] == [None if t is None else not t.strip() for t in texts]
    text = spark.range(1).select(F.repeat(F.concat(F.lit("word  "), F.col("id").cast("string")), 4_000_000).alias("x")).cache()

    def took(line):
        begun = time.monotonic()
        text.select(F.length(line)).collect()
        return time.monotonic() - begun

    took(F.col("x")), took(T.collapse(F.col("x")))
    assert took(T.one_line(F.col("x"), 20)) < took(T.collapse(F.col("x"))) / 2
    text.unpersist()


def test_export_writes_no_corpus(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, "the a\nb\nc\nd\ne\nf") for i in range(12)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    written = []
    monkeypatch.setattr(report, "cut", lambda frame: written.append(frame) or frame)
    told = report.q_export(spark, str(tmp_path))
    assert [w.columns[-1] for w in written] == ["body"] and told.count() == 12
    monkeypatch.undo()
    assert _equals_sql(spark, "export_qa", tmp_path)


def test_search_counts_in_rows_of_chunks(spark):
    texts = ["a b a b a", "a a a b a a", "ab a", "\u00e9t\u00e9 b", ""]
    chunks = spark.createDataFrame([("d", f"c{i}", "s", "t", t) for i, t in enumerate(texts)], "doc_id string, chunk_id string, section_id string, section_title string, text string")
    index = search.build(chunks)
    count = lambda *words: [r[0] for r in index.chunks.orderBy("chunk_id").select(search.frequency(F.col("words"), F.array(*map(F.lit, words)), search.spaced(F.array(*map(F.lit, words))))).collect()]
    assert count("a") == [3, 5, 1, 0, 0] and count("a", "a") == [0, 3, 0, 0, 0] and count("a", "b", "a") == [2, 1, 0, 0, 0]
    assert count("b", "a") == [2, 1, 0, 0, 0] and count("\u00e9t\u00e9", "b") == [0, 0, 0, 1, 0] and count("ab") == [0, 0, 1, 0, 0]
    asked = spark.createDataFrame([("p", "d", ["a b", "a"]), ("q", "d", ["a", "\u00c9t\u00e9"])], "query string, doc_id string, terms array<string>")
    found = search.ranked(asked, index)
    assert sorted((r.query, r.chunk_id) for r in found.collect()) == [("p", "c0"), ("p", "c1"), ("p", "c2"), ("q", "c0"), ("q", "c1"), ("q", "c2"), ("q", "c3")]
    # chunks are read once, and their statistics
    assert _plan(search.ranked(asked, index)).count("FileScan parquet") == 2


def test_reachability_makes_its_searches_once(spark):
    chunks = spark.createDataFrame([("d", "c0", "s0", "t", "red fox"), ("d", "c1", "s1", "t", "blue hen")], "doc_id string, chunk_id string, section_id string, section_title string, text string")
    asked = spark.createDataFrame([(1, "blue hen?", ["d"], ["s1"]), (2, "red fox", ["d"], ["s1"]), (3, "the", ["d"], ["s0"]), (4, "red", ["x"], ["s0"])], "ord long, question string, used_doc_ids array<string>, evidence_section_ids array<string>")
    told = report.reachability(asked, search.build(chunks))
    assert sorted(tuple(r) for r in told.collect()) == [(1, True, 1, 1), (2, False, 2, 2), (3, False, 0, 0), (4, False, 0, 0)]
    # and no plan makes keywords again
    assert T.TOKEN not in _plan(told)
