"""Constraint checks on questions, answers, evidence, calculations and citations; reasons as columns.

Items are rows (ord, doc_id, question, answer, difficulty, kind, evidence_section_ids, evidence, evidence_text,
derived): evidence is an array of (doc_id, section_id, chunk_id, page_idxs, start_char), derived a struct of
(tool, inputs, code, result_text, exec_status) or null. All checks are row expressions: nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import parse, views

ANSWER_CHARS, CHAR_SPAN, HARD_MIN, PAGE_GAP = 220, 20_000, 2, 3
DERIVED = ("tool", "inputs", "code", "result_text", "exec_status")


def _asks(c: Column) -> Column:
    return F.contains(T.text(c), F.lit("?")) | F.contains(T.text(c), F.lit("？"))


def question_fault(question: Column, answer: Column, difficulty: Column, token: str = "UNANSWERABLE") -> Column:
    """First fault of a question and answer, or null."""
    return (
        F.when(T.strip(T.text(question)) == "", "empty_question")
        .when(T.strip(T.text(answer)) == "", "empty_answer")
        .when(T.names_location(question) | T.names_location(answer), "prohibited_location")
        .when(~_asks(question), "missing_question_mark")
        .when((difficulty == "unanswerable") & (T.strip(T.text(answer)) != token), "unanswerable_answer_token_mismatch")
    )


def calc_keys(code: Column) -> Column:
    """Different keys that code takes from INPUTS."""
    found = F.regexp_extract_all(T.text(code), F.lit("INPUTS\\s*\\[\\s*(['\"])([^'\"]+)\\1\\s*\\]"), F.lit(2))
    return F.array_distinct(F.filter(F.transform(found, T.strip), lambda k: k != ""))


def calc_fault(question: Column, inputs: Column, code: Column, difficulty: Column) -> Column:
    """First fault of a calculation: its question, its inputs (a map) and its code; null if none. Values of inputs
    are JSON text: numbers, or strings that hold one."""
    n = F.coalesce(F.size(inputs), F.lit(0))
    hard = difficulty == "hard"
    names, values = F.coalesce(F.map_keys(inputs), F.array().cast("array<string>")), F.coalesce(F.map_values(inputs), F.array().cast("array<string>"))
    nameless = F.exists(names, lambda k: T.strip(T.text(k)) == "")
    odd = F.exists(values, lambda v: v.isNull() | F.rlike(v, F.lit("^\\s*([\\[{]|(true|false|null)\\s*$)")))
    return (
        F.when(T.strip(T.text(question)) == "", "empty_question")
        .when(T.names_location(question), "prohibited_location")
        .when(~_asks(question), "missing_question_mark")
        .when(~F.coalesce(difficulty.isin("easy", "hard"), F.lit(False)), "calc_not_allowed_for_this_difficulty")
        .when(T.strip(T.text(code)) == "", "empty_code")
        .when(~F.contains(T.text(code), F.lit("INPUTS")), "code_must_reference_INPUTS")
        .when(~F.rlike(T.text(code), F.lit("[-+*/]")), "code_must_include_arithmetic")
        .when((n < F.when(hard, 2).otherwise(1)) | (n > 20), "bad_number_of_inputs")
        .when(nameless, "bad_input_name")
        .when(odd, "bad_input_value")
        .when(hard & (F.size(calc_keys(code)) < 2), "hard_calc_must_use_at_least_2_INPUTS_keys")
    )


def _span(values: Column) -> Column:
    return F.array_max(values) - F.array_min(values)


def _pages(evidence: Column) -> Column:
    return F.flatten(F.transform(evidence, lambda e: F.coalesce(e["page_idxs"], F.array().cast("array<int>"))))


def _starts(evidence: Column) -> Column:
    return F.filter(F.transform(evidence, lambda e: e["start_char"]), lambda x: x.isNotNull())


def _documents(evidence: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(evidence, lambda e: e["doc_id"]), lambda x: x.isNotNull() & (x != "")))


def wide_enough(evidence: Column, gap: int, characters: bool = True) -> Column:
    """Whether evidence spans enough pages, or (if `characters`) enough text."""
    pages = _pages(evidence)
    near = F.when(F.size(pages) >= 2, _span(pages) >= gap).otherwise(False)
    if not characters:
        return near
    return near | F.coalesce(_span(_starts(evidence)) >= CHAR_SPAN, F.lit(False))


def evidence_ok(difficulty: Column, evidence: Column, hard_min: int = HARD_MIN, gap: int = PAGE_GAP, multi_doc: bool = False) -> Column:
    """Whether evidence suffices for a difficulty: one chunk for easy items, any for unanswerable ones, several
    chunks over several documents or far apart for hard ones."""
    chunks = F.size(F.array_distinct(F.transform(evidence, lambda e: e["chunk_id"])))
    hard = (chunks >= hard_min) & ((F.size(_documents(evidence)) >= 2) if multi_doc else wide_enough(evidence, gap))
    return F.when(difficulty == "easy", chunks == 1).when(difficulty == "unanswerable", F.size(evidence) >= 1).when(difficulty == "hard", hard).otherwise(False)


def verified_locally(question: Column, answer: Column, difficulty: Column, evidence: Column, evidence_text: Column, hard_min: int = HARD_MIN, gap: int = PAGE_GAP) -> Column:
    """The last check before judging: places, token, numbers, cardinality, and page span only. First fault."""
    chunks = F.size(F.array_distinct(F.transform(evidence, lambda e: e["chunk_id"])))
    plain = T.strip(T.text(answer))
    return (
        F.when(T.names_location(question) | T.names_location(answer), "prohibited_location")
        .when((difficulty == "unanswerable") & ~plain.isin(*T.UNANSWERABLE), "unanswerable_answer_token_mismatch")
        .when((difficulty != "unanswerable") & ~T.grounded(T.number_tokens(answer, 6), evidence_text), "answer_number_not_in_evidence")
        .when((difficulty == "easy") & (chunks != 1), "easy_requires_exactly_1_chunk")
        .when((difficulty == "hard") & (chunks < hard_min), "hard_requires_more_chunks")
        .when((difficulty == "hard") & ~wide_enough(evidence, gap, characters=False), "hard_page_span_too_small")
    )


def gate_reasons(hard_min: int = HARD_MIN, gap: int = PAGE_GAP, multi_doc: bool = False, token: str = "UNANSWERABLE") -> Column:
    """All reasons against an item, in a fixed order, as an array; empty if it passes."""
    q, a, difficulty, kind = F.col("question"), F.col("answer"), F.col("difficulty"), F.coalesce("kind", F.lit("qa"))
    text, code, inputs = F.col("evidence_text"), F.col("derived.code"), F.col("derived.inputs")
    sections = F.size(F.array_distinct(F.filter(F.transform(F.coalesce("evidence_section_ids", F.array().cast("array<string>")), T.strip), lambda s: s != "")))
    evidence = F.filter(F.coalesce("evidence", F.array().cast("array<struct<doc_id:string,section_id:string,chunk_id:string,page_idxs:array<int>,start_char:bigint>>")), lambda e: T.text(e["section_id"]) != "")
    least = max(2, hard_min)
    hard = F.coalesce(difficulty == "hard", F.lit(False))
    unanswerable = F.coalesce(difficulty == "unanswerable", F.lit(False))
    loose = F.filter(T.number_tokens(a, 6), lambda n: ~F.contains(T.without_commas(text), T.without_commas(n)))
    calc = kind == "calc"
    coded = calc & F.col("derived").isNotNull() & (T.strip(T.text(code)) != "")
    spread = (F.size(_documents(evidence)) < 2) if multi_doc else ~wide_enough(evidence, gap)
    values = F.flatten(F.transform(F.map_values(inputs), lambda v: T.number_tokens(v, 4)))
    rules = [
        (T.strip(T.text(q)) == "", "empty_question"),
        (T.strip(T.text(a)) == "", "empty_answer"),
        (q.isNotNull() & ~_asks(q), "missing_question_mark"),
        (T.names_location(q), "prohibited_location_in_question"),
        (T.names_location(a), "prohibited_location_in_answer"),
        (~F.coalesce(difficulty.isin("easy", "hard", "unanswerable"), F.lit(False)), "bad_difficulty"),
        (~unanswerable & (F.length(T.strip(T.text(a))) > ANSWER_CHARS), "answer_too_long"),
        ((difficulty == "easy") & (sections != 1), "easy_requires_exactly_1_evidence_section"),
        (unanswerable & (sections < 1), "unanswerable_requires_at_least_1_evidence_section"),
        (hard & (sections < least), f"hard_requires_at_least_{least}_evidence_sections"),
        (hard & spread, "hard_requires_multi_doc" if multi_doc else "hard_page_span_too_small"),
        ((kind == "qa") & ~unanswerable & (F.size(loose) > 0), F.concat(F.lit("answer_number_not_in_evidence:"), F.get(loose, F.lit(0)))),
        (calc & unanswerable, "unanswerable_cannot_be_calc"),
        (calc & F.col("derived").isNull(), "calc_missing_derived"),
        *((calc & F.col("derived").isNotNull() & F.col(f"derived.{k}").isNull(), f"calc_derived_missing:{k}") for k in DERIVED),
        (calc & F.col("derived").isNotNull() & (T.strip(T.text(code)) == ""), "calc_empty_code"),
        (coded & ~F.contains(code, F.lit("INPUTS")), "calc_code_must_reference_INPUTS"),
        (coded & ~F.rlike(code, F.lit("[-+*/]")), "calc_code_must_include_arithmetic"),
        (coded & hard & (F.size(calc_keys(code)) < 2), "hard_calc_must_use_at_least_2_INPUTS_keys"),
        (coded & T.names_location(code), "calc_code_contains_prohibited_location"),
        (calc & F.col("derived").isNotNull() & inputs.isNull(), "calc_inputs_not_object"),
        (calc & inputs.isNotNull() & ~T.grounded(values, text), "calc_inputs_not_grounded_in_evidence"),
        (unanswerable & a.isNotNull() & (T.strip(T.text(a)) != token), "unanswerable_answer_token_mismatch"),
    ]
    return F.array_compact(F.array(*(F.when(rule, reason) for rule, reason in rules)))


def multimodal(reads: Column) -> Column:
    """Whether any read holds a table or an image."""
    return F.coalesce(F.exists(reads, lambda r: F.coalesce(r["has_table"], F.lit(False)) | (F.size(r["image_urls"]) > 0)), F.lit(False))


def names_documents(question: Column, titles: Column) -> Column:
    """How many of the titles (array) the question names, letters and digits compared."""
    plain = T.identifier(question)
    return F.size(F.filter(titles, lambda t: (T.identifier(T.file_title(t)) != "") & F.contains(plain, T.identifier(T.file_title(t)))))


def safe_file(name: Column) -> Column:
    """Whether a name stays inside its folder."""
    return (T.text(name) != "") & ~F.rlike(name, F.lit("(^|[/\\\\])\\.\\.([/\\\\]|$)|^[/\\\\]|^[A-Za-z]:"))


def debug_items(spark, d) -> DataFrame:
    """Items made of the sections of md_docs."""
    found = parse.sections(views.md_docs(spark, d)).where("idx < 2")
    chunk = F.struct("idx", "doc_id", "section_id", F.col("section_id").alias("chunk_id"), F.array((F.col("idx") * 4).cast("int")).alias("page_idxs"), "start_char", "body", "title")
    rows = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(chunk)).alias("s")).withColumn("n", F.col("doc_id").cast("long"))
    kept = F.slice("s", 1, F.when(F.col("n") % 2 == 0, 1).otherwise(2))
    rows = rows.withColumn("s", kept)
    first = F.get("s", F.lit(0))
    calc = F.col("n") % 11 == 0
    return rows.select(
        F.col("n").alias("ord"),
        "doc_id",
        F.concat(first["title"], F.when(F.col("n") % 4 != 0, "?").otherwise("")).alias("question"),
        F.when(F.col("n") % 7 == 2, "UNANSWERABLE").when(F.col("n") % 5 == 0, "In 1,234 of 56% cases.").when(F.col("n") % 9 < 5, first["title"]).otherwise(first["body"]).alias("answer"),
        F.get(F.array(F.lit("easy"), F.lit("hard"), F.lit("unanswerable")), (F.col("n") % 3).cast("int")).alias("difficulty"),
        F.when(calc, "calc").otherwise("qa").alias("kind"),
        F.transform("s", lambda e: e["section_id"]).alias("evidence_section_ids"),
        F.transform("s", lambda e: F.struct(e["doc_id"].alias("doc_id"), e["section_id"].alias("section_id"), e["chunk_id"].alias("chunk_id"), e["page_idxs"].alias("page_idxs"), e["start_char"].alias("start_char"))).alias("evidence"),
        F.array_join(F.transform("s", lambda e: e["body"]), "\n").alias("evidence_text"),
        F.when(
            calc & (F.col("n") % 22 == 0),
            F.struct(F.lit("python").alias("tool"), F.create_map(F.lit("a"), F.lit("12"), F.lit("b"), F.lit("x")).alias("inputs"), F.lit("r = INPUTS['a'] + INPUTS['b']").alias("code"), F.lit("3").alias("result_text"), F.lit("ok").alias("exec_status")),
        ).alias("derived"),
    )


def q_gate(spark, d):
    return debug_items(spark, d).select("ord", F.array_join(gate_reasons(), "|").alias("reasons"))


def q_question(spark, d):
    return debug_items(spark, d).select("ord", question_fault(F.col("question"), F.col("answer"), F.col("difficulty")).alias("fault"))


def q_evidence(spark, d):
    return debug_items(spark, d).select("ord", evidence_ok(F.col("difficulty"), F.col("evidence")).alias("ok"), verified_locally(*map(F.col, ("question", "answer", "difficulty", "evidence", "evidence_text"))).alias("fault"))


def q_calc(spark, d):
    """Calculations of every kind of fault, one for each document."""
    n = F.col("doc_id")
    fields = {
        "question": F.when(n % 13 == 0, " ").when(n % 13 == 1, "Sum of page 3?").when(n % 13 == 2, "What is the sum").otherwise("What is the sum?"),
        "difficulty": F.get(F.array(F.lit("easy"), F.lit("hard"), F.lit("unanswerable"), F.lit("hard")), (n % 4).cast("int")),
        "code": F.when(n % 11 == 0, "").when(n % 11 == 1, "r = 1 + 2").when(n % 11 == 2, "r = INPUTS['a']").when(n % 11 == 3, "r = INPUTS[\"a\"] + INPUTS[ 'a' ]").otherwise("r = INPUTS['a'] + INPUTS['b']"),
        "inputs": F.when(n % 7 == 0, F.create_map(F.lit(" "), F.lit("1"), F.lit("b"), F.lit("2")))
        .when(n % 7 == 1, F.create_map(F.lit("a"), F.lit("1")))
        .when(n % 7 == 2, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("[2]")))
        .when(n % 7 == 3, F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("a"), F.lit("12"), F.lit("b"), F.lit("1,000"))),
    }
    rows = views.table(spark, d, "documents").select(n.alias("ord"), *(c.alias(k) for k, c in fields.items()))
    return rows.select("ord", calc_fault(*map(F.col, ("question", "inputs", "code", "difficulty"))).alias("fault"), F.array_join(calc_keys(F.col("code")), ",").alias("keys"))


def q_numbers(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.array_join(T.number_tokens(F.col("text")), " ").alias("numbers"))


def q_grounding(spark, d):
    """Whether the numbers of each document's second half stand in its first."""
    half = (F.length("text") / 2).cast("int")
    return views.table(spark, d, "documents").select("doc_id", T.grounded(T.number_tokens(F.substr("text", half), 6), F.substr("text", F.lit(1), half)).alias("grounded"))


def q_flags(spark, d):
    x = F.col("text")
    return views.table(spark, d, "documents").select(
        "doc_id", T.looks_like_table(F.concat(x, F.lit("\n|---|---"))).alias("is_table"), T.has_rows(x).alias("has_rows"), T.names_location(x).alias("names_location"),
        T.language(x).alias("language"), T.service_language(x).alias("service_language"),
    )


_CITED = "regexp_replace({t}, '([.] )', case when doc_id % 3 = 0 then '. [1] ' when doc_id % 3 = 1 then '. [2] [1] ' else '. ' end{g}) || case when doc_id % 5 = 0 then ' [x]' when doc_id % 7 = 0 then ' (3)' else ' [1]' end"


def _cited(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.expr(_CITED.format(t="text", g="")).alias("cited"))


def q_citations(spark, d):
    return _cited(spark, d).select("doc_id", citation_fault_of("cited").alias("fault"), F.md5(T.strip_citations(F.col("cited"))).alias("plain_md5"))


def citation_fault_of(name: str) -> Column:
    return T.citation_fault(F.col(name), F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))


SECTION_ITEMS = f"""{parse.SECTIONS},
two as (select *, doc_id::bigint as n from sections where idx < 2),
kept as (select * from two where idx = 0 or n % 2 <> 0),
items as (
  select n as ord, any_value(doc_id) as doc_id, min(title) filter (idx = 0) as t, min(body) filter (idx = 0) as b, count(*) as k, string_agg(body, chr(10) order by idx) as evidence_text,
    min(start_char) as lo, max(start_char) as hi from kept group by n),
debug_items as (
  select ord, doc_id, t || case when ord % 4 <> 0 then '?' else '' end as question,
    case when ord % 7 = 2 then 'UNANSWERABLE' when ord % 5 = 0 then 'In 1,234 of 56% cases.' when ord % 9 < 5 then t else b end as answer,
    ['easy', 'hard', 'unanswerable'][ord % 3 + 1] as difficulty, case when ord % 11 = 0 then 'calc' else 'qa' end as kind, k, evidence_text, lo, hi, ord % 22 = 0 as has_derived from items)"""
_LOC = "'(?i)" + T.LOCATION + "'"
_SP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_NUM = "(-?\\p{Nd}{1,3}(,\\p{Nd}{3})*(\\.\\p{Nd}+)?(%|‰)?)"
#: RE2 has no lookbehind: a token may not follow a letter, digit or underscore, so the character before is taken too.
_NUMBERS = "regexp_extract_all(answer, '(?:^|[^A-Za-z0-9_])" + _NUM + "', 1)"
_DISTINCT = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_LOOSE = "list_filter((" + _DISTINCT.replace("{0}", _NUMBERS) + ")[1:6], lambda x: not contains(replace(evidence_text, ',', ''), replace(x, ',', '')))"

QUERIES = {
    "gate_reasons": q_gate, "question_fault": q_question, "evidence_ok": q_evidence, "calc_fault": q_calc, "number_tokens": q_numbers,
    "grounding": q_grounding, "text_flags": q_flags, "citation_check": q_citations,
}
ORACLES = {
    "gate_reasons": f"""with {SECTION_ITEMS},
r as (
  select ord, [
    case when {_SP.format('question')} = '' then 'empty_question' end, case when {_SP.format('answer')} = '' then 'empty_answer' end,
    case when not contains(question, '?') and not contains(question, '？') then 'missing_question_mark' end,
    case when regexp_matches(question, {_LOC}) then 'prohibited_location_in_question' end, case when regexp_matches(answer, {_LOC}) then 'prohibited_location_in_answer' end,
    case when difficulty <> 'unanswerable' and length({_SP.format('answer')}) > {ANSWER_CHARS} then 'answer_too_long' end,
    case when difficulty = 'easy' and k <> 1 then 'easy_requires_exactly_1_evidence_section' end,
    case when difficulty = 'hard' and k < 2 then 'hard_requires_at_least_2_evidence_sections' end,
    case when difficulty = 'hard' and not (k >= 2 or hi - lo >= {CHAR_SPAN}) then 'hard_page_span_too_small' end,
    case when kind = 'qa' and difficulty <> 'unanswerable' and len({_LOOSE}) > 0 then 'answer_number_not_in_evidence:' || ({_LOOSE})[1] end,
    case when kind = 'calc' and difficulty = 'unanswerable' then 'unanswerable_cannot_be_calc' end,
    case when kind = 'calc' and not has_derived then 'calc_missing_derived' end,
    case when kind = 'calc' and has_derived and not contains(replace(evidence_text, ',', ''), '12') then 'calc_inputs_not_grounded_in_evidence' end,
    case when difficulty = 'unanswerable' and {_SP.format('answer')} <> 'UNANSWERABLE' then 'unanswerable_answer_token_mismatch' end] as rs from debug_items)
select ord, array_to_string(list_filter(rs, lambda x: x is not null), '|') as reasons from r""",
    "question_fault": f"""with {SECTION_ITEMS}
select ord, case when {_SP.format('question')} = '' then 'empty_question' when {_SP.format('answer')} = '' then 'empty_answer'
  when regexp_matches(question, {_LOC}) or regexp_matches(answer, {_LOC}) then 'prohibited_location'
  when not contains(question, '?') and not contains(question, '？') then 'missing_question_mark'
  when difficulty = 'unanswerable' and {_SP.format('answer')} <> 'UNANSWERABLE' then 'unanswerable_answer_token_mismatch' end as fault from debug_items""",
    "evidence_ok": f"""with {SECTION_ITEMS}
select ord, case difficulty when 'easy' then k = 1 when 'unanswerable' then true else k >= 2 end as ok,
  case when regexp_matches(question, {_LOC}) or regexp_matches(answer, {_LOC}) then 'prohibited_location'
    when difficulty = 'unanswerable' and {_SP.format('answer')} <> 'UNANSWERABLE' then 'unanswerable_answer_token_mismatch'
    when difficulty <> 'unanswerable' and len({_LOOSE}) > 0 then 'answer_number_not_in_evidence'
    when difficulty = 'easy' and k <> 1 then 'easy_requires_exactly_1_chunk' when difficulty = 'hard' and k < 2 then 'hard_requires_more_chunks' end as fault
from debug_items""",
    "calc_fault": """with i as (
  select doc_id as ord, case doc_id % 13 when 0 then '' when 1 then 'Sum of page 3?' when 2 then 'What is the sum' else 'What is the sum?' end as q, ['easy', 'hard', 'unanswerable', 'hard'][doc_id % 4 + 1] as difficulty,
    case doc_id % 11 when 0 then '' when 1 then 'r = 1 + 2' when 2 then 'r = INPUTS[''a'']' when 3 then 'r = INPUTS["a"] + INPUTS[ ''a'' ]' else 'r = INPUTS[''a''] + INPUTS[''b'']' end as code,
    case doc_id % 7 when 1 then 1 when 3 then 0 else 2 end as n, doc_id % 7 = 0 as nameless, doc_id % 7 = 2 as odd, case when doc_id % 11 < 2 then '' when doc_id % 11 < 4 then 'a' else 'a,b' end as keys from documents)
select ord, case when q = '' then 'empty_question' when contains(q, 'page 3') then 'prohibited_location' when not contains(q, '?') then 'missing_question_mark'
  when difficulty = 'unanswerable' then 'calc_not_allowed_for_this_difficulty' when code = '' then 'empty_code' when not contains(code, 'INPUTS') then 'code_must_reference_INPUTS'
  when not contains(code, '+') then 'code_must_include_arithmetic' when n < case difficulty when 'hard' then 2 else 1 end then 'bad_number_of_inputs' when nameless then 'bad_input_name' when odd then 'bad_input_value'
  when difficulty = 'hard' and keys <> 'a,b' then 'hard_calc_must_use_at_least_2_INPUTS_keys' end as fault, keys from i""",
    "number_tokens": f"""with t as (select doc_id, {_NUMBERS.replace('answer', 'text')} as n from documents)
select doc_id, array_to_string(({_DISTINCT.replace('{0}', 'n')})[1:8], ' ') as numbers from t""",
    "grounding": f"""with h as (select doc_id, substr(text, greatest(length(text) // 2, 1)) as answer, substr(text, 1, length(text) // 2) as evidence from documents),
t as (select doc_id, evidence, {_NUMBERS} as n from h)
select doc_id, len(list_filter(({_DISTINCT.replace('{0}', 'n')})[1:6], lambda x: not contains(replace(evidence, ',', ''), replace(x, ',', '')))) = 0 as grounded from t""",
    "text_flags": f"""select doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) >= 1 and len(list_filter(list_filter(string_split(text || chr(10) || '|---|---', chr(10)), lambda x: trim(x) <> '')[1:8], lambda x: starts_with(x, '|---'))) > 0 as is_table,
  contains(text, '|') and contains(text, chr(10)) as has_rows, regexp_matches(text, {_LOC}) as names_location, 'en' as language, 'en' as service_language from documents""",
    "citation_check": f"""with c as (select doc_id, {_CITED.format(t="text", g=", 'g'")} as s from documents),
t as (select doc_id, {_SP.format('s')} as s, list_transform(regexp_extract_all(s, '\\[([0-9]+)\\]', 1), lambda x: x::bigint) as e from c),
m as (select *, regexp_replace(s, '\\[[0-9]+\\]', '', 'g') as rest,
  regexp_replace(s, '[.!?;]\\s*\\[[0-9]+\\]', '', 'g') as uncited from t)
select doc_id, case when regexp_matches(s, '{T.OTHER_CITATION}') then 'uses_non_square_bracket_citation_mark' when len(e) = 0 then 'missing_citations'
    when contains(rest, '[') or contains(rest, ']') then 'malformed_brackets'
    when regexp_matches(uncited, '[。！？；]|(^|[^\\p{{Nd}}])[.!?;]($|[^\\p{{Nd}}])') then 'missing_sentence_end_citation' end as fault,
  md5({_SP.format("regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '\\[[0-9]+\\]', '', 'g'), '[ \\t]+', ' ', 'g'), '\\s+\\n', chr(10), 'g'), '\\n\\s+', chr(10), 'g')")}) as plain_md5 from m""",
}
