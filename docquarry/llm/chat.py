"""Chat formatting by schema fingerprints (DataFrame functions only).

A record arrives in any of several layouts: messages, from/value exchanges, instruction and input, prompt
and completion, question and answer, each with or without a system prompt. Its schema fingerprint is a hash
of the nested field paths that it fills; the fingerprint selects a declarative mapping (a list of turns,
each a role and the paths of its text), and the mapping yields canonical turns (role, text). A record with a
fingerprint that no mapping has is returned with layout null and no turns.

The template writes a turn as `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts a backslash is
doubled, and every control string is broken up by a backslash after its first character, so a formatted
conversation holds control strings only where the template put them. Dropping one backslash before any
character reverses that. The loss mask lists the spans of assistant texts, in code points.

A conversation becomes one string, so its turns meet in one task; a longer one needs a larger task there.

Defined results: null text or role is the empty string; empty texts make turns of their own; turns that tie
on their number are ordered by role, then text; repeated rows are repeated turns; rows with a null
conversation id form one conversation; an empty table gives only what the caller adds; other columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import let, only, table

START, END = "<|im_start|>", "<|im_end|>"
#: What escaping breaks up: its first character, then the rest. `<|` covers all that begin so.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"
#: Roles as the exchange layout names them.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

_TURN = "array<struct<role:string,content:string,`from`:string,value:string>>"
#: Every field that a mapping reads; a record may hold others.
RECORD = (
    f"struct<messages:{_TURN},conversations:{_TURN},system:string,instruction:string,input:string,output:string,"
    "prompt:string,completion:string,response:string,question:string,answer:string>"
)
PATHS = (
    "messages[].role", "messages[].content", "conversations[].from", "conversations[].value", "system", "instruction",
    "input", "output", "prompt", "completion", "response", "question", "answer",
)
FIELDS = ("messages", "conversations", "system", "instruction", "input", "output", "prompt", "completion", "response", "question", "answer")
#: Layout -> its turns. A turn is (role, text path, ...) with texts joined by a blank line, or
#: ("*", role path, text path) for a list of turns.
LAYOUTS = {
    "messages": [("*", "messages[].role", "messages[].content")],
    "exchange": [("*", "conversations[].from", "conversations[].value")],
    "instruction": [("user", "instruction"), ("assistant", "output")],
    "instruction_input": [("user", "instruction", "input"), ("assistant", "output")],
    "completion": [("user", "prompt"), ("assistant", "completion")],
    "response": [("user", "prompt"), ("assistant", "response")],
    "question": [("user", "question"), ("assistant", "answer")],
}


def _used(turns: list[tuple[str, ...]]) -> list[str]:
    return [p for t in turns for p in t[1:]]


def _filled(record: Column, path: str) -> Column:
    if "[]." in path:
        name, leaf = path.split("[].")
        return F.coalesce(F.exists(record[name], lambda t: t[leaf].isNotNull()), F.lit(False))
    return record[path].isNotNull()


def fingerprint(record: Column) -> Column:
    """Hash of the filled field paths, without `system`, which any layout may have."""
    return F.xxhash64(F.concat_ws("\n", *(F.when(_filled(record, p), p) for p in PATHS if p != "system")))


def _mark(paths: list[str]) -> Column:
    return F.xxhash64(F.lit("\n".join(p for p in PATHS if p in paths)))


def _turn(role: Column, text: Column) -> Column:
    role = F.coalesce(role, F.lit(""))
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(record: Column, turns: list[tuple[str, ...]]) -> Column:
    if turns[0][0] == "*":
        (name, role), leaf = turns[0][1].split("[]."), turns[0][2].split("[].")[1]
        ours = lambda r: F.coalesce(*(F.when(r == a, b) for a, b in ROLES.items()), r) if role == "from" else r
        rows = F.transform(record[name], lambda t: _turn(ours(t[role]), t[leaf]))
    else:
        rows = F.array(*(_turn(F.lit(role), F.concat_ws("\n\n", *(record[p] for p in paths))) for role, *paths in turns))
    first = F.when(record["system"].isNotNull(), F.array(_turn(F.lit("system"), record["system"]))).otherwise(F.slice(rows, 1, 0))
    return F.concat(first, rows)


def layout(record: Column) -> Column:
    """Name of the mapping that the record's fingerprint selects, or null."""
    found = [F.when(fingerprint(record) == _mark(_used(turns)), name) for name, turns in LAYOUTS.items()]
    return F.coalesce(*found)


def canonical_turns(record: Column, name: Column) -> Column:
    none = F.array().cast("array<struct<role:string,text:string>>")
    return F.coalesce(*(F.when(name == key, _mapped(record, turns)) for key, turns in LAYOUTS.items()), none)


def read_records(frame: DataFrame, column: str) -> DataFrame:
    """Adds `record`, parsed from a JSON column; malformed JSON gives a record that fills no path."""
    return frame.withColumn("record", F.coalesce(F.from_json(F.col(column), RECORD), F.from_json(F.lit("{}"), RECORD)))


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def _pieces(turns: Column) -> Column:
    """Array of (head, body, loss): what the template writes of each turn before its end marker."""
    head = lambda t: F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    return F.transform(turns, lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("loss")))


def format_chats(frame: DataFrame) -> DataFrame:
    """Adds layout, turns, formatted and loss_spans (start, end; end exclusive) to a frame with `record`."""
    told = frame.withColumn("layout", layout(F.col("record")))
    told = told.withColumn("turns", canonical_turns(F.col("record"), F.col("layout")))
    end = END + "\n"

    def rendered(pieces: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

        def step(a: Column, p: Column) -> Column:
            start = a["at"] + F.length(p["head"])
            stop = start + F.length(p["body"])
            span = F.array(F.struct(start.cast("long").alias("start"), stop.cast("long").alias("end")))
            return F.struct((stop + len(end)).cast("long").alias("at"), F.when(p["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

        text = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(end))), "")
        return F.struct(text.alias("formatted"), F.aggregate(pieces, empty, step)["spans"].alias("loss_spans"))

    told = told.withColumn("__r", let(_pieces(F.col("turns")), rendered))
    return told.withColumns({"formatted": F.col("__r.formatted"), "loss_spans": F.col("__r.loss_spans")}).drop("__r")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, "<\\|im_end\\|>\n"), lambda p: p != "")
    head = lambda p: F.regexp_extract(p, "(?s)^<\\|im_start\\|>((?:[^\\\\\n]++|\\\\.)*+)\n", 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(head(p)).alias("role"),
            unescape(F.substr(p, F.length(head(p)) + F.lit(len(START) + 2))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


#: How conversations are recorded: each layout for one in so many, by a hash of the id, where it can hold the turns.
RECORDED = ("messages", "exchange", "instruction_input", "instruction", "completion", "response", "question")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): rows (conv_id, turn, role, text) as one record each, as sources of different kinds would
    deliver them. Which layout is the conversation's depends on its id; what the layout can't hold (other turns
    than a user's and an assistant's, perhaps after a system's; roles that would be renamed) becomes messages."""
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = only(rows, "conv_id", "turn", "role", "text").groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("rows"))
    own = dict(zip(ROLES.values(), ROLES, strict=True)) | {ASSISTANT: "gpt"}
    role = F.transform("rows", lambda r: r["role"])
    system = F.get("rows", F.lit(0))["role"] == "system"
    rest = F.when(system, F.slice("rows", 2, 1_000_000_000)).otherwise(F.col("rows"))
    plain = (F.size(rest) == 2) & (F.get(rest, F.lit(0))["role"] == "user") & (F.get(rest, F.lit(1))["role"] == ASSISTANT)
    asked, answer = F.get(rest, F.lit(0))["text"], F.get(rest, F.lit(1))["text"]
    cut_at = F.position(F.lit("\n\n"), asked)
    none = F.lit(None).cast("string")
    turn = lambda **c: F.struct(*(c.get(n, none).alias(n) for n in ("role", "content", "from", "value")))
    renamed = lambda r: F.coalesce(*(F.when(r == a, b) for a, b in own.items()), r)
    head = F.when(system, F.get("rows", F.lit(0))["text"])
    fields = {
        "messages": (F.lit(True), {"messages": F.transform("rows", lambda r: turn(role=r["role"], content=r["text"]))}),
        "exchange": (~F.exists(role, lambda r: r.isin(*ROLES)), {"conversations": F.transform("rows", lambda r: turn(**{"from": renamed(r["role"]), "value": r["text"]}))}),
        "instruction_input": (plain & (cut_at > 0), {"system": head, "instruction": F.substr(asked, F.lit(1), cut_at - 1), "input": F.substr(asked, cut_at + 2), "output": answer}),
        "instruction": (plain, {"system": head, "instruction": asked, "output": answer}),
        "completion": (plain, {"system": head, "prompt": asked, "completion": answer}),
        "response": (plain, {"system": head, "prompt": asked, "response": answer}),
        "question": (plain, {"system": head, "question": asked, "answer": answer}),
    }
    empty = F.from_json(F.lit("{}"), RECORD)
    record = lambda filled: F.struct(*(F.coalesce(filled[n], empty[n]).alias(n) if n in filled else empty[n].alias(n) for n in FIELDS))
    chosen = F.pmod(F.xxhash64("conv_id"), F.lit(len(RECORDED)))
    picked = F.coalesce(*(F.when((chosen == i) & fields[name][0], record(fields[name][1])) for i, name in enumerate(RECORDED)), record(fields["messages"][1]))
    return grouped.select("conv_id", picked.alias("record"))


PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE).alias("text")
    )
    formatted = format_chats(conversation_records(rows.unionByName(probe))).select("conv_id", "formatted", "loss_spans")
    read = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escape_sql(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in CONTROL:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


SQL = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7::bigint, 0::bigint, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
t as (select conv_id, turn, role, text from rows),
f as (select *, length('{START}') + length(replace({_escape_sql('role')}, chr(10), '\\' || chr(10))) + 1 + length({_escape_sql('text')}) + length('{END}') + 1 as n from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = '{ASSISTANT}'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{ASSISTANT}'), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars
from f group by conv_id
"""
