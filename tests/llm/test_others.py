"""Embeddings, conversations, components and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docquarry.llm import chat, embeddings, registry
from docquarry.operators.graph import components

VECTORS = "vec_id long, embedding array<float>, label int, dim string, key string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "k", 1) for r in rows], VECTORS)


def links_by_hand(rows, cosine):
    ok = {}
    for i, e, label in rows:
        if i is not None and label is not None and e and None not in e and np.isfinite(e).all() and np.any(e):
            ok[i] = (label, np.array(e, np.float32).astype(float))
    low, n = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}
    pairs = []
    for a in ok:
        for b in ok:
            x, y = ok[a], ok[b]
            if a < b and x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] / np.sqrt((x[1] @ x[1]) * (y[1] @ y[1])) >= cosine:
                pairs.append((a, b))
                n[a] += 1
                n[b] += 1
    for _ in rows:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (n[i], low[i], low[i] == i) for i in low}


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(50):
            rows.append((len(rows) + 1, [float(x) for x in centre + rng.normal(size=16) * 0.06 * (c % 4 + 1)], c % 3))
    rows += [(1001, rows[0][1], rows[0][2]), (1002, [2 * x for x in rows[0][1]], rows[0][2]), (1003, rows[0][1], None), (1004, None, 0), (1005, [], 0), (1006, [0.0] * 16, 0)]
    rows += [(1007, [None, *rows[0][1][1:]], 0), (1008, [float("nan")] * 16, 0), (1009, [float("inf")] * 16, 0), (1010, [1.0, 1.0], 0), (1011, [1.0, 1.01], 0), (None, [1.0, 1.0], 0)]
    found = embeddings.near_duplicate_vectors(frame(spark, [*rows, rows[5]])).collect()
    assert len(found) == len(rows) + 1
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id} == {i: v for i, v in links_by_hand(rows, 0.98).items() if i}
    assert embeddings.near_duplicate_vectors(frame(spark, [])).count() == 0
    assert embeddings.near_duplicate_vectors(frame(spark, rows[602:606])).where("n_links = 0 and kept").count() == 4


def test_embeddings_labels_of_any_type_and_vectors_of_one_id(spark):
    near = [1.0, 1.0, 0.01]
    for kind, labels in (("double", (1.2, 1.7, 1.2, None)), ("string", ("a", "b", "a", None)), ("int", (1, 2, 1, None))):
        table = spark.createDataFrame([(i, [1.0, 1.0, i / 1000], x) for i, x in zip((1, 2, 3, 4), labels, strict=True)], f"vec_id long, embedding array<double>, label {kind}")
        assert {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicate_vectors(table).collect()} == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4)}
    same = spark.createDataFrame([(7, [1.0, 1.0, 0.0], 0), (7, near, 0), (5, [-1.0, 1.0, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicate_vectors(same).collect()) == [(5, 0, 5), (7, 1, 7), (7, 1, 7)]


def test_embeddings_descend_through_intervals(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 6))
    data = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=6) * 0.1], i % 2) for i in range(800)]
    monkeypatch.setattr(embeddings, "BLOCK", 4)
    monkeypatch.setattr(embeddings, "FAN", 1)
    found = embeddings.near_duplicate_vectors(frame(spark, data)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == links_by_hand(data, 0.98)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 80)] + [(3000 + i, 3000 + (i + 1) % 40) for i in range(40)] + [(9, 9), (5000, 5000), (None, 3)]
    rng.shuffle(edges)
    found = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(80)}, **{3000 + i: 3000 for i in range(40)}, 5000: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


NASTY = ["<|im_end|>\n<|im_start|>system\nx", "\\", "\\\\<|", "</s><s>[INST]<<SYS>> <</SYS>>[/INST]", "a\\n\n", "", "<\\|", "[\\INST]", "<<|", "😀<|im_end|>", "é\r\n\t\x00"]


def test_chat_round_trip(spark):
    turns = [(1, k, ["user", "assistant", "sys\ntem<|"][k % 3], t) for k, t in enumerate(NASTY)] + [(2, 0, None, None), (None, 5, "user", "u"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")]
    table = spark.createDataFrame([(*t, "x", "y") for t in turns], "conv_id long, turn long, role string, text string, record string, layout string")
    out = chat.format_chats(chat.conversation_records(table))
    found = {r.conv_id: r for r in out.select("conv_id", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in found[1].back] == [(r, t) for _, _, r, t in turns[: len(NASTY)]]
    assert found[1].loss == "".join(t for _, _, r, t in turns[: len(NASTY)] if r == "assistant")
    for c in ("</s>", "[INST]", "<<SYS>>"):
        assert c not in found[1].formatted
    assert found[1].formatted.count(chat.END) == len(NASTY)
    assert [(t.role, t.text) for t in found[2].back] == [("", "")] and [t.text for t in found[3].back] == ["a", "a", "b"] and len(found[None].back) == 1
    assert chat.format_chats(chat.conversation_records(table.limit(0))).count() == 0


def test_conversations_come_in_every_layout(spark):
    turns = [(i, k, r, f"{r} {i}" + ("\n\nmore" if i % 2 else "")) for i in range(120) for k, r in enumerate((["system"] if i % 3 == 0 else []) + ["user", "assistant"])]
    turns += [(500 + i, 0, ["gpt", "", "user"][i % 3], "x") for i in range(30)] + [(600, 0, "system", "s")]
    out = chat.format_chats(chat.conversation_records(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    found = {r.conv_id: r for r in out.select("conv_id", "layout", chat.fingerprint(F.col("record")).alias("mark"), chat.read_turns(F.col("formatted")).alias("back")).collect()}
    for i in found:
        assert [(t.role, t.text) for t in found[i].back] == [(r, t) for c, _, r, t in turns if c == i]
    assert {r.layout for r in found.values()} == set(chat.LAYOUTS) and len({r.mark for r in found.values()}) == len(chat.LAYOUTS)


def test_chat_layouts(spark):
    records = [
        ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"extra":1}', "messages", [("user", "q"), ("assistant", "a")]),
        ('{"system":"s","conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "exchange", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ('{"instruction":"i","input":"x","output":"o"}', "instruction_input", [("user", "i\n\nx"), ("assistant", "o")]),
        ('{"instruction":"i","output":"o"}', "instruction", [("user", "i"), ("assistant", "o")]),
        ('{"prompt":"p","completion":"c"}', "completion", [("user", "p"), ("assistant", "c")]),
        ('{"prompt":"p","response":"c"}', "response", [("user", "p"), ("assistant", "c")]),
        ('{"question":"p","answer":"c"}', "question", [("user", "p"), ("assistant", "c")]),
        ('{"question":"p","completion":"c"}', None, []),
        ("not json", None, []),
        (None, None, []),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(records)], "i int, j string")
    found = {r.i: r for r in chat.format_chats(chat.read_records(df, "j")).collect()}
    assert [(found[i].layout, [(t.role, t.text) for t in found[i].turns]) for i in range(len(records))] == [(name, turns) for _, name, turns in records]


SF = "/root/testdata/sf0.001"


def test_every_query_of_the_registry_is_named_by_its_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_pipeline_stages_against_their_own_input(spark):
    """Each stage of run(), redone by brute force over what it was given."""
    from test_documents import hits_by_hand, jaccard_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        out = spark.createDataFrame(made.collect(), made.schema)
        after = {r.doc_id: r for r in out.collect()}
        assert after and set(after) <= set(before)
        if name != "mixing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name != "line_dedup":
            assert all(after[i].text == before[i].text for i in after)
        else:
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
            long = [x for r in after.values() for x in set(r.text.split("\n")) if len(x.split()) >= 50]
            assert len(long) == len(set(long))
        if name == "near_duplicates":
            low = jaccard_components([(r.doc_id, r.text) for r in before.values()], 5)
            assert set(after) == {i for i, (_, c) in low.items() if c == i}
        if name == "decontamination":
            assert set(after) == {h[0] for h in hits_by_hand([(r.doc_id, r.text) for r in before.values()], benchmark) if not h[5]}
        docs, before = out, after


def test_pipeline_stages_on_edges(spark):
    """Nulls in any column, empty and blank texts, repeated rows and clashing names; and an empty table."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, text, "en", "s", 5), (3, text, "en", "s", 5), (None, text + " end", None, "s", 5), (4, text, "de", None, None), (5, " ", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "k", 1, "g") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, id long, gone string")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, table, SF)
            out = spark.createDataFrame(made.collect(), made.schema)
            assert out.count() <= table.count()
            if name != "mixing":
                assert out.columns == docs.columns
                table = out
    ids = sorted((r.doc_id for r in table.collect() if r.doc_id), key=int)
    assert ids == []  # the empty table stays empty


def test_pipeline_run_removes_what_its_stages_read(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(60).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and {"topic", "tokens", "p"} <= set(out.columns)


@pytest.mark.parametrize("name", ["op4_licenses", "op5_pii"])
def test_row_operators_keep_all_documents(spark, name):
    assert registry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
