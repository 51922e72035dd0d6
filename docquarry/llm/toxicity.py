"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are read as classes: insult, threat, target, negation, reported speech, quotation mark, clause end,
other. Four transducers pass the class string on and rewrite it. The first marks insults and threats inside
quotation marks (opened and closed on one line) as quoted; the second marks those after a verb of reporting in
their clause; the third those within a few words after a negation. The last accepts clauses: at a clause's end
it tells whether the clause holds a target. Their composition is one transducer, whose states are tuples.

What is scored are matched clauses, each for its kind: a direct insult (an insult that is neither negated,
quoted nor reported, in a clause with a target), a threat (likewise), a bare insult (in a clause without a
target), and softened ones (negated, quoted or reported). A threat without a target matches no clause. The
strength of a kind is the sum of the word weights of its clauses; a logistic curve over the strengths and the
length of the text gives the score. How much each kind counts is learned, starting from a grammar in which the
main weight is that of direct insults and threats. (In the sample tables toxic documents hold bare insults, none
with a target; there the weight of bare clauses comes from the labels. Without labels they count little.)

The insult class is learned too: prefixes of words for which documents that hold one, two or three such words
are far more often toxic (log odds of document frequencies), each prefix as long as it can be without losing
documents. A word weighs what the number of such words so far adds to the odds. Labels are read for training
only, never from rows whose crc32(doc_id as text) mod 4 is 2, from at most `SAMPLE` labelled documents, those
with the lowest hash of their id; near copies among them count once. That bound is the only one: every prefix with the support and odds asked for
is in the lexicon, and every document is scored whole, by its text alone.

Defined results: null and empty texts get the score of a text without any pattern; several labels of one
document count as toxic if one is; without labels, a list of common English insults is used; repeated rows get
equal scores; an empty table gives no rows; other columns pass through, except that one named score is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import cut, let, only, passing, table

#: Labelled documents to learn from, at most.
SAMPLE = 20_000
#: Toxic documents that must hold a prefix; log odds that it must reach at some number of words; prefix
#: lengths; numbers of words with a prefix that are told apart; weight of each word beyond.
SUPPORT, ODDS, LENGTHS, TIMES, BEYOND = 6, 2.5, range(3, 13), 3, 0.25
#: A longer prefix with higher odds stands for a shorter one if it keeps this share of its toxic documents.
KEEP = 0.8
THRESHOLD = 0.3

# Closed word classes, a choice of this module.
THREAT = frozenset("kill hurt beat destroy stab shoot punish töten schlagen umbringen tuer frapper matar golpear".split())
TARGET = frozenset("you your yours yourself u du dich dir ihr euch tu toi te vous tú ti usted ustedes they them he him she her".split())
NEGATION = frozenset("not no never nobody isn aren wasn don doesn nicht kein keine nie ne pas jamais non nunca jamás".split())
REPORTED = frozenset("said says wrote writes quoted reported claimed called sagte schrieb berichtete dit écrit rapporte dijo escribió informó".split())
SEED = frozenset("idiot moron stupid loser scum trash pathetic worthless disgusting".split())
SEED_WEIGHT = 4.0
#: Kinds of clauses.
KINDS = ("direct", "threat", "bare", "softened")
#: What learning starts from, and the curve without labels: intercept, slope over log1p(strength) of each kind,
#: slope over log1p(words) where a text has any clause that matches.
DEFAULT_CURVE = (-2.0, 2.0, 2.0, 0.6, 0.2, 0.0)

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:,\n\"“”«»]")
_WORD = re.compile(r"[^\W\d_]+")
_MARKS = frozenset("\"“”«»")


class Transducer:
    """(state, symbol) -> (state, symbol passed on). What isn't listed is passed on as it is; the state then stays,
    or counts down to 0 if it is a number of symbols that is left."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str]], counts_down: bool = False) -> None:
        self.arcs, self.counts_down = arcs, counts_down

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        found = self.arcs.get((state, symbol))
        return found or (max(0, state - 1) if self.counts_down else state, symbol)


class Composed:
    """Composition: each transducer reads what the one before passed on. Arcs are made when first taken and
    kept."""

    def __init__(self, *parts: Transducer) -> None:
        self.parts, self.start, self.arcs = parts, (0,) * len(parts), {}

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str]:
        found = self.arcs.get((state, symbol))
        if found is None:
            after, passed = [], symbol
            for part, s in zip(self.parts, state, strict=True):
                s, passed = part.step(s, passed)
                after.append(s)
            found = self.arcs[state, symbol] = (tuple(after), passed)
        return found


#: Symbols read: I insult, T threat, Y target, N negation, R reported, ( and ) quotation marks that belong
#: together, B clause end, O other. Symbols told: I and T as they are, i and t softened, D the end of a clause
#: with a target, B of one without, O other.
def grammar(reach: int = 4) -> Composed:
    softened = {"I": "i", "T": "t"}
    quotation = Transducer({(0, "("): (1, "O"), (1, ")"): (0, "O")} | {(1, x): (1, y) for x, y in softened.items()})
    reported = Transducer({(s, "R"): (1, "O") for s in (0, 1)} | {(1, "B"): (0, "B")} | {(1, x): (1, y) for x, y in softened.items()})
    left = range(1, reach + 1)
    negation = Transducer(
        {(s, "N"): (reach, "O") for s in (0, *left)} | {(s, "B"): (0, "B") for s in left} | {(s, x): (s - 1, y) for s in left for x, y in softened.items()},
        counts_down=True,
    )
    clause = Transducer({(s, "Y"): (1, "O") for s in (0, 1)} | {(1, "B"): (0, "D")})
    return Composed(quotation, reported, negation, clause)


def paired(tokens: list[str]) -> list[str]:
    """The tokens with quotation marks as ( and ): on each line the first belongs to the second and so on; one
    that is left over is no mark."""
    out, open_at = list(tokens), None
    for i, token in enumerate(tokens):
        if token == "\n":
            open_at = None
        elif token in _MARKS:
            out[i] = ","
            if open_at is None:
                open_at = i
            else:
                out[open_at], out[i], open_at = "(", ")", None
    return out


@dataclass
class Model:
    """insults: prefix -> what its first, second, ... word weighs; curve: intercept and slopes."""

    insults: dict[str, tuple[float, ...]]
    curve: tuple[float, ...]

    def __post_init__(self) -> None:
        self.lengths = sorted({len(p) for p in self.insults})
        self.signs = [*self.insults, *THREAT]
        self.machine = grammar()

    def insult(self, word: str) -> str | None:
        return next((word[:n] for n in self.lengths if n <= len(word) and word[:n] in self.insults), None)

    def _symbol(self, token: str, seen: Counter[str]) -> tuple[str, float]:
        """The class of a token, and the weight of the word."""
        if token in "().!?;\n":
            return (token if token in "()" else "B"), 0.0
        for symbol, known in (("N", NEGATION), ("R", REPORTED), ("Y", TARGET)):
            if token in known:
                return symbol, 0.0
        if token in THREAT:
            return "T", SEED_WEIGHT
        prefix = self.insult(token) if token[0].isalpha() else None
        if prefix is None:
            return "O", 0.0
        steps, times = self.insults[prefix], seen[prefix]
        seen[prefix] += 1
        return "I", steps[times] if times < len(steps) else BEYOND

    def strength(self, text: str) -> dict[str, float]:
        """Strength by kind of clause, and `words`: the number of words and marks, if any clause matches."""
        total = dict.fromkeys((*KINDS, "words"), 0.0)
        low = text.lower()
        if not any(s in low for s in self.signs):
            return total
        state, seen, held = self.machine.start, Counter(), {"I": 0.0, "T": 0.0}
        tokens = paired(_TOKEN.findall(low))
        for token in (*tokens, "\n"):
            symbol, weight = self._symbol(token, seen)
            state, told = self.machine.step(state, symbol)
            if told in held:
                held[told] += weight
            elif told in "it":
                total["softened"] += weight
            elif told in "DB":
                total["direct" if told == "D" else "bare"] += held["I"]
                total["threat"] += held["T"] * (told == "D")
                held = {"I": 0.0, "T": 0.0}
        total["words"] = float(len(tokens)) * any(total.values())
        return total

    def score(self, text: str) -> float:
        found = self.strength(text)
        z = self.curve[0] + sum(w * math.log1p(found[k]) for w, k in zip(self.curve[1:], (*KINDS, "words"), strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def remainder() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(0))


def training_rows(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic): at most `sample` of the labelled documents that aren't held out."""
    known = only(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(remainder() != 2)
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def different(rows: DataFrame) -> DataFrame:
    """Of documents that are near copies of one another (that share one of three least hashes of their shingles of
    three words), the one with the smallest id: what a text says once is counted once, however often it was
    copied."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "\\s+"), lambda w: w != "")
    least = lambda w, seed: F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, 3), F.lit(seed))))
    marked = rows.withColumn("marks", let(words, lambda w: F.array(*(least(w, seed) for seed in (1, 2, 3)))))
    each = marked.select("doc_id", F.posexplode("marks").alias("i", "mark"))
    first = each.groupBy("i", "mark").agg(F.min("doc_id").alias("first"))
    late = each.join(first, ["i", "mark"]).where("doc_id <> first").select("doc_id").distinct()
    return marked.drop("marks").join(late, "doc_id", "left_anti")


Unit = tuple[str, int]


def _units(text: str) -> set[Unit]:
    """(prefix, k) for each prefix that k words have, k up to TIMES."""
    words = Counter(w[: LENGTHS[-1]] for w in _WORD.findall(text.lower()))
    found: Counter[str] = Counter()
    for w, n in words.items():
        for k in LENGTHS:
            if k > len(w):
                break
            found[w[:k]] += n
    return {(u, k) for u, n in found.items() for k in range(1, min(n, TIMES) + 1)}


def _counted(rows: DataFrame) -> DataFrame:
    """(unit, k, n): documents with k words of each prefix; summed by task first. The empty prefix counts the
    documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[Unit] = Counter()
        for batch in batches:
            for cell in batch.column(0):
                found.update(_units(cell.as_py() or ""))
                found["", 1] += 1
        units, times = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(times, pa.int32()), pa.array(list(found.values()), pa.int64())], ["unit", "k", "n"])

    return rows.select("text").mapInArrow(run, "unit string, k int, n long").groupBy("unit", "k").agg(F.sum("n").alias("n"))


def lexicon(units: dict[Unit, tuple[int, float]]) -> dict[str, tuple[float, ...]]:
    """Prefix -> weights of its first, second, ... word, from (toxic documents, log odds) of the strong ones."""
    top: dict[str, float] = {}
    for (u, _), (_, o) in units.items():
        top[u] = max(o, top.get(u, 0.0))
    held = {u: max(n for (v, _), (n, _) in ((key, units[key]) for key in ((u, k) for k in range(1, TIMES + 1)) if key in units)) for u in top}
    # a prefix gives way to a longer one that occurs as often, then covers all longer ones
    weak = {u[:n] for u in top for n in LENGTHS if n < len(u) and u[:n] in top and top[u] >= top[u[:n]] and held[u] >= KEEP * held[u[:n]]}
    chosen: set[str] = set()
    for u in sorted(set(top) - weak, key=len):
        if not any(u[:n] in chosen for n in LENGTHS if n < len(u)):
            chosen.add(u)
    out = {}
    for u in sorted(chosen):
        reached, steps = 0.0, []
        for k in range(1, TIMES + 1):
            new = max(reached, units[u, k][1]) if (u, k) in units else reached
            steps.append(new - reached)
            reached = new
        out[u] = tuple(steps)
    return out


def curve(strengths: list[dict[str, float]], toxic: np.ndarray, ridge: float = 0.01) -> tuple[float, ...]:
    """Logistic intercept and slopes by Newton steps, drawn to the default ones; a kind never counts against
    toxicity."""
    x = np.array([[1.0, *(math.log1p(s[k]) for k in (*KINDS, "words"))] for s in strengths])
    start = np.array(DEFAULT_CURVE)
    w = start.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (toxic - p) - ridge * (w - start))
        w += np.clip(step, -2, 2)
        w[1:-1] = np.maximum(0, w[1:-1])
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def strong(rows: DataFrame) -> dict[Unit, tuple[int, float]]:
    """(prefix, k) -> (toxic documents, log odds) wherever both reach what is asked for."""
    toxic = cut(_counted(rows.where("toxic = 1")).where(f"unit = '' or n >= {SUPPORT}"))
    wanted = toxic.select("unit").distinct()
    clean = _counted(rows.where("toxic = 0")).join(wanted, "unit", "left_semi").select("unit", "k", F.col("n").alias("c"))
    both = cut(toxic.join(clean, ["unit", "k"], "left").select("unit", "k", "n", F.coalesce("c", F.lit(0)).alias("c")))
    whole = both.where("unit = ''").first()
    if whole is None:
        return {}
    odds = F.log((F.col("n") + 0.5) / F.lit(whole["n"] + 1)) - F.log((F.col("c") + 0.5) / F.lit(whole["c"] + 1))
    found = both.where("unit <> ''").withColumn("odds", odds).where(F.col("odds") >= ODDS)
    return {(r["unit"], r["k"]): (r["n"], r["odds"]) for r in found.collect()}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    with passing(docs.sparkSession):
        rows = cut(only(docs, "doc_id", "text").join(F.broadcast(training_rows(labels, sample)), "doc_id"))
        rows = cut(different(rows))
        insults = lexicon(strong(rows))
        if not insults:
            return Model(dict.fromkeys(SEED, (SEED_WEIGHT,)), DEFAULT_CURVE)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model(insults, DEFAULT_CURVE)
            for batch in batches:
                found = [own.strength(c.as_py() or "") for c in batch.column(0)]
                yield pa.RecordBatch.from_arrays([*(pa.array([f[k] for f in found], pa.float64()) for k in (*KINDS, "words")), batch.column(1)], [*KINDS, "words", "toxic"])

        shape = ", ".join(f"{k} double" for k in (*KINDS, "words"))
        seen = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, f"{shape}, toxic int").collect()
        return Model(insults, curve([r.asDict() for r in seen], np.array([r["toxic"] for r in seen], float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row and column of docs with score."""
    insults, fitted = model.insults, model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(insults, fitted)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own.score(c.as_py() or "") for c in text], pa.float64())], [*batch.schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "score")
    return docs.drop("score").mapInArrow(run, f"{fields}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder() == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


#: A trained grammar can't be run in SQL; tests measure it on held-out labels.
SQL = None
