"""Quality by weak labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed scorer.

Every labeller votes good, bad or nothing on a text. Votes are counted by pattern over all documents (at most
3 to the number of labellers patterns, whatever the corpus), and expectation-maximisation over those counts
estimates how each labeller votes on good and on bad texts, and how many are good. A text is bad in one of
several ways (as many as there are labellers), each with vote rates of its own: the labellers' votes depend on
one another, as a text that is bad in one way is good in the others. All rates and shares are estimated; a
labeller that others never bear out ends up as one that errs on good texts. A labeller that casts no vote says
nothing, as that depends on the length of a text.

The posterior of its pattern is a document's weak label. The labels train a logistic scorer on hashed features:
the shapes of its words and the document's measures in steps. It is fitted on at most `SAMPLE` documents, drawn
by a hash of id and text; counting and scoring cover all. Texts are read once, into a narrow table of votes and
features. Human labels aren't read.

Defined results: null is the empty text, on which the length labeller alone votes; repeated rows (also of one
id, or of none) get equal scores; texts are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import cut, only, table

#: What estimation starts from: how often a labeller calls a good text bad, one that is bad in its way, and one
#: that is bad in another way; the share of each way; and how many votes this assumption counts for.
FALSE_ALARM, HIT, OTHER, SHARE, ASSUMED = 0.05, 0.7, 0.1, 0.02, 20
#: Documents that the scorer is fitted on, at most (drawn by hash, about twice as many are gathered); hashed dimensions; words whose hash a task remembers.
SAMPLE, DIMS, MEMORY = 6_000, 1024, 200_000
KEEP = 0.5
_SYMBOL = re.compile(r"[#$%&*~^<>{}\[\]\\|=_+@]")
_STEPS = (0.01, 0.02, 0.05, 0.1, 0.15, 0.25, 0.4, 0.6, 0.8)
MEASURES = ("repeated", "distinct", "symbols", "upper", "tables", "ended", "shouted", "started")


def measures(text: str, words: list[str], counts: Counter[str]) -> dict[str, float]:
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    upper = sum(map(str.isupper, words))
    return {
        "repeated": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        "distinct": len(counts) / n,
        "symbols": len(_SYMBOL.findall(text)) / max(1, len(text)),
        "upper": upper / n,
        "tables": sum(" | " in x for x in lines) / m,
        "ended": sum(x.rstrip()[-1] in ".!?…\"”»" for x in lines) / m,
        "shouted": text.count("!!") / n,
        "started": sum(x.lstrip()[0].isupper() for x in lines) / m,
    }


def _vote(value: float, bad: bool, good: bool) -> int:
    return -1 if bad else int(good)


def votes(n: int, m: dict[str, float]) -> tuple[int, ...]:
    """-1 bad, 1 good, 0 nothing, from each labeller."""
    some, many = n >= 3, n >= 20
    return (
        _vote(n, n < 1, n >= 40),
        _vote(0, some and m["repeated"] > 0.15, many and m["repeated"] < 0.03),
        _vote(0, many and m["distinct"] < (0.25 if n < 2000 else 0.1), many and m["distinct"] > 0.35),
        _vote(0, some and m["symbols"] > 0.04, some and m["symbols"] < 0.01),
        _vote(0, some and m["upper"] > 0.4, many and m["upper"] < 0.15),
        _vote(0, some and m["tables"] > 0.3, many and m["tables"] == 0),
        _vote(0, some and m["ended"] < 0.4, many and m["ended"] > 0.8),
        _vote(0, some and m["shouted"] > 0.1, False),
        _vote(0, some and m["started"] < 0.4, many and m["started"] > 0.8),
    )


LABELLERS = 9


@dataclass
class Agreement:
    """Shares of the classes (the first is good, the others are ways of being bad), and [class, labeller, bad or
    good vote] rates of the votes that are cast."""

    shares: np.ndarray
    rates: np.ndarray

    def classes(self, patterns: np.ndarray) -> np.ndarray:
        """[class, pattern] posteriors."""
        at = (patterns > 0).astype(int)
        own = np.arange(patterns.shape[1])
        logs = np.stack([np.log(p) + np.where(patterns != 0, np.log(r)[own, at], 0).sum(1) for p, r in zip(self.shares, self.rates, strict=True)])
        found = np.exp(logs - logs.max(0))
        return found / found.sum(0)

    def good(self, patterns: np.ndarray) -> np.ndarray:
        return self.classes(patterns)[0]

    def accuracies(self, patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Estimated share of each labeller's votes that are right."""
        weight = np.stack([1 - self.good(patterns), self.good(patterns)]) * counts
        right = np.array([(weight[0] * (v == -1)).sum() + (weight[1] * (v == 1)).sum() for v in patterns.T])
        return right / np.maximum(1e-9, ((patterns != 0) * counts[:, None]).sum(0))


def agreement(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, tolerance: float = 1e-7) -> Agreement:
    """EM over vote patterns, each with its count."""
    k = patterns.shape[1]
    bad = np.full((k + 1, k), OTHER)
    bad[0] = FALSE_ALARM
    bad[np.arange(1, k + 1), np.arange(k)] = HIT
    start = np.stack([bad, 1 - bad], -1)
    now = Agreement(np.array([1 - k * SHARE] + [SHARE] * k), start)
    votes_cast = np.stack([patterns == -1, patterns == 1], -1).astype(float)
    for _ in range(rounds):
        weight = now.classes(patterns) * counts
        shares = (weight.sum(1) + 1) / (counts.sum() + k + 1)
        rates = np.einsum("cp,pkv->ckv", weight, votes_cast) + ASSUMED * start
        rates /= rates.sum(-1, keepdims=True)
        moved = np.abs(shares - now.shares).max() + np.abs(rates - now.rates).max()
        now = Agreement(shares, rates)
        if moved < tolerance:
            break
    return now


def _shape(word: str) -> str:
    out = []
    for c in word:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _slot(feature: str) -> int:
    h = 2166136261
    for b in feature.encode("utf-8", "surrogatepass"):
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % DIMS


class Reader:
    """Votes and hashed features of texts; remembers the slots of words."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = {}

    def slot(self, word: str) -> int:
        found = self.slots.get(word)
        if found is None:
            if len(self.slots) >= MEMORY:
                self.slots.clear()
            found = self.slots[word] = _slot("shape:" + _shape(word))
        return found

    def read(self, text: str) -> tuple[tuple[int, ...], list[str], Counter[str], dict[str, float]]:
        words = text.split()
        counts = Counter(words)
        m = measures(text, words, counts)
        return votes(len(words), m), words, counts, m

    def features(self, n: int, counts: Counter[str], m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Slots in order, and their values."""
        x = np.zeros(DIMS, np.float32)
        if counts:
            at = np.fromiter(map(self.slot, counts), np.int64, len(counts))
            np.add.at(x, at, np.fromiter(counts.values(), np.float32, len(counts)))
            x = np.sqrt(x / n)
        for name in MEASURES:
            x[_slot(f"{name}:{sum(m[name] > s for s in _STEPS)}")] += 1
        x[_slot(f"length:{int(np.log2(n + 1))}")] += 1
        slots = np.flatnonzero(x)
        return slots.astype(np.int16), x[slots]


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Logistic weights, the last one the intercept, by accelerated gradient steps on all rows."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = v = np.zeros(x.shape[1])
    rate = 4 / max(1e-9, float((x * x).sum(1).mean()))
    for i in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v + rate * (x.T @ (y - p) / len(y) - ridge * v)
        v = new + i / (i + 3) * (new - w)
        w = new
    return w


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, drawn, pattern, slots, x) of every row: a hash to draw it by, its votes as digits 0 (bad), 1, 2, and
    its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            out: list[tuple[str, bytes, bytes]] = []
            for cell in batch.column(2):
                vote, words, counts, m = reader.read(cell.as_py() or "")
                slots, x = reader.features(len(words), counts, m)
                out.append(("".join(str(v + 1) for v in vote), slots.tobytes(), x.tobytes()))
            columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.string(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "drawn", "pattern", "slots", "x"])

    read = only(docs, "doc_id", "text").select("doc_id", F.xxhash64("doc_id", "text").alias("drawn"), "text")
    return read.mapInArrow(run, "doc_id long, drawn long, pattern string, slots binary, x binary")


def _votes(pattern: str) -> list[int]:
    return [int(c) - 1 for c in pattern]


@dataclass
class Model:
    weights: np.ndarray
    agreement: Agreement


def train(read: DataFrame, sample: int = SAMPLE) -> Model:
    """The scorer and the labellers' agreement, from described() rows."""
    rows = read.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    if not rows:
        return Model(np.zeros(DIMS + 1), agreement(np.zeros((1, LABELLERS), int), np.zeros(1)))
    agreed = agreement(np.array([_votes(r["pattern"]) for r in rows]), np.array([r["n"] for r in rows], float))

    # by a hash threshold first: what is gathered doesn't grow with the number of partitions
    share = min(1.0, (2 * sample + 1000) / sum(r["n"] for r in rows))
    few = read.where(F.pmod("drawn", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    chosen = lambda frame: frame.orderBy("drawn", "doc_id").limit(sample).select("pattern", "slots", "x").collect()
    seen = chosen(few) or chosen(read)  # rows that are all alike may all lie beyond the threshold
    x = np.zeros((len(seen), DIMS), np.float32)
    for i, r in enumerate(seen):
        x[i, np.frombuffer(r["slots"], np.int16)] = np.frombuffer(r["x"], np.float32)
    return Model(_fit(x, agreed.good(np.array([_votes(r["pattern"]) for r in seen]))), agreed)


def score(read: DataFrame, model: Model) -> DataFrame:
    """(doc_id, weak_label, score, kept) of described() rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weak: dict[str, float] = {}
        for batch in batches:
            patterns = batch.column(1).to_pylist()
            for p in set(patterns) - set(weak):
                weak[p] = float(model.agreement.good(np.array([_votes(p)]))[0])
            scores = []
            for slots, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                z = float(np.frombuffer(x, np.float32) @ model.weights[np.frombuffer(slots, np.int16)] + model.weights[-1])
                scores.append(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([weak[p] for p in patterns], pa.float64()), pa.array(scores, pa.float64()), pa.array([s >= KEEP for s in scores], pa.bool_())],
                ["doc_id", "weak_label", "score", "kept"],
            )

    return read.select("doc_id", "pattern", "slots", "x").mapInArrow(run, "doc_id long, weak_label double, score double, kept boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = cut(described(table(spark, sf_dir, "documents")))
    return score(read, train(read))


#: A trained scorer can't be run in SQL; tests measure it on labels that it never saw.
SQL = None
