"""License scans by template markup.

A template is plain wording with `<<opt>> ... <</opt>>` around what may be left out and `<<var:N>>` for up to
N replaceable words. It is compiled into an automaton over words: mandatory wording is a chain of exact
words, an optional region an empty transition around it, a replaceable region a chain of any-word steps that
can be left after each. A text is accepted where the whole automaton is passed from a first word on; of the
ways from one start the longest counts.

The base places are phrases, that is templates without markup, and run on the same automata.

A worker holds one batch of texts and matches one text at a time. Texts that lack every stem that the
templates start from are only counted.

Defined results: null is the empty text; texts without words have n_words 0 and no labels; places may
overlap and all count; repeated rows give repeated results; texts are scanned whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docquarry.llm.common import only, table

#: Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label -> template.
TEMPLATES = {
    "apache-2.0": "licensed under <<opt>>the terms of<</opt>> <<opt>>the<</opt>> apache <<opt>>software<</opt>> license <<opt>>version<</opt>> 2.0",
    "cc-by-nc-nd": "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> cc by nc nd <<opt>><<var:2>> license<</opt>>",
    "cc-by-nc-sa": "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> cc by nc sa <<opt>><<var:2>> license<</opt>>",
    "cc-by-nc": "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> cc by nc <<opt>>4.0<</opt>> <<opt>>license<</opt>>",
    "cc-by-sa": "licensed under <<opt>>a<</opt>> <<opt>>the<</opt>> cc by sa <<opt>>4.0<</opt>> <<opt>>license<</opt>>",
    "gpl-grant": "licensed under <<opt>>the terms of<</opt>> the gnu <<opt>>lesser<</opt>> general public license <<opt>>version <<var:2>><</opt>>",
    "gpl-notice": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation <<opt>>either<</opt>> version <<var:2>> of the license",
    "mit-grant": "<<opt>>released<</opt>> <<opt>>licensed<</opt>> <<opt>>distributed<</opt>> under <<opt>>the terms of<</opt>> the mit <<opt>>open source<</opt>> license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<opt>>the software<</opt>> to deal in <<var:2>> software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of <<var:2>> software",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
}
#: A text that holds none of these has no place where a template or phrase could start.
STEMS = (b"licen", b"permission", b"redistribut")
_CC = re.compile(rb"cc[^0-9a-z\x80-\xff]+by")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK = re.compile(r"<<(/?opt|var:\d+)>>|([0-9a-z]+)")


class Automaton:
    """Words to read from each state, with None for any word; empty moves are followed beforehand."""

    def __init__(self, template: str) -> None:
        self.moves: list[list[tuple[bytes | None, int]]] = [[]]
        self.skips: list[set[int]] = [set()]
        self.mandatory = 0
        opened: list[int] = []
        at = 0
        for mark, word in _MARK.findall(template):
            if word:
                self.mandatory += not opened
                at = self._step(at, word.encode())
            elif mark == "opt":
                opened.append(at)
            elif mark == "/opt":
                self.skips[opened.pop()].add(at)
            else:
                starts = [at]
                for _ in range(int(mark.split(":")[1])):
                    at = self._step(at, None)
                    starts.append(at)
                for s in starts[:-1]:
                    self.skips[s].add(at)
        if opened:
            raise ValueError(f"an optional region isn't closed: {template}")
        self.final = at
        self.closed = [self._closure(i) for i in range(len(self.moves))]
        self.firsts = {w for s in self.closed[0] for w, _ in self.moves[s]}
        if None in self.firsts or self.final in self.closed[0]:
            raise ValueError(f"a template starts with a word of its own: {template}")

    def _step(self, at: int, word: bytes | None) -> int:
        self.moves.append([])
        self.skips.append(set())
        self.moves[at].append((word, len(self.moves) - 1))
        return len(self.moves) - 1

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            new = self.skips[todo.pop()] - seen
            seen |= new
            todo += new
        return frozenset(seen)

    def match(self, words: list[bytes], start: int) -> int:
        """End of the longest match from `start`, or -1."""
        states, end = self.closed[0], -1
        for i in range(start, len(words)):
            ahead: set[int] = set()
            for s in states:
                for word, to in self.moves[s]:
                    if word is None or word == words[i]:
                        ahead |= self.closed[to]
            if not ahead:
                break
            states = frozenset(ahead)
            if self.final in states:
                end = i + 1
        return end


@cache
def _compiled() -> dict[bytes, list[tuple[str, Automaton, bool]]]:
    """Automata (label, automaton, whether it is a base phrase) by the words that they can start with."""
    firsts: dict[bytes, list[tuple[str, Automaton, bool]]] = {}
    for base, source in ((True, {v: k for k, v in BASE.items()}), (False, TEMPLATES)):
        for label, template in source.items():
            a = Automaton(template)
            for w in a.firsts:
                firsts.setdefault(w, []).append((label, a, base))
    return firsts


def count_words(text: bytes) -> int:
    inside = _IS_WORD[np.frombuffer(text, np.uint8)]
    return int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()) if len(inside) else 0


def scan(text: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
    """Base places (start word, label) and template places (start word, end word, label, weight)."""
    low = text.lower()
    if not any(s in low for s in STEMS) and not _CC.search(low):
        return [], []
    words = _WORD.findall(low)
    firsts = _compiled()
    base, found = [], []
    for i, w in enumerate(words):
        for label, a, is_base in firsts.get(w, ()):
            end = a.match(words, i)
            if end >= 0:
                if is_base:
                    base.append((i, label))
                else:
                    found.append((i, end, label, 1 - 1 / (1 + a.mandatory)))
    return base, found


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places)."""
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1):
                raw = text.as_py() or b""
                base, found = scan(raw)
                starts = [i for i, _ in base]
                labels = {label for _, label in base}
                score = max([0.5 * bool(base), *(w for *_, w in found)])
                out.append(
                    (
                        count_words(raw),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(labels)),
                        ",".join(sorted(labels | {f[2] for f in found})),
                        score,
                        [{"start": i, "end": j, "label": label} for i, j, label, _ in found],
                    )
                )
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(place))
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    read = only(docs, "doc_id", "text").selectExpr("doc_id", "cast(text as binary) as text")
    return read.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<start:long,end:long,label:string>>",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("places")


#: The labels of the method come from automata, which SQL can't run; tests hold them against brute force.
SQL = None
