"""Personal data: patterns propose spans, validators confirm them, context words adjust their score.

Each kind is searched on its own, leftmost and without overlap; a proposed span that its validator rejects
is dropped and not tried again. Offsets are code points, the end exclusive. Beside the base kinds (email,
ip, card, phone) there are iban (mod-97), ssn (area and group rules, and a context word), key (cloud access
keys by their form) and secret (a value assigned to a password, token or the like).

Patterns run in time linear in the text: an address is found from its @ outwards, dotted numbers and card
numbers are consumed run by run.

Defined results: null is the empty text; no spans give an empty string, whose digest is that of no bytes;
repeated rows give repeated results; texts are scanned whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docquarry.llm.common import only, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "key", "secret")
#: Characters on either side of a span in which context words count.
CONTEXT = 40
#: Kind -> (score of a confirmed span, words that raise it).
SCORES = {
    "email": (0.9, ("mail", "contact", "write", "@", "kontakt", "correo", "courriel")),
    "ip": (0.6, ("ip", "host", "server", "address", "client", "adresse")),
    "card": (0.8, ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta")),
    "phone": (0.7, ("call", "phone", "tel", "mobile", "fax", "telefon")),
    "iban": (0.9, ("iban", "bank", "account", "konto", "compte", "cuenta")),
    "ssn": (0.5, ("ssn", "social security", "social")),
    "key": (0.9, ("key", "aws", "access", "secret")),
    "secret": (0.7, ("password", "token", "secret", "api", "login")),
}
RAISE = 0.1

# Lengths of account numbers by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20, ES=24, FI=18, FO=18,
    FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LI=21, LT=20, LU=20, LV=21,
    MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SE=24, SI=19, SK=24, SM=27, TN=24,
    TR=26, UA=29, VG=24, XK=20,
)

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_KEY = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")
_SECRET = re.compile(r"(?i:password|passwd|pwd|token|secret|api_?key)\s{0,8}[=:]\s{0,8}(?:\"([^\"\s]{8,})\"|([A-Za-z0-9_\-./+]{8,}))")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """What `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+` matches from left to right. The part before
    an @ is as much of the run of its characters as the last match left."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
        else:
            # characters before this @ can't belong to a later address
            done = at + 1
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    """Four parts at a time of each run of dotted numbers."""
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            start = at
            end = start + sum(map(len, four)) + 3
            at = end + 1
            if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in four):
                yield "ip", start, end


def _simple(kind: str, pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable[[str], Iterator[Span]]:
    def find(text: str) -> Iterator[Span]:
        for m in pattern.finditer(text):
            if valid(m.group()):
                yield kind, m.start(), m.end()

    return find


def _card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def _ssn(found: str) -> bool:
    area, group, serial = found.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


cards = _simple("card", _CARD, _card)
phones = _simple("phone", _PHONE, lambda s: 9 <= sum(c in "0123456789" for c in s) <= 15)


def ibans(text: str) -> Iterator[Span]:
    """As many characters as the country's numbers have, single spaces between them aside; no more may follow."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.end()
        rest = IBAN_LENGTHS.get(m.group(1), 0) - 4
        found = re.compile(rf"(?: ?[A-Z0-9]){{{rest}}}(?![A-Za-z0-9])").match(text, at) if rest > 0 else None
        if found and mod97(text[m.start() : found.end()]):
            yield "iban", m.start(), found.end()
            at = found.end()


ssns = _simple("ssn", _SSN, _ssn)
keys = _simple("key", _KEY, lambda s: True)


def secrets(text: str) -> Iterator[Span]:
    for m in _SECRET.finditer(text):
        k = 1 if m.group(1) else 2
        if any(c.isdigit() for c in m.group(k)):
            yield "secret", m.start(k), m.end(k)


def score(text: str, span: Span) -> float:
    kind, start, end = span
    near = (text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]).lower()
    base, words = SCORES[kind]
    return min(1.0, base + RAISE * sum(w in near for w in words))


_DIGIT = re.compile("[0-9]")


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans with their scores, by kind as listed, then start."""
    found: list[Span] = list(emails(text)) if "@" in text else []
    digits = _DIGIT.search(text) is not None
    if digits:
        found += ips(text)
        found += cards(text)
        if "+" in text:
            found += phones(text)
        found += ibans(text)
        if "-" in text:
            # nine digits with hyphens are common; they need a word for what they are
            found += [s for s in ssns(text) if score(text, s) > SCORES["ssn"][0]]
        if "AKIA" in text or "ASIA" in text:
            found += keys(text)
        if "=" in text or ":" in text:
            found += secrets(text)
    return [(*s, score(text, s)) for s in found]


def joined(found: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in found)


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, max_score, found)."""
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for cell in batch.column(1):
                found = spans(cell.as_py() or "")
                base = [s for s in found if s[0] in BASE_KINDS]
                rows.append(
                    [
                        *(sum(s[0] == k for s in base) for k in BASE_KINDS),
                        hashlib.sha256(joined(base).encode()).hexdigest(),
                        joined(found),
                        len(found),
                        max((s[3] for s in found), default=0.0),
                        [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in found],
                    ]
                )
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.float64(), pa.list_(item))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans", "max_score", "found"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return only(docs, "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, max_score double, found array<struct<kind:string,start:long,end:long,score:double>>",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).drop("found")


#: Context and checksums of the method's own kinds are beyond SQL; tests hold the base against plain patterns.
SQL = None
