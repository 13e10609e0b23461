"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Base kinds are email, ip, card (Luhn) and phone.  The method adds iban (mod-97) and
national id numbers, the latter only where a context word stands near.  Every span carries a
score: a prior per kind, raised by what a validator proves and by context words of its kind
within ``CONTEXT`` characters before or after it, lowered by words that speak against it.  Context
words are whole words: "midnight" doesn't hold one, and one cut off by the context's edge isn't read.  Base spans
are always reported; added ones from ``MIN_SCORE`` on.

Defined results: a null or empty text has no spans; spans of one kind don't overlap, of
different kinds they may; repeated rows give repeated results; an empty table an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, ship, whole_text

KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
CONTEXT = 48
MIN_SCORE = 0.6

#: Prior score of a span of each kind, before validators and context.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "national_id": 0.3}
#: What a passed checksum adds.
CHECKSUM = {"card": 0.4, "iban": 0.5}
#: Words that speak for a kind, and words that speak against any.
FOR = {
    "email": ("mail", "email", "mails", "emails", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "login", "from"),
    "card": ("card", "cards", "visa", "mastercard", "credit", "pay", "payment", "tarjeta", "karte", "carte"),
    "phone": ("phone", "telephone", "call", "calls", "tel", "mobile", "cell", "fax", "whatsapp"),
    "iban": ("iban", "account", "accounts", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social security", "national id", "tax id", "steuernummer", "steuer id", "dni"),
}
AGAINST = ("version", "order no", "invoice", "isbn", "serial", "example")


def _any_of(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + r")\b", re.I)


_FOR = {kind: _any_of(words) for kind, words in FOR.items()}
_AGAINST = _any_of(AGAINST)

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ outwards, so that long words cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, checksum passed) of every span whose validator agrees."""
    for a, b in emails(text):
        yield "email", a, b, False
    if not any(d in text for d in "0123456789"):
        return
    for m in _IP.finditer(text):
        if _ip_ok(m.group()):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in _IBAN.finditer(text):
        s = m.group()
        while len(_bare(s)) >= 15:  # words in capitals may follow the number
            if mod97(_bare(s)):
                yield "iban", m.start(), m.start() + len(s), True
                break
            cut = s.rfind(" ")
            if cut < 0:
                break
            s = s[:cut]
    if "-" in text:
        for m in _NATIONAL.finditer(text):
            yield "national_id", m.start(), m.end(), False


def _bare(s: str) -> str:
    return s.replace(" ", "")


def context(text: str, start: int, end: int) -> str:
    """Up to ``CONTEXT`` characters on both sides of a span, without words that the edges cut."""
    a, b = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    while 0 < a < start and _is_word(text[a - 1]) and _is_word(text[a]):
        a += 1
    while end < b < len(text) and _is_word(text[b]) and _is_word(text[b - 1]):
        b -= 1
    return text[a:start] + "\0" + text[end:b]


def _is_word(c: str) -> bool:
    return c == "_" or c.isalnum()


def score(text: str, kind: str, start: int, end: int, passed: bool) -> float:
    near = context(text, start, end)
    s = PRIOR[kind] + (CHECKSUM.get(kind, 0) if passed else 0)
    s += 0.3 if _FOR[kind].search(near) else 0
    s -= 0.2 if _AGAINST.search(near) else 0
    return min(1.0, max(0.0, round(s, 2)))


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed in ``KINDS``."""
    found = [(k, a, b, score(text, k, a, b, ok)) for k, a, b, ok in proposals(text)]
    found = [x for x in found if x[0] in KINDS[:4] or x[3] >= MIN_SCORE]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, scores array<double>")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans and their scores."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b, _ in xs)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                all_spans = spans(text)
                base = [x for x in all_spans if x[0] in KINDS[:4]]
                counts = [sum(x[0] == k for x in base) for k in KINDS[:4]]
                rows.append((None if pd.isna(doc_id) else int(doc_id), *counts,
                             hashlib.sha256(told(base).encode()).hexdigest(), told(all_spans), [x[3] for x in all_spans]))
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")], dtype=object)  # pandas would make ids beside a null floats
            yield out

    return map_frames(docs.select("doc_id", whole_text().alias("text")), run, SCHEMA)


def redacted(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in angle brackets (the first of overlapping ones)."""
    out, done = [], 0
    for kind, a, b, _ in found:
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
            done = b
    return "".join(out) + text[done:]
