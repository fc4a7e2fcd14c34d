"""Operator 6: personal data: patterns propose, checksums confirm, context words adjust.

Base kinds are email, ip, card (Luhn) and phone, found leftmost and without overlap within a kind; a proposal that
fails its check is dropped without another try.  Three kinds are added where they overlap no other span: iban (mod-97),
ssn, and local (a telephone number without country code).  Each added proposal has a score: what its form and checksum
are worth, more for a word of its kind shortly before it, less for a word that speaks against it; it counts from 0.7.

Scale: no shuffle, a batch of rows at a time, whole texts; all searches are linear in the text, also in long runs of
digits or letters.

Defined results: null counts as empty; a text without spans has zero counts, an empty ``spans`` and the digest of the
empty string; positions are code points, end exclusive; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table, text_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local")
ENOUGH = 0.7
NEAR = 40

_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_PART = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+])\(?0[0-9]{1,4}\)?[ /-]?[0-9](?:[ -]?[0-9]){4,10}(?![0-9])")

#: Kind: (score of the form alone, words for it, words against it).  Fixed values.
CONTEXT = {
    "iban": (0.8, ("iban", "account", "bank", "konto", "cuenta", "compte"), ("serial", "part no")),
    "ssn": (0.4, ("ssn", "social security", "tax id"), ("isbn", "order", "part no")),
    "local": (0.3, ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), ("isbn", "order", "invoice")),
}
FOR, AGAINST = 0.4, 0.4


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part cannot hold the sign that ends it, so it is all its characters before the sign."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        sign = text.find("@", max(sign + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts = [m.span() for m in _PART.finditer(text, chain.start(), chain.end())] if "." in chain[0] else ()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or 0) <= 255 for a, b in four):
                yield four[0][0], four[3][1]


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def score(kind: str, text: str, start: int) -> float:
    """Of an added proposal that passed its check."""
    form, good, bad = CONTEXT[kind]
    before = text[max(0, start - NEAR) : start].lower()
    return form + FOR * any(w in before for w in good) - AGAINST * any(w in before for w in bad)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", *m.span()
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span()
    for m in _LOCAL.finditer(text):
        if 7 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield "local", *m.span()


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and added spans, each by kind and start."""
    search = {"email": emails, "ip": addresses, "card": cards, "phone": phones}
    base = [(kind, a, b) for kind in BASE for a, b in search[kind](text)]
    taken, added = [(a, b) for _, a, b in base], []
    for kind, a, b in _proposed(text):
        if score(kind, text, a) >= ENOUGH and not any(a < d and c < b for c, d in taken):
            added.append((kind, a, b))
            taken.append((a, b))
    return base, added


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base kinds, digest of the base spans, all spans as text, number of added ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"]
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, added = find(value.as_py())
                kinds = [k for k, _, _ in base]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in BASE), digest, listed(base + added), len(added)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(work, FOUND)


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))
