"""Personal data in texts, also in disguise, with exact source positions.

Base spans come from plain patterns on the text as it is. Then small transducers
rewrite the text, each as edits whose places are kept: look-alike characters become the
ASCII ones they imitate, invisible characters vanish, runs of spelled digits become
digits (fewer than three words only beside a digit, sign or dot), and "at"/"dot"
disguises become signs. The same detectors run on the rewritten
text, and what they find is mapped back to source characters and added.
"""

from __future__ import annotations

import bisect
import re
import sys
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import slices, whole_text

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Runs are taken whole, which finds the same matches
# as plain repetition but never tries a long run twice.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters that look like ASCII ones, and digit words.
LOOKALIKES = {
    "АВСЕНІЈКМОРЅТХУ": "ABCEHIJKMOPSTXY",  # Cyrillic capitals
    "авсеһіјкморѕтхуԁԛԝ": "abcehijkmopstxydqw",  # Cyrillic small letters
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX",  # Greek capitals
    "αιοκνρτυχ": "aioknptux",  # Greek small letters
    "․。．﹒": "....",  # full stops
    "＠﹫": "@@",  # at signs
    "‐‑‒–—―−－": "--------",  # dashes
    "＋﹢": "++",  # plus signs
    "           　": "            ",  # spaces
}
DIGIT_WORDS = (
    "zero oh one two three four five six seven eight nine "
    "null eins zwei drei vier fünf sechs sieben acht neun "
    "zéro un deux trois quatre cinq six sept huit neuf "
    "cero uno dos tres cuatro cinco seis siete ocho nueve"
).split()
DIGIT_OF = dict(zip(DIGIT_WORDS, "00123456789" + "0123456789" * 3, strict=True))
INVISIBLE = "­​‌‍⁠﻿"


def _look_alikes() -> dict[int, str]:
    table = {ord(a): b for group, plain in LOOKALIKES.items() for a, b in zip(group, plain, strict=True)}
    table |= {code: chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}  # full-width forms
    for code in range(0x80, sys.maxunicode + 1):  # digits of other scripts
        if (digit := unicodedata.decimal(chr(code), None)) is not None:
            table[code] = str(digit)
    return table


LOOK_ALIKE = _look_alikes()
LOOK_ALIKE_SET = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(LOOK_ALIKE)) + "]")

_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_GAP = r"[\s,.-]{1,3}"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_LABEL = r"[A-Za-z0-9-]+"
DISGUISE = re.compile(
    rf"(?P<invisible>[{INVISIBLE}]+)"
    rf"|(?P<digits>(?<![^\W\d_]){_WORD}(?:{_GAP}{_WORD}){{2,}}(?![^\W\d_]))"
    rf"|(?P<at>{_OPEN}(?:at|arroba|chez|ät|@){_CLOSE}"
    rf"|(?<=[A-Za-z0-9])\s{{1,3}}at\s{{1,3}}(?={_LABEL}(?:(?:\.|\s{{1,3}}dot\s{{1,3}}|{_OPEN}dot{_CLOSE}){_LABEL})*(?:\s{{1,3}}dot\s{{1,3}}|{_OPEN}dot{_CLOSE}){_LABEL}))"
    rf"|(?P<dot>{_OPEN}(?:dot|point|punkt|punto|\.){_CLOSE}|(?<=[A-Za-z0-9])\s{{1,3}}dot\s{{1,3}}(?=[A-Za-z0-9]))",
    re.IGNORECASE,
)
#: Cheap signs that DISGUISE may match; most texts have none of them.
HINT = re.compile(
    rf"[{INVISIBLE}]|[\[({{<]\s{{0,3}}(?:at|arroba|chez|ät|@|dot|point|punkt|punto|\.)\s{{0,3}}[\])}}>]|\sdot\s|\b{_WORD}{_GAP}{_WORD}{_GAP}{_WORD}\b",
    re.IGNORECASE,
)
ONE_DIGIT = re.compile(_WORD, re.IGNORECASE)
# Spelled digits in runs of any length, which count beside a digit, a sign or a "dot" only.
_SHORT_GAP = r"[\s,-]{1,3}"
SHORT_RUN = re.compile(rf"(?<![^\W\d_]){_WORD}(?:{_SHORT_GAP}{_WORD})*(?![^\W\d_])", re.IGNORECASE)
_DOT = rf"{_OPEN}(?:dot|point|punkt|punto|\.){_CLOSE}"
BEFORE = re.compile(rf"(?:[0-9+][\s,.()-]{{0,3}}|[^\W_]\.|[^\W_]\s{{1,3}}dot\s{{1,3}}|[^\W_]{_DOT})\Z", re.IGNORECASE)
AFTER = re.compile(rf"[\s,.()-]{{0,3}}[0-9]|\.[^\W_]|\s{{1,3}}dot\s{{1,3}}[^\W_]|{_DOT}[^\W_]", re.IGNORECASE)
#: What such a run stands beside, and what may stand between them.
BESIDE = re.compile(r"[0-9+]++|\.(?=[^\W_])|[\])}>]|\s[dD][oO][tT](?=\s)")
BETWEEN = " \t\n\r\f\v,.()-[]{}<>"
WORDS, DOTS = tuple(DIGIT_WORDS), ("dot", "point", "punkt", "punto")


class Span(NamedTuple):
    start: int
    end: int
    kind: int


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every at sign takes the local part before it and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL_CHARACTERS:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            free = domain.end()
        else:
            free = max(free, at)  # what stands before this sign cannot match any more
        at = text.find("@", max(free, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """The base spans of a text."""
    found = [Span(a, b, 0) for a, b in emails(text)]
    found += [Span(*m.span(), 1) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(*m.span(), 2))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append(Span(*m.span(), 3))
    return sorted(found, key=lambda s: (s.start, s.kind))


class Rewritten:
    """A rewritten text and where its characters come from."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        self.pieces: list[tuple[int, int, int, bool]] = []  # place, source start, source stop, copied
        parts: list[str] = []
        place = at = 0
        for start, stop, put in [*edits, (len(text), len(text), "")]:
            if at < start:
                self.pieces.append((place, at, start, True))
                parts.append(text[at:start])
                place += start - at
            if put:
                self.pieces.append((place, start, stop, False))
                parts.append(put)
                place += len(put)
            at = stop
        self.text = "".join(parts)
        self.places = [piece[0] for piece in self.pieces]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters of a span."""
        place, a, _, copied = self.pieces[bisect.bisect_right(self.places, start) - 1]
        first = a + start - place if copied else a
        place, a, b, copied = self.pieces[bisect.bisect_right(self.places, end - 1) - 1]
        return first, a + end - place if copied else b


def _spelled(plain: str, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    """Edits that turn a run of spelled digits into digits."""
    words = list(ONE_DIGIT.finditer(plain, start, stop))
    for word, following in zip(words, [*words[1:], None], strict=True):
        yield *word.span(), DIGIT_OF[word[0].lower()]
        if following:
            yield word.end(), following.start(), ""


def _short_hint(plain: str) -> bool:
    """Whether a digit word may stand beside a digit, sign or dot; a cheap look."""
    for m in BESIDE.finditer(plain):
        a, b = m.span()
        if plain[b : b + 16].lstrip(BETWEEN).lower().startswith(WORDS):
            return True
        before = plain[max(0, a - 24) : a].rstrip(BETWEEN).lower()
        if before.endswith(DOTS):  # "[dot]" ends at this bracket
            before = before.rstrip("dotpunki").rstrip(BETWEEN)
        if before.endswith(WORDS):
            return True
    return False


def _short_runs(plain: str) -> list[tuple[int, int]]:
    """Runs of spelled digits, of any length, that can be part of an identifier."""
    return [
        (a, b)
        for a, b in (m.span() for m in SHORT_RUN.finditer(plain))
        if BEFORE.search(plain[max(0, a - 16) : a]) or AFTER.match(plain, b)
    ]


def rewrites(text: str) -> Iterator[Rewritten]:
    """The text with its disguises taken off, if it shows any: first with spelled digits
    in runs of three words or more, then also with shorter ones beside other digits, signs
    or dots, where these runs end at a full stop."""
    plain = text if text.isascii() or not LOOK_ALIKE_SET.search(text) else text.translate(LOOK_ALIKE)
    found = list(DISGUISE.finditer(plain)) if HINT.search(plain) else []
    signs = [(*m.span(), {"invisible": "", "at": "@", "dot": "."}[m.lastgroup]) for m in found if m.lastgroup != "digits"]
    edits = signs + [edit for m in found if m.lastgroup == "digits" for edit in _spelled(plain, *m.span())]
    if plain is not text or edits:
        yield Rewritten(plain, sorted(edits))
    if _short_hint(plain):
        short = _short_runs(plain)
        if short:
            runs = short + [m.span() for m in found if m.lastgroup == "digits"]
            more, at = [], 0
            for a, b in sorted(runs, key=lambda run: (run[0], run not in short)):
                if a >= at:  # a run of three or more that holds a short one gives way to it
                    if (a, b) in short or not any(a < d and c < b for c, d in short):
                        more += _spelled(plain, a, b)
                        at = b
            more = sorted(signs + more)
            if more != sorted(edits):
                yield Rewritten(plain, more)


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and spans that only show in a rewritten text."""
    base = detect(text)
    added: set[Span] = set()
    for other in rewrites(text):
        for span in detect(other.text):
            start, end = other.source(span.start, span.end)
            if not any(b.kind == span.kind and b.start <= start and end <= b.end for b in (*base, *added)):
                added.add(Span(start, end, span.kind))
    return base, sorted(added)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points, end exclusive, and
    whether rewriting added it), by start and kind.

    An added span is one that no base span of its kind contains. A null or empty text
    has no spans; repeated rows give repeated results; a null id stays null; other
    columns are ignored. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = find_spans(text)
                both = sorted([(*s, False) for s in base] + [(*s, True) for s in added], key=lambda s: (s[0], s[2], s[1]))
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "added": new} for a, b, k, new in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, SPANS)], ["doc_id", "spans"])

    source = docs.select("doc_id", whole_text().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long,added:boolean>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of all spans by kind, a digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    return find_personal_data(docs).select(
        "doc_id",
        *[_count(spans, kind) for kind in KINDS],
        F.sha2(_listed(F.filter(spans, lambda s: ~s["added"])).cast("binary"), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )
