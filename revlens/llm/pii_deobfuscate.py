"""Personal data under disguise, found by offset-preserving transducers.

A text passes transducers in a row. Each rewrites places of the text and keeps an
edit list (place and length before, place and length after), so any span of its
output maps back to the characters it came from:

1. ``plain_characters``: homoglyphs (compatibility forms, other scripts'
   digits, Cyrillic and Greek look-alikes) become ASCII, invisible characters vanish;
2. ``digits`` and ``plus``: runs of spelled digits ("four two", "double five") become digits;
3. ``signs``: "at" and "dot" disguises of addresses and numbers become ``@`` and ``.``.

The detectors of the base rules then run on the output. A finding that holds
a rewritten place is mapped back to code points of the source and added to
the base findings of the source itself, which stay as they are.

Every detector is linear in the text. Rewrites need a shape that prose does not
have: a run of three digits or digit words, a bracketed sign between name
characters, or a bare "at" whose domain has a disguised dot ("me at example dot com", not
"look at example.com").

Defined results: NULL text counts as empty and has no finding; ties at one start
follow the kinds' order; repeated rows and NULL ids are rows of their own;
texts of any length are searched whole; an empty table gives no row. Other columns
than id and text are ignored, so their names cannot clash.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textgrams import steps, text_column

KINDS = ("email", "ip", "card", "phone")
HITS = "array<struct<kind:string,start:int,end:int,base:boolean,value:string>>"


# ----------------------------------------------------------------- detectors

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, found from their ``@``: a name is the run before it, at most
    back to the address or ``@`` before, so long runs are read once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        if at >= free:
            begin = at
            while begin > free and not _NOT_LOCAL.match(text, begin - 1):
                begin -= 1
            found = _DOMAIN.match(text, at + 1) if begin < at else None
            if found:
                yield begin, found.end()
                free = found.end()
            else:
                free = max(free, at + 1)
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails,
    "ip": ips,
    "card": cards,
    "phone": phones,
}
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}


# --------------------------------------------------------------- transducers


class Edit(NamedTuple):
    """Source characters [start, end) became output characters [to, to_end)."""

    start: int
    end: int
    to: int
    to_end: int


class Rewritten(NamedTuple):
    text: str
    edits: list[Edit]  # disjoint, ascending

    def _place(self, at: int, last: bool) -> int:
        # the last edit that starts at or before the character
        i = bisect_right(self.edits, at, key=lambda e: e.to) - 1
        if i < 0:
            return at + last
        e = self.edits[i]
        if at < e.to_end:
            return e.end if last else e.start
        return e.end + (at - e.to_end) + last

    def source(self, begin: int, end: int) -> tuple[int, int]:
        """The source span of output characters [begin, end)."""
        return self._place(begin, False), self._place(end - 1, True)

    def touched(self, begin: int, end: int) -> bool:
        """Whether [begin, end) has a rewritten character, or a deletion between two."""
        i = bisect_right(self.edits, begin, key=lambda e: e.to_end)
        return i < len(self.edits) and self.edits[i].to < end


class Cleared(NamedTuple):
    """A text without disguises, and the transducers' outputs up to it."""

    text: str
    steps: list[Rewritten]

    def source(self, begin: int, end: int) -> tuple[int, int, bool]:
        """(start, end) in the source, and whether the span was rewritten."""
        touched = False
        for step in reversed(self.steps):
            touched = touched or step.touched(begin, end)
            begin, end = step.source(begin, end)
        return begin, end, touched


def rewrite(text: str, parts: list[tuple[int, int, str]]) -> Rewritten:
    """Replace disjoint, ascending places (start, end, output)."""
    out, edits, at, size = [], [], 0, 0
    for start, end, new in parts:
        out.append(text[at:start])
        size += start - at
        out.append(new)
        edits.append(Edit(start, end, size, size + len(new)))
        size += len(new)
        at = end
    out.append(text[at:])
    return Rewritten("".join(out), edits)


# Letters of other scripts that look like an ASCII letter.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУԁаеіјорѕсухһԛԝѵΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυχɡɑıⅼ",
        "ABESIJKMHOPCTXYdaeijopscyxhqwvABEZHIKMNOPTYXaivopuxgail",
        strict=True,
    )
)
# Characters without width; blanks, dashes and dots other than ASCII's.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
BLANKS = "\u00a0\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"
DOTS = "\u00b7\u2024\u3002"


@lru_cache(maxsize=4096)
def plain(character: str) -> str | None:
    """ASCII form of a disguised character; None if it is none."""
    if character in INVISIBLE:
        return ""
    if character in LOOKALIKES:
        return LOOKALIKES[character]
    try:
        return str(unicodedata.decimal(character))
    except ValueError:
        form = unicodedata.normalize("NFKC", character)
        return form if len(form) == 1 and form.isascii() and form.isprintable() and form != " " else None


#: What may be rewritten: all beyond Latin-1, and three characters of it.
_FOREIGN = re.compile(r"[\xa0\xad\xb7]|[^\x00-\xff]")


def _mark(text: str, at: int) -> str | None:
    """A foreign blank or dash between digits, or a dot inside a word, in ASCII."""
    before, after = text[at - 1 : at], text[at + 1 : at + 2]
    if text[at] in DOTS:
        return "." if before.isalnum() and after.isalnum() else None
    if before.isdecimal() and (after.isdecimal() or (text[at] in BLANKS and after == "(")):
        return " " if text[at] in BLANKS else "-"
    return None


def plain_characters(text: str) -> Rewritten:
    """Homoglyphs and forms of ASCII to ASCII; foreign blanks, dashes and dots
    only inside numbers and words, so that prose keeps its punctuation."""
    parts = []
    for m in _FOREIGN.finditer(text):
        is_mark = m[0] in BLANKS or m[0] in DASHES or m[0] in DOTS
        new = _mark(text, m.start()) if is_mark else plain(m[0])
        if new is not None:
            parts.append((m.start(), m.end(), new))
    return rewrite(text, parts)


# Digit words of the corpus' four languages, each in its order 0 to 9.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_VALUE = {w: str(i) for row in DIGIT_WORDS for i, w in enumerate(row.split())} | {"oh": "0", "zwo": "2"}
_TIMES = {"double": 2, "triple": 3}
_WORD = "|".join(sorted(_VALUE, key=len, reverse=True))
_SPELLED = rf"(?:(?:double|triple)[ -])?(?:{_WORD})"
_TOKEN = rf"(?:{_SPELLED}|[0-9]+)(?![^\W_])"
_POINT = ("dot", "point", "punkt", "punto")
_GAP = rf"(?: (?:{'|'.join(_POINT)}) |,? |[-.,]| - )"
_RUN = re.compile(rf"(?<![^\W_]){_TOKEN}(?:{_GAP}(?:{_TOKEN})){{2,}}", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_OF_RUN = frozenset(_VALUE) | frozenset(_TIMES) | frozenset(_POINT)
#: Digit words that a run needs at least.
LEAST_SPELLED = 3
_PARTS = re.compile(rf"({_SPELLED})|([0-9]+)|({_GAP})", re.I)
_PLUS = re.compile(r"(?<![^\W_])plus (?=[0-9])", re.I)


def may_spell(lowered: str) -> bool:
    """Whether some words in a row could be a run; digits stand between words."""
    return b"\1" * LEAST_SPELLED in bytes([w in _OF_RUN for w in _LETTERS.findall(lowered)])


def digits(text: str) -> Rewritten:
    """Spelled digits in runs with three of them or more, joined where both
    neighbours are spelled."""
    parts: list[tuple[int, int, str]] = []
    for run in _RUN.finditer(text):
        found, spelled, gap = [], 0, None
        before = False
        for m in _PARTS.finditer(text, run.start(), run.end()):
            if m[3] is not None:
                gap = m
                continue
            words = re.split("[ -]", m[1].lower()) if m[1] else [""]
            value = _VALUE.get(words[-1])  # None also for a letter that is another's in caseless matching only
            if value is not None:
                if gap and before and not gap[0].strip(" ,-"):
                    found.append((*gap.span(), ""))
                found.append((*m.span(), value * _TIMES.get(words[0], 1)))
                spelled += 1
            before, gap = value is not None, None
        if spelled >= LEAST_SPELLED:
            parts += found
    return rewrite(text, parts)


def plus(text: str) -> Rewritten:
    """"plus" before a digit becomes ``+``."""
    return rewrite(text, [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)])


# Spoken names of the two signs in the corpus' languages.
_AT_NAME = r"(?:at|@|arobase|arroba|klammeraffe|ät)"
_DOT_NAME = r"(?:dot|punkt|point|punto|\.)"
_OPEN, _CLOSE, _BLANK = r"[\[({<]", r"[\])}>]", r"[ \t]{0,3}"
_AT_BRACKET = rf"{_BLANK}{_OPEN}{_BLANK}{_AT_NAME}{_BLANK}{_CLOSE}{_BLANK}"
_DOT_BRACKET = rf"{_BLANK}{_OPEN}{_BLANK}{_DOT_NAME}{_BLANK}{_CLOSE}{_BLANK}"
_AT_BARE = r"[ \t]{1,3}(?:at|arobase|arroba|klammeraffe)[ \t]{1,3}"
_DOT_BARE = r"[ \t]{1,3}(?:dot|punkt|point|punto)[ \t]{1,3}"
_DOT = rf"(?:{_DOT_BRACKET}|{_DOT_BARE})"
_ANY_AT = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:(?P<bracket>{_AT_BRACKET})|(?P<bare>{_AT_BARE})|(?P<sign>@))(?=[A-Za-z0-9])", re.I)
_LABELS = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)+", re.I)
_HIDDEN_DOT = re.compile(_DOT, re.I)
_NUMBER_DOT = re.compile(rf"(?<=[0-9]){_DOT}(?=[0-9])", re.I)
_NAME_TAIL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOT_BEFORE = re.compile(rf"[A-Za-z0-9._%+-]+{_DOT}\Z", re.I)
#: Characters of a name that are looked at before a disguised ``at``.
_NAME = 64


def _name_dots(text: str, end: int, floor: int) -> list[tuple[int, int, str]]:
    """Disguised dots inside the name that ends at ``end``."""
    out: list[tuple[int, int, str]] = []
    low = max(floor, end - _NAME)
    word = end
    while word > low and _NAME_TAIL.match(text[word - 1]):
        word -= 1
    while word > low:
        dots = [m for m in _HIDDEN_DOT.finditer(text, low, word) if m.end() == word]
        if not dots or dots[-1].start() <= low or not _NAME_TAIL.match(text[dots[-1].start() - 1]):
            break
        out.append((dots[-1].start(), dots[-1].end(), "."))
        word = dots[-1].start()
        while word > low and _NAME_TAIL.match(text[word - 1]):
            word -= 1
    return out[::-1]


def signs(text: str) -> Rewritten:
    """Disguised ``@`` and ``.`` of addresses, and dots between digits."""
    parts: dict[int, tuple[int, int, str]] = {}
    floor = 0
    at = _ANY_AT.search(text)
    while at:
        labels = _LABELS.match(text, at.end())
        dots = [m for m in _HIDDEN_DOT.finditer(text, labels.start(), labels.end())] if labels else []
        # a domain in the clear needs a bracketed sign before it
        if labels and (dots or at["bracket"]):
            for part in _name_dots(text, at.start(), floor):
                parts.setdefault(part[0], part)
            if not at["sign"]:
                parts[at.start()] = (at.start(), at.end(), "@")
            for m in dots:
                parts[m.start()] = (m.start(), m.end(), ".")
            floor = labels.end()
        at = _ANY_AT.search(text, max(at.end(), floor))
    for m in _NUMBER_DOT.finditer(text):
        parts.setdefault(m.start(), (m.start(), m.end(), "."))
    disjoint: list[tuple[int, int, str]] = []
    for part in sorted(parts.values()):
        if not disjoint or part[0] >= disjoint[-1][1]:
            disjoint.append(part)
    return rewrite(text, disjoint)


_BRACKETED = re.compile(rf"{_OPEN}{_BLANK}(?:{_AT_NAME}|{_DOT_NAME}){_BLANK}{_CLOSE}")
_SPOKEN_DOTS = tuple(blank + name for name in _POINT for blank in " \t")


def may_sign(lowered: str) -> bool:
    return any(d in lowered for d in _SPOKEN_DOTS) or _BRACKETED.search(lowered) is not None


TRANSDUCERS: tuple[tuple[Callable[[str], Rewritten], Callable[[str], bool]], ...] = (
    (plain_characters, lambda low: not low.isascii()),
    (digits, may_spell),
    (plus, lambda low: "plus " in low),
    (signs, may_sign),
)


def clear_text(text: str) -> Cleared:
    """The text without disguises, with the way back. A transducer is spared
    a text that has nothing for it by a plainer test of the lowered text."""
    done: list[Rewritten] = []
    lowered = text.lower()
    for transducer, needed in TRANSDUCERS:
        if needed(lowered):
            out = transducer(text)
            if out.edits:
                done.append(out)
                text, lowered = out.text, out.text.lower()
    return Cleared(text, done)


def base_hits(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base findings, sorted."""
    return sorted(
        (a, rank, b)
        for rank, kind in enumerate(KINDS)
        if _NEEDS[kind] in text
        for a, b in DETECTORS[kind](text)
    )


def find(text: str) -> list[tuple[int, int, int, bool, str]]:
    """(start, rank, end, base, value in the clear) of all findings, sorted."""
    hits = [(a, rank, b, True, text[a:b]) for a, rank, b in base_hits(text)]
    cleared = clear_text(text)
    if cleared.steps:
        known = {(a, rank, b) for a, rank, b, _, _ in hits}
        for a, rank, b in base_hits(cleared.text):
            start, end, touched = cleared.source(a, b)
            if touched and (start, rank, end) not in known:
                hits.append((start, rank, end, False, cleared.text[a:b]))
        hits.sort(key=lambda h: h[:3])
    return hits


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("value", pa.string())]
        )
    )
    for batch in batches:
        texts = text_column(batch.column("text"))
        for a, b in steps(texts):
            hits = [
                [{"kind": KINDS[r], "start": s, "end": e, "base": base, "value": v} for s, r, e, base, v in find(t)]
                for t in texts.slice(a, b - a).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(hits, kind)], ["doc_id", "hits"]
            )


def scan_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hits) of every document, in place, without a shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, hits {HITS}")
