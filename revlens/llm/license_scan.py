"""Licence scan: Aho-Corasick phrases and SPDX expressions.

Texts are lower-cased (A-Z only) and cut into words (runs of digits, a-z and
non-ASCII characters). One Aho-Corasick automaton finds all notice phrases and
the identifier tag in the words of a whole step of texts. Behind an identifier
tag the raw text's expression is read: a shunting-yard parser turns it into
reverse Polish order (with > and > or) and evaluates it to its licence labels
and to whether it can be met by permissive licences alone.

``permissive`` says whether all well-formed expressions of a text can be met so
(NULL if it has none). Score: 1 for such expressions, 0.95 for others that are
well-formed, 0.9 for a base phrase, 0.8 for another notice phrase, 0.5 for a
malformed expression only, 0 for none.

Defined results: NULL text counts as empty; an empty text has zeros, NULL
places and empty labels; a malformed expression adds the label ``invalid``;
repeated rows get equal results; NULL doc ids are kept; empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textgrams import NON_ALNUM, raw, steps, text_column

# The contract's base phrases with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of public licences' notices.
NOTICE_PHRASES = {
    "apache license": "apache",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons": "creative-commons",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "public domain": "public-domain",
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.I)

# SPDX ids that ask for no more than attribution.
PERMISSIVE = frozenset(
    "0bsd apache-2.0 bsd-2-clause bsd-3-clause cc-by-4.0 cc0-1.0 isc mit mit-0 unlicense zlib".split()
)
_RANK = {"or": 1, "and": 2, "with": 3}


class BadExpression(ValueError):
    pass


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: tokens of a licence expression in reverse Polish order."""
    out: list[str] = []
    operators: list[str] = []
    want_operand = True
    for token in re.findall(r"[()]|[A-Za-z0-9.+:_-]+", expression):
        low = token.lower()
        if low in _RANK:
            if want_operand:
                raise BadExpression(f"operator {low} without a left side")
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[low]:
                out.append(operators.pop())
            operators.append(low)
            want_operand = True
        elif token == "(":
            if not want_operand:
                raise BadExpression("parenthesis after an operand")
            operators.append(token)
        elif token == ")":
            if want_operand:
                raise BadExpression("empty parenthesis")
            while operators and operators[-1] != "(":
                out.append(operators.pop())
            if not operators:
                raise BadExpression("closing parenthesis without an opening one")
            operators.pop()
        else:
            if not want_operand:
                raise BadExpression("two operands in a row")
            out.append(low)
            want_operand = False
    if want_operand:
        raise BadExpression("operand missing at the end")
    while operators:
        if operators[-1] == "(":
            raise BadExpression("parenthesis not closed")
        out.append(operators.pop())
    return out


def evaluate(expression: str) -> tuple[frozenset[str], bool]:
    """(licence labels, can be met by permissive licences alone)."""
    stack: list[tuple[frozenset[str], bool]] = []
    for token in to_postfix(expression):
        if token not in _RANK:
            stack.append((frozenset([token]), token.rstrip("+") in PERMISSIVE))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # an exception: it adds leave, never conditions
            if len(left[0]) != 1 or len(right[0]) != 1:
                raise BadExpression("an exception needs one licence")
            stack.append((left[0], left[1]))
        elif token == "and":
            stack.append((left[0] | right[0], left[1] and right[1]))
        else:
            stack.append((left[0] | right[0], left[1] or right[1]))
    return stack[0]


def expression_in(rest_of_line: str) -> str:
    """The expression at the start of a line's rest: comment ends are cut."""
    return re.split(r"\*/|-->|#|[\"'<>,;]", rest_of_line)[0].strip()


def expressions(text: str) -> tuple[set[str], bool | None, float]:
    """(labels, can all be met by permissive licences, score) of the text's
    identifier tags, each read once."""
    labels: set[str] = set()
    permissive, score = None, 0.0
    for line in set(m[1] for m in TAG.finditer(text)):
        try:
            found, met = evaluate(expression_in(line))
        except BadExpression:
            labels.add("invalid")
            score = max(score, 0.5)
        else:
            labels |= found
            permissive = met if permissive is None else permissive and met
    if permissive is not None:
        score = 1.0 if permissive else 0.95
    return labels, permissive, score


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        a.add_word(f" {phrase} ", (True, phrase.count(" ") + 1, label))
    for phrase, label in NOTICE_PHRASES.items():
        a.add_word(f" {phrase} ", (False, phrase.count(" ") + 1, label))
    a.add_word(f" {TAG_WORDS} ", (None, 3, ""))
    a.make_automaton()
    return a


def _words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Each row's words joined by single blanks, and their number."""
    flat, offsets = raw(pc.ascii_lower(texts))
    if not len(flat):
        return [b""] * len(texts), np.zeros(len(texts), np.int64)
    inside = ~NON_ALNUM[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(flat)]
    first[starts] = inside[starts]
    # a word's bytes, and one blank in place of the byte behind it
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    kept = np.where(inside, flat, 0x20).astype(np.uint8)[keep]
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    n = np.concatenate([[0], np.cumsum(first)])[offsets]
    body = kept.tobytes()
    return [body[a:b].strip(b" ") for a, b in zip(at[:-1], at[1:], strict=True)], np.diff(n)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found_by = automaton()
    for batch in batches:
        texts = text_column(batch.column("text"))
        for a, b in steps(texts):
            rows, n_words = _words_of(texts.slice(a, b - a))
            body = (b" " + b" \n ".join(rows) + b" ").decode("utf-8", "replace")
            hits = list(found_by.iter(body))
            per_row: dict[int, list] = {}
            if hits:
                points = np.frombuffer(body.encode("utf-32-le", "replace"), np.uint32)
                blanks = np.flatnonzero(points == 0x20)
                breaks = np.flatnonzero(points == 0x0A)
                for end, (base, size, label) in hits:
                    row = int(np.searchsorted(breaks, end))
                    begin = breaks[row - 1] + 1 if row else 0
                    # the phrase ends at the blank behind its last word; the row starts with a blank
                    last = int(np.searchsorted(blanks, end) - np.searchsorted(blanks, begin)) - 1
                    per_row.setdefault(row, []).append((base, last - size + 1, label))
            out = []
            for i in range(b - a):
                base_at, base_labels, labels, permissive, score = [], set(), set(), None, 0.0
                found = per_row.get(i, ())
                if any(base is None for base, _, _ in found):
                    labels, permissive, score = expressions(texts[a + i].as_py())
                for base, word, label in found:
                    if base is None:
                        continue
                    if base:
                        base_at.append(word)
                        base_labels.add(label)
                        score = max(score, 0.9)
                    else:
                        labels.add(label)
                        score = max(score, 0.8)
                out.append(
                    (
                        int(n_words[i]),
                        len(base_at),
                        min(base_at, default=None),
                        max(base_at, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(base_labels | labels)),
                        score,
                        permissive,
                    )
                )
            columns = list(zip(*out, strict=True))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a)]
                + [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"],
            )


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document; reads and judges rows in place, no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = (
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_base long, first_word long, "
        "last_word long, base_labels string, labels string, score double, permissive boolean"
    )
    return rows.mapInArrow(_scan_batches, schema)
