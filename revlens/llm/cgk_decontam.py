"""Benchmark decontamination by CGK embedding, bit sampling and edit verification.

Texts and benchmark items are sequences of words (runs of ASCII letters and
digits or non-ASCII characters, lower case). An item of n words is sought in
all windows of n words. The CGK random walk reads words from an anchor: at
step t it writes the current word and moves on if a random bit of (t, word) is
1. Two sequences with few edits fall into step again, so edit distance becomes
Hamming distance between walks. Each repetition takes its own walk and samples
few of its steps; a sample counts where it shows as many places as it has
steps, and, for an item, where all of them lie in the item.

Every word of an item is an anchor, and so is every word of a window that may
match. A window and an item that agree in a sample from some anchors are taken
as aligned there, and the windows that start up to k words (the edits allowed)
before or after are candidates. Anchors leave no part of an item unread: edits
at its head spoil the walks from there and not those from behind them. An
infix edit distance over the words around a candidate decides.

With k = n / 5 edits, wherever they lie, an item of 10 words or more has three
unedited words in a row, and one of 5 to 9 words two, so samples of three and
of two steps are enough; items of less than 5 words allow no edit. Recall is
measured in the tests, against all windows: at least 0.99 for edits at the
head, at the tail, together, inserted, deleted and evenly spread.

A window within k edits holds at least n - k words of the item, so windows
with fewer words that occur in any item of n words are left out before the
walk, and candidates that share fewer with their item before the edit distance;
neither loses anything.

A document is contaminated by an item if some stretch of it is within
``EDIT_SHARE`` of the item's words in edits (insertions, deletions,
substitutions of words).

The benchmark is worked off in blocks of at most ``BLOCK_ITEMS`` items, the
stated query set against all documents; what is sent to tasks is one block.

Defined results: NULL and empty texts or items match nothing; items with equal
words give equal results under their own ids; rows repeated in a table give
their result once in ``contaminated``; empty tables give empty results; other
columns are ignored or, in ``drop_contaminated``, pass through untouched. NULL
doc ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textgrams import NON_ALNUM, U, mix64, steps, text_column, word_hashes

EDIT_SHARE = 0.2
REPETITIONS = 16
#: Steps that each sample of a walk is drawn from; short spans meet edits less.
SPANS = (5, 6, 8, 16)
#: Spans of the samples for items of fewer words than ``SHORT``.
SHORT_SPANS = (2, 3, 4)
SHORT = 10
BLOCK_ITEMS = 5_000
#: Pairs of a place and an item, or of a place and a window, worked on at once.
PAIRS = 1_000_000
#: Places walked from at once.
PLACES = 50_000
_VOCAB_BITS = 22


def edits_allowed(n: int) -> int:
    return int(EDIT_SHARE * n)


def sample_steps(n: int) -> int:
    """Steps that a sample for items of ``n`` words compares."""
    return 1 if n == 1 else 2 if n < SHORT else 3


class Item:
    """One benchmark item: id, word hashes, and its positions by word."""

    def __init__(self, item_id, words: np.ndarray):
        self.id = item_id
        self.words = words
        self.at: dict[int, int] = {}
        for i, w in enumerate(words.tolist()):
            self.at[w] = self.at.get(w, 0) | (1 << i)
        self.distinct, self.times = np.unique(words, return_counts=True)

    def shared(self, windows: np.ndarray) -> np.ndarray:
        """Words that each window (a row) and the item have in common, with
        multiplicity: no alignment can match more."""
        m = len(self.distinct)
        at = np.minimum(np.searchsorted(self.distinct, windows), m - 1)
        row, column = np.nonzero(self.distinct[at] == windows)
        counts = np.bincount(row * m + at[row, column], minlength=len(windows) * m)
        return np.minimum(counts.reshape(len(windows), m), self.times).sum(axis=1)


def items_of(rows: list[tuple]) -> list[Item]:
    """Items from (item_id, text) rows; those without words are left out."""
    texts = pa.array([t or "" for _, t in rows], pa.large_string())
    words, at = word_hashes(texts, NON_ALNUM)
    return [
        Item(rows[i][0], words[at[i] : at[i + 1]].copy()) for i in range(len(rows)) if at[i] < at[i + 1]
    ]


def infix_distance(item: Item, words: list[int]) -> int:
    """Least edits between the item and any stretch of ``words`` (bit-parallel)."""
    n = len(item.words)
    mask, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best = mask, 0, n, n
    for w in words:
        eq = item.at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = mh | (~(xv | ph) & mask)
        mv = ph & xv
        best = min(best, score)
    return best


def walk(words: np.ndarray, anchors: np.ndarray, length: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """CGK walks of repetition ``turn``, words as symbols: the word of each step
    and how far from its anchor it stands (steps x anchors).

    The random bits of a word are those of one hash, one for each step.
    """
    padded = np.concatenate([words, np.zeros(length, np.uint64)])
    bits = mix64(padded ^ mix64(np.array([turn + 1], np.uint64)))
    pos = anchors.astype(np.int64)
    out = np.empty((length, len(anchors)), np.uint64)
    moved = np.zeros((length, len(anchors)), np.int8)
    for t in range(length):
        out[t] = padded[pos]
        move = ((bits[pos] >> U(t)) & U(1)).astype(np.int8)
        pos = pos + move
        if t + 1 < length:
            np.add(moved[t], move, out=moved[t + 1])
    return out, moved


def _samples(turn: int) -> list[tuple[int, ...]]:
    """The sampled steps of repetition ``turn``, of three, two and one steps."""
    rng = np.random.default_rng(turn)
    drawn = [(span, 3) for span in SPANS] + [(span, 2) for span in SHORT_SPANS]
    chosen = [tuple(sorted(rng.choice(span, size, replace=False).tolist())) for span, size in drawn]
    return list(dict.fromkeys(chosen + ([(0,)] if turn == 0 else [])))


def _apart(moved: np.ndarray, chosen: tuple[int, ...]) -> np.ndarray:
    """Walks that stand at another place in each of the ``chosen`` steps."""
    ok = np.ones(moved.shape[1], bool)
    for s, t in zip(chosen, chosen[1:]):
        ok &= moved[s] < moved[t]
    return ok


def _key(walks: np.ndarray, chosen: tuple[int, ...], which: np.ndarray) -> np.ndarray:
    key = walks[chosen[0]][which] * U(0x9E3779B97F4A7C15)
    for i, t in enumerate(chosen[1:]):
        key = (key ^ (key >> U(31))) + walks[t][which] * U(0xBF58476D1CE4E5B9 + 2 * i)
    return mix64(key)


class Searcher:
    """The items of one block, with the keys of their walks."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.by_size: dict[int, list[int]] = {}
        for i, item in enumerate(items):
            self.by_size.setdefault(len(item.words), []).append(i)
        # words by the leading bits of their hash; words that share them count
        # as one, which only lets more windows through
        slots = [self._slot(item.words) for item in items]
        used = np.unique(np.concatenate(slots)) if slots else np.zeros(0, np.int64)
        self.word_id = np.zeros(1 << _VOCAB_BITS, np.int32)
        self.word_id[used] = np.arange(1, len(used) + 1)
        self.known = {}
        for n, ids in self.by_size.items():
            self.known[n] = np.zeros(len(used) + 1, bool)
            for i in ids:
                self.known[n][self.word_id[slots[i]]] = True
        # sorted keys of the walks from all words of the items that a sample
        # counts for, their items and anchors, and a bit per leading bits of a key
        self.sizes = np.array([len(x.words) for x in items], np.int64)
        flat = np.concatenate([x.words for x in items]) if items else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), self.sizes)
        anchor = np.arange(len(flat)) - (np.cumsum(self.sizes) - self.sizes)[owner]
        n_steps = np.array([sample_steps(n) for n in self.sizes.tolist()], np.int64)[owner]
        self.keys = []
        for turn in range(REPETITIONS if items else 0):
            walks, moved = walk(flat, np.arange(len(flat)), max(SPANS), turn)
            for chosen in _samples(turn):
                inside = anchor + moved[chosen[-1]] < self.sizes[owner]
                at = np.flatnonzero(_apart(moved, chosen) & inside & (n_steps == len(chosen)))
                if not len(at):
                    continue
                keys = _key(walks, chosen, at)
                order = np.argsort(keys, kind="stable")
                shift = U(64 - min(max(8 * len(at), 1 << 10).bit_length(), 22))
                bit = np.zeros(1 << (64 - int(shift)), bool)
                bit[(keys >> shift).astype(np.int64)] = True
                at = at[order]
                self.keys.append(
                    (turn, chosen, keys[order], owner[at].astype(np.int32), anchor[at].astype(np.int32), shift, bit)
                )
        self.gap = max((edits_allowed(n) for n in self.by_size), default=0) + 1

    @staticmethod
    def _slot(words: np.ndarray) -> np.ndarray:
        return (words >> U(64 - _VOCAB_BITS)).astype(np.int64)

    def candidates(
        self, words: np.ndarray, passed: dict[int, np.ndarray], some: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) pairs: where an item would begin by a walk that agrees
        in some sample, if a window that passed starts within the allowed edits
        of it."""
        most, longest = self.gap - 1, max(self.by_size)
        place, total = np.arange(len(words)), np.concatenate([[0], np.cumsum(some)])
        near = total[np.minimum(place + most + 1, len(words))] > total[np.maximum(place - longest - most, 0)]
        anchors = np.flatnonzero(near)
        sums = {n: np.zeros(len(ok) + 1, np.int32) for n, ok in passed.items()}
        for n, ok in passed.items():
            np.cumsum(ok, out=sums[n][1:])
        found = [np.zeros(0, np.int64)]
        for first in range(0, len(anchors), PLACES):
            here = anchors[first : first + PLACES]
            low = int(here[0])
            stretch = words[low : int(here[-1]) + max(SPANS)]
            last = -1
            for turn, chosen, keys, owner, anchor, shift, bit in self.keys:
                if turn != last:
                    (walks, moved), last = walk(stretch, here - low, max(SPANS), turn), turn
                which = np.flatnonzero(_apart(moved, chosen))
                mine = _key(walks, chosen, which)
                seen = np.flatnonzero(bit[(mine >> shift).astype(np.int64)])
                which, mine = which[seen], mine[seen]
                lo = np.searchsorted(keys, mine, "left")
                times = np.searchsorted(keys, mine, "right") - lo
                part_of = np.cumsum(times) // PAIRS
                for part in np.split(np.arange(len(which)), np.flatnonzero(part_of[1:] != part_of[:-1]) + 1):
                    many = times[part]
                    rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    entry = np.repeat(lo[part], many) + rank
                    item = owner[entry].astype(np.int64)
                    begin = np.repeat(here[which[part]], many) - anchor[entry]
                    ok = np.zeros(len(item), bool)
                    for n, upto in sums.items():
                        mask = np.flatnonzero(self.sizes[item] == n)
                        k, end = edits_allowed(n), len(upto) - 1
                        ok[mask] = (
                            upto[np.clip(begin[mask] + k + 1, 0, end)] > upto[np.clip(begin[mask] - k, 0, end)]
                        )
                    found.append(np.unique((begin[ok] + longest) * len(self.items) + item[ok]))
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.items) - longest, pairs % len(self.items)

    @staticmethod
    def windows(item: Item, words: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Starts within the allowed edits of ``begin`` whose window has enough
        words of the item, whatever their multiplicity."""
        n = len(item.words)
        k = edits_allowed(n)
        found = [np.zeros(0, np.int64)]
        step = max(1, PAIRS // (n + 2 * k))
        for a in range(0, len(begin), step):
            part = begin[a : a + step]
            span = part[:, None] + np.arange(-k, n + k)
            seen = words[np.clip(span, 0, len(words) - 1)]
            slot = np.minimum(np.searchsorted(item.distinct, seen), len(item.distinct) - 1)
            total = np.zeros((len(part), n + 2 * k + 1), np.int32)
            np.cumsum((item.distinct[slot] == seen) & (span >= 0) & (span < len(words)), axis=1, out=total[:, 1:])
            row, shift = np.nonzero(total[:, n:] - total[:, : 2 * k + 1] >= n - k)
            found.append(part[row] - k + shift)
        out = np.unique(np.concatenate(found))
        return out[(out >= 0) & (out <= len(words) - n)]

    def hits(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item, first word, edits): the best place of each item in a row,
        of equal ones the window with most of the item's words, then the first."""
        plain, rows = word_hashes(texts, NON_ALNUM)
        if not len(plain) or not self.items:
            return []
        # rows apart by a gap of words that no item has
        counts = np.diff(rows)
        row_of = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(plain)) + row_of * self.gap
        words = np.zeros(len(plain) + (len(counts) + 1) * self.gap, np.uint64)
        words[place] = plain
        known_id = np.zeros(len(words), np.int32)
        known_id[place] = self.word_id[self._slot(plain)]
        known = np.zeros(len(words) + 1, np.int32)
        row_start = rows[:-1] + np.arange(len(counts)) * self.gap
        passed = {}
        for n in self.by_size:
            np.cumsum(self.known[n][known_id], out=known[1:])
            if len(words) > n:
                passed[n] = known[n:] - known[:-n] >= n - edits_allowed(n)
        some = np.zeros(len(words), bool)
        for ok in passed.values():
            some[: len(ok)] |= ok
        begin, items = self.candidates(words, passed, some)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for i in np.unique(items):
            item = self.items[i]
            n = len(item.words)
            k = edits_allowed(n)
            if n not in passed:
                continue
            here = self.windows(item, words, begin[items == i])
            if not len(here):
                continue
            step = max(1, PAIRS // n)
            common = np.concatenate(
                [item.shared(words[here[a : a + step, None] + np.arange(n)]) for a in range(0, len(here), step)]
            )
            # a stretch has at least the edits that its window's words say
            order = np.argsort(-common, kind="stable")
            order = order[common[order] >= n - k]
            done = np.zeros(len(words) + 1, bool)
            for start, least in zip(here[order].tolist(), (n - common[order]).tolist(), strict=True):
                row = max(int(np.searchsorted(row_start, start, "right")) - 1, 0)
                if done[start] or best.get((row, i), (k + 1, 0))[0] <= least:
                    continue
                a = max(int(row_start[row]), start - k)
                b = min(int(row_start[row] + counts[row]), start + n + k)
                edits = infix_distance(item, words[a:b].tolist())
                # stretches that begin up to k words before lie in it too
                done[max(0, start - k) : start + 1] = True
                if edits <= k and edits < best.get((row, i), (k + 1, 0))[0]:
                    best[row, i] = (edits, max(start - int(row_start[row]), 0))
        return [(row, i, first, edits) for (row, i), (edits, first) in sorted(best.items())]


def _blocks(bench: DataFrame, item_id: str, text: str) -> Iterator[list[Item]]:
    """The items, block by block: never more than about ``BLOCK_ITEMS`` at
    once on the driver or in a task."""
    items = bench.select(F.col(item_id).alias("i"), F.col(text).cast("string").alias("t"))
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for b in range(blocks):
        here = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = here.distinct().orderBy("i", "t").collect()
        yield items_of([(r["i"], r["t"]) for r in rows])


def _find(searcher_of, item_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = searcher_of()
        for batch in batches:
            texts = text_column(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in steps(texts):
                hits = searcher.hits(texts.slice(a, b - a))
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([a + h[0] for h in hits])),
                            pa.array([searcher.items[h[1]].id for h in hits], item_type),
                            pa.array([h[2] for h in hits], pa.int64()),
                            pa.array([len(searcher.items[h[1]].words) for h in hits], pa.int64()),
                            pa.array([h[3] for h in hits], pa.int64()),
                        ],
                        ["doc_id", "item_id", "first_word", "item_words", "edits"],
                    )

    return run


def _drop(searcher_of, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = searcher_of()
        for batch in batches:
            texts = text_column(batch.column(text))
            clean = np.ones(len(texts), bool)
            for a, b in steps(texts):
                for row, *_ in searcher.hits(texts.slice(a, b - a)):
                    clean[a + row] = False
            yield batch.filter(pa.array(clean))

    return run


def _sent(docs: DataFrame, items: list[Item]):
    """The block as a broadcast variable; each task builds its searcher once."""
    value = docs.sparkSession.sparkContext.broadcast([(x.id, x.words) for x in items])
    return lambda: Searcher([Item(i, w) for i, w in value.value])


def contaminated(
    docs: DataFrame,
    bench: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, first_word, item_words, edits) of contaminated
    documents: the best window of each item in each, the first if several."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    types = (docs.schema[doc_id].dataType, bench.schema[item_id].dataType)
    schema = (
        f"doc_id {types[0].simpleString()}, item_id {types[1].simpleString()}, "
        "first_word long, item_words long, edits long"
    )
    parts = [
        rows.mapInArrow(_find(_sent(docs, items), to_arrow_type(types[1])), schema)
        for items in _blocks(bench, item_id, item_text)
    ]
    found = reduce(DataFrame.unionByName, parts)
    return (
        found.groupBy("doc_id", "item_id", "item_words")
        .agg(F.min(F.struct("edits", "first_word")).alias("b"))
        .select("doc_id", "item_id", F.col("b.first_word").alias("first_word"), "item_words", F.col("b.edits").alias("edits"))
    )


def drop_contaminated(
    docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` without the contaminated rows, decided row by row in place."""
    for items in _blocks(bench, item_id, item_text):
        docs = docs.mapInArrow(_drop(_sent(docs, items), text), docs.schema)
    return docs
