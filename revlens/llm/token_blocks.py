"""Token-id output in compressed blocks: an adaptive context-mixing range coder.

Documents are tokenised, an end id is appended to each, and the ids go in
ascending document order into blocks. Every block is coded on its own: models
start empty, and a header carries sizes and checksums, so a block can be read,
checked or lost without its neighbours.

Model. Two predictions name one id each: order 2 (the id that last followed
the two ids before) and order 1 (after the one before), each with a confidence
from 0 to 7 that grows with hits and shrinks with misses. Order 0 is an
adaptive distribution over all ids seen in the block. The three are mixed
into one distribution: the weights of the two named ids and of the order-0
rest are learned per pair of confidences from how often each was right so far
in the block. One range-coder step codes an id under the mixture; an id new
to the block follows in a second, uniform step.

A block is cut into lanes, contiguous runs of ids that take their steps
together and share the block's model; every lane has its own range coder
(64-bit carry-less, 32-bit words). Steps are numpy operations over all lanes of
several blocks, which is what makes coding in Python tasks affordable.

File format. A Parquet table in the shared folder, one row per block, written
and committed by Spark (a retried task leaves no partial file): ``part``
(range partition in document order), ``block`` (number in the part), ``docs``
(document ids, with rank of equal ids by order), ``lengths`` (ids of each
document in this block; the first document may go on from the block before),
``n_ids``, ``crc32`` (of the ids as little-endian 32-bit integers),
``payload`` (lane count, words per lane, coded words) and ``payload_crc32``.

Defined results: NULL text counts as empty and gives the end id only; a NULL
doc id comes first in the order; rows equal in id are kept as separate
documents, ordered by a hash of their text; a document longer than a block
goes on in the next; empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

import os
import struct
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shared_path, tokenizer_path
from .textgrams import raw, steps, text_column

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1 << 17
LANES = 512
GROUP = 16
#: Ids must be below this.
MAX_ID = 1 << 16
CACHE_PIECES = 600_000
#: New words that the model takes as one text, and texts in one call.
CALL_WORDS, CALLS = 32, 256
#: Text bytes that are tokenised together.
STEP_BYTES = 4_000_000
#: What ``str.isspace`` holds for beside a blank and a line break, and those two
#: at an end of a text or beside one another.
ODD_SPACE = (
    r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
)

_HI_BITS, _LO_BITS = 12, 16
_HI, _LO = 1 << _HI_BITS, 1 << _LO_BITS
_WORD, _FIVE = np.uint64(32), np.uint64(5)
_LOW32 = np.uint64(0xFFFFFFFF)
_TOP = np.uint64(1 << 32)
#: A named id and its confidence share one integer: the id in the lower bits.
_NAME, _ONE = np.uint32(0xFFFF), np.uint32(1 << 16)
_MOST = np.uint32(7 << 16)
_NAME_BITS, _THREE, _SIX = np.uint32(16), np.uint32(3), np.uint32(6)
#: The two ids before are mixed to 16 bits.
_MIX2, _MIX1 = np.uint16(40503), np.uint16(30103)


class Tokens:
    """Ids of whole texts by the tokenizers library.

    The tokenizer first splits a text into stretches of letters, digits, other
    characters and white space, and never merges across them. So a text can be
    cut before a blank between two other characters, around a single line
    break between such, and between a word and the punctuation behind it. Ids
    of pieces and words met before are remembered and only new words go to the
    library, many in one call. Pieces are looked up once for
    all texts of a step. The memory has two generations of ``CACHE_PIECES``: a
    full young one becomes the old one, and what is met again moves back, so
    frequent words outlast any number of rare ones. A special token's string in
    a text is that token, as the library has it, and ends the stretches beside it.
    """

    TAIL = ".,;:!?*$%&#|\"()"
    #: Letters beside ASCII ones that are cut from closing punctuation for all texts of a step.
    LETTERS = ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x400, 0x481), (0x48A, 0x52F))

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content: array("H", [i]).tobytes() for i, t in added.items()}
        self.cut = re.compile("|".join(f"({re.escape(s)})" for s in self.special) or r"(?!)")
        self.tail = np.zeros(256, bool)
        self.tail[list(self.TAIL.encode())] = True
        self.letter = np.zeros(0x800, bool)  # of characters up to two bytes
        for a, b in ((0x41, 0x5A), (0x61, 0x7A), *self.LETTERS):
            self.letter[a : b + 1] = True
        self.model = self.library.model
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        # the printable stand-ins that byte-level BPE has for bytes
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        self.blank = chr(256 + others.index(0x20))
        self.stand_in = {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(others)}}
        # the model alone; a byte that no text has and no merge takes stands between words
        self.joined = Tokenizer(self.model)
        bounds = [chr(self.stand_in[b]) for b in (0xFF, 0xFE, 0xC0, 0xC1)]
        vocab = self.library.get_vocab(with_added_tokens=False)
        bounds = [c for c in bounds if [x for x in vocab if c in x] == [c]]
        self.bound = vocab[bounds[0]] if bounds else None
        self.stand_ins = np.array([self.stand_in[b] for b in range(256)], "<u4")
        if bounds:
            self.stand_ins[0x0A] = ord(bounds[0])

    @staticmethod
    def pieces(text: str) -> list[str]:
        if " ".join(text.split()) == text.replace("\n", " ") and "\0" not in text:
            # all white space is single and between words: cut at each blank
            return text.replace(" ", "\0 ").split("\0")
        parts = text.split(" ")
        out = [parts[0]]
        for p in parts[1:]:
            if p and out[-1] and not p[0].isspace() and not out[-1][-1].isspace():
                out.append(" " + p)
            else:  # next to other white space: not a safe cut
                out[-1] += " " + p
        return out

    @classmethod
    def finer(cls, piece: str) -> list[str]:
        """A piece cut around line breaks and before closing punctuation."""
        lines = piece.split("\n") if "\n" in piece else ()
        if lines and all(x and not x[-1].isspace() and (i == 0 or not x[0].isspace()) for i, x in enumerate(lines)):
            return [y for i, x in enumerate(lines) for y in (["\n"] if i else []) + cls.finer(x)]
        core = piece.rstrip(cls.TAIL)
        if core != piece and core and core[-1].isalpha():
            return [core, piece[len(core) :]]
        return [piece]

    def letters(self, word: str, core: str) -> bytes:
        """Ids of one stretch of letters, ``core``, with or without a blank
        before it: straight to the BPE model."""
        if core.isascii():
            stand_ins = core if core is word else self.blank + core
        else:
            stand_ins = word.encode().decode("latin-1").translate(self.stand_in)
        return array("H", [t.id for t in self.model.tokenize(stand_ins)]).tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """``letters`` of many words, ``CALL_WORDS`` at once."""
        if self.bound is None:
            return [self.letters(x, x[1:] if x[:1] == " " else x) for x in words]
        calls = ["\n".join([*words[a : a + CALL_WORDS], ""]) for a in range(0, len(words), CALL_WORDS)]
        calls = [self.stand_ins[np.frombuffer(x.encode(), np.uint8)].tobytes().decode("utf-32-le") for x in calls]
        out = []
        for a in range(0, len(calls), CALLS):
            coded = self.joined.encode_batch_fast(calls[a : a + CALLS], add_special_tokens=False)
            ids = np.array([i for x in coded for i in x.ids], np.uint16)
            flat, ends = ids.tobytes(), (2 * (ids == self.bound).nonzero()[0]).tolist()
            out += [flat[x:y] for x, y in zip([0, *[e + 2 for e in ends]], ends)]
        return out

    def missed_all(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that the young memory lacks, which then has them."""
        got = list(map(self.known_before.get, pieces))
        new = [i for i, x in enumerate(got) if x is None]
        words = [i for i in new if (x := pieces[i]).isalpha() or x[:1] == " " and x[1:].isalpha()]
        for i, ids in zip(words, self.words([pieces[i] for i in words]), strict=True):
            got[i] = ids
        self.known.update((x, ids) for x, ids in zip(pieces, got, strict=True) if ids is not None)
        for i in new:
            if got[i] is None:
                got[i] = self.missed(pieces[i])
        return got

    def missed(self, piece: str) -> bytes:
        """Ids of a piece that the young memory lacks, which then has them."""
        got = self.known_before.get(piece)
        if got is None:
            core = piece[1:] if piece[:1] == " " else piece
            if core.isalpha():
                got = self.letters(piece, core)
            elif len(finer := self.finer(piece)) > 1:
                got = b"".join([self.known.get(x) or self.missed(x) for x in finer])
            else:
                got = array("H", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        self.known[piece] = got
        return got

    def make_room(self) -> None:
        if len(self.known) >= CACHE_PIECES:
            self.known_before, self.known = self.known, {}

    def cut_all(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts without odd white space, and which piece each text
        begins with: cut before blanks, around line breaks and before punctuation
        that closes a word."""
        data, offsets = raw(texts)
        begins = data == 0x20
        lines = (data == 0x0A).nonzero()[0]
        begins[lines] = begins[lines + 1] = True
        begins[offsets[offsets < len(data)]] = True
        # runs of punctuation within a text
        tail = self.tail[data]
        first, last = tail.copy(), tail.copy()
        first[1:] &= ~tail[:-1] | begins[1:]
        last[:-1] &= ~tail[1:] | begins[1:]
        first, last = first.nonzero()[0], last.nonzero()[0]
        ended = np.append(begins, True)[last + 1]
        first = first[ended & ~begins[first]]
        before, lead = data[first - 1].astype(np.int64), data[np.maximum(first - 2, 0)].astype(np.int64)
        two = (before & 0xC0 == 0x80) & (lead & 0xE0 == 0xC0)  # a character of two bytes
        code = np.where(two, (lead & 0x1F) << 6 | before & 0x3F, np.where(before < 0x80, before, 0))
        begins[first[self.letter[code]]] = True
        at = begins.nonzero()[0]
        pieces = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)
        )
        return pieces, np.searchsorted(at, offsets)

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids (uint16) of each of some texts (large strings, no NULL).

        Texts whose white space is single blanks and line breaks between words
        are cut at each, and the distinct pieces of all of them looked up once.
        """
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        even = texts.filter(pa.array(~odd))
        pieces, ends = self.cut_all(even)
        coded = pieces.dictionary_encode()
        self.make_room()
        known = self.known
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, names))
        lacking = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(lacking, self.missed_all([names[i] for i in lacking]), strict=True):
            ids[i] = x
        spread = pa.array(ids, pa.large_binary()).take(coded.indices)
        places = np.frombuffer(spread.buffers()[1], np.int64)[ends] // 2
        flat = np.frombuffer(spread.buffers()[2] or b"", np.uint16)
        at = 0
        for i, alone in enumerate(odd):
            if alone:
                yield self.encode(texts[i].as_py())
            else:
                yield flat[places[at] : places[at + 1]]
                at += 1

    def encode(self, text: str) -> np.ndarray:
        """Ids (uint16) of a whole text."""
        if any(s in text for s in self.special):
            parts = [x for x in self.cut.split(text) if x]
            return np.frombuffer(b"".join([self.special.get(x) or self.stretch(x) for x in parts]), np.uint16)
        return np.frombuffer(self.stretch(text), np.uint16)

    def stretch(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        parts = self.pieces(text)
        got = list(map(self.known.get, parts))
        if None in got:
            self.make_room()
            known = self.known
            for i, x in enumerate(got):
                if x is None:
                    x = known.get(parts[i])
                    got[i] = self.missed(parts[i]) if x is None else x
        return b"".join(got)


def worker_tokens(path: str) -> Tokens:
    """The tokens of this Python worker, kept from task to task with the words
    they have met. Functions are shipped by value, so a global of theirs would
    begin anew with every task; a module entry of the process lasts."""
    kept = sys.modules.setdefault("_revlens_worker", types.ModuleType("_revlens_worker"))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if getattr(kept, "path", None) != path:
        kept.path, kept.tokens = path, Tokens(path)
    return kept.tokens


class Model:
    """Mixture state of ``n`` blocks that are coded together. Only a decoder
    looks up which id a slot of order 0 stands for (``slots``)."""

    def __init__(self, blocks: int, slots: bool):
        self.b = blocks
        self.named2 = np.zeros(blocks << 16, np.uint32)
        self.named1 = np.zeros(blocks << 16, np.uint32)
        # outcome counts by (block, same name?, confidence 2, confidence 1)
        self.hits = np.tile(np.array([[1, 1, 2]], np.int64), (blocks * 128, 1))
        self.apart = np.arange(blocks * 128) & 64 == 0  # the two names differ
        self.weights()
        self.counts = np.zeros(blocks << 16, np.int32)
        self.share0 = np.zeros(blocks << 16, np.uint32)  # frequency above 16 bits of start; 0 for new ids
        self.slot0 = np.zeros(blocks << 16, np.uint16) if slots else None
        self.novel = np.full(blocks, _LO, np.uint32)  # slots of ids not seen yet

    def weights(self) -> None:
        n = self.hits
        total = n.sum(axis=1)
        f2 = 1 + n[:, 0] * (_HI - 8) // total
        f1 = (1 + n[:, 1] * (_HI - 8) // total) * self.apart
        self.shares = (f2 << 16 | f1).astype(np.uint32)

    def order0(self, block: int) -> None:
        """The order-0 distribution of the ids counted so far."""
        c = self.counts[block << 16 : (block + 1) << 16]
        ids = (c != 0).nonzero()[0]
        seen = c[ids]
        room = _LO - len(ids) - 256
        # below 2**33 by below 2**18: the float quotient's floor is exact
        freq = 1 + (seen * float(max(room, 0)) / max(int(seen.sum()), 1)).astype(np.int64)
        if len(ids) >= _LO - 256:  # no room to tell them apart
            freq = np.ones(len(ids), np.int64)
        starts = np.cumsum(freq) - freq
        base = block << 16
        # a frequency is below 2**16: the room is, and one id has all of it at most
        self.share0[base + ids] = (freq << _LO_BITS) | starts
        used = int(freq.sum())
        if self.slot0 is not None:
            self.slot0[base : base + used] = np.repeat(ids.astype(np.uint16), freq)
        self.novel[block] = _LO - used


def _pick(which: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``np.where`` of two arrays of one unsigned type, without branches."""
    mask = np.negative(which.view(np.uint8)).view(np.int8).astype(a.dtype)
    return b ^ ((a ^ b) & mask)


def _rebuild_at(steps: int) -> set[int]:
    """Steps after which order 0 is brought up to date: soon, then rarer."""
    out, t, gap = set(), 1, 1
    while t < steps:
        out.add(t)
        gap = min(2 * gap, 64)
        t += gap
    return out


class _Run:
    """Walks the lanes of some blocks step by step; coder-independent part.

    ``lane_block`` must be ascending; all lanes of a block have ``length``
    steps but the later lanes may end earlier. Ids are 16-bit and shares
    below 2**29, and arrays are kept that narrow: a step is many passes over them.
    All places lie within their tables; ``mode="clip"`` only spares the search for others.
    """

    def __init__(self, lane_block: np.ndarray, lane_len: np.ndarray, blocks: int, slots: bool = False):
        self.block = lane_block
        self.len = lane_len
        self.model = Model(blocks, slots)
        self.p1 = np.zeros(len(lane_block), np.uint16)
        self.p2 = np.zeros(len(lane_block), np.uint16)
        self.base = lane_block.astype(np.int64) << 16
        self.at = self.base.copy()  # places of p1 in the tables
        self.cell = lane_block.astype(np.uint32) << np.uint32(7)
        self.steps = int(lane_len.max()) if len(lane_len) else 0
        self.rebuild = _rebuild_at(self.steps)
        self.pending: list[np.ndarray] = []
        self.outcomes: list[np.ndarray] = []

    def context(self, on):
        m, i1 = self.model, self.at[on]
        i2 = self.base[on] + ((self.p2[on] * _MIX2) ^ (self.p1[on] * _MIX1))
        e2, e1 = m.named2.take(i2, mode="clip"), m.named1.take(i1, mode="clip")
        n2, n1 = e2.astype(np.uint16), e1.astype(np.uint16)
        same = (n2 == n1).view(np.uint8)
        cell = self.cell[on] + (((e2 >> _NAME_BITS) << _THREE) + (e1 >> _NAME_BITS)) + (same.astype(np.uint32) << _SIX)
        shares = m.shares.take(cell, mode="clip")
        return i2, i1, n2, n1, e2, e1, cell, shares >> _NAME_BITS, shares & _NAME

    def interval(self, on, at, ctx, hit2, hit1, new=None):
        """(start, size) of the step of the ids at ``at``, and which are new to
        order 0. A decoder knows the latter from the slot."""
        f2, f1 = ctx[7], ctx[8]
        share = self.model.share0.take(at, mode="clip")
        freq, begin = share >> _NAME_BITS, share & _NAME
        if new is None:
            new = share == 0
        fresh = new.nonzero()[0]
        novel = self.model.novel.take(self.block[on][fresh])
        freq[fresh], begin[fresh] = novel, np.uint32(_LO) - novel
        named = f2 + f1
        rest = np.uint32(_HI) - named
        f2 <<= _NAME_BITS
        f1 <<= _NAME_BITS
        named <<= _NAME_BITS
        start = _pick(hit1, f2, rest * begin + named) * ~hit2
        size = _pick(hit2, f2, _pick(hit1, f1, rest * freq))
        return start.astype(np.uint64), size.astype(np.uint64), new

    def learn(self, t: int, on, ids, at, ctx, hit2, hit1) -> None:
        m = self.model
        i2, i1, _, n1, e2, e1, cell, _, _ = ctx
        outcome = cell * np.uint32(3)
        outcome += np.uint32(2)
        outcome -= hit1.view(np.uint8) + (hit2.view(np.uint8) << np.uint8(1))
        self.outcomes.append(outcome)
        fresh = ids.astype(np.uint32)
        for i, entry, right, named in ((i2, e2, hit2, m.named2), (i1, e1, n1 == ids, m.named1)):
            # a miss lowers the confidence, and at none the name is replaced
            missed = _pick(entry >= _ONE, entry - _ONE, fresh)
            named[i] = _pick(right, entry + _ONE * (entry < _MOST), missed)
        if isinstance(on, slice):  # all lanes
            self.p2, self.p1, self.at = self.p1, ids, at
        else:
            self.p2[on] = self.p1[on]
            self.p1[on] = ids
            self.at = self.at.copy()  # the one before may be pending
            self.at[on] = at
        self.pending.append(at)
        rebuilt = t + 1 in self.rebuild
        if rebuilt:
            np.add.at(m.counts, np.concatenate(self.pending), np.int32(1))
            self.pending = []
            for b in range(m.b):
                m.order0(b)
        if rebuilt or t % 8 == 7:
            m.hits += np.bincount(np.concatenate(self.outcomes), minlength=m.hits.size).reshape(m.hits.shape)
            self.outcomes = []
            m.weights()


def _lanes(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(block of each lane, ids in it) for blocks laid end to end; the split
    depends on the block's size only."""
    block, length = [], []
    for b, n in enumerate(sizes):
        lanes = max(1, min(LANES, n // 64))
        per = -(-n // lanes)
        begin = np.minimum(np.arange(lanes) * per, n)
        end = np.minimum(begin + per, n)
        block.append(np.full(lanes, b, np.int64))
        length.append(end - begin)
    return np.concatenate(block), np.concatenate(length)


def _settle(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    """Whether each lane's upper word is settled; ranges too small to go on are
    cut to the end of their upper word first, which settles it."""
    settled = (low ^ (low + rng)) < _TOP
    small = rng < _TOP
    if small.any():
        cut = (small & ~settled).nonzero()[0]
        rng[cut] = (~low[cut] & _LOW32) + np.uint64(1)
        settled |= small
    return settled


class _Encoder:
    def __init__(self, lanes: int, room: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        # lanes side by side, as they write at much the same pace
        self.words = np.zeros((room, lanes), np.uint32)
        self.next = np.arange(lanes)  # places of the lanes' next words

    def put(self, on, start, size, bits: int) -> None:
        r = self.range[on] >> np.uint64(bits)
        low = self.low[on] + r * start
        rng = r * size
        out = _settle(low, rng)
        # all lanes write; those not settled write there again
        self.words.ravel()[self.next[on]] = low >> _WORD
        self.next[on] += out * np.int64(self.words.shape[1])
        shift = out.astype(np.uint64) << _FIVE
        self.low[on], self.range[on] = low << shift, rng << shift

    def finish(self) -> None:
        for _ in range(2):
            self.words.ravel()[self.next] = self.low >> _WORD
            self.next += self.words.shape[1]
            self.low <<= _WORD

    def payload(self, a: int, b: int) -> bytes:
        """The coded lanes from ``a`` up to ``b``."""
        n = self.next[a:b] // self.words.shape[1]
        words = self.words[: n.max(), a:b].T
        written = np.arange(words.shape[1]) < n[:, None]
        return struct.pack("<I", b - a) + n.astype("<u4").tobytes() + words[written].astype("<u4").tobytes()


class _Decoder:
    def __init__(self, words: np.ndarray, n: np.ndarray):
        """``words`` of all lanes, lane after lane, ``n`` of each."""
        lanes = len(n)
        self.words = np.zeros((max(2, int(n.max())) + 1, lanes), np.uint32)  # lanes side by side
        self.words.T[np.arange(len(self.words)) < n[:, None]] = words
        self.next = np.arange(lanes) + 2 * lanes
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.code = (self.words[0].astype(np.uint64) << _WORD) | self.words[1]

    def peek(self, on, bits: int) -> np.ndarray:
        r = self.range[on] >> np.uint64(bits)
        return np.minimum((self.code[on] - self.low[on]) // r, np.uint64((1 << bits) - 1))

    def take(self, on, start, size, bits: int) -> None:
        r = self.range[on] >> np.uint64(bits)
        low = self.low[on] + r * start
        rng = r * size
        out = _settle(low, rng)
        shift = out.astype(np.uint64) << _FIVE
        # lanes not settled read no bits of their next word
        word = self.words.take(self.next[on], mode="clip").astype(np.uint64) >> (_WORD - shift)
        self.code[on] = (self.code[on] << shift) | word
        self.next[on] += out * np.int64(self.words.shape[1])
        self.low[on], self.range[on] = low << shift, rng << shift


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks of ids (uint16 values), each independent."""
    if not blocks:
        return []
    lane_block, lane_len = _lanes([len(b) for b in blocks])
    run = _Run(lane_block, lane_len, len(blocks))
    lane_at = np.searchsorted(lane_block, np.arange(len(blocks) + 1))
    coder = _Encoder(len(lane_block), 2 * run.steps + 4)
    steps_ids = np.zeros((run.steps, len(lane_block)), np.uint16)
    for block, a, b in zip(blocks, lane_at[:-1].tolist(), lane_at[1:].tolist()):
        held = np.arange(run.steps) < lane_len[a:b, None]
        steps_ids[:, a:b].T[held] = block
    shortest = int(lane_len.min())
    for t in range(run.steps):
        on = slice(None) if t < shortest else np.flatnonzero(lane_len > t)
        ids = steps_ids[t, on]
        at = run.base[on] + ids
        ctx = run.context(on)
        n2, n1 = ctx[2], ctx[3]
        hit2 = n2 == ids
        hit1 = ~hit2 & (n1 == ids)
        start, size, new = run.interval(on, at, ctx, hit2, hit1)
        coder.put(on, start, size, _HI_BITS + _LO_BITS)
        extra = (new & ~hit2 & ~hit1).nonzero()[0]
        if len(extra):
            lanes = extra if isinstance(on, slice) else on[extra]
            coder.put(lanes, ids[extra].astype(np.uint64), np.uint64(1), 16)
        run.learn(t, on, ids, at, ctx, hit2, hit1)
    coder.finish()
    return [coder.payload(a, b) for a, b in zip(lane_at[:-1].tolist(), lane_at[1:].tolist())]


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """Ids (uint16) of the payloads, whose blocks held ``sizes`` ids."""
    if not payloads:
        return []
    lane_block, lane_len = _lanes(sizes)
    parts, counts = [], []
    for b, p in enumerate(payloads):
        (lanes,) = struct.unpack_from("<I", p)
        if lanes != int((lane_block == b).sum()):
            raise ValueError("block header does not fit its size")
        n = np.frombuffer(p, "<u4", lanes, 4).astype(np.int64)
        counts.append(n)
        parts.append(np.frombuffer(p, "<u4", offset=4 + 4 * lanes))
    run = _Run(lane_block, lane_len, len(sizes), slots=True)
    coder = _Decoder(np.concatenate(parts).astype(np.uint32), np.concatenate(counts))
    model = run.model
    shortest = int(lane_len.min())
    out = np.zeros((run.steps, len(lane_block)), np.uint16)
    for t in range(run.steps):
        on = slice(None) if t < shortest else np.flatnonzero(lane_len > t)
        ctx = run.context(on)
        n2, n1, f2, f1 = ctx[2], ctx[3], ctx[7], ctx[8]
        v = coder.peek(on, _HI_BITS + _LO_BITS).astype(np.uint32)
        hi = v >> _NAME_BITS
        named = f2 + f1
        hit2 = hi < f2
        hit1 = (hi < named) & ~hit2
        # below 2**28 by below 2**12: the float quotient's floor is exact
        floor = named << _NAME_BITS
        slot = ((np.maximum(v, floor) - floor) / (np.uint32(_HI) - named)).astype(np.uint32)
        slot = np.minimum(slot, np.uint32(_LO - 1))
        ids = _pick(hit2, n2, _pick(hit1, n1, model.slot0.take(run.base[on] + slot, mode="clip")))
        # the slots at the end stand for ids not met yet: an id past all others
        beyond = slot >= np.uint32(_LO) - model.novel.take(run.block[on], mode="clip")
        at = run.base[on] + ids
        start, size, new = run.interval(on, at, ctx, hit2, hit1, beyond)
        coder.take(on, start, size, _HI_BITS + _LO_BITS)
        extra = (new & ~hit2 & ~hit1).nonzero()[0]
        if len(extra):
            lanes = extra if isinstance(on, slice) else on[extra]
            raw = coder.peek(lanes, 16)
            coder.take(lanes, raw, np.uint64(1), 16)
            ids[extra] = raw.astype(np.uint16)
            at[extra] = run.base[lanes] + ids[extra]
        run.learn(t, on, ids, at, ctx, hit2, hit1)
        out[t, on] = ids
    result = []
    lane_at = np.searchsorted(lane_block, np.arange(len(sizes) + 1))
    for a, b in zip(lane_at[:-1].tolist(), lane_at[1:].tolist()):
        held = np.arange(run.steps) < lane_len[a:b, None]
        result.append(out[:, a:b].T[held])
    return result


BLOCK_SCHEMA = (
    "part int, block long, docs array<bigint>, continues boolean, lengths array<bigint>, "
    "n_ids long, crc32 long, payload binary, payload_crc32 long"
)


def _ids32_crc(ids: np.ndarray, crc: int = 0) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), crc)


def _encode_part(path: str, block_ids: int):
    """One sorted partition of documents to block rows; holds ``GROUP``
    blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(path)
        schema = pa.schema(
            [
                ("part", pa.int32()),
                ("block", pa.int64()),
                ("docs", pa.list_(pa.int64())),
                ("continues", pa.bool_()),
                ("lengths", pa.list_(pa.int64())),
                ("n_ids", pa.int64()),
                ("crc32", pa.int64()),
                ("payload", pa.binary()),
                ("payload_crc32", pa.int64()),
            ]
        )
        part, number = None, 0
        ready: list[tuple[list, list, bool, np.ndarray]] = []
        docs: list = []
        lengths: list[int] = []
        pieces: list[np.ndarray] = []
        filled, continues = 0, False

        def close() -> None:
            nonlocal docs, lengths, pieces, filled, continues
            ready.append((docs, lengths, continues, np.concatenate(pieces)))
            docs, lengths, pieces, filled, continues = [], [], [], 0, False

        def flush() -> pa.RecordBatch:
            nonlocal number, ready
            rows = []
            for (d, n, cont, ids), payload in zip(ready, encode_blocks([r[3] for r in ready]), strict=True):
                rows.append((part, number, d, cont, n, len(ids), _ids32_crc(ids), payload, zlib.crc32(payload)))
                number += 1
            ready = []
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for batch in batches:
            ids_of, texts = batch.column("doc_id").to_pylist(), text_column(batch.column("text"))
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for a, b in steps(texts, STEP_BYTES):
                for doc, words in zip(ids_of[a:b], tokens.encode_all(texts.slice(a, b - a)), strict=True):
                    ids = np.append(words, np.uint16(END_ID))
                    at = 0
                    while at < len(ids):
                        take = min(len(ids) - at, block_ids - filled)
                        if not docs and at:
                            continues = True
                        docs.append(doc)
                        lengths.append(take)
                        pieces.append(ids[at : at + take])
                        filled += take
                        at += take
                        if filled == block_ids:
                            close()
                            if len(ready) == GROUP:
                                yield flush()
        if docs:
            close()
        if ready:
            yield flush()

    return run


def write_blocks(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write the block table and return it as read back.

    Rows are range partitioned and sorted by (id, text hash), so parts and
    blocks follow document order; copies of one id can spread over parts.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    dealt = (
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    file = tokenizer_path(tokenizer)
    dealt.mapInArrow(_encode_part(file, block_ids), BLOCK_SCHEMA).write.parquet(path)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


DIGEST_SCHEMA = (
    "part int, block long, nth long, doc_id bigint, n long, crc long, open_start boolean, open_end boolean"
)


def read_ids(batches: Iterator[pa.RecordBatch], group: int = GROUP) -> Iterator[tuple[dict, np.ndarray]]:
    """(block row, ids) of block rows; checks both checksums."""
    for batch in batches:
        rows = batch.to_pylist()
        for a in range(0, len(rows), group):
            some = rows[a : a + group]
            for r in some:
                if zlib.crc32(r["payload"]) != r["payload_crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']}: damaged payload")
            for r, ids in zip(
                some, decode_blocks([r["payload"] for r in some], [r["n_ids"] for r in some]), strict=True
            ):
                if _ids32_crc(ids) != r["crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']}: wrong ids")
                yield r, ids


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and block it lies in, with the crc of its ids."""
    names = ["part", "block", "nth", "doc_id", "n", "crc", "continues"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    for row, ids in read_ids(batches):
        out = []
        at = 0
        for i, (doc, n) in enumerate(zip(row["docs"], row["lengths"], strict=True)):
            out.append((row["part"], row["block"], i, doc, n, _ids32_crc(ids[at : at + n]), row["continues"] and i == 0))
            at += n
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )


def _joined_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crc of documents that lie in several blocks, from crc and length of
    their stretches in order."""
    for batch in batches:
        rows = batch.to_pylist()
        crcs = []
        for r in rows:
            crc, stretches = 0, sorted(r["stretches"], key=lambda s: (s["block"], s["nth"]))
            for i, s in enumerate(stretches):
                crc = s["crc"] if i == 0 else crc32_combine(crc, s["crc"], 4 * s["n"])
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("part"),
                batch.column("seq"),
                batch.column("doc_id"),
                batch.column("n_tokens"),
                pa.array(crcs, pa.int64()),
            ],
            ["part", "seq", "doc_id", "n_tokens", "ids_crc32"],
        )


def _gf2_times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if not vector:
            break
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def crc32_combine(crc1: int, crc2: int, length2: int) -> int:
    """crc32 of two byte strings laid end to end, from their crcs."""
    # the operator that appends one zero bit, squared to 1, 2, 4... bytes
    operator = [0xEDB88320] + [1 << i for i in range(31)]
    for _ in range(3):
        operator = [_gf2_times(operator, row) for row in operator]
    while length2:
        if length2 & 1:
            crc1 = _gf2_times(operator, crc1)
        operator = [_gf2_times(operator, row) for row in operator]
        length2 >>= 1
    return crc1 ^ crc2


def digests(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from
    the blocks. Offsets come from the totals per part (one small row each)
    and running sums inside a part."""
    from .common import stored

    stretch = blocks.mapInArrow(
        _digest_batches, "part int, block long, nth long, doc_id long, n long, crc long, continues boolean"
    )
    in_part = W.partitionBy("part").orderBy("block", "nth")
    # a stretch that does not continue the one before begins a document
    numbered = stored(
        stretch.withColumn("seq", F.sum((~F.col("continues")).cast("long")).over(in_part)), "stretches"
    )
    found = numbered.groupBy("part", "seq", "doc_id").agg(
        F.sum("n").alias("n_tokens"),
        F.collect_list(F.struct("block", "nth", "n", "crc")).alias("stretches"),
    )
    # nearly all documents lie in one block, whose crc is theirs
    alone = F.size("stretches") == 1
    docs = (
        found.where(alone)
        .select("part", "seq", "doc_id", "n_tokens", F.col("stretches")[0]["crc"].alias("ids_crc32"))
        .unionByName(
            found.where(~alone).mapInArrow(
                _joined_crc, "part int, seq long, doc_id long, n_tokens long, ids_crc32 long"
            )
        )
    )
    before = (
        numbered.groupBy("part")
        .agg(F.sum("n").alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .select("part", "base")
    )
    running = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq"))
    return (
        docs.withColumn("end", running)
        .join(F.broadcast(before), "part")
        .select(
            "doc_id", (F.col("base") + F.col("end") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"
        )
    )


def write_and_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode ``docs`` to a new block table and digest what is read back."""
    return digests(write_blocks(docs, shared_path(docs.sparkSession, "token-blocks"), doc_id, text))
