"""Language identification by error-correcting output codes.

Each language has a codeword of bits. A binary logistic classifier over hashed
byte n-grams (2 and 3 bytes of the letters) predicts each bit. Decoding sums
the logistic loss of every bit's margin against a language's codeword,
weighted by how well that bit's classifier did on training rows set aside,
and takes the nearest codeword; a small lead over the second flags the row as
ambiguous.

Up to six languages get exhaustive codes, more get the random code of largest
least distance among several draws, with 15 log2(languages) bits.

Training reads a bounded sample: about ``PER_LANGUAGE`` labelled rows of each
of the ``MOST_LANGUAGES`` languages with most rows (of equal ones the first by
name), fewer of each where that would exceed ``MOST_ROWS`` in all. The rows are
chosen by a hash of the id so that every run takes the same; their n-gram
shares (at most ``BUCKETS`` numbers a row) go to the driver, never texts.
Prediction reads only the text.

Defined results: an id that is repeated with one language is learned from
once; NULL text counts as empty; a text without a letter, and
every text if no language could be learned, gives ``und`` with score 0; NULL
ids and NULL languages are not learned from, rows with NULL ids are scored
(held_out NULL); repeated rows get equal results; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold
from .textgrams import raw, steps, text_column

BUCKETS = 4096
PER_LANGUAGE = 500
MOST_LANGUAGES = 200
MOST_ROWS = 12_000
ROUNDS = 150
AMBIGUOUS = 0.2
UNKNOWN = "und"


def gram_counts(texts: pa.Array) -> np.ndarray:
    """(rows x BUCKETS) hashed counts of 2- and 3-byte runs of lower-case text,
    all that is neither letter nor non-ASCII taken as a blank."""
    flat, offsets = raw(pc.utf8_lower(texts))
    n = len(texts)
    if not len(flat):
        return np.zeros((n, BUCKETS), np.float32)
    letter = ((flat >= 0x61) & (flat <= 0x7A)) | (flat >= 0x80)
    x = np.where(letter, flat, 0x20).astype(np.uint32)
    row = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros(n * BUCKETS, np.int64)
    for size in (2, 3):
        if len(x) < size:
            continue
        m = len(x) - size + 1
        code = np.zeros(m, np.uint32)
        some = np.zeros(m, bool)
        for k in range(size):
            code = code * np.uint32(0x9E3779B1) + x[k : m + k] * np.uint32(0x85EBCA6B) + np.uint32(size)
            some |= letter[k : m + k]
        ok = some & (row[:m] == row[size - 1 :])
        bucket = (code >> np.uint32(20)).astype(np.int64)
        out += np.bincount((row[:m] * BUCKETS + bucket)[ok], minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS).astype(np.float32)


def features(texts: pa.Array) -> np.ndarray:
    x = np.sqrt(gram_counts(texts))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """(k x bits) of -1/1; no bit is constant, rows differ."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 6:
        bits = np.arange(1, 2 ** (k - 1))
        low = (bits[None, :] >> np.arange(k - 1)[:, None]) & 1
        return np.where(np.vstack([np.zeros(len(bits), int), low]) > 0, 1, -1).astype(np.int8)
    rng = np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), size=(k, int(np.ceil(15 * np.log2(k)))))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        agree = code.astype(int) @ code.T
        np.fill_diagonal(agree, -code.shape[1])
        distance = (code.shape[1] - int(agree.max())) // 2
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (BUCKETS x bits)
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, lead over the second)."""
        margin = x @ self.weights + self.bias
        # loss of margin m against sign s is log(1 + exp(-s m))
        plus, minus = np.logaddexp(0, -margin) * self.trust, np.logaddexp(0, margin) * self.trust
        up = (self.code > 0).astype(np.float64)
        loss = plus @ up.T + minus @ (1 - up).T
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        top = np.sort(p, axis=1)
        lead = top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)
        return p.argmax(axis=1), top[:, -1], lead


def fit(x: np.ndarray, languages: list[str]) -> Model | None:
    """Logistic classifiers of all bits at once, by accelerated gradient."""
    names = sorted(set(languages))
    if not names:
        return None
    code = codewords(len(names))
    y = code[[names.index(v) for v in languages]].astype(np.float64)
    aside = np.arange(len(x)) % 5 == 4
    if aside.all() or not aside.any():
        aside = np.zeros(len(x), bool)
    use, y = x[~aside], y.astype(np.float32)
    sign = y[~aside]
    w, b = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    vw, vb = w.copy(), b.copy()
    for t in range(ROUNDS):
        gw, gb = w + 0.9 * vw, b + 0.9 * vb
        m = use @ gw.astype(np.float32) + gb
        g = -sign / (1 + np.exp(np.clip(sign * m, -30, 30))) / len(use)
        vw = 0.9 * vw - 8.0 * (use.T @ g.astype(np.float32) + 1e-5 * gw)
        vb = 0.9 * vb - 2.0 * g.sum(axis=0)
        w, b = w + vw, b + vb
    right = np.ones(code.shape[1])
    if aside.any():
        right = (np.sign(x[aside] @ w.astype(np.float32) + b) == y[aside]).mean(axis=0)
    trust = np.maximum(2 * right - 1, 0.05)
    return Model(names, code, w.astype(np.float32), b, trust * len(trust) / trust.sum())


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_column(batch.column("text"))
        for a, b in steps(texts):
            x = features(texts.slice(a, b - a))
            at, value = [], []
            for row in x:
                i = np.flatnonzero(row)
                at.append(i.astype("<u2").tobytes())
                value.append(row[i].astype("<f4").tobytes())
            kept = [batch.column(c).slice(a, b - a) for c in ("doc_id", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(at, pa.binary()), pa.array(value, pa.binary())], ["doc_id", "lang", "at", "value"]
            )


def training_sample(
    rows: DataFrame, label: str, key: str, per_label: int, most_labels: int, most_rows: int
) -> DataFrame:
    """About ``per_label`` (key, label) pairs of each label, fewer where all would
    exceed ``most_rows``: those whose hashed key lies below the label's share.

    Only the ``most_labels`` labels with most rows count. Works on ids and
    labels, without a sort or window; the driver sees a count of each label
    that counts. The result is bounded by ``most_rows``, so it may be broadcast.
    """
    u = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) / 1_000_000.0
    keyed = rows.select(key, label).withColumn("__u", u)
    counts = keyed.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).limit(most_labels)
    found = counts.collect()
    each = min(per_label, most_rows / max(1, len(found)))
    kind = rows.schema[label].dataType.simpleString()
    share = rows.sparkSession.createDataFrame([(r[0], each / r[1]) for r in found], f"`{label}` {kind}, __share double")
    return keyed.join(F.broadcast(share), label).where(F.col("__u") < F.col("__share")).select(key, label).distinct()


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model | None:
    """Learn from (doc_id, text, lang) rows, all of which may be learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sample = training_sample(known, "lang", "doc_id", per_language, MOST_LANGUAGES, most_rows)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        known.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), ["doc_id", "lang"])
        .select("doc_id", "lang", "text")
        .mapInArrow(_feature_batches, f"doc_id {id_type}, lang string, at binary, value binary")
        .groupBy("doc_id", "lang")
        .agg(F.min(F.struct("at", "value")).alias("x"))
        .select("lang", "x.at", "x.value")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))
    order = np.random.default_rng(1).permutation(len(rows))
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, j in enumerate(order):
        x[i, np.frombuffer(rows[j]["at"], "<u2").astype(np.int64)] = np.frombuffer(rows[j]["value"], "<f4")
    return fit(x, [rows[j]["lang"] for j in order])


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch.column("text"))
            for a, b in steps(texts):
                part = texts.slice(a, b - a)
                letters = has_letter(part)
                if model is None:
                    names, score, close = [UNKNOWN] * len(part), np.zeros(len(part)), np.ones(len(part), bool)
                else:
                    best, score, lead = model.decode(features(part))
                    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
                    score, close = np.where(letters, score, 0.0), (lead < AMBIGUOUS) | ~letters
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(names, pa.string()),
                        pa.array(np.asarray(score, np.float64)),
                        pa.array(close),
                    ],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row; no shuffle."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean"
    )
    return rows.mapInArrow(_predict(model), schema)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2
