"""Toxicity by a counterfactual-regularised linear classifier.

A document is the set of its words (hashed into ``BUCKETS``); identity terms
have features of their own. The score is logistic. Training minimises the log
loss of the documents plus a penalty on score changes under counterfactuals:
in every sentence of a labelled document that holds an identity term, the term
changes places with each other term of its groups, and the squared change of
the sentence's score is added. Where both terms stand in the sentence the
change of places leaves its words as they are, so nothing is added. The
penalty keeps neutral mentions of a group from raising the score.

The groups are a parameter, given by language (``IDENTITY_GROUPS``); a text is
searched for the terms of all languages, as its language is no input.

Word features are scaled by their log-odds between the classes (words in
fewer than ``LEAST_DOCS`` training rows are left out), which lets the few
telling words outweigh the many that are not.

Training reads a bounded sample of about ``PER_LABEL`` rows of each label, by
a hash of the id; their word sets (bucket numbers) and those of at most
``SENTENCES`` sentences with identity terms a row (those of least hash), never
texts, go to the driver. Scoring reads only the text.

Defined results: NULL text counts as empty and scores as the bias; without
labelled rows, or with one label only, every score is that label's share
(0 if there is none); rows with NULL ids or labels are not learned from;
documents with conflicting labels count once per label, repeated rows of an id
and label once in all; repeated rows get equal results; NULL ids are scored
(held_out NULL); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold
from .langid_ecoc import training_sample
from .textgrams import NON_ALNUM, U, steps, text_column, word_hashes

BUCKETS = 1 << 17
PER_LABEL = 6_000
LEAST_DOCS = 5
ROUNDS = 200
L2 = 1e-4
SWAP_PENALTY = 50.0
SENTENCES = 32
SENTENCE_END = r"[.!?\n\x{2026}\x{3002}]+"

# Identity terms in groups, by language (plain nouns and adjectives).
IDENTITY_GROUPS = {
    "en": (
        ("woman", "man", "women", "men", "girl", "boy"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("black", "white", "asian", "latino", "arab", "african"),
        ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
        ("immigrant", "refugee", "citizen", "foreigner"),
        ("disabled", "blind", "deaf", "autistic"),
    ),
    "de": (
        ("frau", "mann", "frauen", "männer", "mädchen", "junge"),
        ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
        ("schwarz", "weiß", "asiatisch", "arabisch", "afrikanisch"),
        ("schwul", "lesbisch", "heterosexuell", "bisexuell", "transgender"),
        ("einwanderer", "flüchtling", "bürger", "ausländer"),
        ("behindert", "blind", "taub", "autistisch"),
    ),
    "fr": (
        ("femme", "homme", "femmes", "hommes", "fille", "garçon"),
        ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
        ("noir", "blanc", "asiatique", "arabe", "africain"),
        ("gay", "lesbienne", "hétérosexuel", "bisexuel", "transgenre"),
        ("immigré", "réfugié", "citoyen", "étranger"),
        ("handicapé", "aveugle", "sourd", "autiste"),
    ),
    "es": (
        ("mujer", "hombre", "mujeres", "hombres", "niña", "niño"),
        ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
        ("negro", "blanco", "asiático", "árabe", "africano"),
        ("gay", "lesbiana", "heterosexual", "bisexual", "transgénero"),
        ("inmigrante", "refugiado", "ciudadano", "extranjero"),
        ("discapacitado", "ciego", "sordo", "autista"),
    ),
}


class Terms:
    """Identity terms with their features (from ``BUCKETS`` on) and swaps."""

    def __init__(self, by_language: dict[str, tuple[tuple[str, ...], ...]]):
        groups = [[t.lower() for t in g] for language in by_language.values() for g in language]
        self.names = sorted({t for g in groups for t in g})
        place = {t: i for i, t in enumerate(self.names)}
        others: dict[int, set[int]] = {i: set() for i in range(len(self.names))}
        for g in groups:
            for t in g:
                others[place[t]] |= {place[x] for x in g if x != t}
        self.others = {i: sorted(v) for i, v in others.items()}
        hashes = word_hashes(pa.array(self.names, pa.large_string()), NON_ALNUM)[0]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    @property
    def size(self) -> int:
        """Number of features, those of plain words included."""
        return BUCKETS + len(self.names)


TERMS = Terms(IDENTITY_GROUPS)


def word_features(texts: pa.Array, terms: Terms = TERMS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of each row, sorted."""
    words, rows = word_hashes(texts, NON_ALNUM)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    feature = (words >> U(47)).astype(np.int64)
    if len(terms.hashes):
        at = np.minimum(np.searchsorted(terms.hashes, words), len(terms.hashes) - 1)
        feature = np.where(terms.hashes[at] == words, BUCKETS + terms.order[at], feature)
    keys = np.unique(row * terms.size + feature)
    return keys // terms.size, keys % terms.size


def mentions(texts: pa.Array, terms: Terms = TERMS, most: int = SENTENCES) -> list[list[np.ndarray]]:
    """For each row the features of its distinct sentences with identity terms,
    the ``most`` of least hash."""
    parts = pc.split_pattern_regex(texts, SENTENCE_END)
    text_of = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    row, feature = word_features(parts.flatten().cast(pa.large_string()), terms)
    out: list[dict[bytes, np.ndarray]] = [{} for _ in range(len(texts))]
    for sentence in np.unique(row[feature >= BUCKETS]):
        found = feature[np.searchsorted(row, sentence) : np.searchsorted(row, sentence, "right")].astype("<u4")
        out[text_of[sentence]][blake2b(found.tobytes(), digest_size=8).digest()] = found
    return [[sentences[h] for h in sorted(sentences)[:most]] for sentences in out]


@dataclass
class Model:
    weights: np.ndarray  # by feature
    bias: float
    terms: Terms

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, feature = word_features(texts, self.terms)
        logit = self.bias + np.bincount(row, self.weights[feature], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))


def _sigmoid(logit: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))


class Swaps:
    """Every sentence with a term changed for another: the penalty's terms."""

    def __init__(self, sentences: list[np.ndarray], terms: Terms, slot: np.ndarray, scale: np.ndarray):
        triples = []
        for i, features in enumerate(sentences):
            held = {int(f) - BUCKETS for f in features if f >= BUCKETS}
            triples += [(i, a, b) for a in sorted(held) for b in terms.others[a] if b not in held]
        self.sentence, a, b = np.array(triples, np.int64).reshape(-1, 3).T
        self.before, self.after = slot[BUCKETS + a], slot[BUCKETS + b]
        row = np.repeat(np.arange(len(sentences)), [len(x) for x in sentences])
        col = np.concatenate(sentences).astype(np.int64) if sentences else np.zeros(0, np.int64)
        on = slot[col] >= 0
        self.row, self.col = row[on], slot[col[on]]
        self.value = scale[col[on]]
        self.count = len(sentences)

    def gradient(self, w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """Of the sum of squared score changes, by weights and bias."""
        logit = np.bincount(self.row, self.value * w[self.col], minlength=self.count) + bias
        logit = logit[self.sentence]
        p, q = _sigmoid(logit), _sigmoid(logit - w[self.before] + w[self.after])
        at_p, at_q = 2 * (p - q) * p * (1 - p), 2 * (p - q) * q * (1 - q)
        both = np.bincount(self.sentence, at_p - at_q, minlength=self.count)
        g = np.bincount(self.col, self.value * both[self.row], minlength=len(w))
        g += np.bincount(self.before, at_q, minlength=len(w)) - np.bincount(self.after, at_q, minlength=len(w))
        return g, float(both.sum())


def fit(
    docs: list[np.ndarray],
    labels: np.ndarray,
    swap_penalty: float = SWAP_PENALTY,
    sentences: list[np.ndarray] | None = None,
    terms: Terms = TERMS,
) -> Model:
    """``docs`` holds each row's distinct features, ``sentences`` those of the
    sentences with identity terms (by default each document is one sentence)."""
    n = len(docs)
    weights = np.zeros(terms.size)
    if n == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if n else 0.0
        return Model(weights, float(np.clip(np.log((share + 1e-16) / (1 - share + 1e-16)), -35, 35)), terms)
    row = np.repeat(np.arange(n), [len(d) for d in docs])
    col = np.concatenate(docs).astype(np.int64)
    pos = np.bincount(col, labels[row].astype(float), minlength=terms.size)
    neg = np.bincount(col, 1.0 - labels[row], minlength=terms.size)
    n1, n0 = labels.sum(), n - labels.sum()
    ratio = np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n0 + 2))
    scale = np.where(pos + neg >= LEAST_DOCS, ratio, 0.0)
    scale[BUCKETS:] = 1.0
    kept = np.flatnonzero(scale)
    slot = np.full(terms.size, -1)
    slot[kept] = np.arange(len(kept))
    swaps = Swaps([d for d in docs if (d >= BUCKETS).any()] if sentences is None else sentences, terms, slot, scale)
    on = slot[col] >= 0
    row, col = row[on], slot[col[on]]
    value = scale[kept][col]
    w = np.zeros(len(kept))
    bias = float(np.log(n1 / n0))
    m1, m2 = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, ROUNDS + 1):
        error = (_sigmoid(np.bincount(row, value * w[col], minlength=n) + bias) - labels) / n
        g = np.append(np.bincount(col, value * error[row], minlength=len(kept)) + L2 * w, error.sum())
        if swaps.count:
            by_weight, by_bias = swaps.gradient(w, bias)
            g += np.append(by_weight, by_bias) * (swap_penalty / n)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = 0.05 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-10)
        w, bias = w - step[:-1], bias - float(step[-1])
    weights[kept] = w * scale[kept]
    return Model(weights, bias, terms)


def _set_batches(terms: Terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch.column("text"))
            for a, b in steps(texts):
                part = texts.slice(a, b - a)
                row, feature = word_features(part, terms)
                at = np.searchsorted(row, np.arange(b - a + 1))
                sets = [feature[at[i] : at[i + 1]].astype("<u4").tobytes() for i in range(b - a)]
                held = [[x.tobytes() for x in found] for found in mentions(part, terms)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("toxic").slice(a, b - a),
                        pa.array(sets, pa.binary()),
                        pa.array(held, pa.list_(pa.binary())),
                    ],
                    ["doc_id", "toxic", "features", "sentences"],
                )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = PER_LABEL,
    swap_penalty: float = SWAP_PENALTY,
    groups: dict[str, tuple[tuple[str, ...], ...]] = IDENTITY_GROUPS,
) -> Model:
    """Learn from (doc_id, text) rows and their (doc_id, toxic) labels."""
    terms = Terms(groups)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    chosen = training_sample(known, "toxic", "doc_id", per_label, 2, 2 * per_label)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "toxic", "text")
        .mapInArrow(
            _set_batches(terms), f"doc_id {id_type}, toxic int, features binary, sentences array<binary>"
        )
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct("features", "sentences")).alias("x"))
        .select("toxic", "x.features", "x.sentences")
        .collect()
    )
    rows.sort(key=lambda r: (r["toxic"], bytes(r["features"]), [bytes(x) for x in r["sentences"]]))
    return fit(
        [np.frombuffer(r["features"], "<u4") for r in rows],
        np.array([r["toxic"] for r in rows], float),
        swap_penalty,
        [np.frombuffer(x, "<u4") for r in rows for x in r["sentences"]],
        terms,
    )


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch.column("text"))
            for a, b in steps(texts):
                score = model.scores(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(score),
                        pa.array((score >= 0.5).astype(np.int32)),
                    ],
                    ["doc_id", "score", "predicted"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row; no shuffle."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _score(model), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int"
    )


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0
