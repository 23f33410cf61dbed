"""Quality rules by distribution divergence (DataFrame functions only).

Each document's histograms of character classes and of the common words of
its language are compared with language references by the Jensen-Shannon
divergence (base 2, so 0 to 1). References are the mean histograms of all
documents of a language, gathered from the whole corpus. Every row is measured
once and stored with its counts; references and verdicts come from there, and
no text is shuffled.

Guards: a histogram judges only documents of a least size (``MIN_CHARS``,
``MIN_WORDS``); a document below it passes that comparison.

Defined results: NULL text counts as empty; an empty text has zeros and fails
the base rule; a NULL or unlisted ``lang`` is compared with the reference of
all documents; repeated rows get equal results; an empty table gives an empty
result; other columns pass through untouched and added names avoid theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_name, let, stored

# Common function words of four languages (public word lists).
COMMON_WORDS = {
    "de": ("der", "die", "und", "das", "in", "von", "mit", "den", "zu", "ist", "nicht", "ein"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "las", "un", "por", "con"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "que", "une", "du", "qui"),
}
ANY_LANG = "*"

# Character classes, taken off a text one after the other; the last class is
# what remains. They are disjoint, so the count of SYMBOLS is exact.
CHAR_CLASSES = (
    "[a-z ]+",
    "[\\x09-\\x0D]+",
    "[A-Z]+",
    "[#*$%&|<>]+",
    "[.,;:!?'\"()-]+",
    "[0-9]+",
    r"[\x00-\x7F]+",
)
SYMBOLS = 3

MIN_CHARS = 200
MIN_WORDS = 100
MAX_CHAR_JSD = 0.10
MAX_WORD_JSD = 0.065
SCALE = 1_000_000


# A lambda runs interpreted, up to a microsecond per element. What runs per
# word below is therefore mostly put together from whole-array functions.


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _class_counts(text: Column) -> Column:
    """Counts by class: each class is what remains less when it is removed."""

    def step(rest: Column, k: int) -> Column:
        if k == len(CHAR_CLASSES):
            return F.array(F.length(rest))
        return let(
            F.regexp_replace(rest, CHAR_CLASSES[k], ""),
            lambda less: F.concat(F.array(F.length(rest) - F.length(less)), step(less, k + 1)),
        )

    return step(text, 0)


def _common_counts(words: Column, lang: Column) -> Column:
    """Counts of the language's common words, then of all other words."""

    def taken(rest: Column, listed: tuple[str, ...]) -> Column:
        """Counts of ``listed``, each by what its removal leaves."""
        if not listed:
            return F.array().cast("array<int>")
        return let(
            F.array_remove(rest, listed[0]),
            lambda less: F.concat(F.array(F.size(rest) - F.size(less)), taken(less, listed[1:])),
        )

    def of(code: str) -> Column:
        listed = COMMON_WORDS[code]
        forms = sorted({f for w in listed for f in (w, w.capitalize(), w.upper())})
        return let(
            F.filter(words, lambda w: w.isin(*forms)),
            lambda kept: F.concat(
                taken(F.transform(kept, F.lower), listed), F.array(F.size(words) - F.size(kept))
            ),
        )

    out = F.when(lang == "de", of("de"))
    for code in ("en", "es", "fr"):
        out = out.when(lang == code, of(code))
    return out.otherwise(F.array(F.lit(0)))


def reference_key(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit(ANY_LANG))


def _shares(counts: Column) -> Column:
    """Counts as millionths of their sum (whole numbers: sums don't depend on
    the order of rows); zeros if there are none."""
    return let(
        counts,
        lambda c: let(
            F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x),
            lambda n: F.transform(
                c, lambda x: F.when(n > 0, F.floor(x.cast("long") * SCALE / n)).otherwise(0).cast("long")
            ),
        ),
    )


def language_references(measured: DataFrame, ref: str, stats: str) -> DataFrame:
    """Mean histograms of rows that ``text_stats`` has measured: one row per
    language of ``COMMON_WORDS`` and one for all documents, so at most
    ``len(COMMON_WORDS) + 1`` rows (ref, ref_chars, ref_words). Every document
    that reaches the guards counts."""
    s = F.col(stats)
    shares = measured.where(s["n_text"] >= MIN_CHARS).select(
        F.col(ref).alias("ref"),
        _shares(s["chars"]).alias("c"),
        F.when(s["n_words"] >= MIN_WORDS, _shares(s["common"])).alias("w"),
    )
    n_classes = len(CHAR_CLASSES) + 1
    n_words = len(COMMON_WORDS["en"]) + 1
    sums = [F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(n_classes)]
    sums += [F.sum(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(n_words)]
    per_lang = shares.groupBy("ref").agg(*sums)
    everything = shares.select(F.lit(ANY_LANG).alias("ref"), "c", F.lit(None).cast("array<long>").alias("w"))
    both = per_lang.where(F.col("ref") != ANY_LANG).unionByName(everything.groupBy("ref").agg(*sums))
    return both.select(
        "ref",
        F.array(*[f"c{i}" for i in range(n_classes)]).alias("ref_chars"),
        F.array(*[f"w{i}" for i in range(n_words)]).alias("ref_words"),
    )


def jensen_shannon(p: Column, q: Column) -> Column:
    """Divergence in bits of two arrays of counts; NULL if either is empty."""

    def norm(a: Column) -> Column:
        return let(
            a,
            lambda c: let(
                F.aggregate(c, F.lit(0.0), lambda s, x: s + F.coalesce(x.cast("double"), F.lit(0.0))),
                lambda n: F.when(n > 0, F.transform(c, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)) / n)),
            ),
        )

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    both = F.zip_with(
        norm(p), norm(q), lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2
    )
    return F.aggregate(both, F.lit(0.0), lambda s, x: s + x)


def _windows(words: Column) -> Column:
    """All windows of three words as text, each with the place of its first.

    The array shifted by one and two words is zipped with itself and cast to
    text as a whole. Words hold no space, so the text "{a, b, c}" of a window
    stands for just these three words.
    """
    n = F.size(words)
    triples = F.arrays_zip(
        F.slice(words, F.lit(1), n - 2), F.slice(words, F.lit(2), n - 2), F.slice(words, F.lit(3), n - 2)
    )
    return F.arrays_zip(
        triples.cast("array<string>").alias("k"), F.sequence(F.lit(0), n - 3).alias("i")
    )


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Sorted windows that equal a neighbour are the repeated ones; the places
    they cover are summed in order. Texts without one stop at the distinct
    count.
    """
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))

    def covered(windows: Column) -> Column:
        starts = let(
            F.sort_array(windows),
            lambda s: F.sort_array(
                F.filter(
                    s, lambda x, j: (F.get(s, j - 1)["k"] == x["k"]) | (F.get(s, j + 1)["k"] == x["k"])
                )["i"]
            ),
        )
        return F.aggregate(
            starts,
            zero,
            lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).cast("long").alias("n")
            ),
            lambda a: a["n"],
        )

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(
            _windows(words),
            lambda w: F.when(F.size(F.array_distinct(w["k"])) == F.size(w), F.lit(0).cast("long")).otherwise(
                covered(w)
            ),
        )
    )


def text_stats(text: Column, lang: Column) -> Column:
    """Struct of the base counts and both histograms of one text."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        F.struct(word_list(text).alias("words"), _class_counts(text).alias("chars")),
        lambda t: F.struct(
            F.size(t["words"]).cast("long").alias("n_words"),
            F.length(F.array_join(t["words"], "")).cast("long").alias("word_chars"),
            t["chars"][SYMBOLS].cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated_words(t["words"]).alias("n_repeat_words"),
            F.length(text).alias("n_text"),
            t["chars"].alias("chars"),
            _common_counts(t["words"], lang).alias("common"),
        ),
    )


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` (of it the columns ``carry``, if given) with a struct column
    ``quality`` (or that name prolonged): the base counts, ``char_jsd``,
    ``word_jsd``, ``base_failed``, ``kept``.

    Measured rows are stored once; references and verdicts both come from
    there. The references are a few rows by construction, so their broadcast
    has a fixed bound, and each row joins exactly one of them.
    """
    carry = docs.columns if carry is None else carry
    key, stats, out, ref_c, ref_w = (
        free_name(docs, n) for n in ("__ref", "__stats", "quality", "__ref_chars", "__ref_words")
    )
    body = F.coalesce(F.col(text), F.lit(""))
    measured = stored(
        docs.withColumn(key, reference_key(F.col(lang)))
        .withColumn(stats, text_stats(body, F.col(key)))
        .select(*carry, key, stats),
        "quality",
    )
    refs = language_references(measured, key, stats).select(
        F.col("ref").alias(key), F.col("ref_chars").alias(ref_c), F.col("ref_words").alias(ref_w)
    )
    judged = measured.join(F.broadcast(refs), key, "left")
    s = F.col(stats)
    char_jsd = F.when(s["n_text"] >= MIN_CHARS, jensen_shannon(s["chars"], F.col(ref_c)))
    word_jsd = F.when(
        (s["n_words"] >= MIN_WORDS) & (F.col(key) != ANY_LANG),
        jensen_shannon(s["common"], F.col(ref_w)),
    )
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    verdict = let(
        F.struct(char_jsd.alias("c"), word_jsd.alias("w")),
        lambda v: F.struct(
            *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            v["c"].alias("char_jsd"),
            v["w"].alias("word_jsd"),
            failed.alias("base_failed"),
            (
                ~failed
                & (F.coalesce(v["c"], F.lit(0.0)) <= MAX_CHAR_JSD)
                & (F.coalesce(v["w"], F.lit(0.0)) <= MAX_WORD_JSD)
            ).alias("kept"),
        ),
    )
    return judged.select(*carry, verdict.alias(out))
