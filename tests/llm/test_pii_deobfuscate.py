"""Personal data: base rules against their plain patterns, disguises against
planted identifiers, offsets against the edits that made them."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from revlens.llm import pii_deobfuscate as pii
from revlens.llm import queries

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def checksum(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """Base findings by the contract's patterns as they stand."""
    out = []
    for rank, (kind, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and checksum(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((m.start(), rank, m.end()))
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["a1@.", "0123456789 -", "+12 ().-", "19.25", "x@y.+1 0-é", "4 2-"])
def test_base_rules_match_their_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert pii.base_hits(text) == base(text), text


# (text, kind, the disguised part, value in the clear)
DISGUISED = [
    ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com", "john@example.com"),
    ("to john.doe at example dot co dot uk, thanks", "email", "john.doe at example dot co dot uk", "john.doe@example.co.uk"),
    ("a john dot doe (at) mail.example.com b", "email", "john dot doe (at) mail.example.com", "john.doe@mail.example.com"),
    ("joe@example[.]com", "email", "joe@example[.]com", "joe@example.com"),
    ("écrire à jean arobase exemple point fr.", "email", "jean arobase exemple point fr", "jean@exemple.fr"),
    ("\U0001f600 jоe@еxample.com", "email", "jоe@еxample.com", "joe@example.com"),
    ("joe@exam​ple.com", "email", "joe@exam​ple.com", "joe@example.com"),
    ("ｊｏｅ＠example．com", "email", "ｊｏｅ＠example．com", "joe@example.com"),
    ("host 10[.]0[.]0[.]1 down", "ip", "10[.]0[.]0[.]1", "10.0.0.1"),
    ("host 10 dot 0 dot 0 dot 1 down", "ip", "10 dot 0 dot 0 dot 1", "10.0.0.1"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one", "192.168.1.1"),
    ("１９２.168.1.1", "ip", "１９２.168.1.1", "192.168.1.1"),
    ("card four two " * 1 + "four two " * 7 + "ok", "card", "four two " * 7 + "four two", "4242424242424242"),
    ("4242 four two four two 4242 4242", "card", "4242 four two four two 4242 4242", "4242 4242 4242 4242"),
    ("4242 4242 4242 4242", "card", "4242 4242 4242 4242", "4242 4242 4242 4242"),
    ("call plus one five five five zero one two three four five six ok", "phone",
     "plus one five five five zero one two three four five six", "+15550123456"),
    ("tel +٤٩ ٣٠ 1234567", "phone", "+٤٩ ٣٠ 1234567", "+49 30 1234567"),
    ("ruf +49 (30) double five 1 zwei drei vier fünf sechs", "phone", "+49 (30) double five 1 zwei drei vier fünf sechs", None),
]

CLEAN = [
    "We met at example.com and looked at it. Dot the i at noon.",
    "One of the two or three four-leaf clovers; seven of nine.",
    "Le un, le deux et le trois: rendez-vous au point 3. Un point précis.",
    "+1 (848) 555-1373 Un an après, call +1 (848) 555-1374 – 12 people",
    "Почта на русском, где нет адресов: сосна, роса.",
    "Version 3 dot 5 (at) noon, end [dot]; 1990–1995, 2000·2005",
    "İſİx ſix fİve ſeven eight one two three Kelvin",
]


@pytest.mark.parametrize(("text", "kind", "part", "value"), DISGUISED)
def test_disguises_map_back_to_their_characters(text, kind, part, value):
    hits = pii.find(text)
    found = [(pii.KINDS[r], text[s:e], v) for s, r, e, known, v in hits if not known]
    assert (kind, part) in [f[:2] for f in found]
    assert value is None or (kind, part, value) in found
    assert [h[:3] for h in hits if h[3]] == base(text)  # base findings stay


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_gets_no_finding_beyond_the_base(text):
    assert [h[:3] for h in pii.find(text)] == base(text)


def test_offsets_hold_for_random_mixtures():
    rng = random.Random(3)
    fill = ["und ", "\U0001f600 ", "ünd\n", "a. ", "нет ", "at ", "one ", "(x) ", "​", "12 "]
    for _ in range(300):
        text, places = "", []
        for _, kind, part, value in rng.choices(DISGUISED, k=4):
            text += "".join(rng.choices(fill, k=rng.randrange(6))) + ".\n\n"
            places.append((kind, len(text), len(text) + len(part), value))
            text += part + "\n\n"
        got = {(pii.KINDS[r], s, e) for s, r, e, _, _ in pii.find(text)}
        assert {p[:3] for p in places} <= got, text


def test_rewrites_map_every_character():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choices("abcdefgh", k=30))
        cuts = sorted(rng.sample(range(31), 6))
        parts = [(a, b, rng.choice(["", "X", "YZ", "LONGER"])) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        out = pii.rewrite(text, parts)
        owner = []  # source span and whether rewritten, of every output character
        at = 0
        for a, b, new in parts:
            owner += [(i, i + 1, False) for i in range(at, a)] + [(a, b, True)] * len(new)
            at = b
        owner += [(i, i + 1, False) for i in range(at, len(text))]
        assert len(owner) == len(out.text)
        for i in range(len(owner)):
            for j in range(i + 1, len(owner) + 1):
                assert out.source(i, j) == (owner[i][0], owner[j - 1][1])
                gap = any(owner[k][1] < owner[k + 1][0] for k in range(i, j - 1))
                assert out.touched(i, j) == (any(o[2] for o in owner[i:j]) or gap)


def test_very_long_texts_are_searched_whole():
    for piece in ("1.", "a@", "+1", "1 dot ", "x at ", "one ", "[dot]", " "):
        text = piece * (200_000 // len(piece)) + "\njohn [at] example [dot] com"
        assert any(text[s:e] == "john [at] example [dot] com" for s, _, e, _, _ in pii.find(text))


def test_query_returns_counts_and_digests(spark, tmp_path):
    texts = [t for t, *_ in DISGUISED] + CLEAN + [None, "", "a@b.c a@b.c 1.2.3.4 4242-4242-4242-4242 +1 (555) 555-5555", "x " * 150_000]
    rows = [(i, t, "en", 0) for i, t in enumerate(texts)] + [(None, "joe@x.yz", None, 1), (0, texts[0], "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, hits int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_pii_deobfuscate(spark, str(tmp_path)).collect()}
    assert queries.op12_pii_deobfuscate(spark, str(tmp_path)).count() == len(rows)
    for i, t, *_ in rows:
        want = base(t or "")
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(h[1] == k for h in want) for k in range(4)]
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
    assert pii.scan_pii(docs.where(F.lit(False))).count() == 0
