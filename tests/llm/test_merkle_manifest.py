"""Merkle manifest against a tree built in memory, level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from revlens.llm import merkle_manifest as mm
from revlens.llm.queries import newlines_deleted

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, tree int, idx int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    vs = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("-" if v is None else f"{len(v.encode())}:{v}" for v in vs)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        low = i // 3 * 3
        out.append((nodes[low:i], nodes[i + 1 : low + 3]))
        i //= 3
    return out


def brute(rows):
    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        by_source.setdefault(source, []).append((doc_id, leaf(doc_id, source, lang, n_chars, text), (source, lang, n_chars, text)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree_of([r[1] for r in by_source[s]]))
    top = tree_of([t[-1][0] for t in trees])
    root = top[-1][0]
    out = []
    for k, s in enumerate(order):
        for i, (doc_id, lf, (source, lang, n_chars, text)) in enumerate(by_source[s]):
            steps = path(trees[k], i) + path(top, k)
            now = lf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                now = leaf(doc_id, source, lang, n_chars, text.replace("\n", ""))
            for left, right in steps:
                now = h(left + [now] + right)
            proof = h(x for left, right in steps for x in left + right)
            out.append((doc_id, lf, trees[k][-1][0], root, proof, now, now == root))
    return out


def rows_of(rng, n, sources):
    rows = []
    for i in rng.sample(range(10 * n), n):
        source = "hot" if rng.random() < 0.5 else rng.choice([None, "", "é", "Z", "a"][:sources] + [f"s{rng.randrange(sources)}"])
        text = rng.choice([None, "", "one", "a\nb\n", "Zeile\n" * 400, f"t{i}\n\U0001f600", "ü" * rng.randrange(9)])
        rows.append((i, text, rng.choice([None, "en"]), source, rng.choice([None, len(text or "")])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 3, 4) for r in rows], DOCS)


def got(df, levels):
    leaves = mm.leaves_of(df, tampered={"text": newlines_deleted()})
    return [tuple(r) for r in mm.proofs(mm.build(leaves, levels)).collect()]


@pytest.mark.parametrize(("n", "sources", "levels"), [(500, 5, 2), (120, 40, 1), (400, 3, 6), (1, 1, 2), (28, 1, 3)])
def test_manifest_matches_brute_force(spark, n, sources, levels):
    rows = rows_of(random.Random(n), n, sources)
    if n > 100:
        # a repeated row, a NULL id, two texts under one id, an id of its own source
        rows += [rows[0], rows[0], (None, "x\ny", None, None, None), (rows[1][0], "other", *rows[1][2:]), (-7, "a\nb", "en", "lone", 3)]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got(frame(spark, rows).repartition(4), levels), key=key) == sorted(brute(rows), key=key)


def test_whole_proofs_lead_to_the_root(spark):
    rows = rows_of(random.Random(5), 60, 3)
    m = mm.build(mm.leaves_of(frame(spark, rows)), 2)
    for r in mm.proofs(m, whole_proof=True).collect():
        now = r["leaf"]
        for step in r["proof"]:
            now = h(step["others"][: step["at"]] + [now] + step["others"][step["at"] :])
        assert now == m.root and r["verified"] and r["folded_root"] == m.root
        assert r["proof_sha256"] == h(x for s in r["proof"] for x in s["others"])


def test_only_every_few_levels_is_persisted(spark):
    rows = [(i, "t", "en", "hot", 1) for i in range(300)]
    m = mm.build(mm.leaves_of(frame(spark, rows)), 2)
    # 300 leaves, 34 nodes two levels up, 4 and 1 further up; 100, 12 and 2 are recomputed
    sizes = [b.select(F.explode("entries")).count() for b in m.sources.bands]
    assert sizes == [300, 34, 4]
    assert max(b.select(F.max(F.size("entries"))).first()[0] for b in m.sources.bands) <= 9


def test_empty_table(spark):
    m = mm.build(mm.leaves_of(frame(spark, rows_of(random.Random(1), 3, 1)).where(F.lit(False))))
    assert m.root is None and mm.proofs(m).count() == 0
