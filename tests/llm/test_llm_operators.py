"""Training-data operators against brute force, round trips and held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import (
    cgk_decontam,
    html_consensus,
    langid_ecoc,
    license_scan,
    poisson_mix,
    prob_minhash,
    quality_divergence,
    secret_ledger,
    textgrams,
    token_blocks,
    toxicity_cf,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "a", "a b\tc\n\nd", "x " * 3000, "Zeile\nZeile\nZeile", "été \U0001f600 ok", "!!! ???"]


def docs_of(spark, texts, extra=False):
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, 0) for i, t in enumerate(texts)]
    rows.append((None, "no id here", None, None, None))
    rows.append(rows[0])  # a repeated row
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumn("quality", F.lit(1)).withColumn("copy", F.lit("c")).withColumn("label", F.lit(0)) if extra else df


def base_secrets(text):
    out = []
    p = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(p, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (kind, p, n) in enumerate((("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)), 1):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text) if len(m[0]) >= n]
    return [x[2] for x in sorted(out)]


SECRETS = [
    'token = "abc" token=token:abcdefgh PASSWORD: hunter2222',
    "éé AKIA" + "A" * 16 + " AKIAAKIA " + "0123456789abcdef" * 2 + " api_key='xyz123456' apikey:1",
    "secret=" + "f" * 30 + " passwd =\x20\x20'a.b/c+d=e'",
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36,
]


def test_secrets_match_brute_force_and_ledger_is_incremental(spark, tmp_path):
    docs = docs_of(spark, SECRETS + ODD, extra=True)
    path = str(tmp_path / "ledger")
    ledger = secret_ledger.update_ledger(docs, "text", path)
    got = secret_ledger.by_path(docs, ["doc_id"], "text", secret_ledger.findings(ledger)).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in got:
        base = [f"{h['kind']}:{h['start']}:{h['end']}" for h in r["hits"] if h["rank"] < 3]
        assert base == base_secrets(texts[r["doc_id"]])
    n = ledger.count()
    # nothing unseen: no new ledger row; a new rule version: all blobs, that rule only
    assert secret_ledger.update_ledger(docs, "text", path, exists=True).count() == n
    rules = (*secret_ledger.RULES, secret_ledger.Rule("word", "hunter[0-9]+", version=2))
    more = secret_ledger.update_ledger(docs, "text", path, rules, exists=True)
    assert more.where(F.size("rules") == 1).count() == n
    found = secret_ledger.findings(more, rules)
    assert found.where("kind = 'word'").count() == 1
    empty = docs.where("false")
    assert secret_ledger.by_path(empty, ["doc_id"], "text", found).count() == 0


def test_quality_counts_match_brute_force(spark):
    texts = ["a b c a b c d", "x y\nx y\n\nx y z", "w " * 60, "&& one ## two"] + ODD + ["the of and " * 50]
    docs = docs_of(spark, texts, extra=True)
    got = quality_divergence.judge(docs)
    assert got.columns[: len(docs.columns)] == docs.columns and got.columns[-1] == "quality_"
    for r in got.collect():
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, x in enumerate(tri) if tri.count(x) > 1 for k in range(3)} if len(tri) < 500 else None
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        q = r["quality_"]
        assert q["n_words"] == len(w) and q["word_chars"] == sum(map(len, w))
        assert q["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert q["n_dup_lines"] == len(lines) - len(set(lines))
        if covered is not None:
            assert q["n_repeat_words"] == len(covered)
        assert not (q["base_failed"] and q["kept"])
    assert quality_divergence.judge(docs.where("false")).count() == 0


def test_poisson_mix_reaches_weights_and_repeats(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "cast(id as string) text", "if(id % 10 < 8, 'big', 'small') source")
    weights = {"big": 1.0, "small": 3.0}
    a = poisson_mix.mix(docs, weights, detail=True)
    n = {r["source"]: r["count"] for r in a.groupBy("source").count().collect()}
    assert abs(n["big"] - 1500) < 200 and abs(n["small"] - 4500) < 300
    b = poisson_mix.mix(docs.repartition(7), weights, detail=True)
    assert sorted(a.collect()) == sorted(b.collect())
    many = poisson_mix.mix(docs.limit(200), {"big": 1.0}, target_rows=20_000)
    assert abs(many.count() - 20_000) < 1000
    odd = docs_of(spark, ODD, extra=True)
    assert poisson_mix.mix(odd, detail=True).columns == [*odd.columns, "copy_", "shuffle_key"]
    assert poisson_mix.mix(odd.where("false")).count() == 0


def near_texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(120)]
        texts.append(" ".join(base))
        for k in range(g):
            w = list(base)
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w) if k % 2 else "  ".join(w).upper())
    shared = [rng.choice(vocab) for _ in range(60)]
    texts += [" ".join(shared + [rng.choice(vocab) for _ in range(60)]) for _ in range(40)]
    return texts + ["one two", "one  two", "one"]


def test_near_duplicate_classes_match_brute_force(spark):
    texts = near_texts() + ODD
    docs = docs_of(spark, texts, extra=True)
    got = prob_minhash.near_duplicate_classes(docs).collect()
    assert len(got) == docs.count()

    def grams(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if x]
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None

    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    want = dict(enumerate(label))
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    kept = prob_minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    with_words = [i for i, s in enumerate(sets) if s]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and sets[r["doc_id"]]) == sorted(
        {want[i] for i in with_words}
    )
    assert prob_minhash.near_duplicate_classes(docs.where("false")).count() == 0


def test_near_duplicates_that_repeat_a_passage(spark):
    rng = random.Random(8)
    texts = []
    for times in (1, 3, 10, 100):
        for _ in range(25):
            base = [f"w{rng.randrange(10**6)}" for _ in range(84)]
            loop = [f"w{rng.randrange(10**6)}" for _ in range(10)]
            # 80 shingles, and the same with 4 + 10 (+ 5 if repeated) of its own
            texts += [" ".join(base), " ".join(base + loop * times)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicate_classes(docs).collect()}
    want = {}
    for i in range(0, len(texts), 2):
        a, b = (frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (texts[i].split(), texts[i + 1].split()))
        assert len(a & b) >= 0.8 * len(a | b)
        want |= {i: i, i + 1: i}
    assert got == want


def test_blocks_pass_on_all_pairs_near_the_threshold():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(2):
        small = np.unique(np.arange(100, dtype=np.uint32) if i else np.arange(90, dtype=np.uint32))
        sig = rng.integers(0, 2**32, prob_minhash.COMPONENTS, dtype=np.uint32)
        sig[: prob_minhash.ROWS] = 7  # they agree in one band only
        rows.append((1, 0, 0, 0, sig.tobytes(), bytes([i]), bytes([i]), 0, small.tobytes()))
    names = ["bucket", "one", "other", "block", "sig", "label", "node", "band", "small"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    got = [r for b in prob_minhash._block_batches(iter([batch])) for r in b.to_pylist()]
    assert got == [{"u": b"\x01", "v": b"\x00"}]


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    sim = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 150).astype(np.uint64)
        b = np.concatenate([a[:100], rng.integers(0, 2**63, 50).astype(np.uint64)])
        s = prob_minhash.signatures(np.concatenate([a, b]), np.array([0, 150, 300]))
        sim.append((s[0] == s[1]).mean())
    assert abs(np.mean(sim) - 0.5) < 0.03
    assert prob_minhash.probability_jaccard({1: 1, 2: 1, 3: 1}, {2: 1, 3: 1, 4: 1}) == pytest.approx(0.5)


def test_contamination_matches_exhaustive_edit_distance(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 6, 12, 20, 35, 60])]
    items += [(6, None), (7, "")]
    texts = []
    for i, t in items[:6]:
        for edits in (0, 1, len(t.split()) // 5, len(t.split()) // 2):
            w = t.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join([rng.choice(vocab) for _ in range(30)] + w + [rng.choice(vocab) for _ in range(30)]))
    texts += [", ".join(x.upper() for x in items[4][1].split())] + ODD
    docs = docs_of(spark, texts, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = cgk_decontam.contaminated(docs, bench)
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found.collect()}
    want = {}
    for it in cgk_decontam.items_of(items):
        for d, t in enumerate(texts):
            words, _ = textgrams.word_hashes(pa.array([t or ""], pa.large_string()), textgrams.NON_ALNUM)
            e = cgk_decontam.infix_distance(it, words.tolist())
            if e <= cgk_decontam.edits_allowed(len(it.words)):
                want[d, it.id] = e
    assert got == want
    clean = cgk_decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    dirty = {d for d, _ in want}
    assert clean.count() == sum(r["doc_id"] not in dirty for r in docs.collect())
    assert cgk_decontam.contaminated(docs.where("false"), bench).count() == 0
    assert cgk_decontam.drop_contaminated(docs, bench.where("false")).count() == docs.count()


@pytest.mark.parametrize("n", [5, 16, 20, 40, 60, 100])
def test_contamination_is_found_wherever_the_edits_lie(n):
    rng = random.Random(n)
    vocab = [f"v{i}" for i in range(3000)]
    k = cgk_decontam.edits_allowed(n)
    items, texts = [], []
    for i in range(24):
        w = [rng.choice(vocab) for _ in range(n)]
        items.append((i, " ".join(w)))
        at = (0, n - k, rng.randrange(n - k + 1))[i % 3]
        if i % 4 == 0:
            w[at : at + k] = [rng.choice(vocab) for _ in range(k)]
        elif i % 4 == 1:
            del w[at : at + k]
        elif i % 4 == 2:
            w[at:at] = [rng.choice(vocab) for _ in range(k)]
        else:
            for j in rng.sample(range(n), k):
                w[j] = rng.choice(vocab)
        around = [rng.choice(vocab) for _ in range(2 * (i % 5))]
        texts.append(" ".join(around + w + around))
    searcher = cgk_decontam.Searcher(cgk_decontam.items_of(items))
    got = {(row, i): edits for row, i, _, edits in searcher.hits(pa.array(texts, pa.large_string()))}
    want = {}
    for i, item in enumerate(searcher.items):
        for d, t in enumerate(texts):
            words, _ = textgrams.word_hashes(pa.array([t], pa.large_string()), textgrams.NON_ALNUM)
            e = cgk_decontam.infix_distance(item, words.tolist())
            if e <= k:
                want[d, i] = e
    assert got == want and set(want) >= {(i, i) for i in range(24)}


def stretch_edits(item, words):
    """Least edits between ``item`` and any stretch of ``words``, cell by cell."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        before, row = row, [i]
        for j, y in enumerate(words, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[j - 1] + 1))
    return min(row)


@pytest.mark.parametrize("n", [4, 5, 9, 10, 14, 20, 45, 90])
def test_walks_alone_reach_the_target_recall(n):
    rng = random.Random(n)
    vocab = [f"v{i}" for i in range(2000)]
    k = cgk_decontam.edits_allowed(n)
    items, texts, kinds = [], [], ("head", "tail", "even", "random", "insert", "delete")
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(n)]
        items.append((i, " ".join(w)))
        kind = kinds[i % len(kinds)]
        spots = {"head": range(k), "tail": range(n - k, n), "even": [min(n - 1, (j + 1) * n // (k + 1)) for j in range(k)]}
        for j in sorted(spots.get(kind, rng.sample(range(n), k)), reverse=True):
            if kind == "insert":
                w.insert(j, rng.choice(vocab))
            elif kind == "delete":
                del w[j]
            else:
                w[j] = rng.choice(vocab)
        around = [rng.choice(vocab) for _ in range(20)]
        texts.append(" ".join(around + w + around))
    searcher = cgk_decontam.Searcher(cgk_decontam.items_of(items))
    got = {(row, i): edits for row, i, _, edits in searcher.hits(pa.array(texts, pa.large_string()))}
    want = {(i, i): stretch_edits(items[i][1].split(), texts[i].split()) for i in range(120)}
    assert all(e <= k for e in want.values())
    assert all(got[pair] == want[pair] for pair in set(got) & set(want))
    assert len(set(got) & set(want)) >= 0.99 * len(want)


def test_contamination_of_long_and_repetitive_texts():
    """A text of one item word over and over, a long text with an item at its
    very end, and items of equal words."""
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(500)]
    item = [rng.choice(vocab) for _ in range(30)]
    items = [(1, " ".join(item)), (2, " ".join(item)), (3, "same " * 12), (4, "solo")]
    long = " ".join([rng.choice(vocab) for _ in range(60_000)] + item[2:])
    texts = [long, "same " * 20_000, "Solo!", " ".join(item[:15])]
    searcher = cgk_decontam.Searcher(cgk_decontam.items_of(items))
    got = {(row, searcher.items[i].id, edits) for row, i, _, edits in searcher.hits(pa.array(texts, pa.large_string()))}
    assert got == {(0, 1, 2), (0, 2, 2), (1, 3, 0), (2, 4, 0)}


def test_buckets_of_equal_members_are_searched_once(spark):
    a, b, c = (bytes([i]) * 16 for i in range(3))
    rows = [(a, 2, 20, a), (b, 2, 20, b), (a, 1, 10, a), (b, 1, 10, b)]  # one pair in two bands
    rows += [(a, 3, 30, a), (b, 3, 30, b), (c, 3, 30, b)]  # other members
    rows += [(b, 4, 40, b), (c, 4, 40, b)]  # one component
    members = spark.createDataFrame(rows, "node binary, band int, bucket long, label binary")
    assert sorted(tuple(r) for r in prob_minhash._open_buckets(members).collect()) == [(10, 1), (30, 1)]


def test_shingles_of_repeated_rows_come_once(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "d e f"), (2, "a b c"), (None, "g h i")], "doc_id long, text string")
    nodes = prob_minhash.sign(docs).groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    got = prob_minhash._grams_of(nodes, docs, "doc_id", "text")
    assert got.count() == got.select("node").distinct().count() == 3
    # shingles of nodes with one row are not grouped
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_rows_are_sifted_without_a_shuffle(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("text"))
    wanted = rows.where("k is null or k % 40 = 0").select("k")
    got = prob_minhash._likely(rows, "k", wanted)
    keys = {r["k"] for r in got.collect()}
    assert keys >= {r["k"] for r in wanted.collect()} and len(keys) < 3000
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    nodes = prob_minhash.sign(docs).withColumn("n", F.lit(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # as for tables too large to be sent
        plan = prob_minhash._grams_of(nodes, docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(node" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "doc_id" in x]


def test_components_stop_once_every_node_has_its_label(spark, monkeypatch):
    from revlens.llm import components

    def node(i):
        return bytes([i]) * 4

    def labels(pairs):
        edges = spark.createDataFrame([(node(a), node(b)) for a, b in pairs], "u binary, v binary")
        return {tuple(bytes(x) for x in r) for r in components.components(edges).collect()}

    assert labels([(i, i + 1) for i in range(1, 9)] + [(20, 30), (30, 30)]) == {
        *((node(i), node(1)) for i in range(1, 10)), (node(20), node(20)), (node(30), node(20))
    }
    assert labels([]) == set()
    names, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: names.append(name) or stored(df, name))
    assert labels([(1, 2), (3, 1)]) == {(node(1), node(1)), (node(2), node(1)), (node(3), node(1))}
    assert names == ["edges"]


def test_tokens_of_many_texts_are_those_of_the_library():
    tokens = token_blocks.Tokens(token_blocks.tokenizer_path(token_blocks.TOKENIZER))
    some = [" ", "\n", "a", "b", "é", "—", ".", ",", "1", "\t", "\xa0", " the", " of", "'s", "\r\n", "\0", "<|endoftext|>", "日本", "!!"]
    draw = random.Random(3)
    texts = ["", "plain words, only.\nHere (too)."] + ["".join(draw.choices(some, k=draw.randint(0, 9))) for _ in range(2000)]
    got = list(tokens.encode_all(pa.array(texts, pa.large_string())))
    assert [x.tolist() for x in got] == [tokens.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_before_any_punctuation_are_kept_once():
    tokens = token_blocks.Tokens(token_blocks.tokenizer_path(token_blocks.TOKENIZER))
    texts = [f"one thinnesh{a} and thinnesh{b}" for a in ".,;:!?" for b in ".,;:!?"]
    list(tokens.encode_all(pa.array(texts, pa.large_string())))
    # not a piece for each word with each mark
    assert set(tokens.known) == {"one", " thinnesh", " and", *".,;:!?"}


def test_new_words_go_to_the_model_together(monkeypatch):
    tokens = token_blocks.Tokens(token_blocks.tokenizer_path(token_blocks.TOKENIZER))
    monkeypatch.setattr(token_blocks.Tokens, "letters", None)  # a call for one word
    draw = random.Random(4)
    words = ["".join(draw.choices("abcéßж日", k=draw.randint(1, 9))) for _ in range(20_000)]
    texts = [" ".join(words[a : a + 25]) for a in range(0, len(words), 25)] + ["né. né, (né)\nné!", "", "é", ".é", "é."]
    got = list(tokens.encode_all(pa.array(texts, pa.large_string())))
    assert [x.tolist() for x in got] == [tokens.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert {" né", "né", "."} <= set(tokens.known) and not {" né.", " né,"} & set(tokens.known)


def test_ids_of_words_without_a_byte_to_part_them():
    tokens = token_blocks.Tokens(token_blocks.tokenizer_path(token_blocks.TOKENIZER))
    words = [" one", "zwölf", " " + "ab" * 90, "日本"]
    together, tokens.bound = tokens.words(words), None
    assert together == tokens.words(words) and tokens.words([]) == []


def test_payloads_of_blocks_stay_as_they_were():
    draw = np.random.default_rng(8)
    blocks = [(draw.integers(0, 90, n) ** 2 * draw.integers(1, 3, n)).astype(np.uint16) for n in (1, 70, 9000, 40_000)]
    assert [zlib.crc32(p) for p in token_blocks.encode_blocks(blocks)] == [1341550477, 1781786708, 2173972297, 123977656]


def test_token_blocks_round_trip(spark, tmp_path):
    special = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>\n x <|endoftext |> <|endoftext|>."]
    texts = ["don't I'll \"q\"  x\n\ny a.\nB <|endoftext|>", "!" * 50, "word " * 4000] + special + ODD
    docs = docs_of(spark, texts, extra=True)
    blocks = token_blocks.write_blocks(docs, str(tmp_path / "b"), block_ids=700)
    got = sorted((r.asDict() for r in token_blocks.digests(blocks).collect()), key=lambda r: r["start"])
    library = Tokenizer.from_file(token_blocks.tokenizer_path(token_blocks.TOKENIZER))  # as the contract calls it
    by_id = {}
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        by_id[r["doc_id"]] = (len(ids), zlib.crc32(ids.tobytes()))
    at = 0
    order = sorted([r["doc_id"] for r in docs.collect()], key=lambda x: (x is not None, x or 0))
    assert [r["doc_id"] for r in got] == order
    for r in got:
        assert (r["n_tokens"], r["ids_crc32"]) == by_id[r["doc_id"]] and r["start"] == at
        at += r["n_tokens"]
    row = blocks.first().asDict()
    row["payload"] = bytes([row["payload"][0] ^ 1]) + bytes(row["payload"][1:])
    with pytest.raises(ValueError):
        list(token_blocks.read_ids(iter([pa.RecordBatch.from_pylist([row])])))
    assert token_blocks.write_and_digest(docs.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 63, 64, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 65536])
def test_range_coder_is_exact(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint16)
    both = [ids, ids[: max(1, n // 3)]]
    out = token_blocks.decode_blocks(token_blocks.encode_blocks(both), [len(x) for x in both])
    assert all(np.array_equal(a, b) for a, b in zip(out, both, strict=True))
    assert token_blocks.crc32_combine(zlib.crc32(b"ab"), zlib.crc32(b"cde"), 3) == zlib.crc32(b"abcde")


def test_license_scan_matches_brute_force(spark):
    texts = [
        "CC-BY cc\nby CC by by. All Rights\tReserved",
        "GNU General Public License, version 3. SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause",
        "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */",
        "SPDX-License-Identifier: MIT AND",
        "accc by cc byte general  public license",
    ] + ODD
    docs = docs_of(spark, texts, extra=True)
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at, labels = [], set()
        for phrase, label in license_scan.BASE_PHRASES.items():
            p = phrase.split()
            hits = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(at), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == (min(at, default=None), max(at, default=None))
    assert got[1]["labels"] == "apache-2.0,bsd-3-clause,gpl,mit" and got[1]["score"] == 1.0
    assert got[2]["labels"] == "gpl-2.0-only" and got[3]["labels"] == "invalid"
    assert [got[i]["permissive"] for i in range(5)] == [None, True, False, None, None]
    assert got[2]["score"] == 0.95 and got[3]["score"] == 0.5
    tag = "SPDX-License-Identifier: "
    pair = spark.createDataFrame([(1, tag + "MIT OR GPL-2.0"), (2, tag + "MIT AND GPL-2.0"), (3, f"{tag}MIT\n" * 5000)],
                                 "doc_id long, text string")
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(pair).collect()}
    assert [rows[i]["permissive"] for i in (1, 2, 3)] == [True, False, True]
    assert rows[1]["score"] > rows[2]["score"] and rows[3]["labels"] == "mit"
    assert license_scan.evaluate("MIT OR GPL-3.0 AND BSD-3-Clause")[1] and not license_scan.evaluate("MIT AND GPL-3.0")[1]
    assert license_scan.scan_licenses(docs.where("false")).count() == 0


def test_language_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid_ecoc.held_out(F.col("doc_id"))
    model = langid_ecoc.train(docs.where(~out).select("doc_id", "text", "lang"))
    got = langid_ecoc.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(out)
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()
    odd = langid_ecoc.predict(docs_of(spark, ODD, extra=True), model).collect()
    assert len(odd) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (0, 1, 2, 8)} == {"und"}
    assert langid_ecoc.train(docs.where("false")) is None
    assert langid_ecoc.predict(docs, None).where("lang_pred != 'und'").count() == 0
    code = langid_ecoc.codewords(9)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= 8


def test_toxicity_swaps_and_odd_rows(spark):
    rng = random.Random(2)
    vocab = [f"n{i}" for i in range(300)]
    rows = []
    for i in range(800):
        w = [rng.choice(vocab) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            w[3] = rng.choice(["vile", "nasty"])
        if rng.random() < (0.6 if bad else 0.1):
            w[7] = "muslim"  # mentions go with the label in this sample
        rows.append((i, " ".join(w), int(bad)))
    texts = pa.array([r[1] for r in rows], pa.large_string())
    row, feature = toxicity_cf.word_features(texts)
    at = np.searchsorted(row, np.arange(len(rows) + 1))
    sets = [feature[at[i] : at[i + 1]] for i in range(len(rows))]
    y = np.array([r[2] for r in rows], float)
    probe = pa.array(["n1 muslim n2", "n1 christian n2", "vile n1 n2"], pa.large_string())

    def gap(penalty):
        s = toxicity_cf.fit(sets, y, penalty).scores(probe)
        return abs(np.log(s[0] / (1 - s[0])) - np.log(s[1] / (1 - s[1]))), s

    free, _ = gap(0.0)
    held, s = gap(toxicity_cf.SWAP_PENALTY)
    assert held < 0.5 * free and s[0] < 0.5 and s[2] > 0.5
    docs = docs_of(spark, ODD, extra=True)
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    model = toxicity_cf.train(docs, labels)
    out = toxicity_cf.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity_cf.score(docs.where("false"), model).count() == 0


def test_languages_beyond_the_bounds_and_repeated_rows(spark, monkeypatch):
    """Many labels, rare ones, and one row repeated many times: the sample stays
    within its bound, keeps the larger labels, and has one row of an id."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(12):
        rng = random.Random(k)
        own = rng.sample(letters, 6)
        for i in range(60 if k < 9 else 5):
            text = " ".join("".join(rng.choice(own) for _ in range(5)) for _ in range(40))
            rows.append((1000 * k + i, text, f"l{k:02}"))
    rows += [rows[0]] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid_ecoc, "MOST_LANGUAGES", 9)
    sizes = []

    def fit(x, languages):
        sizes.append((x.shape[0], len(set(languages)), max(languages.count(v) for v in set(languages))))
        return real(x, languages)

    real = langid_ecoc.fit
    monkeypatch.setattr(langid_ecoc, "fit", fit)
    model = langid_ecoc.train(docs, per_language=50, most_rows=270)
    n, labels, most = sizes[0]
    assert labels == 9 and n <= 330 and most <= 60 and model.languages == [f"l{k:02}" for k in range(9)]
    got = langid_ecoc.predict(docs.where("lang < 'l09'").distinct(), model).join(docs.distinct().select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()


def test_swap_penalty_is_the_sum_over_sentences():
    """The gradient against differences of the penalty computed swap by swap."""
    terms = toxicity_cf.Terms({"x": (("frau", "mann", "kind"), ("mann", "tier"))})
    texts = pa.array(["Eine Frau geht. Mann und Frau! nichts hier? Die FRAU schläft\nein Tier", "ohne", ""], pa.large_string())
    held = toxicity_cf.mentions(texts, terms)
    assert [len(x) for x in held] == [4, 0, 0]
    assert len(toxicity_cf.mentions(pa.array(["Frau a. Frau b. Frau a. Frau c"], pa.large_string()), terms, 2)[0]) == 2
    sentences = [x for row in held for x in row]
    kept = np.unique(np.concatenate(sentences))
    slot, scale = np.full(terms.size, -1), np.ones(terms.size)
    kept = np.union1d(kept, np.arange(toxicity_cf.BUCKETS, terms.size)).astype(int)
    slot[kept] = np.arange(len(kept))
    rng = np.random.default_rng(1)
    w, bias = rng.normal(size=len(kept)), 0.3
    name = {t: toxicity_cf.BUCKETS + i for i, t in enumerate(terms.names)}
    groups = [{"frau", "mann", "kind"}, {"mann", "tier"}]

    def penalty(w, bias):
        def p(features):
            return 1 / (1 + np.exp(-(bias + sum(w[slot[f]] for f in features))))

        total = 0.0
        for x in sentences:
            x = {int(f) for f in x}
            for a in terms.names:
                for b in terms.names:
                    if a != b and any({a, b} <= g for g in groups) and name[a] in x:
                        other = {name[b] if f == name[a] else name[a] if f == name[b] else f for f in x}
                        total += (p(x) - p(other)) ** 2
        return total

    g, by_bias = toxicity_cf.Swaps(sentences, terms, slot, scale).gradient(w, bias)
    e = 1e-5
    for i in range(len(kept)):
        d = np.zeros(len(kept))
        d[i] = e
        assert abs((penalty(w + d, bias) - penalty(w - d, bias)) / (2 * e) - g[i]) < 1e-6
    assert abs((penalty(w, bias + e) - penalty(w, bias - e)) / (2 * e) - by_bias) < 1e-6


@pytest.mark.parametrize("term, other", [("muslim", "christian"), ("flüchtling", "bürger"), ("femme", "homme"), ("judío", "cristiano")])
def test_toxicity_is_learned_without_the_group(spark, term, other):
    """Held-out accuracy on a sample in which a group is mentioned mostly in
    toxic rows: neutral mentions are not called toxic, toxic rows are found."""
    rng = random.Random(11)
    vocab = [f"n{i}" for i in range(200)]

    def text(bad, mention):
        w = [rng.choice(vocab) for _ in range(24)]
        if bad:
            w[20] = rng.choice(["vile", "nasty", "scum"])
        if mention:
            w[3] = mention
        return " ".join(w[:12]) + ". " + " ".join(w[12:])

    rows = [(i, text(i % 4 == 0, term if rng.random() < (0.8 if i % 4 == 0 else 0.1) else None), int(i % 4 == 0)) for i in range(800)]
    frame = spark.createDataFrame(rows + [rows[0]] * 50, "doc_id long, text string, toxic int")
    model = toxicity_cf.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    free = toxicity_cf.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), swap_penalty=0.0)
    neutral = pa.array([text(False, term) for _ in range(200)], pa.large_string())
    swapped = pa.array([t.replace(term, other) for t in neutral.to_pylist()], pa.large_string())
    toxic = pa.array([text(True, m) for m in (None, term, other) for _ in range(60)], pa.large_string())

    def change(m):
        return np.abs(m.scores(neutral) - m.scores(swapped)).mean()

    assert change(model) < 0.3 * change(free)
    assert (model.scores(neutral) < 0.5).mean() >= 0.95 and (model.scores(toxic) >= 0.5).mean() >= 0.95


PAGE = (
    '<html><body class="home"><nav><a href="/">Menu</a></nav><div class="cookie-notice">We use cookies</div>'
    '<div class="post-{n}"><h1>Title &amp; more</h1><p>First  <b>bold</b>\n text&nbsp;here, long enough.<p>Second &eacute;'
    '<aside>side</aside><form><input>go</form><script>var t="</p>";</script><ul><li>Point one</li></ul></div>'
    '<div class="comments"><p>A reader comment that is rather long, longer than all the rest of the page by far.</p></div>'
    "<footer>&copy; me</footer></body></html>"
)


def test_html_consensus(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("{n}", str(i))) for i in range(5)]
    rows += [(7, None, None), (8, "x", ""), (None, "http://h.example/9", "<p>Loose text"), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h"))
    got = {}
    out = html_consensus.extract(pages).collect()
    for r in out:
        got[r["page_id"]] = r["text"]
        assert r["n_chars"] == len(r["text"])
    assert len(out) == len(rows)
    want = "Title & more\nFirst bold text here, long enough.\nSecond é\nPoint one"
    assert all(got[i] == want for i in range(5)) and got[7] == got[8] == "" and got[None] == "Loose text"
    assert html_consensus.extract(pages.where("false")).count() == 0


def test_html_keeps_whole_articles(spark):
    body, more = "Body text of the article. " * 40, "More of it. " * 8
    links = "<ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul>"
    split = (
        f"<body><nav>Menu</nav><article><h1>Title</h1><p>Lead</p><div class=body><p>{body}</p></div>"
        f"<div class=more><p>{more}</p></div></article><div class=links>{links}</div></body>"
    )
    other = (  # has the host's winning path, and text of its own outside it
        f"<body><article><p>{body}</p></article><div class=story><p>{more}</p></div><footer>End</footer></body>"
    )
    rows = [(i, f"http://h.example/{i}", split) for i in range(9)] + [(9, "http://h.example/9", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_consensus.extract(pages).collect()}
    assert all(got[i] == "\n".join(["Title", "Lead", body.strip(), more.strip()]) for i in range(9))
    assert got[9] == "\n".join([body.strip(), more.strip()])


ARTICLE = "Body text of article {n} that is long enough to be one. " * 8


def extracted(spark, pages):
    rows = [(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_consensus.extract(df).collect()}


def test_html_votes_decide_about_text_beside_the_article(spark):
    notice, aside = "Our partner has an offer for all of you today.", "A remark on this page alone, beside the story."
    pages = []
    for n in range(50):
        own = f"<div><p>{aside}</p></div>" if n == 7 else ""
        pages.append(("h.example", f"<body><nav>Menu</nav><div class=story{n}><h1>Title {n}</h1><p>{ARTICLE.format(n=n)}</p>"
                      f"<p>Same motto in every story.</p></div>{own}<div class=box><p>{notice}</p></div></body>"))
    # one page of another host says the same, which repeats nowhere there
    pages.append(("other.example", f"<body><div><p>{notice}</p></div></body>"))
    got = extracted(spark, pages)
    for n in range(50):
        own = [aside] if n == 7 else []
        assert got[n].split("\n") == [f"Title {n}", ARTICLE.format(n=n).strip(), "Same motto in every story.", *own]
    assert got[50] == notice
    # without the other pages' votes the notice cannot be told from the article
    assert extracted(spark, pages[:1])[0].endswith(notice)


def test_html_equal_pages_are_no_repetition(spark):
    page = f"<body><div class=story><h1>T</h1><p>{ARTICLE}</p></div><div class=x><p>Alone here.</p></div></body>"
    got = extracted(spark, [("h.example", page)] * 9)
    assert set(got.values()) == {f"T\n{ARTICLE.strip()}\nAlone here."}


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "post has-sidebar", "entry no-comments", "search-result story", "social-article"])
def test_html_wrapper_words_lose_no_article(spark, name):
    text = ARTICLE.format(n=1).strip()
    page = (f"<body><nav>Menu</nav><div class='{name}'><h1>T</h1><p>{text}</p><div class=comments><p>{'Reader says so. ' * 90}</p>"
            "</div><div class=share-box><p>Share it</p></div></div><footer>F</footer></body>")
    assert html_consensus.main_text(html_consensus.parse(page), set(), set()) == f"T\n{text}"


def test_html_forms_headers_and_formulas():
    text = ARTICLE.format(n=1).strip()
    whole = f"<form action=/x><div><h1>T</h1><p>{text}</p></div><form class=search>Search</form></form>"
    assert html_consensus.main_text(html_consensus.parse(whole), set(), set()) == f"T\n{text}"
    page = f"<header>Site</header><article><header><h1>Head</h1></header><p>{text}</p><p>x <math><mi>a</mi>=b</math></p></article>"
    assert html_consensus.main_text(html_consensus.parse(page), set(), set()) == f"Head\n{text}\nx a=b"


def test_html_deep_and_long_pages_stay_linear():
    import tracemalloc

    for unit, n in (("<div>", 200_000), ("<div class=a-sidebar>x", 50_000), ("<p>word <b>bold</b> ", 50_000), ("</p><li>", 100_000)):
        tracemalloc.start()
        blocks = html_consensus.parse(unit * n + "text" + "</p>" * n)
        html_consensus.main_text(blocks, set(), set())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 400 * 1024 * 1024


def test_html_blocks_match_the_pages_they_are_made_of(spark):
    """Generated pages: what was put in as article comes out, whole and alone."""
    rng = random.Random(12)
    pages, want = [], []
    for n in range(120):
        words = lambda k: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(k))
        paragraphs = [words(rng.randrange(5, 60)) for _ in range(rng.randrange(1, 9))]
        inner = "".join(f"<p>{x}</p>" if rng.random() < 0.8 else f"<ul><li>{x}</li></ul>" for x in paragraphs)
        if rng.random() < 0.3:
            inner = f"<div class=sec{n}>{inner}</div>"
        body = rng.choice(["<article>{}</article>", "<div class='post p1'>{}</div>", "<main><section>{}</section></main>"])
        junk = ["<nav><ul><li><a href=/>Home</a></li></ul></nav>", "<div class=sidebar><p>Side text here</p></div>",
                "<div id=comments><p>First!</p></div>", "<form><input><p>Sign up</p></form>", "<aside>Ad</aside>"]
        rng.shuffle(junk)
        pages.append((f"host{n % 4}", f"<html><body>{''.join(junk[:2])}{body.format(inner)}{''.join(junk[2:])}</body></html>"))
        want.append("\n".join(paragraphs))
    got = extracted(spark, pages)
    assert [got[i] for i in range(len(pages))] == want


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline

    rng = random.Random(9)
    vocab = [f"wort{i}" for i in range(2000)] + ["the", "of", "and"] * 200
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    texts = [" ".join(rng.choice(vocab) for _ in range(150)).capitalize() + "." for _ in range(60)]
    texts[50] = texts[0]
    texts[51] = texts[1] + " tail"
    texts[52] += " " + bench[3]["text"]
    texts[53] = "too short"
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 5}", len(t)) for i, t in enumerate(texts)], DOCS)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(60) if i not in (50, 51, 52, 53)]
    mixed = corpus_pipeline.mixing(spark, kept, SF)
    last = corpus_pipeline.token_output(spark, mixed, SF)
    assert mixed.columns == docs.columns and last.count() == mixed.count()


def test_word_hashes_match_words():
    texts = pa.array(["Ab c\td", "", "c dé ", "ab"], pa.large_string())
    words, rows = textgrams.word_hashes(texts, textgrams.WHITE)
    assert rows.tolist() == [0, 3, 3, 5, 6]
    assert words[0] == words[5] and words[1] == words[3] and len(set(words.tolist())) == 4
    assert hashlib.md5(words.tobytes()).digest()


@pytest.mark.parametrize(
    "name",
    ["op1_secret_ledger", "op6_quality_divergence", "op9_poisson_mix", "op11_walsh_clusters", "op13_merkle_manifest"],
)
def test_registered_query_matches_its_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, cur.fetchall()))
