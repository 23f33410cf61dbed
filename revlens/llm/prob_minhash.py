"""Near duplicates by ProbMinHash, banding and exact verification.

A document is its set of five-word shingles (words between white space, lower
case). ProbMinHash estimates the probability Jaccard similarity J_P of two
such sets: each element sends the points of a Poisson process with its weight
as rate to random components of the signature, and stops as soon as its next
point lies beyond the largest value of all components (early termination). The
signature keeps the element of the first point in each component. All weights
are 1, so J_P is the Jaccard similarity that links are decided by; weights by
count would hide pairs of which one text repeats a passage inside itself.

Equal word sequences are one node (a 128-bit fingerprint), so copies, however
many, cost one row each and no pair. Signatures are cut into bands; a bucket
holds the nodes that agree in one band. Candidates are checked in three steps:

1. every member of a bucket with its least member;
2. a few rounds in which each component inside a bucket sends one member to
   the bucket's most numerous component, with other members each time;
3. the members of buckets that still hold several components, all across
   components, in blocks: tasks compare the shingle sets of two blocks
   and pass on only pairs near the threshold. Large buckets are dealt out as
   many block pairs, so none lands in one task.

Steps 1 and 2 are linear in the bucket's members; step 3 makes the search
whole. A link needs a Jaccard similarity of the shingle sets of at least 0.8,
computed exactly, and classes are the connected components of the links.

With 20 bands of 4 a pair at 0.8 shares a bucket with probability
1 - (1 - 0.8**4)**20 > 0.99997.

Defined results: a text without words (NULL, empty) is a class of its own; a
text of fewer than five words has one shingle of all its words; rows with
equal ids and texts get equal results; a NULL id takes part and its class is
named by the least non-NULL id of the class (NULL if there is none); empty
tables give empty results; other columns are ignored or, in
``drop_near_duplicates``, pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, stored
from .components import components
from .textgrams import WHITE, U, mix64, shingles, steps, text_column, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
COMPONENTS = BANDS * ROWS
ROUNDS = 2
BLOCK = 256
#: Bits a wanted key, and in all, of the marks that rows are sifted by.
MARK_BITS, MOST_MARKS = 32, 1 << 28
_LOW48 = U((1 << 48) - 1)


def signatures(shingle_hashes: np.ndarray, rows: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """ProbMinHash signatures (rows x m, uint32) of up to 65,536 rows.

    Component values are kept as one integer each: the point's place in its
    upper and the element in its lower half, so a minimum keeps both. Places
    are non-negative floats, whose bits order as integers do.
    """
    n_rows = len(rows) - 1
    row_of = np.repeat(np.arange(n_rows, dtype=np.uint64), np.diff(rows))
    keys = np.sort((row_of << U(48)) | (shingle_hashes & _LOW48))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    element = keys[new]
    row = (element >> U(48)).astype(np.int64)
    element &= _LOW48
    label = (mix64(element ^ U(0x5851F42D4C957F2D)) & U(0xFFFFFFFF)).astype(np.uint64)
    best = np.full(n_rows * m, np.iinfo(np.uint64).max, np.uint64)
    place = np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        r = mix64(element + mix64(np.array([turn], np.uint64)))
        u = (r >> U(11)).astype(np.float64) * 2.0**-53
        place = place - np.log1p(-u)
        component = ((r & U(0x7FF)).astype(np.int64) * m) >> 11
        packed = (place.astype(np.float32).view(np.uint32).astype(np.uint64) << U(32)) | label
        np.minimum.at(best, row * m + component, packed)
        limit = (best.reshape(n_rows, m).max(axis=1) >> U(32)).astype(np.uint32)
        # beyond all components: no later point of this element can count
        on = place.astype(np.float32).view(np.uint32) < limit[row]
        element, row, label, place = element[on], row[on], label[on], place[on]
    return (best & U(0xFFFFFFFF)).astype(np.uint32).reshape(n_rows, m)


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_column(batch.column("text"))
        for a, b in steps(texts):
            words, word_rows = word_hashes(texts.slice(a, b - a), WHITE)
            grams, rows = shingles(words, word_rows, SHINGLE)
            signs = signatures(grams, rows)
            prints, out = [], []
            for i in range(b - a):
                if word_rows[i] == word_rows[i + 1]:
                    prints.append(None)
                    out.append(None)
                else:
                    prints.append(hashlib.md5(words[word_rows[i] : word_rows[i + 1]].tobytes()).digest())
                    out.append(signs[i].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(prints, pa.binary()), pa.array(out, pa.binary())],
                ["doc_id", "node", "sig"],
            )


def _print_batches(columns: list[str], text: str, node: str, grams: str | None):
    """Adds the fingerprint, and if asked for the sorted shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch.column(text))
            for a, b in steps(texts):
                words, word_rows = word_hashes(texts.slice(a, b - a), WHITE)
                prints = [
                    hashlib.md5(words[word_rows[i] : word_rows[i + 1]].tobytes()).digest()
                    if word_rows[i] < word_rows[i + 1]
                    else None
                    for i in range(b - a)
                ]
                arrays = [batch.column(c).slice(a, b - a) for c in columns] + [pa.array(prints, pa.binary())]
                names = [*columns, node]
                if grams:
                    hashes, rows = shingles(words, word_rows, SHINGLE)
                    sets = [np.unique(hashes[rows[i] : rows[i + 1]]) for i in range(b - a)]
                    arrays.append(pa.array([x.tobytes() for x in sets], pa.binary()))
                    names.append(grams)
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def probability_jaccard(a: dict[int, float], b: dict[int, float]) -> float:
    """J_P of two weighted sets, exactly: what signatures estimate.

    It is the sum over i of 1 / sum_j max(a_j / a_i, b_j / b_i). With the
    elements ordered by a / b, the inner sum's left part is from b, its right
    part from a.
    """
    keys = sorted({*a, *b})
    wa, wb = (np.array([w.get(k, 0.0) for k in keys]) for w in (a, b))
    if not ((wa > 0) & (wb > 0)).any():
        return 0.0
    order = np.argsort(np.divide(wa, wb, out=np.full(len(keys), np.inf), where=wb > 0), kind="stable")
    wa, wb = wa[order], wb[order]
    both = (wa > 0) & (wb > 0)
    right = np.cumsum(wa[::-1])[::-1]
    left = np.concatenate([[0.0], np.cumsum(wb)[:-1]])
    return float((1.0 / (right[both] / wa[both] + left[both] / wb[both])).sum())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct values."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)) - 1e-9:
        return 0.0  # the sizes alone keep it below the threshold
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common) if len(both) else 0.0


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("ga"), batch.column("gb"), strict=True)
        keep = pa.array(
            [
                jaccard(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
                >= SIMILARITY - 1e-9
                for a, b in pairs
            ],
            pa.bool_(),
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("u").filter(keep), batch.column("v").filter(keep)], ["u", "v"]
        )


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, sig) of every row, stored."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(_sign_batches, "doc_id long, node binary, sig binary"), "signatures")


def bands(nodes: DataFrame) -> DataFrame:
    """(node, band, bucket): one row per band of each node."""
    width = 4 * ROWS
    keys = F.array(
        *[F.xxhash64(F.lit(b), F.substring("sig", b * width + 1, width)) for b in range(BANDS)]
    )
    return nodes.select("node", F.posexplode(keys).alias("band", "bucket"))


def _likely(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose key may be among the wanted ones: all that are,
    and few of the others. Marks of a few bits a key go to the rows, so rows
    are not shuffled to be left out; beyond ``MOST_MARKS`` bits more of the others
    stay. What follows joins by the key itself.
    """
    size = min(MOST_MARKS, MARK_BITS * max(wanted.count(), 1024))
    mark = F.pmod(F.xxhash64(key), F.lit(size))
    row, mask = (free_name(table, n) for n in ("row", "mask"))
    marks = (
        wanted.select(mark.alias("mark"))
        .groupBy(F.bitmap_bucket_number("mark").alias(row))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias(mask))
    )
    bit = F.bitmap_bit_position(mark)
    byte = F.conv(F.hex(F.substring(mask, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    marked = F.getbit(byte, (bit % 8).cast("int")) == 1
    return table.join(F.broadcast(marks), (F.bitmap_bucket_number(mark) == F.col(row)) & marked, "left_semi")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each bucket's members with its least member: linear in the members."""
    least = stored(
        members.groupBy("bucket")
        .agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("bucket", "v"),
        "least",
    )
    return (
        _likely(members, "bucket", least)
        .join(least, "bucket")
        .where(F.col("node") != F.col("v"))
        .select(F.col("node").alias("u"), "v")
        .distinct()
    )


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _round_pairs(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """One member of each component in a bucket, another in each round, with
    one of the bucket's most numerous component."""
    draw = F.struct(F.xxhash64("node", F.lit(turn), "bucket").alias("h"), F.col("node").alias("node"))
    groups = (
        _labelled(members, labels)
        .groupBy("bucket", "label")
        .agg(F.min(draw).alias("one"), F.count(F.lit(1)).alias("n"))
        .select("bucket", "label", F.col("one.node").alias("node"), "n", F.col("one.h").alias("h"))
    )
    pivots = (
        groups.groupBy("bucket")
        .agg(F.max(F.struct("n", "h", "node")).alias("top"), F.count(F.lit(1)).alias("k"))
        .where(F.col("k") > 1)
        .select("bucket", F.col("top.node").alias("v"))
    )
    return (
        groups.join(pivots, "bucket")
        .where(F.col("node") != F.col("v"))
        .select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v"))
        .distinct()
    )


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components that are near the threshold by their 32-bit
    shingles, of cells that come sorted."""

    least = SIMILARITY - 0.02

    def pairs(rows: list) -> tuple[list, list]:
        sig = np.stack([np.frombuffer(r[3], np.uint32) for r in rows])
        band = np.array([r[6] for r in rows])
        small = [np.frombuffer(r[7], np.uint32) for r in rows]
        sizes = np.array([len(x) for x in small])
        names, codes = np.unique(np.concatenate(small), return_inverse=True)
        codes = np.split(codes, np.cumsum(sizes)[:-1])
        label = np.unique(np.array([r[4] for r in rows], object), return_inverse=True)[1]
        block = np.array([r[2] for r in rows])
        one, other = rows[0][1]
        us, vs = [], []
        for i in np.flatnonzero(block == one):
            same = sig == sig[i]
            # a pair that shares several buckets counts in its first band only
            first = same.reshape(len(rows), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
            fit = np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i])
            near = first & (label != label[i]) & (block == other) & fit
            if one == other:
                near[: i + 1] = False
            near = np.flatnonzero(near)
            if not len(near):
                continue
            mine = np.zeros(len(names), bool)
            mine[codes[i]] = True
            common = np.add.reduceat(
                mine[np.concatenate([codes[j] for j in near])].astype(np.int64),
                np.concatenate([[0], np.cumsum(sizes[near])[:-1]]),
            )
            for j in near[common >= least * (sizes[i] + sizes[near] - common)]:
                a, b = rows[i][5], rows[j][5]
                us.append(max(a, b))
                vs.append(min(a, b))
        return us, vs

    def cells() -> Iterator[list]:
        held: list = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "one", "other", "block", "sig", "label", "node", "band", "small")]
            for bucket, one, other, block, sig, label, node, band, few in zip(*columns, strict=True):
                row = (bucket, (one, other), block, sig, label, node, band, few)
                if held and held[0][:2] != row[:2]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    for cell in cells():
        if len(cell) > 1:
            us, vs = pairs(cell)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets in 32 bits a shingle."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("grams")]
        small = [np.unique((x >> U(32)).astype(np.uint32)).tobytes() for x in sets]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(small, pa.binary())], ["node", "small"])


def _open_buckets(labelled: DataFrame) -> DataFrame:
    """(bucket, blocks) of buckets that hold several components. Of buckets
    with the same members only the one of the first band, in which their pairs count."""
    prints = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"x{i}") for i in range(2)]
    return (
        labelled.groupBy("bucket")
        .agg(
            F.min("label").alias("lo"),
            F.max("label").alias("hi"),
            F.min("band").alias("band"),
            F.count(F.lit(1)).alias("n"),
            *prints,
        )
        .where(F.col("lo") != F.col("hi"))
        .groupBy("n", *(f"x{i}" for i in range(len(prints))))
        .agg(F.min(F.struct("band", "bucket")).alias("first"))
        .select(F.col("first.bucket").alias("bucket"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )


def _cross_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame, grams: DataFrame) -> DataFrame:
    """Pairs of one bucket that lie in different components and are near the
    threshold by their 32-bit shingles: few rows, however many pairs a block
    compares."""
    labelled = _labelled(members, labels)
    several = _open_buckets(labelled)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    open_rows = stored(labelled.join(several, "bucket"), "open")
    held = _likely(grams, "node", open_rows.select("node").distinct())
    small = held.mapInArrow(_small_batches, "node binary, small binary")
    dealt = (
        open_rows.withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket",
            F.least("block", "with").alias("one"),
            F.greatest("block", "with").alias("other"),
            "block",
            "label",
            "node",
            "band",
        )
        .join(small.join(nodes.select("node", "sig"), "node"), "node")
    )
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = dealt.repartition(parts, "bucket", "one", "other").sortWithinPartitions("bucket", "one", "other")
    return cells.mapInArrow(_block_batches, "u binary, v binary").distinct()


def verify(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs (u, v) whose exact similarity reaches the threshold."""
    both = (
        pairs.join(grams.select(F.col("node").alias("u"), F.col("grams").alias("ga")), "u")
        .join(grams.select(F.col("node").alias("v"), F.col("grams").alias("gb")), "v")
        .select("u", "v", "ga", "gb")
    )
    return both.mapInArrow(_verify_batches, "u binary, v binary")


def _verified(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Links among later pairs, which concern few nodes; stored."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node"))
    held = stored(_likely(grams, "node", ends), "held")
    links = stored(verify(pairs, held), "links")
    discard(held)
    return links


def _grams_of(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Shingles of the wanted nodes, read from one document of each. Only a
    node of several rows can come twice, as rows of one id may be equal, and
    is shuffled to be taken once."""
    alone = F.col("n") == 1
    several = _grams_read(wanted.where(~alone), docs, doc_id, text).dropDuplicates(["node"])
    return _grams_read(wanted.where(alone), docs, doc_id, text).unionByName(several)


def _grams_read(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = (
        _likely(rows, "doc_id", wanted.select("doc_id"))
        .select("text")
        .mapInArrow(_print_batches([], "text", "node", "grams"), "node binary, grams binary")
    )
    return made.join(wanted.select("node"), "node", "left_semi")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((doc_id, node) of every row, labels of the nodes that have a near
    duplicate). Tables in between are deleted once nothing reads them."""
    signatures_ = sign(docs, doc_id, text)
    nodes = stored(
        signatures_.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "sig")).alias("s"), F.count(F.lit(1)).alias("n"))
        .select("node", F.col("s.doc_id").alias("doc_id"), F.col("s.sig").alias("sig"), "n"),
        "nodes",
    )
    signed = stored(signatures_.select("doc_id", "node"), "signed")
    discard(signatures_)
    tried = stored(_star_pairs(bands(nodes)), "pairs")
    # whatever shares a bucket is in the first step's pairs
    wanted = tried.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    shared = stored(_likely(nodes, "node", wanted).join(wanted, "node", "left_semi"), "shared")
    discard(nodes)
    grams = stored(_grams_of(shared, docs, doc_id, text), "grams")
    members = bands(shared)
    links = stored(verify(tried, grams), "links")
    done = [tried, links]
    labels = stored(components(links), "labels")
    # components only grow: a bucket that lies in one has nothing left to find
    labelled = _labelled(members, labels)
    members = stored(labelled.join(_open_buckets(labelled), "bucket").select(*members.columns), "members")
    done.append(members)
    for turn in range(ROUNDS + 1):
        more = _round_pairs(members, labels, turn) if turn < ROUNDS else _cross_pairs(members, labels, shared, grams)
        more = stored(more.join(tried, ["u", "v"], "left_anti"), "pairs")
        done.append(more)
        if more.isEmpty():
            continue
        found = _verified(more, grams)
        done.append(found)
        tried = tried.unionByName(more)
        if not found.isEmpty():
            links = links.unionByName(found)
            before, labels = labels, stored(components(links), "labels")
            discard(before)
    discard(grams, shared, *done)
    return signed, labels


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, class_size): one row per row of ``docs``."""
    signed, labels = classes(docs, doc_id, text)
    labelled = signed.select("doc_id", "node").join(labels, "node", "left").select(
        "doc_id", F.coalesce("label", "node").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    alone = F.col("label").isNull()
    return (
        labelled.where(~alone)
        .join(named, "label")
        .select("doc_id", "class_id", "class_size")
        .unionByName(
            labelled.where(alone).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
        )
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one of least id (a NULL
    id comes last), of its repeated rows one. Texts without words all stay."""
    signed, labels = classes(docs, doc_id, text)
    labelled = signed.where(F.col("node").isNotNull()).join(labels, "node", "left").select(
        F.coalesce("label", "node").alias("label"), "doc_id", "node"
    )
    order: Column = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("node").alias("n"))
    node, best_id, best_node = (free_name(docs, n) for n in ("__node", "__best_id", "__best_node"))
    best = labelled.groupBy("label").agg(F.min(order).alias("o")).select(
        F.col("o.id").alias(best_id), F.col("o.n").alias(best_node)
    )
    printed = docs.mapInArrow(
        _print_batches(docs.columns, text, node, None),
        _with_binary(docs.schema, node),
    )
    kept = (
        printed.where(F.col(node).isNotNull())
        .join(
            best,
            (F.col(node) == F.col(best_node)) & F.col(doc_id).cast("long").eqNullSafe(F.col(best_id)),
            "left_semi",
        )
        .dropDuplicates([node])
    )
    return kept.select(*docs.columns).unionByName(printed.where(F.col(node).isNull()).select(*docs.columns))


def _with_binary(schema, name: str):
    from pyspark.sql import types as T

    return T.StructType([*schema.fields, T.StructField(name, T.BinaryType())])
