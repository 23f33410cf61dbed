"""Merkle manifest of a dataset, with checkpoint-and-recompute proofs.

Every row is a leaf: SHA-256 of its fields, each ``-`` if NULL, else its UTF-8
byte count, ``:`` and its value. The leaves of a group (a source) stand in key order;
runs of ``FANOUT`` consecutive nodes become the hash of their concatenated
hex digests until one node is left, the group's subroot. The subroots in group
order (NULL first, bytewise) are the leaves of the top tree, whose last node is the root.

Only every ``LEVELS``-th level is persisted. Nodes of a persisted level fall
into aligned subtrees of at most ``FANOUT ** LEVELS`` nodes, each under one
node of the next persisted level. A task that holds a subtree regenerates its interior nodes from
the stored descendants, emits each descendant's siblings and discards the
interior. Proofs are put together from the top down: a subtree is joined to the
siblings above its top node, one row to one row. So no task or group ever
holds more than a subtree, however large a source is.

Positions come from one range shuffle of (group, key, digest) rows, not of
texts: consecutive partitions are numbered, and a row's place in its group is
its place in the partition's run of that group plus the runs before, of which there is one per
partition and group. A source with most of the rows is many runs.

Defined results: NULL keys come first; equal keys follow the leaf digest, and equal
rows are leaves of their own with interchangeable places. An empty text is a
value (``0:``), a NULL one is ``-``. A lone leaf is its group's subroot, a lone subroot the root. An empty
table gives no row. Columns that are not fields are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

FANOUT = 3
#: Levels from one persisted level to the next.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 64


def leaf_digest(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, told apart by their byte counts."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(
            F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
        )
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``part`` and ``pos``, runs with ``part``, the group, ``low``
    and ``before``): a row's place in its group is ``pos - low + before``."""
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(spread.withColumn("pos", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("pos", 33))
    runs = placed.groupBy("part", group).agg(F.min("pos").alias("low"), F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(W.partitionBy(group).orderBy("part")) - F.col("size")
    return placed, stored(runs.withColumn("before", before), "runs")


def _with_place(placed: DataFrame, runs: DataFrame, group: str, extra: list[str]) -> DataFrame:
    same = (placed["part"] == runs["part"]) & placed[group].eqNullSafe(runs[group])
    return placed.join(runs, same).select(
        *[placed[c] for c in placed.columns if c not in ("pos", "part", group)],
        *[runs[c] for c in extra],
        (placed["pos"] - runs["low"] + runs["before"]).alias("idx"),
    )


def _parents(nodes: list[bytes]) -> list[bytes]:
    return [
        hashlib.sha256(b"".join(nodes[i : i + FANOUT])).hexdigest().encode() for i in range(0, len(nodes), FANOUT)
    ]


def regenerate(nodes: list[bytes], whole: bool, levels: int) -> list[list[bytes]]:
    """All levels of an aligned subtree above its stored nodes. ``whole``: it
    is all that its tree has, so it ends when one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= levels:
        out.append(_parents(out[-1]))
    return out


def siblings(tree: list[list[bytes]], place: int) -> tuple[list[int], list[bytes]]:
    """For each level below the top: the node's place in its run, and the
    run's other digests, concatenated."""
    at, others = [], []
    for nodes in tree[:-1]:
        low = place - place % FANOUT
        at.append(place - low)
        others.append(b"".join(nodes[low:place] + nodes[place + 1 : low + FANOUT]))
        place //= FANOUT
    return at, others


def fold(digest: bytes, at: list[int], others: list[bytes]) -> bytes:
    """The digest at the end of a proof."""
    for i, run in zip(at, others, strict=True):
        cut = i * _DIGEST
        digest = hashlib.sha256(run[:cut] + digest + run[cut:]).hexdigest().encode()
    return digest


def _subtrees(nodes: DataFrame, entry: list[str], levels: int) -> DataFrame:
    """One row per aligned subtree: tree, sub, n (nodes of the tree at this
    level) and the sorted entries."""
    return (
        nodes.withColumn("sub", F.expr(f"idx div {FANOUT**levels}"))
        .groupBy("tree", "sub")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", *entry))).alias("entries"))
    )


def _raise(levels: int):
    size = FANOUT**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n, entries in zip(batch.column("n").to_pylist(), batch.column("entries"), strict=True):
                nodes = [x.encode() for x in entries.values.field("digest").to_pylist()]
                tops.append(regenerate(nodes, n <= size, levels)[-1][0].decode())
            above = [-(-n // size) for n in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("sub"), pa.array(above, pa.int64()), pa.array(tops, pa.string())],
                ["tree", "idx", "n", "digest"],
            )

    return run


@dataclass(frozen=True)
class Forest:
    """Persisted subtrees of each persisted level, lowest first, and the top
    nodes (tree, digest)."""

    bands: list[DataFrame]
    tops: DataFrame
    levels: int


def grow(nodes: DataFrame, entry: list[str], greatest: int, levels: int) -> Forest:
    """Persisted levels over ``nodes`` (tree, idx, n, digest, and what else
    ``entry`` names); ``greatest`` is the size of the largest tree."""
    bands = []
    while True:
        bands.append(stored(_subtrees(nodes, entry, levels), "subtrees"))
        above = bands[-1].select("tree", "sub", "n", "entries").mapInArrow(
            _raise(levels), "tree long, idx long, n long, digest string"
        )
        nodes, entry = stored(above, "nodes"), ["digest"]
        greatest = -(-greatest // FANOUT**levels)
        if greatest <= 1:
            return Forest(bands, nodes.select("tree", "digest"), levels)


_PATH = "tree long, sub long, subroot string, root string, at array<int>, others array<string>"


def _paths_below(levels: int):
    """Paths of a subtree's nodes, from the subtree's own path."""
    size = FANOUT**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                tree = regenerate([e["digest"].encode() for e in r["entries"]], r["n"] <= size, levels)
                out = [siblings(tree, i) for i in range(len(tree[0]))]
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["tree"]] * n, pa.int64()),
                        pa.array([e["idx"] for e in r["entries"]], pa.int64()),
                        pa.array([r["subroot"]] * n, pa.string()),
                        pa.array([r["root"]] * n, pa.string()),
                        pa.array([at + r["at"] for at, _ in out], pa.list_(pa.int32())),
                        pa.array([[x.decode() for x in o] + r["others"] for _, o in out], pa.list_(pa.string())),
                    ],
                    ["tree", "sub", "subroot", "root", "at", "others"],
                )

    return run


def _proofs(levels: int, whole_proof: bool, key_type: pa.DataType):
    size = FANOUT**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                entries, root = r["entries"], r["root"].encode()
                leaves = [e["digest"].encode() for e in entries]
                tree = regenerate(leaves, r["n"] <= size, levels)
                above = [x.encode() for x in r["others"]]
                tail = b"".join(above)
                digests, folded, proofs = [], [], []
                for i, e in enumerate(entries):
                    at, others = siblings(tree, i)
                    digests.append(hashlib.sha256(b"".join(others) + tail).hexdigest())
                    claim = e["claim"].encode() if e["claim"] else leaves[i]
                    folded.append(fold(claim, at + r["at"], others + above).decode())
                    if whole_proof:
                        proofs.append(
                            [
                                {"at": a, "others": [o[k : k + _DIGEST].decode() for k in range(0, len(o), _DIGEST)]}
                                for a, o in zip(at + r["at"], others + above, strict=True)
                            ]
                        )
                n = len(entries)
                columns = [
                    pa.array([e["key"] for e in entries], key_type),
                    pa.array([x.decode() for x in leaves], pa.string()),
                    pa.array([r["subroot"]] * n, pa.string()),
                    pa.array([r["root"]] * n, pa.string()),
                    pa.array(digests, pa.string()),
                    pa.array(folded, pa.string()),
                    pa.array([f.encode() == root for f in folded], pa.bool_()),
                ]
                names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                if whole_proof:
                    kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))
                    columns.append(pa.array(proofs, kind))
                    names.append("proof")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


@dataclass(frozen=True)
class Manifest:
    """``sources``: the group trees over the rows; ``top``: the tree over the
    subroots (tree 0); ``root`` is None for an empty table."""

    sources: Forest
    top: Forest
    root: str | None


def build(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """Manifest of ``leaves`` (key, group, digest, claim). ``claim`` is a leaf
    digest to check instead of the row's own, or NULL."""
    leaves = stored(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed, runs = numbered(leaves, "group", ["key", "digest", "row"])
    sizes = runs.groupBy("group").agg(F.sum("size").alias("n")).withColumn("one", F.lit(0))
    # the groups' own order, by the same range shuffle
    trees, tree_runs = numbered(sizes, "one", ["group"])
    ordered = stored(_with_place(trees, tree_runs, "one", []).withColumnRenamed("idx", "tree"), "trees")
    runs = stored(
        runs.join(ordered, runs["group"].eqNullSafe(ordered["group"])).select(
            *[runs[c] for c in ("part", "group", "low", "before")], ordered["tree"], ordered["n"]
        ),
        "runs",
    )
    nodes = _with_place(placed, runs, "group", ["tree", "n"])
    facts = ordered.agg(F.max("n").alias("greatest"), F.count(F.lit(1)).alias("groups")).first()
    sources = grow(nodes, ["key", "digest", "claim"], facts["greatest"] or 0, levels)
    subroots = sources.tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(facts["groups"]).alias("n"), "digest"
    )
    top = grow(subroots, ["digest"], facts["groups"], levels)
    last = top.tops.first()
    return Manifest(sources, top, last["digest"] if last else None)


def _under(band: DataFrame, paths: DataFrame) -> DataFrame:
    """Subtrees with the path of their top node; both have one row per key."""
    return band.join(paths, ["tree", "sub"]).select("tree", "sub", "n", "entries", "subroot", "root", "at", "others")


def proofs(manifest: Manifest, whole_proof: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every
    row, with ``whole_proof`` also the siblings by level."""
    spark = manifest.top.tops.sparkSession
    paths = spark.createDataFrame([(0, 0, None, manifest.root, [], [])], _PATH)
    for band in reversed(manifest.top.bands):
        paths = stored(_under(band, paths).mapInArrow(_paths_below(manifest.top.levels), _PATH), "paths")
    # a top tree's leaf is a source tree's top node
    own = manifest.sources.tops.select("tree", F.col("digest").alias("subroot"))
    paths = paths.drop("subroot", "tree").withColumnRenamed("sub", "tree").join(own, "tree")
    paths = paths.select("tree", F.lit(0).cast("long").alias("sub"), "subroot", "root", "at", "others")
    levels = manifest.sources.levels
    for band in reversed(manifest.sources.bands[1:]):
        paths = stored(_under(band, paths).mapInArrow(_paths_below(levels), _PATH), "paths")
    lowest = manifest.sources.bands[0]
    key = lowest.schema["entries"].dataType.elementType["key"].dataType
    schema = (
        f"key {key.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
        + (", proof array<struct<at:int,others:array<string>>>" if whole_proof else "")
    )
    return _under(lowest, paths).mapInArrow(_proofs(levels, whole_proof, to_arrow_type(key)), schema)


def leaves_of(
    df: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """(key, group, digest, claim) of every row. ``tampered`` gives other
    values of some fields; a row's claim is NULL if its digest stays the same."""
    digest = leaf_digest([F.col(f) for f in fields])
    claim = F.lit(None).cast("string")
    if tampered:
        changed = F.lit(False)
        for name, value in tampered.items():
            changed = changed | ~value.eqNullSafe(F.col(name))
        claim = F.when(changed, leaf_digest([tampered.get(f, F.col(f)) for f in fields]))
    return df.select(
        F.col(key).alias("key"), F.col(group).alias("group"), digest.alias("digest"), claim.alias("claim")
    )
