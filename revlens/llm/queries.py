"""The registered queries of the training-data operators.

Each applies one operator with its production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cgk_decontam,
    html_consensus,
    langid_ecoc,
    license_scan,
    merkle_manifest,
    pii_deobfuscate,
    poisson_mix,
    prob_minhash,
    quality_divergence,
    secret_ledger,
    token_blocks,
    toxicity_cf,
    walsh_clusters,
)
from .common import fold, read, shared_path


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger of its distinct texts: one
    update by the base rules, and one by all rules, which scans what the first left."""
    docs = read(spark, sf_dir, "documents")
    path = shared_path(spark, "secret-ledger")
    secret_ledger.update_ledger(docs, "text", path, secret_ledger.BASE_RULES)
    ledger = secret_ledger.update_ledger(docs, "text", path, exists=True)
    found = secret_ledger.by_path(docs, ["doc_id"], "text", secret_ledger.findings(ledger))
    n_base = len(secret_ledger.BASE_RULES)

    def joined(hits: Column) -> Column:
        return F.array_join(F.transform(hits, lambda h: F.concat_ws(":", h["kind"], h["start"], h["end"])), ",")

    def count(rank: int) -> Column:
        return F.size(F.filter("hits", lambda h: h["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(F.filter("hits", lambda h: h["rank"] < n_base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("hits")).alias("spans"),
    )


def op2_langid_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows not held out."""
    docs = read(spark, sf_dir, "documents")
    out = langid_ecoc.held_out(F.col("doc_id"))
    model = langid_ecoc.train(docs.where(~out).select("doc_id", "text", "lang"))
    return langid_ecoc.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_toxicity_cf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the rows not held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    out = toxicity_cf.held_out(F.col("doc_id"))
    model = toxicity_cf.train(docs.select("doc_id", "text"), labels.where(~out).select("doc_id", "toxic"))
    return toxicity_cf.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document by near duplicates at 0.8."""
    return prob_minhash.near_duplicate_classes(read(spark, sf_dir, "documents"))


def op5_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_consensus.extract(read(spark, sf_dir, "pages"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    q = quality_divergence.judge(docs, carry=["doc_id"])
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return q.select("doc_id", *[F.col("quality")[c].alias(c) for c in columns])


def op7_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items they hold."""
    return cgk_decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the
    written blocks."""
    return token_blocks.write_and_digest(read(spark, sf_dir, "documents"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of all documents, in shuffled order."""
    return poisson_mix.mix(read(spark, sf_dir, "documents"), detail=True)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op11_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector."""
    rows = walsh_clusters.with_inertia(walsh_clusters.cluster(read(spark, sf_dir, "embeddings")))
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_pii_deobfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, in the clear and under disguise."""
    found = pii_deobfuscate.scan_pii(read(spark, sf_dir, "documents"))

    def joined(hits: Column) -> Column:
        return F.array_join(F.transform(hits, lambda h: F.concat_ws(":", h["kind"], h["start"], h["end"])), ",")

    base = F.filter("hits", lambda h: h["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda h: h["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii_deobfuscate.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("hits")).alias("spans"),
    )


def newlines_deleted(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text without line ends where 2 divides crc32 of the id, else as it is."""
    even = F.coalesce(fold(F.col(doc_id), 2) == 0, F.lit(False))
    return F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, folded from a text that may be tampered with."""
    docs = read(spark, sf_dir, "documents")
    leaves = merkle_manifest.leaves_of(docs, tampered={"text": newlines_deleted()})
    found = merkle_manifest.proofs(merkle_manifest.build(leaves))
    return found.withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_ledger,
        op2_langid_ecoc,
        op3_toxicity_cf,
        op4_prob_minhash,
        op5_html_consensus,
        op6_quality_divergence,
        op7_cgk_decontamination,
        op8_token_blocks,
        op9_poisson_mix,
        op10_license_scan,
        op11_walsh_clusters,
        op12_pii_deobfuscate,
        op13_merkle_manifest,
    )
}
