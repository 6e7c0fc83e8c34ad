"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_root, scratch_folder
from .common import ascii_lower, table
from .exact_dedup import exact_dedup
from .importance import importance_ranks
from .licences import scan_licences
from .line_dedup import dedup_lines
from .merkle import fold, leaf_digest, merkle_manifest, proof_digest
from .mixing import mix_to_weights
from .near_dedup import near_dedup
from .pii import pseudonymise
from .quality import quality_verdicts
from .secret_scan import scan_secrets
from .sentencepiece_codec import token_digests
from .shard import write_shards, written_shards
from .url_filter import judge_urls

TOKENIZER = "piece_bpe_32k.model"
# a key for tests over made-up data; a real one is a secret of the caller's
PSEUDONYM_KEY = "test key, known to all"

# (verdict, host, path)
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts without covered lines, and what was removed: the number of
    lines, and the intervals as first-last, comma-joined."""
    cut = F.array_join(F.transform("cut", lambda x: F.concat_ws("-", x["s"], x["e"])), ",")
    return (dedup_lines(table(spark, sf_dir, "documents"))
            .select("doc_id", "text", "n_lines", "n_removed", F.coalesce(cut, F.lit("")).alias("removed")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards are written; the rows are what the written shards hold."""
    ensure_checkpoint_root(spark)
    path, docs = scratch_folder(spark, "shards"), table(spark, sf_dir, "documents")
    write_shards(docs, path)
    return written_shards(spark, path, docs.schema)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_weights(table(spark, sf_dir, "documents")).drop("rid")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")

    base = F.filter("places", lambda p: p["exact"])
    return (scan_licences(table(spark, sf_dir, "documents")).withColumn("base", base)
            .select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(F.col("base.first")).alias("first_word"),
                    F.array_max(F.col("base.first")).alias("last_word"),
                    labels(F.col("base")).alias("base_labels"), labels(F.col("places")).alias("labels"),
                    F.coalesce(F.array_max(F.col("places.share")), F.lit(0.0)).alias("score")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every proof, and the root it gives for the stored row. Where 5 divides the
    checksum of the id, the row is tampered with: its text has lost its capitals."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(F.col("text").isNotNull(), ascii_lower(F.col("text")))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    manifest = merkle_manifest(docs, also={"changed": F.when(tampered, leaf_digest([*fields, text]))})
    folded = fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return (manifest.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                            folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_quality_rules, op3_url_filter, op4_line_dedup, op5_minhash_near_dedup,
    op6_sentencepiece, op7_pii, op8_sharding, op9_mixing, op10_secret_scan,
    op11_license_scan, op12_merkle_manifest, op13_importance_resampling)}
