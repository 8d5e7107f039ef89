"""The operators applied to the driver tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (
    ann,
    decontaminate,
    html_text,
    merkle,
    minhash_dedup,
    mixing,
    oracles,
    pii,
    quality,
    secrets,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from panelkit.llm.common import sampled_texts, table

KEEP_SCORE = 0.3    # a document counts as the positive class from this score on
NEIGHBOURS = 20
QUERY_STEP = 20     # vectors whose id this divides are queries
PII_KEY = "change-me-per-corpus"  # the key of the pseudonyms; a secret in production
TOKENIZER = "byte_bpe_50k.json"   # of the public tokenizers
TOKEN_LIMIT = 512
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPER_EVERY = 5    # documents whose id's checksum this divides are checked against a changed text
MIX_TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}  # share of tokens by language


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    """Learnt from ``documents`` and ``labels`` outside the held-out fold."""
    return quality.fit(quality.labelled_texts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", 5, 0))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document; rows with a null id count as held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir), ["doc_id"])
    return scored.select("doc_id", F.coalesce(quality.remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op2_toxicity_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; rows with a null id count as held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(quality.labelled_texts(docs, table(spark, sf_dir, "labels"), "toxic", 4, 2,
                                              toxicity.TRAIN_ROWS))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", F.coalesce(quality.remainder("doc_id", 4) == 2, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal values replaced by keyed pseudonyms."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), ["doc_id"], PII_KEY)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (document, benchmark item) pairs that leak, with their evidence."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % QUERY_STEP == 0, NEIGHBOURS)


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged capture index of the archives written from all pages."""
    index = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "urlkey", "ts", "rank")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, domain) of a sample of the documents in the labelled table; the domain is the language."""
    marks = docs.select("doc_id", F.col("lang").alias("domain")).join(
        labels.select("doc_id").distinct(), "doc_id", "left_semi")
    return sampled_texts(docs, marks, mixing.LABELLED_ROWS)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling rate for every document, so that languages meet MIX_TARGETS."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, language_labels(docs, labels), MIX_TARGETS, ["doc_id"])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of ``documents`` with its commoner near word and the root of its variants."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"],
                                     public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof digest and check of every document; texts whose A-Z are lower-cased must fail it."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0, F.lit(False))
    return merkle.manifest(table(spark, sf_dir, "documents"), LEAF_COLUMNS, "source", "doc_id",
                           {"text": merkle.lower_ascii(F.col("text"))}, tampered)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_toxicity_classifier": op2_toxicity_classifier,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_secret_scan": op4_secret_scan,
    "op5_html_extraction": op5_html_extraction,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_warc_archive": op8_warc_archive,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_source_mixing": op10_source_mixing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_counts": op12_token_counts,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# The others need compression, decoding, learned models, keyed permutations, a
# tokenizer or approximate search, which SQL cannot express or cannot match
# row by row; tests/llm holds brute-force versions instead.
ORACLES: dict[str, str] = {
    "op8_warc_archive": oracles.ARCHIVE,
    "op9_minhash_dedup": oracles.NEAR_DUPLICATES,
    "op11_spelling_variants": oracles.SPELLING,
    "op13_merkle_manifest": oracles.MERKLE,
}
