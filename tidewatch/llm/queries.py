"""The registered queries of the operators: thin calls with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    bpe,
    html_text,
    language_model,
    line_dedup,
    merkle,
    mixing,
    pivots,
    preferences,
    quality,
    ranked_search,
    simhash,
    subwords,
    token_files,
    winnow,
)
from tidewatch.llm.common import held_out, lower_ascii, table
from tidewatch.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query

# A dominant source at a quarter of its natural share, two sources twice as often as the others.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0}


@_register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in shuffled order, each as often as its source's rate says."""
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS)


@_register
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate class of every vector."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@_register
def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with another one's last answer."""
    conversations = table(spark, sf_dir, "conversations")
    pairs = preferences.format_preferences(
        conversations, preferences.swapped_answers(conversations), pair="conv_id"
    )
    return pairs.select(
        "conv_id",
        "n_prompt_turns",
        "prompt",
        preferences.completion(F.col("chosen")).alias("chosen"),
        preferences.mask(F.col("chosen")).alias("chosen_mask"),
        preferences.completion(F.col("rejected")).alias("rejected"),
        preferences.mask(F.col("rejected")).alias("rejected_mask"),
    )


@_register
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def line_index(spark: SparkSession, documents: DataFrame) -> line_dedup.LineIndex:
    """An empty index with about a million line keys per shard for these documents."""
    shards = 8 + documents.count() // 50_000
    return line_dedup.LineIndex(spark, work_dir(spark, "lines"), shards)


@_register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication leaves of every document, as digests."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = line_index(spark, documents)
    index.insert(documents)
    return index.clean(documents).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@_register
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; every seventh is never learned from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.train_and_score(documents, order=3)


@_register
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document."""
    return winnow.compare_with_next(table(spark, sf_dir, "documents"))


@_register
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_register
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(documents, shingle=3, max_bits=2, seed=42)


@_register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; labels of every fifth one are never learned from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    return quality.score(documents, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted"
    )


@_register
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return ranked_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20
    )


@_register
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest by language; every third one's text is tampered with."""
    documents = table(spark, sf_dir, "documents")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(
        held_out(F.col("doc_id"), 3, 0), merkle.leaf_digest(*fields, lower_ascii(F.col("text")))
    )
    leaf = merkle.leaf_digest(*fields, F.col("text"))
    manifest = merkle.build(documents, "doc_id", "lang", leaf, claimed=tampered)
    return merkle.climb(manifest).select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@_register
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids as read back from files of Huffman-coded blocks."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = work_dir(spark, "token-files")
    definition = subwords.load(public_tokenizers.path(WORD_VOCABULARY))
    token_files.write(documents, folder, definition, end=END_ID)
    return token_files.read(spark, folder).select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
