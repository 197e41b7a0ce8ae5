"""The corpus pipeline: stages applied to ``documents``, each written as Parquet and read again.

Every stage takes all rows its predecessor kept, and all but the last give back the columns of the
documents; each handles odd rows as its operator's docstring says.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, mixing, quality, simhash
from tidewatch.llm.common import prepare, stored, table
from tidewatch.llm.queries import VOCABULARY, WEIGHTS, line_index

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be of label 1."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the one of smallest id; ``n_chars`` follows the
    text. Documents stay even where nothing of them is left."""
    prepare(spark)
    index = line_index(spark, docs)
    index.insert(docs)
    return (
        index.clean(docs)
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        .select(*docs.columns)
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group: fingerprints of 3-word shingles at
    most 2 bits apart, or five-word shingles of a Jaccard similarity of 0.8 or more. All rows of
    that id stay, and rows without an id, as nothing names them."""
    prepare(spark)
    kept = (
        simhash.near_duplicates(docs, shingle=3, max_bits=2, similarity=0.8, words=5)
        .where("doc_id = component_id")
        .select("doc_id")
        .distinct()
        .withColumn("__kept", F.lit(True))
    )
    return docs.join(kept, "doc_id", "left").where("__kept OR doc_id IS NULL").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in shuffled order, each as often as its source's rate says."""
    prepare(spark)
    return mixing.mix(docs, WEIGHTS).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents, ``text`` as the ids decode, ``n_tokens`` and ``ids``."""
    prepare(spark)
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, ranks).withColumn("text", F.col("decoded").cast("string"))
    names = [name for name in docs.columns if name not in ("n_tokens", "ids")]
    return decoded.select(*names, F.size("ids").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

# A trained model, bit counts of hashes and merges of tokens are beyond SQL; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{position}")
    return docs
