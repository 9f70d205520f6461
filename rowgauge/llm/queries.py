"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgauge.session import scratch_path

from . import pii
from .bytepairs import encode_texts
from .chat import format_chat, read_turns, text_part, under_loss
from .codes import compress, hex_code
from .langid import held_out, identify, train
from .linededup import drop_common_lines
from .mixing import mix
from .neighbours import nearest
from .pieces import encode_pieces
from .sharding import shard_documents
from .simjoin import similar_documents
from .storage import settle
from .trie import conversation_trie
from .winnow import beside_next

SHARDS = 24
PROBE = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards near equal in bytes."""
    placed = shard_documents(
        table(spark, sf_dir, "documents"),
        SHARDS,
        scratch_path(spark, "slot-map"),
        lambda df: settle(df, "slotted"),
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op2_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], given.schema)
    messages = given.union(probe).withColumn("parts", text_part(F.col("text")))
    read = format_chat(messages).withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", under_loss(F.col("formatted"), F.col("loss_spans"))
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).withColumn("held_out", held_out(F.col("doc_id")))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return beside_next(table(spark, sf_dir, "documents")).drop("places")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its number of links."""
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


def piece_model() -> bytes:
    """The vocabulary file, read once on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    found = encode_pieces(table(spark, sf_dir, "documents"), piece_model(), decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the kinds' counts are those of the base spans, as the digest is."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train(docs)).withColumn("every", F.concat("base", "added"))

    def of(kind, spans="every"):
        return F.sort_array(F.filter(spans, lambda s: s["kind"] == kind))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of(kind, "base")).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined(F.flatten(F.array(*[of(kind) for kind in pii.KINDS]))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten or more of them hold."""
    found = drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


#: The domains of the labels, and the share of the tokens that each is to have.
MIX = {"clean": 0.95, "poor": 0.05, "toxic": 0.0}


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, domain``: toxic, or else of good or poor quality."""
    named = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")
    return table(spark, sf_dir, "labels").select("doc_id", named.alias("domain"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of every document for the wanted mix of domains."""
    return mix(table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), MIX).drop("key")


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared and every own prefix of all conversations, rebuilt with shared starts."""
    return conversation_trie(table(spark, sf_dir, "conversations"), share=True)


def byte_ranks() -> tuple[bytes, str]:
    """The vocabulary file, read once on the driver, and the pattern that splits texts."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to byte-level tokens and decoded."""
    found = encode_texts(table(spark, sf_dir, "documents"), *byte_ranks(), decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, and what it loses."""
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"),
        hex_code(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books and books.sha256()).cast("string").alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_chat_parts": op2_chat_parts,
    "op3_language": op3_language,
    "op4_winnowing": op4_winnowing,
    "op5_jaccard": op5_jaccard,
    "op6_pieces": op6_pieces,
    "op7_pii": op7_pii,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_forest": op10_forest,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_vector_codes": op13_vector_codes,
}
