"""The queries of this subpackage, over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import alignment, chat, hosts, jaccard, language, merkle, mixing, neighbours, paragraphs, pii, sharding, templates, tokens
from tidewater.llm.common import sha256_hex
from tidewater.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


#: Folder of public tokenizer files, and the split pattern of the byte-level ones.
TOKENIZERS = "/opt/tokenizers"
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_ngram_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"), jaccard.Join(words=3, percent=90))


@query("op4_host_rules", hosts.HOST_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.document_rules(table(spark, sf_dir, "documents"))


#: Bytes of text in a shard; the given tables are small, so the limit is too.
SHARD_BYTES = 1 << 20


@query("op7_extendible_shards", sharding.shard_sql(SHARD_BYTES))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARD_BYTES).select("doc_id", "bytes", "shard", "page", "depth", "shard_bytes")


@query("op9_apportioned_mix", mixing.MIX_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2.0)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_language_mixture")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language.held_out(F.col("doc_id")).alias("held_out"))
    return language.identify(docs, language.fit(docs.filter("not held_out")), ("doc_id", "held_out"))


@query("op5_chat_layouts", chat.CHAT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql("select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')")
    records = chat.turn_records(rows.union(more))
    return chat.digests(chat.read_back(chat.formatted(chat.canonical_turns(records))))


@query("op8_template_leaks")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_personal_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.document_spans(table(spark, sf_dir, "documents"))


@query("op2_paragraph_repeats")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_line_tokens")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.attribute(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", PIECES)


@query("op11_merkle_manifest", merkle.MANIFEST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # One more than the greatest long is still a number.
    other = merkle.leaf("doc_id", "source", "lang", F.col("n_chars").cast("decimal(20,0)") + 1, "text")
    rows = docs.select("doc_id", "lang", merkle.leaf("doc_id", "source", "lang", "n_chars", "text").alias("leaf"), F.when(tampered, other).alias("tampered"))
    manifest = merkle.build(rows, "lang", ["doc_id"], "leaf", ["doc_id", "tampered"])
    return merkle.fold(manifest, "tampered").drop("tampered")


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = alignment.ByteLevel(f"{TOKENIZERS}/byte_bpe_50k.json", PIECES)
    aligned = alignment.align(docs, first, alignment.Pieces(f"{TOKENIZERS}/piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, sha256_hex(F.col("groups"))).otherwise("")
    aligned = written(aligned.select("*", digest.alias("groups_sha256"), F.monotonically_increasing_id().alias("row")).drop("groups"), "aligned")
    usual = alignment.usual_links(aligned, "row", alignment.pair_counts(aligned))
    rows = aligned.drop("pairs").join(usual, "row", "left").drop("row")
    return rows.fillna(0, ["n_best", "count_sum"])


@query("op13_cosine_neighbours", neighbours.NEAREST_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
