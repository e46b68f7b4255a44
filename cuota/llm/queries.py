"""One registered query per training-data operator, over the whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuota.llm.bpe import bpe_decode, bpe_encode, ids_sha256
from cuota.llm.exact_dedup import exact_dedup
from cuota.llm.filter_audit import audit_documents
from cuota.llm.langid import fit_languages, held_out, identify_languages
from cuota.llm.merkle import fold, leaf_digest, merkle_manifest, siblings
from cuota.llm.mixing import mix_sources
from cuota.llm.neighbours import near_vectors
from cuota.llm.packing import ids_crc32 as packed_crc32
from cuota.llm.packing import pack_documents
from cuota.llm.secrets import scan_secrets
from cuota.llm.simhash import simhash_groups
from cuota.llm.token_files import ids_crc32, read_token_files, write_token_files
from cuota.llm.word_pieces import count_pieces
from cuota.llm.warc import captures, read_records, write_archives
from cuota.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_language_id")
def _(spark, sf):
    documents = _table(spark, sf, "documents")
    model = fit_languages(documents, usable=~held_out())
    found = identify_languages(documents.select("doc_id", "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op2_exact_dedup")
def _(spark, sf):
    return exact_dedup(_table(spark, sf, "documents"), only_decisions=True)


@query("op3_warc_captures")
def _(spark, sf):
    folder = scratch_path(spark, "archives")
    write_archives(_table(spark, sf, "pages"), folder)
    found = captures(read_records(spark, folder))
    return found.select(F.col("metadata.page").cast("long").alias("page_id"),
                        F.col("response.bytes").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
                        F.col("response.record_type").alias("record_type"),
                        F.col("metadata.refers_to").cast("long").alias("refers_to"))


@query("op4_near_vectors")
def _(spark, sf):
    return near_vectors(_table(spark, sf, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query("op5_simhash_dedup")
def _(spark, sf):
    return simhash_groups(_table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op6_token_files")
def _(spark, sf):
    folder = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf, "documents"), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", ids_crc32("tokens").alias("ids_crc32"))


@query("op7_token_counts")
def _(spark, sf):
    return count_pieces(_table(spark, sf, "documents").select("doc_id", "text")).drop("text")


@query("op8_bpe_round_trip")
def _(spark, sf):
    encoded = bpe_encode(_table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "ids")
    return bpe_decode(encoded).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                      ids_sha256("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_secret_scan")
def _(spark, sf):
    found = scan_secrets(_table(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_owned", "n_live",
                        "n_example")


@query("op10_mix_sources")
def _(spark, sf):
    mixed = mix_sources(_table(spark, sf, "documents"), only_decisions=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op11_pack_documents")
def _(spark, sf):
    packed = pack_documents(_table(spark, sf, "documents"))
    return packed.select("doc_id", "start", "length", packed_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query("op12_filter_audit")
def _(spark, sf):
    return audit_documents(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query("op13_merkle_manifest")
def _(spark, sf):
    """Rows of every seventh checksum are tampered with: their leaf, remade from one character more, must not verify."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    columns = [F.col(c) for c in ("doc_id", "source", "lang")]
    tampered = F.when(hit, leaf_digest(*columns, F.col("n_chars") + 1, F.col("text")))
    proven = merkle_manifest(_table(spark, sf, "documents"), carry={"tampered": tampered})
    folded = proven.withColumn("folded_root", fold(F.col("sides"), F.coalesce("tampered", "leaf")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("sides")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
