"""The registered queries of the training-data operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, class_lm, fingerprint, jaccard, langid, linedup, mixing, oracles, packing, prefix_trie, secrets, token_counts, vector_codes, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op2_mixing(spark, sf_dir):
    return mixing.mixture_by_document(_table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_jaccard(spark, sf_dir):
    return jaccard.similar_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_secrets(spark, sf_dir):
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans_base").cast("binary"), 256).alias("base_sha256"), "spans", "oversize_layers")


def op6_fingerprint(spark, sf_dir):
    return fingerprint.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op7_linedup(spark, sf_dir):
    return linedup.drop_repeated_lines(_table(spark, sf_dir, "documents"), counts=True).select("doc_id", "n_lines", "n_removed", "text")


def op8_langid(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.filter("not held_out"))
    return langid.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def op9_ann(spark, sf_dir):
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark, sf_dir):
    return token_counts.context_table(token_counts.length_histogram(_table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_class_lm(spark, sf_dir):
    return class_lm.score_texts(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_mixing, op3_packing, op4_jaccard, op5_secrets, op6_fingerprint, op7_linedup, op8_langid, op9_ann, op10_token_counts, op11_prefix_trie, op12_class_lm, op13_vector_codes)}

# The rows of the other queries depend on digests, encoders or trained models that SQL does not have, or on joins it
# cannot run over whole tables; tests hold each against brute force on small tables.
ORACLES: dict[str, str] = {"op11_prefix_trie": oracles.OP11, "op13_vector_codes": oracles.OP13}
