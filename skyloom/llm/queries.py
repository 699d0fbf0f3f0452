"""The registered queries opN_<name> of the text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, cotraining, fingerprint, html_text, mixing, ngram_join, pii, prefix_trie, quality_rules, suffix_index, toxicity, url_filter, whitening
from skyloom.llm.oracle import ORACLE_SQL as ORACLE_SQL
from skyloom.session import materialize, table


def _ranks(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select("doc_id", "quality_score", "p_text", "p_meta", "kept")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, *_ranks()).select("doc_id", "ids")
    return bpe.decode(ids, *_ranks()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_sha256("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.with_next(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # texts are not written beside their spans, as nothing reads them there
    found = pii.detect(docs.select("doc_id", "text"), keep=["doc_id"]).select("doc_id", "base", "spans")
    counts = [F.size(F.filter("base", pii.of_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.classify(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = mixing.apply(docs, mixing.fit(docs))
    return found.select("doc_id", "n_tokens", F.round(F.array_max(F.map_values("posterior")), 9).alias("posterior"), "rate")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The rules of op6: (verdict, host and start of the path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    length = lambda total, s: total + s["end"] - s["start"]
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("repeats", F.lit(0).cast("long"), length).alias("n_removed"),
        F.size("repeats").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(prefix_trie.sequences(table(spark, sf_dir, "conversations")))
    conv = F.col("conv_id")
    rebuilt = prefix_trie.with_heads(found, conv - conv % 100, (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int"), 5)
    return prefix_trie.trie(rebuilt)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    found = materialize(whitening.whiten(vectors, model, keep=["vec_id"]))
    error = whitening.identity_error(found, model)
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained.cast("array<double>"), F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


QUERIES = {f.__name__: f for f in (op1_cotraining, op2_bpe, op3_html_text, op4_fingerprint, op5_pii, op6_url_filter, op7_ngram_join, op8_mixing, op9_toxicity, op10_quality_rules, op11_suffix_index, op12_prefix_trie, op13_whitening)}
