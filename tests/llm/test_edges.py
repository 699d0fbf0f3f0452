"""Every operator on nulls, empty and long texts, repeats, empty tables and clashing names."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from skyloom.llm import bpe, cotraining, fingerprint, html_text, mixing, ngram_join, pii, quality_rules, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, n string, label string, x int, kept string, rate string, ids string, spans string, host string, score string, root int, m int, w int, sig string"
LONG = "word 4111111111111111 a@b.com idiot " * 6000
ROWS = [
    (1, "the same text of more than five words here", "en", "s", 42),
    (1, "the same text of more than five words here", "en", "s", 42),
    (2, "the same text of more than five words here", None, None, None),
    (3, None, "en", "s", 0),
    (4, "", "fr", "t", 0),
    (5, " \n\t ", "fr", "t", 4),
    (None, "le chat de la maison est dans le jardin avec une souris", "fr", "t", 9),
    (None, None, None, None, None),
    (6, LONG, "en", "s", len(LONG)),
    (7, "x" * 50_000, "en", "s", 50_000),
    (9, " " * 1_200_000, "en", "s", 1_200_000),
    (10, "\n" * 1_200_000 + "end", "en", "s", 1_200_003),
    (8, "中文 emoji 😀 \x00 nul   sep <|endoftext|>", "zz", "u", 7),
]
LABELS = [(1, 1, 0), (2, 0, 1), (6, 0, 1), (None, 1, 1), (7, None, None), (8, 1, 0), (4, 1, 0), (99, 1, 1), (1, 1, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    rest = (0, "n", "l", 5, "k", "r", "i", "s", "h", "c", 3, 4, 5, "g")
    return spark.createDataFrame([(*r, *rest) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def _tokenizer():
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _operators(labels):
    return {
        "cotraining": lambda d: cotraining.score(d, cotraining.fit(d, labels)),
        "bpe": lambda d: bpe.decode(bpe.encode(d, *_tokenizer()), *_tokenizer()),
        "html": lambda d: html_text.extract(d, "text", "n"),
        "fingerprint": lambda d: fingerprint.fingerprint(d),
        "next": lambda d: fingerprint.with_next(d),
        "pii": lambda d: pii.find(d, pii.fit(d)),
        "url": lambda d: url_filter.judge(d, [("block", "com/")], "text"),
        "join": lambda d: ngram_join.classify(d),
        "mixing": lambda d: mixing.apply(d, mixing.fit(d)),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "rules": lambda d: quality_rules.judge(d),
    }


@pytest.mark.parametrize("name", list(_operators(None)))
def test_edges(docs, labels, name):
    rows = _operators(labels)[name](docs).collect()
    assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", list(_operators(None)))
def test_empty_tables(docs, labels, name):
    assert _operators(labels.limit(0))[name](docs.limit(0)).collect() == []


def test_no_labels(docs, labels):
    assert {r.quality_score for r in cotraining.score(docs, cotraining.fit(docs, labels.limit(0))).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


def test_clashing_names_of_scores_and_rules(docs, labels):
    """Columns named like a result are replaced by it, others named like an intermediate one stay."""
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars", *(F.lit("mine").alias(c) for c in ("N_words", "kept", "js_chars", "pt", "pm", "quality_score")))
    judged = quality_rules.judge(odd)
    assert judged.columns == ["doc_id", "text", "lang", "source", "n_chars", "pt", "pm", "quality_score", *quality_rules.RESULTS]
    plain = quality_rules.judge(docs.select("doc_id", "text", "lang"))
    assert sorted(map(str, judged.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    scored = cotraining.score(odd, cotraining.fit(odd, labels))
    assert {(r.pt, r.pm) for r in scored.select("pt", "pm").collect()} == {("mine", "mine")}
    assert dict(scored.dtypes)["quality_score"] == "double" and dict(scored.dtypes)["kept"] == "boolean"


def test_join_of_edges(docs):
    found = {(r.id, r.class_id, r.n_links, r.keeper) for r in ngram_join.classify(docs).collect()}
    assert (1, 1, 2, True) in found and (2, 1, 2, False) in found  # the repeated row and its copy
    assert (3, 3, 0, True) in found and (4, 4, 0, True) in found and (None, None, 0, True) in found
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "10", "None", "None"])


def test_mixing_keeps_every_document(docs):
    kept = mixing.repeat(mixing.apply(docs.select("doc_id", "text", "lang"), mixing.fit(docs)))
    assert kept.columns == ["doc_id", "text", "lang"]
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in ROWS}


def test_pipeline_of_edges(spark, docs, labels, tmp_path):
    """Nulls, repeats, blanks and clashing names go through every stage; columns come out as they went in."""
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    before, texts = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, str(tmp_path))
        after.write.parquet(str(tmp_path / name))
        before = spark.read.parquet(str(tmp_path / name))
        assert set(docs.columns) <= set(before.columns)
        assert {r.rate for r in before.select("rate").distinct().collect()} <= {"r"}
        texts[name] = [(r.doc_id, r.text) for r in before.collect()]
    kept = {i for i, _ in texts["quality_classifier"]}
    # the repeated row and its copy have the same text, hence the same fate; of those kept one row stays
    assert texts["ngram_jaccard_join"].count((1, ROWS[0][1])) == (1 in kept)
    assert {i for i, _ in texts["ngram_jaccard_join"]} == kept - ({2} if 1 in kept else set())
    assert {i for i, _ in texts["mixing"]} == {i for i, _ in texts["pii"]} == {i for i, _ in texts["ngram_jaccard_join"]}
    assert not any(t and "4111111111111111" in t for _, t in texts["pii"])
    assert all(t is not None for i, t in texts["pii"] if i == 4)
    rows = before.select("text", F.size("ids").alias("n"), "round_trip").collect()
    assert all(r.round_trip for r in rows) and all(r.n == 0 for r in rows if not r.text)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_an_empty_table(spark, docs, labels, tmp_path, name):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), str(tmp_path)).collect() == []


def test_tied_rows_have_equal_results(docs, labels):
    """Rows that repeat a text get the same scores, fingerprints, spans and verdicts."""
    for name, columns in (("cotraining", ["quality_score"]), ("toxicity", ["score"]), ("fingerprint", ["fingerprint"]), ("pii", ["spans"]), ("mixing", ["rate"])):
        rows = _operators(labels)[name](docs.where("doc_id = 1")).select(*columns).collect()
        assert len(rows) == 2 and rows[0] == rows[1], name
