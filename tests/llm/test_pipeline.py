"""Each stage of the pipeline, on what the stage before it kept, against plain Python or SQL."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import public_tokenizers
from oracle import connection
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import bpe, cotraining, mixing, pii
from skyloom.llm.oracle import NGRAM_JOIN
from skyloom.session import table


def _rows(df):
    return {(r.doc_id, r.text): r for r in df.collect()}


def _redacted(text: str, spans: str) -> str:
    """text with each run of overlapping spans replaced by the first one's kind."""
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in spans.split(",") if s):
        if int(start) >= at:
            out.append(text[at : int(start)] + f"[{kind.upper()}]")
        at = max(at, int(end))
    return "".join([*out, text[at:]])


def test_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    before, steps = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, before, sf_dir).write.parquet(path)
        steps[name] = (before, spark.read.parquet(path))
        before = steps[name][1]
        assert before.columns[: len(columns)] == columns

    given, kept = steps["quality_classifier"]
    model = cotraining.fit(given, table(spark, sf_dir, "labels"))
    good = cotraining.score(given, model).where("quality_score >= 0.4")
    assert _rows(kept) == _rows(good.select(columns))
    assert 0 < kept.count() < given.count()

    given, kept = steps["ngram_jaccard_join"]
    folder = tmp_path / "joined"
    given.write.parquet(str(folder / "documents.parquet"))
    classes = defaultdict(set)
    for doc_id, class_id, _ in connection(str(folder), ["documents"]).execute(NGRAM_JOIN).fetchall():
        classes[class_id].add(doc_id)
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(min(members) for members in classes.values())
    assert len(ids) < given.count()

    given, clean = steps["pii"]
    spans = {r.doc_id: (r.text, r.s) for r in pii.find(given, pii.fit(given)).select("doc_id", "text", pii.listed(F.col("spans")).alias("s")).collect()}
    found = {r.doc_id: r for r in clean.collect()}
    assert found.keys() == spans.keys() and any(s for _, s in spans.values())
    for doc_id, (text, s) in spans.items():
        assert found[doc_id].text == _redacted(text, s)
        assert found[doc_id].n_chars == len(found[doc_id].text)
        assert not re.search(r"[a-z]@[a-z]+\.[a-z]", found[doc_id].text)

    given, mixed = steps["mixing"]
    copies = Counter(r.doc_id for r in mixed.collect())
    for r in mixing.apply(given, mixing.fit(given)).select("doc_id", "rate").collect():
        assert math.floor(r.rate) <= copies[r.doc_id] <= math.ceil(r.rate)
        assert copies[r.doc_id] >= 1
    assert _rows(mixed) == _rows(given)

    given, encoded = steps["byte_bpe"]
    encoder = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert encoded.count() == given.count() and encoded.columns == [*columns, "ids", "n_tokens", "round_trip"]
    for r in encoded.collect():
        assert list(r.ids) == encoder.encode_ordinary(r.text) and r.n_tokens == len(r.ids)
        assert encoder.decode(r.ids) == r.text
