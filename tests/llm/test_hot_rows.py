"""Repeated rows, whole regions and many domains, against known results."""

from __future__ import annotations

import numpy as np
import pytest

from skyloom.llm import fingerprint, html_text, mixing, ngram_join


@pytest.mark.parametrize("width", [2, 256])
def test_repeated_rows_with_near_copies(spark, width):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base)] * 6 + [(None, f"{base} tail")] * 5 + [(2, f"{base} other tail"), (2, f"{base} tail"), (3, "six quite different words stand here"), (3, "six quite different words stand here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = [(r.id, r.class_id, r.n_links, r.keeper) for r in ngram_join.classify(docs, width=width).collect()]
    # 13 rows are alike, each linked with the 12 others
    expected = [(1, 1, 12, True)] * 6 + [(None, 1, 12, False)] * 5 + [(2, 1, 12, False)] * 2 + [(3, 3, 1, True)] * 2
    assert sorted(found, key=str) == sorted(expected, key=str)
    kept = sorted(r.doc_id for r in ngram_join.keep_one(docs, width=width).collect())
    assert kept == [1, 3]


def test_verification_reads_a_repeated_text_once(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, base)] * 40 + [(7, f"{base} tail")], "doc_id long, text string").repartition(4)
    read = []
    verified = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda texts, *how: read.append(texts.count()) or verified(texts, *how))
    assert {(r.id, r.class_id, r.n_links) for r in ngram_join.classify(docs).collect()} == {(None, 7, 40), (7, 7, 40)}
    assert read == [2]


def test_line_lengths_choose_the_region_of_a_marked_page():
    long = "This is a paragraph of running text that says a little more than a menu does. " * 3
    links = "".join(f"<p><a href=/{i}>Read on about number {i}</a></p>" for i in range(4))
    page = f"<p>{long}</p><article><h1>Head</h1><p>Short.</p><p>{long}</p><p><a href=x>One link</a></p><p>End.</p>{links}</article><p>{long}</p>"
    assert html_text.main_text(page) == f"Head\nShort.\n{long.strip()}\nOne link\nEnd."
    assert html_text.main_text(f"<article>{links}<p>{long}</p></article>") == long.strip()


def test_lines_of_links_between_surge_and_dive_stay():
    long = "This is a paragraph of running text that says a little more than a menu does. " * 3
    assert html_text.main_text(f"<p>{long}</p><p><a href=x>One link</a></p><p>{long}</p>") == f"{long.strip()}\nOne link\n{long.strip()}"


def test_mixing_meets_targets_of_many_domains(spark):
    # each domain has its own letters; one document is far longer than the others
    words = [f"{chr(0x4E00 + 97 * d)}{chr(0x5E00 + 89 * d)}" for d in range(34)]
    rows = [(40 * d + i, " ".join([words[d]] * (20 + i)), f"d{d:02}") for d in range(34) for i in range(20)] + [(9_999, " ".join([words[0]] * 2000), "d00")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    have = {f"d{d:02}": sum(len(t.split()) for _, t, lang in rows if lang == f"d{d:02}") for d in range(34)}
    targets = {d: n * (0.7 + 0.05 * (i % 12)) for i, (d, n) in enumerate(have.items())}
    model = mixing.fit(docs, targets=targets)
    assert not model.missed
    assert np.allclose(model.expected, model.targets, rtol=5e-3)


def test_mixing_reports_missed_targets(spark):
    docs = spark.createDataFrame([(i, "some words of one language " * 5, "en") for i in range(20)], "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="out of reach"):
        model = mixing.fit(docs, targets={"en": 500.0, "zz": 300.0})
    assert "zz" in model.missed


@pytest.mark.parametrize("rows_a_bucket", [3, 10, 2_000])
def test_ids_that_hold_most_rows(spark, rows_a_bucket):
    shared = "the same opening words of many texts " * 10  # longer than the characters that deal rows
    rows = [(i, f"text number {i} of its own") for i in range(-20, 40, 3)]
    rows += [(None, f"{chr(97 + i % 26)} lost {i} {shared}") for i in range(50)] + [(None, None)] * 9 + [(None, "a row without an id")] * 30
    rows += [(7, f"{shared}{i * i % 17}") for i in range(40)] + [(2**60 + 1, "far out")] * 25 + [(-(2**63), "lowest")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # null ids are as the lowest id
    order = sorted(((-(2**63) if i is None else i, t or "", i) for i, t in rows), key=lambda r: (-r[0], r[1]))
    expected = []
    for at, (_, text, i) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        changed = fingerprint.edited(text, following)
        own, mark, beyond = (fingerprint.digest(t.encode()) for t in (text, changed, following))
        expected.append((i, len(text), own, changed, mark, fingerprint.likeness(own, mark), fingerprint.likeness(own, beyond)))
    found = [tuple(r) for r in fingerprint.with_next(docs, rows_a_bucket=rows_a_bucket).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_copies_of_one_row_are_shared_among_tasks(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "COPIES", 7)
    docs = spark.createDataFrame([(None, "one text that holds most rows")] * 100 + [(1, "another")], "doc_id long, text string")
    found = fingerprint.with_next(docs, rows_a_bucket=10).collect()
    assert len(found) == 101
    assert sum(r.near_next == 1 for r in found) == 99
