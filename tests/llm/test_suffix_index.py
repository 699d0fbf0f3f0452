"""Operator 11 against a dictionary of all 200-byte strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from skyloom.llm import suffix_index
from skyloom.llm.queries import QUERIES
from skyloom.session import table

N = suffix_index.LENGTH


def _brute(texts: list[str | None]) -> list[list[tuple[int, int]]]:
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + N] for d in data for i in range(len(d) - N + 1))
    found = []
    for d in data:
        spans: list[list[int]] = []
        for i in range(len(d) - N + 1):
            if counts[d[i : i + N]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + N
                else:
                    spans.append([i, i + N])
        found.append([tuple(s) for s in spans])
    return found


def _check(spark, texts, batches=4, **extra):
    schema = "doc_id long, text string" + "".join(f", {c} string" for c in extra)
    frame = spark.createDataFrame([(i, t, *extra.values()) for i, t in enumerate(texts)], schema).repartition(3)
    rows = {r.doc_id: r for r in suffix_index.without_repeats(frame, batches=batches).collect()}
    assert len(rows) == len(texts)
    for i, spans in enumerate(_brute(texts)):
        assert [tuple(s) for s in rows[i].repeats] == spans, i
        data = (texts[i] or "").encode()
        cuts = [0, *(x for s in spans for x in s), len(data)]
        assert bytes(rows[i].kept) == b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
    return rows


def _words(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def _corpus(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    texts: list[str | None] = [_words(rng, rng.randrange(1, 400)) for _ in range(40)]
    passage = _words(rng, 60)
    for i in range(12):  # passages that begin and end in other places
        a, b = sorted(rng.sample(range(len(passage)), 2))
        texts.append(_words(rng, 30) + passage[a:b] + _words(rng, 50) + passage + _words(rng, 5))
    for _ in range(15):  # near copies
        words = texts[rng.randrange(40)].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    # repeats of 199, 200 and 201 bytes, and texts of those lengths
    for n in (N - 1, N, N + 1):
        texts += [_words(rng, 20) + ("|" + passage * 2)[:n] + str(k) * 40 for k in range(2)] + ["z%d" % n + "q" * (n - 4), "exact" + "é" * n]
    return [*texts, None, "", "short", texts[0], texts[3], texts[3]]


@pytest.mark.parametrize("seed,batches", [(0, 4), (1, 1), (2, 5)])
def test_brute_force(spark, seed, batches):
    _check(spark, _corpus(seed), batches)


def test_periodic_texts(spark):
    """Blanks, periods around the lengths, and a text that repeats itself."""
    rng = random.Random(5)
    texts = ["a" * 700, " " * 200, "ab" * 300, "abc" * 90 + "x" + "abc" * 90, _words(rng, 80) * 3, ("p" * 99 + "q") * 8, ("p" * 100 + "q") * 8, "r" * 199, "中文" * 150, "\x00" * 450]
    _check(spark, texts)


def test_hot_prefixes(spark, monkeypatch):
    """A passage with more surroundings than one task compares."""
    monkeypatch.setattr(suffix_index, "GROUP", 5)
    rng = random.Random(7)
    passage = _words(rng, 90)
    _check(spark, [_words(rng, 40) + passage[rng.randrange(40) :] + _words(rng, 40) for _ in range(30)] + [_words(rng, 200) for _ in range(10)])


def test_blocks(spark, monkeypatch):
    """Long texts are cut to blocks at which runs end."""
    monkeypatch.setattr(suffix_index, "BLOCK", 333)
    suffix_index._POWERS.clear()
    rng = random.Random(9)
    long = _words(rng, 1500)
    found = list(suffix_index.blocks(long.encode()))
    assert len(found) > 10 and sum(r.ends[-1] for _, r in found) == len(long) - N + 1
    _check(spark, [long, "shifted by some bytes " + long[50:], _words(rng, 900) + long[2000:2600]])
    suffix_index._POWERS.clear()


def test_levels_grow_geometrically(spark):
    family = suffix_index.Family(spark)
    sizes = []
    for i in range(7):
        rows = spark.createDataFrame([(k, k, k, False) for k in (i, i + 1, 100 + i)], "key long, low long, high long, many boolean")
        hits = family.add(rows)
        assert {r.key for r in hits.collect()} == ({i} if i else set())
        sizes.append([n for n, *_ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    family.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("skyloom_")]


def test_odd_rows(spark):
    rows = _check(spark, [None, "", "tiny", "x" * 300], repeats="r", kept="k", h="h", key="c", row="w", marks="m")
    assert rows[2].h == "h" and rows[2].row == "w" and rows[2].marks == "m"
    frame = spark.createDataFrame([(None, "y" * 250), (None, "y" * 250), (1, None)], "doc_id long, text string")
    assert sorted(len(r.repeats) for r in suffix_index.without_repeats(frame).collect()) == [0, 1, 1]
    assert suffix_index.without_repeats(frame.limit(0)).collect() == []


def test_very_long_text(spark):
    """Two megabytes of blanks, and a long text beside its copy."""
    rng = random.Random(3)
    long = _words(rng, 120_000)
    frame = spark.createDataFrame([(0, " " * 2_000_000), (1, long), (2, "once " + long)], "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.repeats] for r in suffix_index.without_repeats(frame).collect()}
    assert found == {0: [(0, 2_000_000)], 1: [(0, len(long))], 2: [(5, 5 + len(long))]}


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    spans = dict(zip(texts, _brute(list(texts.values())), strict=True))
    rows = QUERIES["op11_suffix_index"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(spans.values())
    for r in rows:
        data = texts[r.doc_id].encode()
        cuts = [0, *(x for s in spans[r.doc_id] for x in s), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(data), len(data) - len(kept), len(spans[r.doc_id]), hashlib.sha256(kept).hexdigest())
