"""Results against brute force, exact round trips and held-out labels."""

from __future__ import annotations

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from skyloom.llm import bpe, fingerprint, html_text, mixing, ngram_join, pii, quality_rules, url_filter
from skyloom.llm.queries import QUERIES, URL_RULES
from skyloom.session import table

MID = "/root/testdata/sf0.01"


def test_bpe_is_tiktoken_and_round_trips(spark, sf_dir):
    encoder = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in QUERIES["op2_bpe"](spark, sf_dir).collect():
        ids = encoder.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pieces_do_not_change_ids():
    encoder = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(3)
    parts = ["a", "'s", "'", "ll", "5", " ", "  ", "\n", "\t", "é", "!", "\x1c", "\xa0", "\u2003", "中", "'re", "\r\n", "_"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(150))
        assert sum((encoder.encode_ordinary(p) for p in bpe.pieces(text, 7)), []) == encoder.encode_ordinary(text)


def test_main_text(spark, sf_dir):
    for r in html_text.extract(table(spark, sf_dir, "pages")).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?p>|</?h1>", article))
        assert r.text == "\n".join(b for b in blocks if b)


def test_main_text_of_other_layouts():
    long = "This is a paragraph of running text that says a little more than a menu does. " * 3
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><div id="sidebar"><p>{long}</p></div>
    <ul class="menu"><li><a href="/">Home</a><li><a href="/b">Blog</a></ul><h2>Head &amp; line</h2><p>{long}<p>A <i>sh</i>ort&nbsp;one.<div class='cookie-notice'>We use cookies</div>
    <form><p>Name</p></form><p>{long}</p><section class="comments"><p>{long}</p></section><footer>&copy; me</footer><script>"<p>no</p>"</script></body>"""
    one = re.sub(r"\s+", " ", long).strip()
    assert html_text.main_text(page) == f"Head & line\n{one}\nA short one.\n{one}"
    marked = "<nav><a href=x>A<article><header><h1>T</h1></header><p>x</p><aside>ad</aside><p>y<br>z</p></article><p>out</p>"
    assert html_text.main_text(marked) == "T\nx\ny z"
    assert html_text.main_text(None) == html_text.main_text("") == ""


@pytest.mark.parametrize("rows_a_bucket", [17, 100_000])
def test_neighbours(spark, sf_dir, rows_a_bucket):
    docs = table(spark, sf_dir, "documents")
    ordered = sorted(docs.select("doc_id", "text").collect(), key=lambda r: -r.doc_id)
    found = {r.id: r for r in fingerprint.with_next(docs, rows_a_bucket=rows_a_bucket).collect()}
    assert len(found) == len(ordered)
    for i, row in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)].text
        half = len(row.text) // 2
        r = found[row.doc_id]
        assert r.edited_text == row.text[: len(row.text) - half] + after[:half]
        assert r.fingerprint == fingerprint.digest(row.text.encode())
        assert r.near_next == fingerprint.likeness(r.fingerprint, fingerprint.digest(after.encode()))
        assert 0 <= r.near_edited <= 1
    near = [r.near_edited > r.near_next for r in found.values()]
    assert np.mean(near) > 0.95


_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def _base(text: str) -> str:
    found = []
    for order, (kind, pattern) in enumerate(_BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15}
            if good[kind]:
                found.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_personal_data(spark):
    rng = random.Random(5)
    parts = ["a", "@", ".", "-", "b.com", "1", "23", "255", "256", "+", "+49 ", " ", "(", ")", "4111 1111 1111 1111", "é", "%", "_", "\n", "00.", "12345678901234"]
    odd = ["".join(rng.choice(parts) for _ in range(40)) for _ in range(400)]
    odd += ["mail bob (at) example (dot) com", "call 555-123-4567 now", "a." * 3000 + "b@" + "c." * 3000 + "d", "1" * 30_000]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").union(table(spark, MID, "documents").selectExpr("-1 - doc_id", "text"))
    found = pii.find(docs, pii.fit(docs))
    rows = found.select("doc_id", "text", pii.listed(found["base"]).alias("b"), pii.listed(found["spans"]).alias("s"), pii.redact(found["text"], found["spans"]).alias("clean")).collect()
    for r in rows:
        assert r.b == _base(r.text), r.text
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))
    by = {r.text: r for r in rows}
    assert by["mail bob (at) example (dot) com"].clean == "mail [EMAIL]"
    assert by["call 555-123-4567 now"].clean == "call [PHONE] now"


def test_url_parts_and_rules(spark):
    urls = {
        "https://WWW.Example.com/en/x?q": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://a.example.com/de/": ("a.example.com", "/de/", "com/", "allow"),
        "http://x.net/es/1#y": ("x.net", "/es/1", "net/es/", "block"),
        "http://com?x": ("com", "", None, None),
        "a/b://h": ("h", "", None, None),
        "nothing": ("", "", None, None),
        "https://free-bets.example.net/en/": ("free-bets.example.net", "/en/", None, "block"),
        "https://library.example.net/en/": ("library.example.net", "/en/", None, "allow"),
    }
    rows = url_filter.judge(spark.createDataFrame([(u,) for u in urls], "url string"), URL_RULES).collect()
    for r in rows:
        host, path, rule, verdict = urls[r.url]
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert verdict in (None, r.verdict), r.url


def _shingles(text: str) -> frozenset:
    words = text.split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.mark.parametrize("width", [2, 256])
def test_join_is_exact(spark, width):
    docs = table(spark, MID, "documents").select("doc_id", "text").where("doc_id < 500")
    base = "one two three four five six seven eight nine ten eleven twelve".split()
    near = [(10_000 + i, " ".join([*base * 4, "tail", str(i % 7)])) for i in range(12)]
    docs = docs.union(spark.createDataFrame(near, "doc_id long, text string"))
    rows = [(r.doc_id, _shingles(r.text)) for r in docs.collect()]
    owners = defaultdict(list)
    for i, (_, s) in enumerate(rows):
        for x in s:
            owners[x].append(i)
    links, parent = Counter(), list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, s) in enumerate(rows):
        for j, k in Counter(j for x in s for j in owners[x] if j > i).items():
            if k >= 0.8 * (len(s) + len(rows[j][1]) - k):
                links.update((i, j))
                parent[max(top(i), top(j))] = min(top(i), top(j))
    family = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        family[top(i)].append(doc_id)
    expected = {doc_id: (min(family[top(i)]), links[i]) for i, (doc_id, _) in enumerate(rows)}
    found = ngram_join.classify(docs, width=width).collect()
    assert {r.id: (r.class_id, r.n_links) for r in found} == expected
    assert sum(r.keeper for r in found) == len(family)


def test_pruning_limits_keep_similar_pairs():
    rng = np.random.default_rng(1)
    matches = rng.random((20_000, ngram_join.HASHES)) < 0.8
    for n, least in ngram_join.least_matches():
        assert (matches[:, :n].sum(1) >= least).all()


def test_mixing_meets_targets(spark):
    docs = table(spark, MID, "documents")
    targets = {"en": 200_000.0, "fr": 150_000.0, "de": 100_000.0, "es": 120_000.0}
    for how in ({}, {"targets": targets}):
        model = mixing.fit(docs, **how)
        assert np.allclose(model.expected, model.targets, rtol=2e-3)
        rows = mixing.apply(docs, model).collect()
        assert all(r.rate >= 0 for r in rows)
        assert np.mean([max(r.posterior, key=r.posterior.get) == r.lang for r in rows]) > 0.98
        for i, d in enumerate(model.domains):
            assert np.isclose(sum(r.rate * r.n_tokens * r.posterior[d] for r in rows), model.targets[i], rtol=2e-3)
    assert min(r.rate for r in mixing.apply(docs, mixing.fit(docs)).collect()) >= 1 - 1e-9


def test_toxicity_held_out(spark):
    """On the largest of the small tables, which has enough toxic texts of each language to learn from."""
    large = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, large, "labels").collect()}
    rows = [r for r in QUERIES["op9_toxicity"](spark, large).collect() if r.held_out and r.doc_id in labels]
    toxic, clean = ([r.predicted for r in rows if labels[r.doc_id] == y] for y in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


def test_quality_views(spark):
    labels = {r.doc_id: r.quality for r in table(spark, MID, "labels").collect()}
    rows = [r for r in QUERIES["op1_cotraining"](spark, MID).collect() if r.doc_id in labels]
    assert np.mean([r.kept for r in rows if labels[r.doc_id]]) > 0.99
    assert np.mean([r.kept for r in rows if not labels[r.doc_id]]) < 0.2


def _counts(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    odd = ["", " \t\n", "a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h i", "x\n" * 30, "a " * 40, "a\x0bb\x1cc\xa0d", "# * |\n\n # * |"]
    docs = table(spark, MID, "documents").select("doc_id", "text", "lang").union(spark.createDataFrame([(-i, t, "en") for i, t in enumerate(odd)], "doc_id long, text string, lang string"))
    labels = {r.doc_id: r.quality for r in table(spark, MID, "labels").collect()}
    rows = quality_rules.judge(docs).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _counts(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert np.mean([r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]) > 0.99
    assert np.mean([r.kept for r in rows if labels.get(r.doc_id) == 0]) < 0.25


def _wide_overlaps(base, wide):
    return [w for w in wide if not any(b[0] < w[2] and w[0] < b[2] for b in base)]


def test_pii_on_thousands_of_matches(spark):
    """Positions, overlaps and redaction by blocks, against plain Python, on texts of none to thousands of matches."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    made = ["a{0}@mail.com", "u{0}(at)d(dot)com", "+1 202 555 {0:04d}", "10.0.0.{0}", "4111 1111 1111 1111", "202-555-{0:04d}", "plain words é中\U0001f600", "x" * 900, "@", "1234567890123456{0}"]
    texts = [" ".join(rng.choice(made).format(rng.randrange(10_000)) for _ in range(n)) for n in (0, 1, 2, 31, 32, 33, 64, 1025, 4000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii._candidates(frame, F.col("text")).select("doc_id", "__base", "__wide")
    spans = lambda kind, patterns: pii._spans(F.col("text"), kind, patterns)
    raw = {r.doc_id: r for r in frame.select("doc_id", *(spans(k, pii.WIDE).alias(f"w_{k}") for k in pii.KINDS)).collect()}
    for r in found.collect():
        for kind in pii.KINDS:
            for s in raw[r.doc_id][f"w_{kind}"]:
                assert texts[r.doc_id][s.start : s.end] == s.match and texts[r.doc_id][max(0, s.start - 30) : s.start].endswith(s.before) and texts[r.doc_id][s.end : s.end + 1] == s.after
        base = [(b.start, b.kind, b.end) for b in r["__base"]]
        wide = sorted((s.start, i, s.end) for i, k in enumerate(pii.KINDS) for s in raw[r.doc_id][f"w_{k}"])
        assert [(w.start, w.kind, w.end) for w in r["__wide"]] == _wide_overlaps(base, wide)
    model = pii.fit(frame)
    for r in pii.find(frame, model).withColumn("clean", pii.redact(F.col("text"), F.col("spans"))).collect():
        out, at = "", 0
        for s in r.spans:
            if s.start >= at:
                out += texts[r.doc_id][at : s.start] + f"[{pii.KINDS[s.kind].upper()}]"
            at = max(at, s.end)
        assert r.clean == out + texts[r.doc_id][at:]
