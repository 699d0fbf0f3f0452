"""The toxicity features by plain loops, one round of co-training by hand, and furniture by compound names."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from skyloom.llm import cotraining, html_text, toxicity


def _plain(text: str, lexicon: tuple[str, ...]) -> list[float]:
    """The features word by word, from their definitions."""
    if not text:
        return [0.0] * len(toxicity.NAMES)
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum() or c == "_":
            word += c
        elif word:
            words.append(word)
            word = ""
    n = max(1, len(words))
    hit = [any(w.startswith(t[:-1]) if t.endswith("-") else w == t for t in lexicon) for w in words]
    near = 0
    for i, h in enumerate(hit):
        around = [w for j, w in enumerate(words) if j != i and abs(i - j) <= toxicity.NEAR]
        near += h and any(w in toxicity.SECOND_PERSON for w in around)
    insults = sum(w in toxicity.INSULTS for w in words)
    return [
        100 * sum(hit) / n, math.log1p(sum(hit)), len({w for w, h in zip(words, hit) if h}), 100 * insults / n, None,
        100 * near / n, 100 * sum(w in toxicity.SECOND_PERSON for w in words) / n,
        sum(c.isupper() for c in text) / len(text), text.count("!") / len(text), text.count("?") / len(text),
        sum(c in ".,;:!?'\"()-" for c in text) / len(text), None, math.log1p(len(words)),
    ]


def test_features_of_random_texts():
    rng = random.Random(3)
    lexicon = ("idiot", "loser", "tra-", "fool")
    words = ["you", "idiot", "loser", "train", "trash", "tree", "YOUR", "fool", "foolish", "a", "Stupid", "te", "--", "x!", "no?"]
    texts = ["", " ", "idiot idiot idiot idiot", "you you you idiot"] + [rng.choice((" ", "\n", ", ")).join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(300)]
    for text in texts:
        for name, got, want in zip(toxicity.NAMES, toxicity.features(text, lexicon), _plain(text, lexicon), strict=True):
            assert want is None or got == pytest.approx(want), (name, text)


def test_neighbours_count_each():
    found = dict(zip(toxicity.NAMES, toxicity.features("idiot idiot idiot idiot you you", ("idiot",)), strict=True))
    assert found["insults_per_100"] == pytest.approx(100 * 4 / 6) and found["second_person_per_100"] == pytest.approx(100 * 2 / 6)
    odd = dict(zip(toxicity.NAMES, toxicity.features("you 1d1ot and i.d.i.o.t, fine", ("idiot",)), strict=True))
    assert odd["leet_hits"] == 2 and odd["obfuscated"] > 0


def test_a_round_of_pseudo_labels(spark):
    """Each view learns from its own labelled rows and from what the other one is sure of, at a lower weight."""
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(400):
        good = rng.random() < 0.5
        text = " ".join(rng.choices(["river", "house", "green", "walks", "reads"], k=30)) + "." if good else " ".join(rng.choices(["$$$", "##", "WIN", "888", "|||"], k=30))
        rows.append((i, text, "en", "books" if good else "spam", len(text)))
        if i < 120:
            marks.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = cotraining.fit(docs, labels, rounds=1)
    check = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    views = cotraining._views(docs).join(labels.withColumnRenamed("quality", "y"), "doc_id", "left").cache()
    known = views.where(F.col("y").isNotNull() & ~check).select("__t", "__m", F.col("y").cast("double").alias("y"), F.lit(1.0).alias("w"))
    meta = cotraining._fit(known, "__m")
    sure = [(r.doc_id, p) for r in views.where("y is null").select("doc_id", "__m").collect() if not 0.05 < (p := float(meta.predictProbability(r["__m"])[1])) < 0.95]
    assert sure
    guessed = spark.createDataFrame([(i, float(p > 0.5)) for i, p in sure], "doc_id long, guess double")
    more = views.drop("y").join(guessed, "doc_id").select("__t", "__m", F.col("guess").alias("y"), F.lit(cotraining.PSEUDO_WEIGHT).alias("w"))
    text = cotraining._fit(known.union(more), "__t")
    assert model.text.intercept == pytest.approx(text.intercept, abs=1e-3)
    assert list(model.text.coefficients) == pytest.approx(list(text.coefficients), abs=1e-3)
    # the calibration sees labelled rows that neither view was fitted on, and nothing else
    checked = cotraining._combined(cotraining._p(cotraining._p(views.where(F.col("y").isNotNull() & check), model.text, "__t", "__pt"), model.meta, "__m", "__pm"))
    both = cotraining._fit(checked.select("__b", F.col("y").cast("double").alias("y"), F.lit(1.0).alias("w")), "__b", regParam=1e-2)
    assert list(model.both.coefficients) == pytest.approx(list(both.coefficients), abs=1e-3)


ARTICLE = "".join(f"<p>Paragraph {i} of the story, with words enough to be a paragraph of its own.</p>" for i in range(4))


@pytest.mark.parametrize("name", ["commentlist", "cookiebar", "user-comments", "reader-comments", "siteNotice", "commentThread", "replylist"])
def test_furniture_by_compound_names(name):
    away = "".join(f"<div>Somebody {i} wrote that this is a very long remark about the story, longer than the story.</div>" for i in range(12))
    page = f'<body><div class="story"><h1>Title</h1>{ARTICLE}</div><div class="{name}">{away if "omment" in name or "repl" in name else "We use cookies here."}</div></body>'
    text = html_text.main_text(page)
    assert "Title" in text and "Paragraph 3" in text
    assert "Somebody" not in text and "cookies" not in text


@pytest.mark.parametrize("name", ["comments-open", "has-comments", "address", "advance", "formation", "shareholders"])
def test_names_that_only_sound_like_furniture(name):
    assert "Paragraph 2" in html_text.main_text(f'<body><div>Short line outside.</div><div class="{name}">{ARTICLE}</div></body>')


def test_forms_of_the_layout():
    """A form around the page is one of the layout, one beside the article is furniture; a titled discussion is the text."""
    assert "Paragraph 3" in html_text.main_text(f'<body><form id="aspnetForm"><div><h1>Title</h1>{ARTICLE}</div></form></body>')
    text = html_text.main_text(f"<body><div>{ARTICLE}</div><form><label>Your name please</label><p>Subscribe to our letter</p></form></body>")
    assert "Paragraph 0" in text and "Subscribe" not in text
    assert "Paragraph 1" in html_text.main_text(f'<body><p>Menu of the forum</p><div class="comment-page"><h1>Thread</h1>{ARTICLE}</div></body>')
