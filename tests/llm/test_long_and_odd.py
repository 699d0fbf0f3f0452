"""Pages without marks and long runs of blanks, against known texts and the plain tokenizer."""

from __future__ import annotations

import random
import time

import public_tokenizers
import pytest

from skyloom.llm import bpe
from skyloom.llm.html_text import main_text

LONG = "This is a paragraph of running text that says a little more than a menu does. " * 3
FURNITURE = (
    "<nav><ul>{links}</ul></nav>", '<div class="cookie-notice"><p>{text}</p></div>', '<div id="sidebar">{text}</div>', "<form><p>{text}</p></form>",
    "<footer><p>{text}</p></footer>", '<section class="comments"><p>{text}</p><p>{text}</p></section>', '<div class="ad-box">{text}</div>', "<aside>{text}</aside>",
)


def test_pages_without_marks():
    rng = random.Random(4)
    links = "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(5))
    for _ in range(200):
        blocks = ["Heading", *(rng.choice([LONG.strip(), "Short one.", "A & b <i>c</i>"]) for _ in range(rng.randint(1, 6))), LONG.strip()]
        body = "".join(f"<{t}>{b.replace(' & ', ' &amp; ')}" + f"</{t}>" * rng.randint(0, 1) for b, t in zip(blocks, ["h1"] + ["p"] * 9, strict=False)).replace("<h1>Heading<p>", "<h1>Heading</h1><p>")
        before, after = ("".join(f.format(text=LONG, links=links) for f in rng.sample(FURNITURE, 3)) for _ in "ab")
        expected = "\n".join(b.replace("<i>", "").replace("</i>", "") for b in blocks)
        assert main_text(f"<body class=has-sidebar>{before}<div class='layout with-sidebar'>{body}</div>{after}</body>") == expected


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<article class="post has-sidebar"><p>{LONG}</p></article>', LONG.strip()),
        (f'<article><p class="share">Share<p>{LONG}<p>End.</article>', f"{LONG.strip()}\nEnd."),
        ("<h1>A heading</h1><p>Short one.</p><p>Another.</p>", "A heading\nShort one.\nAnother."),
        ('<p>x <span class="ad">Ad</span> y</p>', "x y"),
        ("<form><p>Name</p></form>", ""),
    ],
)
def test_hints_do_not_silence_text(page, text):
    assert main_text(page) == text


def test_tags_that_never_close_take_linear_time():
    began = time.perf_counter()
    for part in ("<a ", "</ ", "<script ", '<a x="> ', "<!-- "):
        main_text(part * 300_000)
    assert time.perf_counter() - began < 20


def test_long_runs_of_blanks():
    encoder = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "é", " ", "\n", "5", "!", "'s", "\x1c", "\x85"]) + rng.choice([" ", "\t", "\n", "　", "\x85", "\xa0", " \n"]) * rng.choice([0, 1, 999, 1000, 1001, 1500]) for _ in range(rng.randint(0, 5)))
        assert bpe.encode_text(encoder, text).tolist() == encoder.encode_ordinary(text)
    for blank in (" ", "\n", "\t"):
        text = f"a{blank * 5_000_000}b"
        assert encoder.decode_bytes(bpe.encode_text(encoder, text)).decode() == text
