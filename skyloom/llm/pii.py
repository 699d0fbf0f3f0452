"""Operator 5 [native]: personal data by weak supervision.

Base patterns find emails, IP addresses, cards and phone numbers; wider patterns
find candidates that they leave out. On each span, labelers vote (for, against
or not at all): the base pattern, a validity check, a gazetteer of words that
stand before such data, the span's neighbours, and words that stand before
other numbers. Expectation maximisation over the counts of all vote patterns of
all documents estimates how reliable each labeler is, and its posteriors train a
logistic span classifier. Candidates that it accepts are added; base spans
always stay.

Texts are read once: detect() writes each document's spans and their votes beside
it, from which the fit and the verdicts follow. fit() and find() do the two apart,
for a model that judges other documents.

Everything that touches documents is DataFrame functions. What the driver sees
is one count for each pattern of votes and features, at most
4 x 3^5 x 2^5 rows.

Defined results: a null or empty text has no spans. Offsets are code points, the
end is exclusive, spans are ordered by start and then by kind. Candidates that
overlap a base span are left out. Repeated rows are judged each on its own. Work
grows with a text's length and its number of matches, not with their squares.
Other columns pass through; those named base or spans are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import text_of
from skyloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: A span of _keyed().
_SPAN = "struct<start:int,kind:int,end:int,key:string>"
#: Characters before a span that labelers read.
CONTEXT = 30

# The base patterns, written so that matching is linear and needs no
# deep stack. A run is only tried from its start or from the end of the last match.
_NAME = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_NAME}]))[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wider patterns, for candidates.
WIDE = {
    "email": rf"(?<![{_NAME}])[{_NAME}]{{1,64}} ?(?:\(at\)|\[at\]|\{{at\}}|@) ?[A-Za-z0-9-]{{1,63}} ?(?:\(dot\)|\[dot\]|\{{dot\}}|\.) ?[A-Za-z]{{2,24}}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:00[1-9][0-9 ().-]{8,16}[0-9]|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
}
# What a text must have for a pattern to be tried.
_NEEDS = {"email": "@|[(\\[{]at[)\\]}]", "ip": "[0-9]\\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9][ -]?[0-9]", "phone": "\\+[0-9]|[0-9]{3}[) .-]|00[1-9]"}
# Gazetteers: words that stand before such data, words that stand before other numbers, and common top-level domains.
_CUES = {
    "email": "mail|contact|write|adresse|correo|kontakt|schreib",
    "ip": "\\bip\\b|address|host|server|adresse|direcci|router",
    "card": "card|visa|master|amex|carte|tarjeta|karte|credit|debit",
    "phone": "call|tel|phone|mobile|fax|appel|llam|anruf|handy|portable|whatsapp|sms",
}
_OTHER = "token|key|hash|sha|md5|version|licen|isbn|issn|order|invoice|serial|article|uuid|commit|build|=\\s*\"?$|#$"
_DOMAINS = "com|org|net|edu|gov|io|co|info|biz|eu|de|fr|es|uk|us|ca|it|nl|ch|at|be|pt|br|mx|in|jp|cn|ru|pl|se|no|dk|fi|au|nz"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the checksum of a digit string holds."""
    backwards = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    doubled = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """Whether a match counts as a base span."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(match)
    n = F.length(digits)
    return n.between(10, 15) if kind == "phone" else F.when(n.between(14, 19), _luhn(digits)).otherwise(F.lit(False))


#: Side of the blocks of _before(); a power of two.
_SIDE_BITS = 5
_SIDE = 1 << _SIDE_BITS


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _before(values: Column, start: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each value what start and all values before it join to, for an associative join.

    Each value joins those before it in its block to what stands before the block,
    which is found the same way from the blocks' totals. So work is linear, where
    growing an array in an aggregate would copy it at each step.
    """

    def within(rows: Column, at: Column, first: Column, n: Column) -> Column:
        return F.aggregate(F.slice(rows, first, n), at, join)

    def of(rows: Column) -> Column:
        if levels == 0:
            return F.transform(rows, lambda _, i: within(rows, start, F.lit(1), i))
        places = F.sequence(F.lit(0), F.shiftright(F.size(rows) - 1, _SIDE_BITS))
        neutral = F.element_at(rows, 1)

        def total(b: Column) -> Column:
            first = F.shiftleft(b, _SIDE_BITS) + 1
            return within(rows, F.element_at(rows, first), first + 1, F.lit(_SIDE - 1))

        blocks = _before(F.transform(places, total), start, join, levels - 1)
        return F.when(F.size(rows) == 0, F.transform(rows, lambda _: neutral)).otherwise(
            _let(blocks, lambda known: F.transform(rows, lambda _, i: within(rows, F.get(known, F.shiftright(i, _SIDE_BITS)), F.shiftleft(F.shiftright(i, _SIDE_BITS), _SIDE_BITS) + 1, i.bitwiseAND(_SIDE - 1))))
        )

    return _let(values, of)


def _spans(text: Column, kind: str, patterns: dict[str, str]) -> Column:
    """array of (start, end, match, before, after) of all matches, in code points.

    The text between matches and the matches themselves alternate, so lengths
    add up to positions.
    """
    matches, between = F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0)), F.split(text, patterns[kind], -1)
    none = "array<struct<start:int,end:int,match:string,before:string,after:string>>"

    def placed(gaps: Column) -> Column:
        n = F.greatest(F.size(gaps) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(gaps, F.lit(1), n), matches, lambda gap, match: F.struct(F.length(gap).alias("skip"), F.length(match).alias("size"), F.substring(gap, -CONTEXT, CONTEXT).alias("before"), match.alias("match")))
        afters = F.transform(F.slice(gaps, F.lit(2), n), lambda gap: F.substring(gap, 1, 1))

        def of(found: Column) -> Column:
            ends = _before(F.transform(found, lambda p: p["skip"] + p["size"]), F.lit(0), lambda a, b: a + b)
            starts = F.zip_with(found, ends, lambda p, at: at + p["skip"])
            context = F.zip_with(starts, afters, lambda at, after: F.struct(at.alias("at"), after.alias("after")))
            return F.zip_with(
                found,
                context,
                lambda p, c: F.struct(c["at"].alias("start"), (c["at"] + p["size"]).alias("end"), p["match"].alias("match"), p["before"].alias("before"), c["after"].alias("after")),
            )

        return _let(pairs, of)

    return F.when(text.rlike(_NEEDS[kind]), _let(between, placed)).otherwise(F.array().cast(none))


def _clear(wide: Column, base: Column) -> Column:
    """The wide spans that no base span overlaps.

    Of all spans by start, the largest base end before a wide span must not pass its
    start, nor the first base start after it lie before its end.
    """
    spans = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("wide"), b["kind"].alias("kind"), b["end"].alias("end"), F.lit(None).cast(_SPAN).alias("span"))),
        F.transform(wide, lambda w: F.struct(w["start"].alias("start"), F.lit(1).alias("wide"), w["kind"].alias("kind"), w["end"].alias("end"), w.alias("span"))),
    )
    far = F.lit(2**31 - 1)

    def of(found: Column) -> Column:
        reached = _before(F.transform(found, lambda s: F.when(s["wide"] == 0, s["end"]).otherwise(0)), F.lit(0), _larger)
        coming = F.reverse(_before(F.reverse(F.transform(found, lambda s: F.when(s["wide"] == 0, s["start"]).otherwise(far))), far, _smaller))
        around = F.zip_with(reached, coming, lambda r, c: F.struct(r.alias("reached"), c.alias("coming")))
        free = F.zip_with(found, around, lambda s, n: F.when((s["wide"] == 1) & (n["reached"] <= s["start"]) & (n["coming"] >= s["end"]), s["span"]))
        return F.filter(free, lambda s: s.isNotNull())

    return F.when((F.size(wide) == 0) | (F.size(base) == 0), wide).otherwise(_let(F.array_sort(spans), of))


def _key(kind: str, span: Column, first: str) -> Column:
    """The votes (+, -, 0) and features (0, 1) of a span, as one short text; first is the base pattern's vote."""
    match, before, after = span["match"], F.lower(span["before"]), span["after"]
    digits = F.length(_digits(match))
    vote = lambda yes, no: F.when(yes, "+").when(no, "-").otherwise("0")
    if kind == "email":
        good = F.lower(match).rlike(rf"\b(?:{_DOMAINS})$")
        validity = vote(good, ~good)
    elif kind == "ip":
        validity = vote(_valid(kind, match) | match.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"), F.lit(first == "-"))
    elif kind == "card":
        sound = _luhn(_digits(match))
        validity = vote(sound, ~sound)
    else:
        validity = vote(digits.between(10, 15), ~digits.between(10, 15))
    tied = before.rlike(r"[0-9a-z_\"'=#/]$") | after.rlike(r"[0-9A-Za-z_\"'=/]")
    votes = [F.lit(first), validity, vote(before.rlike(_CUES[kind]), F.lit(False)), vote(~tied, tied), vote(F.lit(False), before.rlike(_OTHER))]
    features = [match.rlike("[ ().-]"), F.length(match) > 20, before.rlike(r"[:(]\s*$"), before == "", match.rlike("[A-Za-z]")]
    return F.concat(F.lit(f"{kind}|"), *votes, F.lit("|"), *(F.when(f, "1").otherwise("0") for f in features))


def _candidates(df: DataFrame, text: Column, failed: bool = False) -> DataFrame:
    """df with __base and __wide, arrays of (start, kind order, end, key), and if asked for __failed.

    __failed are matches of a base pattern that its check drops; they show the
    labelers what is not personal data.
    """
    base, wide, dropped = [], [], []
    for order, kind in enumerate(KINDS):
        found = _spans(text, kind, BASE)
        base.append(_keyed(_kept(found, kind), kind, order, "+"))
        dropped.append(_keyed(_kept(found, kind, False), kind, order, "-"))
        # a wide card is a match of the base pattern that failed its check
        wide.append(_keyed(_spans(text, kind, WIDE), kind, order, "-" if kind == "card" else "0"))
    columns = {"__base": F.array_sort(F.concat(*base)), "__wide": F.array_sort(F.concat(*wide))}
    found = df.withColumns(columns | ({"__failed": F.concat(*dropped)} if failed else {}))
    return found.withColumn("__wide", _clear(F.col("__wide"), F.col("__base")))


def _kept(spans: Column, kind: str, kept: bool = True) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["match"]) == F.lit(kept))


def _keyed(spans: Column, kind: str, order: int, first: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end"), _key(kind, s, first).alias("key")))


@dataclass
class Model:
    """Accepted patterns, and for reports each labeler's reliability and each pattern's probability."""

    accepted: list[str]
    reliability: np.ndarray
    probability: dict[str, float]


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Two-class Dawid-Skene over vote patterns (+1, 0, -1) with counts: (posterior of personal data, reliabilities).

    Labelers that keep silent tell nothing. Counts of each outcome are smoothed in
    favour of labelers that are right more often than not, which also fixes which
    class is which.
    """
    posterior = 1 / (1 + np.exp(-1.5 * votes.sum(1)))
    right = np.full(votes.shape[1], 0.8)
    for _ in range(rounds):
        agree = (counts[:, None] * np.where(votes > 0, posterior[:, None], np.where(votes < 0, 1 - posterior[:, None], 0))).sum(0)
        spoke = (counts[:, None] * (votes != 0)).sum(0)
        right = np.clip((agree + 8) / (spoke + 10), 0.55, 0.99)
        share = np.clip(((counts * posterior).sum() + 1) / (counts.sum() + 2), 0.05, 0.95)
        weight = np.log(right / (1 - right))
        posterior = 1 / (1 + np.exp(-(np.log(share / (1 - share)) + votes @ weight)))
    return posterior, right


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, steps: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps over the pattern table."""
    w = np.zeros(x.shape[1])
    share = counts / counts.sum()
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def fit(df: DataFrame, text_col: str = "text", threshold: float = 0.5) -> Model:
    """Estimate labelers and train the span classifier over all spans of all documents."""
    return _fit(_candidates(df.select(text_of(df, text_col).alias("text")), F.col("text"), failed=True), threshold)


def find(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add base and spans: arrays of (start, kind, end), by start and kind; other columns pass through."""
    return _find(_candidates(df, text_of(df, text_col)), model)


def detect(df: DataFrame, text_col: str = "text", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """find() with a model fitted on the same documents, and the columns to keep (None: all); candidates are computed once and written with these."""
    kept = df.columns if keep is None else keep
    found = materialize(_candidates(df, text_of(df, text_col), failed=True).select(*kept, "__base", "__wide", "__failed"))
    return _find(found, _fit(found, threshold)).drop("__failed")


def _fit(found: DataFrame, threshold: float) -> Model:
    spans = found.select(F.explode(F.concat("__base", "__wide", "__failed")).alias("s"))
    rows = spans.groupBy(F.col("s.key").alias("key")).count().orderBy("key").collect()
    if not rows:
        return Model([], np.full(5, 0.8), {})
    keys, counts = [r.key for r in rows], np.array([r["count"] for r in rows], float)
    parts = [k.split("|") for k in keys]
    votes = np.array([[{"+": 1, "-": -1, "0": 0}[v] for v in p[1]] for p in parts])
    posterior, right = expectation_maximisation(votes, counts)
    kinds = np.array([[p[0] == k for k in KINDS] for p in parts], float)
    features = np.array([[f == "1" for f in p[2]] for p in parts], float)
    x = np.hstack([kinds, votes, features])
    p = 1 / (1 + np.exp(-x @ _logistic(x, posterior, counts)))
    return Model([k for k, value in zip(keys, p, strict=True) if value >= threshold], right, dict(zip(keys, p.tolist(), strict=True)))


def _find(found: DataFrame, model: Model) -> DataFrame:
    # patterns of base spans need no verdict; the list holds wide ones only
    accepted = [k for k in model.accepted if not k.split("|")[1].startswith("+")]
    added = F.filter("__wide", lambda w: w["key"].isin(accepted)) if accepted else F.slice("__wide", 1, 0)
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.withColumns({"base": plain(F.col("__base")), "spans": plain(F.array_sort(F.concat("__base", added)))}).drop("__base", "__wide")


def of_kind(order: int):
    """A test of spans for filter()."""
    return lambda s: s["kind"] == order


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Code points of the pieces that redact() cuts a text into.
_PIECE_BITS = 10


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; a span inside or over another joins it."""
    size = 1 << _PIECE_BITS
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)

    def between(pieces: Column, a: Column, b: Column) -> Column:
        """The text from a to b; substring() counts from the start of what it is given, so that is one piece."""
        one, two = F.shiftright(a, _PIECE_BITS), F.shiftright(b, _PIECE_BITS)
        first, last = F.coalesce(F.get(pieces, one), F.lit("")), F.coalesce(F.get(pieces, two), F.lit(""))
        at = a.bitwiseAND(size - 1)
        apart = F.concat(F.substring(first, at + 1, F.lit(size)), F.array_join(F.slice(pieces, one + 2, F.greatest(two - one - 1, F.lit(0))), ""), F.substring(last, F.lit(1), b.bitwiseAND(size - 1)))
        return F.when(one == two, F.substring(first, at + 1, b - a)).otherwise(apart)

    def of(pieces: Column) -> Column:
        ended = _before(F.transform(spans, lambda s: s["end"]), F.lit(0), _larger)
        parts = F.zip_with(spans, ended, lambda s, at: F.when(s["start"] < at, "").otherwise(F.concat(between(pieces, at, s["start"]), F.lit("["), F.upper(name(s)), F.lit("]"))))
        return F.concat(F.array_join(parts, ""), between(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(cut, of)).otherwise(text)
