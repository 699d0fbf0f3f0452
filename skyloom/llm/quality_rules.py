"""Operator 10 [native]: base quality rules and distribution divergence.

Base rules count words, symbols, repeated lines and words in repeated windows.
The method compares each document's histogram of character classes and its
histogram of common words to the references of its language by Jensen-Shannon
distance. Every language of the table with MIN_DOCS documents has references: its
COMMON words that are in the most documents, and the histograms of its documents
that pass the base rules. Documents with fewer words than a guard are not judged
by histograms.

A document without a language, or of one with fewer documents, is of an unknown
language: only the shares of letters (of any script), digits, punctuation and
symbols among its visible characters are compared, with those of prose.

Defined results: a null or empty text has no words and fails the base rules; an
empty table has no references; repeated rows count each. Words that are in equally
many documents are taken in their byte order. Columns of the table that are named
like a result are replaced by it. Very long texts are counted whole. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_of
from skyloom.session import materialize

#: Words that the histograms need to be compared at all.
MIN_WORDS_CHARS = 20
MIN_WORDS_COMMON = 60
#: Jensen-Shannon distances (base 2, 0 to 1) above which a document is rejected, and what is added for each
#: word's share of the document: few words make a rough histogram.
MAX_CHARS, SHORT_CHARS = 0.25, 5.0
MAX_COMMON, SHORT_COMMON = 0.29, 3.0
WINDOW = 8
#: Common words of a language, and documents that it needs for references.
COMMON, MIN_DOCS = 20, 20
#: Languages with references at most: their lists are broadcast.
MAX_LANGUAGES = 1_000
#: Columns of a verdict.
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "js_chars", "js_common", "base_failed", "kept")

# Character classes, as Java patterns; what is left over is a class of its own.
_CLASSES = {"lower": r"[^\p{Ll}]+", "upper": r"[^\p{Lu}]+", "digit": r"[^\p{Nd}]+", "stop": r"[^.,;:!?'\"()-]+", "symbol": r"[^#*$%&|<>@=/\\{}\[\]_^~+]+"}
# Of visible characters in any script, and their shares in prose; the rest are symbols.
_SCRIPTLESS = {r"[^\p{L}\p{M}]+": 0.955, r"[^\p{Nd}]+": 0.005, r"[^\p{P}]+": 0.035}
#: One letter for each common word.
_CODES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[:COMMON]

_SPACES = r"[ \t-\r]+"


def common_words(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, list): the words of each language of MIN_DOCS documents that are in most of them.

    Words are counted by language and word; then each task sends its best COMMON
    words of a language, so that no language is gathered in one place.
    """
    sizes = df.groupBy(df[lang_col].alias("lang")).count().where(F.col("lang").isNotNull() & (F.col("count") >= MIN_DOCS))
    known = [r.lang for r in sizes.limit(MAX_LANGUAGES + 1).collect()]
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    rows = df.where(df[lang_col].isin(known)) if known else df.limit(0)
    words = rows.select(df[lang_col].alias("lang"), F.explode(F.array_distinct(F.split(F.lower(text_of(df, text_col)), _SPACES))).alias("word"))
    counts = words.where("word <> ''").groupBy("lang", "word").count()
    best = counts.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))).where(F.col("place") <= COMMON)
    return best.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("list"))


def measure(df: DataFrame, text_col: str, keep: list[str], lists: DataFrame) -> DataFrame:
    """keep and the counts of each whole text; lists are the common words by language (column __lang of df)."""
    text = text_of(df, text_col)
    plain = df.select(*keep, text.alias("__text"), F.filter(F.split(text, _SPACES), lambda w: w != "").alias("__words"))
    named = lists.select(F.col("lang").alias("__lang"), F.col("list").alias("__list"))
    tokens = plain.join(F.broadcast(named), "__lang", "left").select(*plain.columns, "__list")
    words = F.col("__words")
    hashed = tokens.select("*", F.transform(words, lambda w: F.xxhash64(w)).alias("__hashes"), F.size(words).alias("__n"))
    # one window for each word that has seven after it
    windows = F.when(
        F.size("__hashes") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("__hashes") - WINDOW + 1), lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    windowed = hashed.select("*", windows.alias("__windows"))
    distinct = windowed.select("*", (F.size(F.array_distinct("__windows")) < F.size("__windows")).alias("__again"), F.size("__windows").alias("__n_windows"))
    # starts of windows that occur twice or more: equal hashes stand side by side in sorted order
    placed = distinct.select("*", F.when(F.col("__again"), F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__sorted"), F.size("__words").alias("__again_n"))
    same = lambda a, b: F.coalesce(F.get("__sorted", a)["h"] == F.get("__sorted", b)["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter(F.transform("__sorted", lambda s, i: F.struct(s["i"].alias("i"), (same(i, i - 1) | same(i, i + 1)).alias("twice"))), lambda s: s["twice"]), lambda s: s["i"]))
    repeated = placed.select("*", F.when(F.col("__again"), starts).alias("__starts"), F.size("__sorted").alias("__sorted_n"))
    # words under the windows: each start adds its way to the next one, eight at most
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
        lambda seen, i: F.struct((seen["words"] + F.least(F.lit(WINDOW), i - seen["last"])).alias("words"), i.alias("last")),
        lambda seen: seen["words"],
    )
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    with_lines = repeated.select("*", lines.alias("__lines"), F.coalesce(F.when(F.col("__again"), covered), F.lit(0)).alias("__covered"))
    places = F.filter(F.transform(words, lambda w: F.array_position("__list", F.lower(w))), lambda p: p > 0)
    codes = F.array_join(F.transform(places, lambda p: F.substring(F.lit(_CODES), p.cast("int"), F.lit(1))), "")
    coded = with_lines.select("*", F.when(F.col("__list").isNotNull(), codes).alias("__codes"), F.size("__lines").alias("__n_lines"))
    body = F.regexp_replace("__text", _SPACES, "")
    classes = {name: F.length(F.regexp_replace("__text", pattern, "")) for name, pattern in _CLASSES.items()}
    counts = [F.length("__codes") - F.length(F.replace("__codes", F.lit(c), F.lit(""))) for c in _CODES]
    scriptless = F.array(*(F.length(F.regexp_replace("__text", pattern, "")) for pattern in _SCRIPTLESS))
    return coded.select(
        *keep,
        F.col("__n").cast("long").alias("n_words"),
        F.length(body).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.regexp_replace("__text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.col("__n_lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.col("__covered").cast("long").alias("n_repeat_words"),
        F.length("__text").alias("__chars"),
        F.array(*classes.values()).alias("__classes"),
        F.when(F.col("__list").isNotNull(), F.array(*counts)).alias("__common"),
        F.when(F.col("__list").isNull(), scriptless).alias("__scriptless"),
    )


def _with_rest(counts: Column, total: Column) -> Column:
    """counts and, as the last one, what is left of total."""
    return F.concat(counts, F.array(F.greatest(F.lit(0.0), total - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x))))


def _distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) between a histogram of total and a reference."""
    p = F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0)))

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0)) / 2

    parts = F.zip_with(p, reference, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)))


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """keep (all columns if None, but those named like RESULTS) with the counts, base_failed, both distances (null where not compared) and kept.

    The counts of a document are written once to the shared folder (they are a
    few hundred bytes a row, besides what is kept) and read for the references and
    for the verdicts; the references are one row for each language.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in RESULTS]
    table = df.withColumn("__lang", df[lang_col])
    lists = materialize(common_words(df, text_col, lang_col))
    counts = materialize(measure(table, text_col, [*keep, "__lang"], lists))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    n_chars, n_words = F.col("__chars").cast("double"), F.col("n_words").cast("double")
    doubles = counts.withColumns({c: F.col(c).cast("array<double>") for c in ("__classes", "__common", "__scriptless")})
    whole = doubles.withColumns({"__classes": _with_rest(F.col("__classes"), n_chars), "__common": _with_rest(F.col("__common"), n_words)})
    sums = [*(F.sum(F.col("__classes")[i]).alias(f"c{i}") for i in range(len(_CLASSES) + 1)), *(F.sum(F.col("__common")[i]).alias(f"w{i}") for i in range(COMMON + 1))]
    totals = whole.where(~base_failed & F.col("__common").isNotNull()).groupBy("__lang").agg(*sums)

    def shares(prefix: str, n: int) -> Column:
        found = F.array(*(F.col(f"{prefix}{i}") for i in range(n)))
        return F.transform(found, lambda c: c / F.greatest(F.lit(1.0), F.aggregate(found, F.lit(0.0), lambda a, x: a + x)))

    references = totals.select("__lang", shares("c", len(_CLASSES) + 1).alias("__ref_classes"), shares("w", COMMON + 1).alias("__ref_common"))
    judged = whole.join(F.broadcast(references), "__lang", "left")
    known = F.col("__ref_classes").isNotNull()
    visible = F.col("word_chars").cast("double")
    prose = F.array(*map(F.lit, _SCRIPTLESS.values()), F.lit(1 - sum(_SCRIPTLESS.values())))
    unknown = F.when(F.col("__scriptless").isNotNull(), _distance(_with_rest(F.col("__scriptless"), visible), visible, prose))
    judged = judged.withColumns(
        {
            "js_chars": F.when(known, _distance(F.col("__classes"), n_chars, F.col("__ref_classes"))).otherwise(unknown),
            "js_common": F.when(known, _distance(F.col("__common"), n_words, F.col("__ref_common"))),
        }
    )
    slack = lambda limit, short: F.lit(limit) + short / F.greatest(n_words, F.lit(1.0))
    far_chars = (F.col("n_words") >= MIN_WORDS_CHARS) & (F.col("js_chars") > slack(MAX_CHARS, SHORT_CHARS))
    far_common = (F.col("n_words") >= MIN_WORDS_COMMON) & (F.col("js_common") > slack(MAX_COMMON, SHORT_COMMON))
    far = F.coalesce(far_chars, F.lit(False)) | F.coalesce(far_common, F.lit(False))
    return judged.withColumn("base_failed", base_failed).select(*keep, *RESULTS[:-1], (~F.col("base_failed") & ~far).alias("kept"))
