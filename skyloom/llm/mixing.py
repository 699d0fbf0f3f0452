"""Operator 8: mixing sources to target weights by soft membership.

A classifier trained on the labelled rows (naive Bayes over hashed byte pairs,
with its evidence tempered so that posteriors stay soft) gives each document a
posterior over the domains. Projected gradient least squares then fits
nonnegative rates, one for each document, such that the expected tokens of each
domain (rate x tokens x posterior, summed) match the targets, with a small pull
towards rate 1.

A rate is a function of the document and of the steps so far, which are vectors of
one number a domain; so a step of the fit is one aggregation. Steps are
preconditioned by the domains' second moments and accelerated (Nesterov 1983,
begun anew when the error grows). Every STEPS steps the rates so far are written
beside the weights, so that no pass repeats more than STEPS of them.

Targets that a round of steps does not come much closer to are out of reach, as
where domains cannot be told apart by their texts: then plain least squares, the
least sum of squared misses, takes the place of the preconditioned one, and what is
missed is warned of and listed in Model.missed.

The default targets give each domain its share of tokens to the power
`flatten`, scaled so that the best served domain keeps its tokens: rates are then
at least about 1, under-represented domains repeat, and no document goes.

op8_mixing and the pipeline mix the column lang, as that is what the texts of the
tables here can tell; any column of domains will do, source among them, with
targets for its values.

Defined results: a null or empty text has no tokens, its rate stays 1; rows with
a null domain, or one outside the targets, train nothing but get a posterior and
a rate; without labelled rows all posteriors are even. Extra columns pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import small_batches, text_of
from skyloom.session import materialize

#: Hashed byte pairs that the classifier counts.
PAIRS = 2048
#: Byte pairs whose evidence a document can have at most, so that posteriors stay soft.
EVIDENCE = 40.0
#: Domains at most: vectors of this size, and a matrix of its square, go to the driver.
MAX_DOMAINS = 1024
#: Steps of a round; rounds go on as long as each takes the error down by these factors.
STEPS = 30
GAIN, LEAST_GAIN = 0.25, 0.6
#: Weight of the pull towards rate 1, and the largest relative error at which steps end early.
PULL = 1e-5
CLOSE = 1e-4
#: What is added to the second moments before they are inverted.
DAMPING = 1e-4
#: Relative error of one domain from which its target counts as missed.
MISSED = 1e-2
#: Texts whose byte pairs are counted at a time.
SLICE = 256
FLATTEN = 0.7


def _pairs(text: str) -> np.ndarray:
    b = np.frombuffer(text.encode(), np.uint8)
    if len(b) < 2:
        return np.zeros(PAIRS, np.int64)
    return np.bincount((b[:-1].astype(np.uint32) * 257 + b[1:]) * np.uint32(2654435761) >> np.uint32(21), minlength=PAIRS)


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")


@dataclass
class Steps:
    """The steps of a fit: a gradient each, and how far the next one looks ahead."""

    scale: float = 1.0
    size: float = 0.0
    gradients: list[np.ndarray] = field(default_factory=list)
    ahead: list[float] = field(default_factory=list)


@dataclass
class Model:
    """Domains, log shares and log likelihoods of byte pairs, targets, and the steps of the fit."""

    domains: list[str]
    prior: np.ndarray
    likelihood: np.ndarray
    targets: np.ndarray = field(default_factory=lambda: np.zeros(0))
    expected: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: Steps = field(default_factory=Steps)
    missed: dict[str, tuple[float, float]] = field(default_factory=dict)


def posteriors(texts: list[str], model: Model) -> np.ndarray:
    """One row a text, summing to 1."""
    found = [np.zeros((0, len(model.domains)))]
    for at in range(0, len(texts), SLICE):
        counts = np.stack([_pairs(t) for t in texts[at : at + SLICE]]).astype(np.float64)
        total = counts.sum(1, keepdims=True)
        evidence = counts @ model.likelihood.T * (np.minimum(total, EVIDENCE) / np.maximum(total, 1))
        logits = model.prior + evidence
        p = np.exp(logits - logits.max(1, keepdims=True))
        found.append(p / p.sum(1, keepdims=True))
    return np.concatenate(found)


def rates(weights: np.ndarray, steps: Steps, begun: int = 0, state: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The rates of rows with these tokens x posteriors, and where the next step looks, after the steps from `begun` on."""
    r, z = state or (np.ones(len(weights)), np.ones(len(weights)))
    scaled = weights * steps.scale
    pull = PULL * np.minimum(1.0, scaled.sum(1))
    for gradient, ahead in zip(steps.gradients[begun:], steps.ahead[begun:], strict=True):
        new = np.maximum(0.0, z - steps.size * (scaled @ gradient + pull * (z - 1)))
        z = new + ahead * (new - r)
        r = new
    return r, z


def train(df: DataFrame, text_col: str, domain_col: str, domains: list[str] | None = None) -> Model:
    """Count byte pairs of all labelled rows, one vector a domain."""
    small_batches(df.sparkSession)
    rows = df.select(df[domain_col].cast("string").alias("domain"), text_of(df, text_col).alias("text")).where(F.col("domain").isNotNull())
    if domains is not None:
        rows = rows.where(F.col("domain").isin(domains))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for domain, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(domain, np.zeros(PAIRS, np.int64))
                sums[domain] += _pairs(text)
        for domain, pairs in sums.items():
            at = np.flatnonzero(pairs)
            yield pa.RecordBatch.from_pydict({"domain": [domain] * len(at), "pair": at.astype(np.int32), "n": pairs[at]}, schema)

    schema = pa.schema([("domain", pa.string()), ("pair", pa.int32()), ("n", pa.int64())])
    counts = rows.mapInArrow(count, "domain string, pair int, n long").groupBy("domain", "pair").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("domain").agg(F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("pairs")).orderBy("domain").limit(MAX_DOMAINS + 1).collect()
    if len(packed) > MAX_DOMAINS:
        raise ValueError(f"over {MAX_DOMAINS} domains")
    found = {r.domain: r.pairs for r in packed}
    names = sorted(found) if domains is None else list(domains)
    if not names:
        return Model(["all"], np.zeros(1), np.zeros((1, PAIRS)))
    table = np.full((len(names), PAIRS), 0.5)
    for i, name in enumerate(names):
        for pair, n in found.get(name, {}).items():
            table[i, pair] += n
    shares = table.sum(1)
    return Model(names, np.log(shares / shares.sum()), np.log(table / shares[:, None]))


def fit(df: DataFrame, text_col: str = "text", domain_col: str = "lang", targets: dict[str, float] | None = None, flatten: float = FLATTEN, steps: int = STEPS) -> Model:
    """Train the classifier and fit the rates; targets are expected tokens of each domain; those not met are in missed, with a warning."""
    model = train(df, text_col, domain_col, sorted(targets) if targets else None)
    text = text_of(df, text_col)
    size = len(model.domains)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def weigh(texts: pa.Array, tokens: pa.Array) -> pa.Array:
        p = posteriors(texts.to_pylist(), model) * tokens.to_numpy()[:, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * size), pa.array(p.ravel()))

    weights = materialize(df.select(weigh(text, tokens_of(text)).alias("w"), F.lit(1.0).alias("r"), F.lit(1.0).alias("z")))
    have, square = _moments(weights, size)
    if targets:
        model.targets = np.array([float(targets[d]) for d in model.domains])
    else:
        share = np.where(have > 0, have, 0.0) ** flatten
        served = np.divide(have, share, out=np.zeros(size), where=share > 0)
        model.targets = share * served.max(initial=0.0)
    model.expected = have
    if not square.any():
        return model
    # weights are scaled so that the squared norm of the map from rates to tokens is 1 at most
    norm = float(np.linalg.eigvalsh(square)[-1])
    inverse = np.linalg.inv(square / norm + DAMPING * np.eye(size))
    model.expected, reached = _descend(weights, have, model, norm, inverse, steps, GAIN)
    if not reached:
        model.expected, _ = _descend(weights, have, model, norm, np.eye(size), steps, LEAST_GAIN)
    model.missed = {d: (h, t) for d, h, t in zip(model.domains, model.expected.tolist(), model.targets.tolist(), strict=True) if abs(h - t) > MISSED * max(1.0, t)}
    if model.missed:
        warnings.warn(f"targets out of reach (domain: expected tokens, target): {model.missed}", stacklevel=2)
    return model


def _descend(rows: DataFrame, have: np.ndarray, model: Model, norm: float, metric: np.ndarray, steps: int, gain: float) -> tuple[np.ndarray, bool]:
    """Take steps from rates of 1 until the targets are met, or a round does not take their error in this metric down to `gain` of it."""
    model.steps = path = Steps(1 / np.sqrt(norm), 1 / (1 + PULL))
    error = lambda got: float((got - model.targets) @ metric @ (got - model.targets))
    close = lambda got: np.abs(got - model.targets).max() <= CLOSE * max(1.0, model.targets.max())
    look, momentum, begun, last = have, 1.0, 0, error(have)
    while not close(have):
        if len(path.gradients) - begun == steps:
            if error(have) > gain * last:
                return have, bool((np.abs(have - model.targets) <= MISSED * np.maximum(1.0, model.targets)).all())
            last, done = error(have), begun
            begun = len(path.gradients)
            rows = materialize(_advance(rows, path, done))
        path.gradients.append(metric @ ((look - model.targets) * path.scale))
        path.ahead.append(0.0)
        new = _tokens(rows, path, begun)
        if error(new) > error(have):
            momentum = 1.0
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        path.ahead[-1] = (momentum - 1) / following
        # tokens are linear in the rates, so those of the rates ahead need no pass
        look = new + path.ahead[-1] * (new - have)
        have, momentum = new, following
    return have, True


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    r, z = (batch.column(c).to_numpy() for c in "rz")
    return batch.column("w").values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), (r, z)


def _tokens(rows: DataFrame, path: Steps, begun: int) -> np.ndarray:
    """Sums of rate x weight for each domain."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = 0.0
        for batch in batches:
            w, state = _columns(batch)
            got = got + rates(w, path, begun, state)[0] @ w
        yield pa.RecordBatch.from_pydict({"got": [got]} if np.ndim(got) else {"got": []}, schema)

    schema = pa.schema([("got", pa.list_(pa.float64()))])
    size = len(path.gradients[0])
    sums = rows.mapInArrow(add, "got array<double>").agg(F.array(*(F.sum(F.col("got")[i]) for i in range(size))).alias("got")).first()
    return np.array([x or 0.0 for x in sums.got])


def _advance(rows: DataFrame, path: Steps, begun: int) -> DataFrame:
    """rows with the rates after all steps."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, state = _columns(batch)
            r, z = rates(w, path, begun, state)
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(r), pa.array(z)], ["w", "r", "z"])

    return rows.mapInArrow(move, "w array<double>, r double, z double")


def _moments(weights: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the weights, and of the products of two domains' weights: one row a domain or pair of domains."""
    upper = np.flatnonzero(np.triu(np.ones((size, size), bool)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, square = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            w, _ = _columns(batch)
            if len(w):
                sums += w.sum(0)
                square += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": np.concatenate([upper, -1 - np.arange(size)]).astype(np.int32), "v": np.concatenate([square.ravel()[upper], sums])})

    sums, square = np.zeros(size), np.zeros(size * size)
    for r in weights.mapInArrow(add, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        if r["at"] < 0:
            sums[-1 - r["at"]] = r.v
        else:
            square[r["at"]] = r.v
    square = square.reshape(size, size)
    return sums, square + np.triu(square, 1).T


def apply(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add n_tokens, posterior (map of domain to probability) and rate; other columns pass through."""
    small_batches(df.sparkSession)
    text = text_of(df, text_col)
    size = len(model.domains)

    @F.arrow_udf(T.StructType([T.StructField("p", T.ArrayType(T.DoubleType())), T.StructField("rate", T.DoubleType())]))
    def judge(texts: pa.Array, tokens: pa.Array) -> pa.Array:
        p = posteriors(texts.to_pylist(), model)
        r, _ = rates(p * tokens.to_numpy()[:, None], model.steps)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * size), pa.array(p.ravel()))
        # rounded, so that a rate of 1 but for rounding errors stays 1
        return pa.StructArray.from_arrays([lists, pa.array(r.round(9))], ["p", "rate"])

    counted = df.withColumn("n_tokens", tokens_of(text))
    judged = counted.withColumn("__mix", judge(text, F.col("n_tokens")))
    names = F.array(*map(F.lit, model.domains))
    return judged.withColumns({"posterior": F.map_from_arrays(names, F.col("__mix.p")), "rate": F.col("__mix.rate")}).drop("__mix")


def repeat(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row floor(rate) times, and once more for a hash of it below the rest; drops what apply() added."""
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate").cast("int")
    copies = whole + F.when(place < F.col("rate") - whole, 1).otherwise(0)
    return df.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("__copy", "n_tokens", "posterior", "rate")
