"""Toxicity scores by a linear classifier with counterfactual regularisation.

For every labelled text that names a group, variants are made in which the identity terms are
swapped for others of the same kind. A text that names none gets neutral mentions of groups put in.
Training minimises the log loss plus the squared change of the score between a text and its variants,
so that neither which group is named nor that one is named moves the score.
Features are words and word beginnings, which also meet inflected and compound forms.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored

#: Terms of one line are swapped for each other.
IDENTITY_TERMS = """
women men
woman man
female male
girls boys
girl boy
muslim christian jewish hindu buddhist atheist
muslims christians jews hindus buddhists atheists
black white asian latino african european
gay straight lesbian bisexual
immigrants refugees natives locals
old young elderly
frauen männer
muslime christen juden
femmes hommes
musulmans chrétiens juifs
mujeres hombres
musulmanes cristianos judíos
"""
KIND = {term: (line.split(), i) for line in IDENTITY_TERMS.split("\n")
        for i, term in enumerate(line.split())}
WORD = re.compile(r"\w+")
CACHED_WORDS = 300_000


@dataclass(frozen=True)
class Settings:
    """``max_rows`` labelled rows at most train the model, those whose ids hash lowest. A text that
    names no group gets ``mentions`` variants with a mention each."""

    max_rows: int = 8000
    features: int = 2000
    least_rows: int = 3
    l2: float = 1e-4
    counterfactual: float = 1.0
    mentions: int = 3
    steps: int = 500
    rate: float = 0.05


@dataclass(frozen=True)
class Model:
    """Weights of features, and the number of pairs of a text and a variant that the penalty saw."""

    weights: dict[str, float]
    bias: float
    pairs: int = 0


def features(word: str) -> list[str]:
    """The word itself and its beginnings of three to eight letters."""
    return ["=" + word, *("^" + word[:k] for k in range(3, min(9, len(word))))]


TERM_FEATURES = sorted({f for term in KIND for f in features(term)})


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def swapped(found: list[str], shift: int) -> list[str] | None:
    """The words with every identity term moved on by ``shift`` within its kind; None if there is
    none."""
    if not any(w in KIND for w in found):
        return None
    out = []
    for w in found:
        if w in KIND:
            kind, i = KIND[w]
            w = kind[(i + shift) % len(kind)]
        out.append(w)
    return out


def variants(found: list[str]) -> Iterator[list[str]]:
    """One variant for every other term of the largest kind named, without those that hold the same
    words as the text."""
    own = sorted(found)
    for shift in range(1, max((len(KIND[w][0]) for w in found if w in KIND), default=0)):
        variant = swapped(found, shift)
        if sorted(variant) != own:
            yield variant


def mentions(found: list[str], terms: list[str], n: int) -> list[list[str]]:
    """The words with a mention of each of ``n`` of ``terms``, which a checksum of the words picks."""
    first = zlib.crc32(" ".join(found).encode("utf-8", "replace"))
    return [found + [terms[(first + k) % len(terms)]] for k in range(min(n, len(terms)))]


class Vectors:
    """Sparse vectors over a list of features: the logarithm of one plus the count."""

    def __init__(self, names: list[str]):
        self.index = {name: i for i, name in enumerate(names)}
        self.known: dict[str, tuple[int, ...]] = {}

    def counts(self, found: list[str]) -> Counter:
        out: Counter = Counter()
        known, index = self.known, self.index
        for w in found:
            ids = known.get(w)
            if ids is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                ids = tuple(index[f] for f in features(w) if f in index)
                if len(w) <= 64:
                    known[w] = ids
            if ids:
                out.update(ids)
        return out

    def vector(self, found: list[str]) -> dict[int, float]:
        return {i: math.log1p(n) for i, n in self.counts(found).items()}


def labelled_sample(
    docs: DataFrame, labels: DataFrame, trains: Column, max_rows: int
) -> DataFrame:
    """``text`` and ``label`` of at most ``max_rows`` labelled rows, those of equal id and text being
    one. Ids are ordered first and then the rows of the chosen ones, both by hash and without their
    texts; ``max_rows`` bounds what is sent to the documents each time."""
    chosen = (
        labels.where(trains & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    docs = docs.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    rows = (
        docs.select("doc_id", "_key").join(F.broadcast(chosen), "doc_id").distinct()
        .orderBy(F.xxhash64("doc_id", "_key"), "doc_id", "_key").limit(max_rows))
    found = docs.join(F.broadcast(rows), ["doc_id", "_key"]).groupBy("doc_id", "_key")
    return found.agg(F.any_value("text").alias("text"), F.any_value("label").alias("label")).select("text", "label")


def feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part, counts = batch.iloc[at:at + 256], (Counter(), Counter())
            for text, label in zip(part["text"], part["label"]):
                counts[int(label > 0)].update({f for w in set(words(text)) for f in features(w)})
            names = list(set(counts[0]) | set(counts[1]))
            yield pd.DataFrame({"feature": names, "positive": [counts[1][f] for f in names],
                                "negative": [counts[0][f] for f in names]})


def informative(sample: DataFrame, positives: int, negatives: int, settings: Settings) -> list[str]:
    """The features whose rows differ most between the classes by the likelihood ratio, and those of
    identity terms, if ever so few rows have them: the penalty is about these, and they are a fixed
    list."""
    rate = positives / (positives + negatives)
    found = sample.mapInPandas(feature_counts, "feature string, positive bigint, negative bigint")
    total = F.col("positive") + F.col("negative")

    def part(n: Column, share: float) -> Column:
        return F.when(n > 0, n * F.log(n / (total * share))).otherwise(0.0)

    ratio = part(F.col("positive"), rate) + part(F.col("negative"), 1 - rate)
    counts = found.groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    known = stored(counts.where(total >= settings.least_rows).select("feature", F.round(ratio, 9).alias("ratio")))
    top = known.orderBy(F.desc("ratio"), "feature").limit(settings.features).collect()
    terms = known.where(F.col("feature").isin(TERM_FEATURES)).collect()
    return sorted({r.feature for r in [*top, *terms]})


def training_rows(names: list[str], put_in: int = 0):
    """Rows of a text (label, ids, values) and of the change that each of its variants makes (no label).
    Mentions are of terms that have a feature, ``put_in`` of them at most; others change nothing."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(names)
        terms = [term for term in KIND if any(f in vectors.index for f in features(term))]
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["label"]):
                found = words(text)
                own = vectors.vector(found)
                out.append((float(label > 0), list(own), list(own.values())))
                others = variants(found) if any(w in KIND for w in found) else mentions(found, terms, put_in)
                for variant in others:
                    other = vectors.vector(variant)
                    change = {i: other.get(i, 0.0) - own.get(i, 0.0) for i in own | other}
                    change = {i: x for i, x in change.items() if x}
                    if change:
                        out.append((None, list(change), list(change.values())))
            yield pd.DataFrame(out, columns=["label", "ids", "values"])

    return run


def fit(docs: DataFrame, labels: DataFrame, trains: Column, settings: Settings = Settings()) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label), of which rows with
    ``trains`` count. The sample is bounded by ``settings.max_rows`` and comes to the driver as
    sparse vectors over at most ``settings.features`` features and those of identity terms. Without both
    classes the score is
    the smoothed share of positives."""
    sample = stored(labelled_sample(docs, labels, trains, settings.max_rows))
    n = {bool(r[0]): r[1] for r in sample.groupBy(F.col("label") > 0).count().collect()}
    positives, negatives = n.get(True, 0), n.get(False, 0)
    prior = (positives + 0.5) / (positives + negatives + 2)
    bias = math.log(prior / (1 - prior))
    if not positives or not negatives:
        return Model({}, bias)
    names = informative(sample, positives, negatives, settings)
    rows = sample.mapInPandas(training_rows(names, settings.mentions), "label double, ids array<int>, values array<double>")
    return trained(names, rows.toPandas(), bias, settings)


def sparse(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(ids) for ids in rows["ids"]]
    flat = lambda c, kind: np.fromiter((x for xs in rows[c] for x in xs), kind, sum(sizes))
    return np.repeat(np.arange(len(rows)), sizes), flat("ids", np.int64), flat("values", float)


def trained(names: list[str], rows: pd.DataFrame, bias: float, settings: Settings) -> Model:
    """Full-batch descent with adaptive steps on log loss + l2 + counterfactual penalty."""
    own = rows["label"].notna()
    row, col, x = sparse(rows[own])
    pair, pair_col, change = sparse(rows[~own])
    label, pairs, n = rows["label"][own].to_numpy(), int((~own).sum()), len(names)
    w = np.append(np.zeros(n), bias)
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, settings.steps + 1):
        score = np.bincount(row, x * w[col], len(label)) + w[n]
        error = (1 / (1 + np.exp(-score)) - label) / len(label)
        grad = np.append(np.bincount(col, x * error[row], n) + settings.l2 * w[:n], error.sum())
        if pairs:
            moved = np.bincount(pair, change * w[pair_col], pairs)
            grad[:n] += 2 * settings.counterfactual / pairs * np.bincount(
                pair_col, change * moved[pair], n)
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        w -= settings.rate * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return Model({f: float(v) for f, v in zip(names, w) if v}, float(w[n]), pairs)


def scorer(model: Model):
    vectors, weights = Vectors(list(model.weights)), list(model.weights.values())

    def score(text: str | None) -> float:
        total = model.bias + sum(
            weights[i] * x for i, x in sorted(vectors.vector(words(text)).items()))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))

    return score


@lru_cache(maxsize=2)
def scorer_of(items: tuple, bias: float):
    return scorer(Model(dict(items), bias))


def toxicity(text: Column, model: Model) -> Column:
    """Score in [0, 1] of the whole text; null and empty texts get the score of no features."""
    items, bias = tuple(model.weights.items()), model.bias

    @F.pandas_udf("double")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer_of(items, bias)
        for batch in batches:
            yield pd.Series([score(text) for text in batch], dtype="float64")

    return compute(text)


def held_out(doc_id: str | Column) -> Column:
    """Rows that never train: those whose id, as text, has a CRC-32 divisible by 5; null ids too."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", settings: Settings = Settings(),
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (score >= 0.5), learnt from the rows of ``labels``
    that are not held out.

    One row out per row in; columns of these names are replaced, all others kept. Ids that have
    several labels count as positive if one of them is. Rows with a null id or label and labels
    without a document are not learnt from. An empty table of either kind is fine.
    """
    model = fit(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")),
        ~held_out("doc_id"), settings)
    return docs.withColumn("score", toxicity(F.col(text), model)).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
