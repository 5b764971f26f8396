"""Toxicity (operator 4): a chain of linear classifiers.

Categories are learnt in a fixed order. The model of a category sees the
text's features and the scores that the earlier models give it. For training,
those scores are out-of-fold: each labelled text is scored by models that
were fitted without its fold, so a later model learns from the errors that
earlier ones make on unseen texts. For use, each category has one model
fitted on the whole sample.

Features are counts over the distinct tokens of the whole text: the word and
its beginnings and end (so inflected and compounded words share weights),
hashed to a fixed number of indices. A model keeps the indices whose rates in
the two classes differ significantly, at most ``MAX_FEATURES``, and fits a
logistic regression on them. The rates are counted by Spark over the sample,
fold by fold, and the sample is cut down to the indices that some model can
keep before it is dealt to the models. As the score is a sum over tokens, a
task scores each distinct token once.

The models are fitted on at most ``SAMPLE_DOCS`` labelled documents (those of
the least id hashes), a documented bound; every document is scored. The folds
of one category are fitted in parallel tasks, each on the bounded sample. Only
models (bounded) and the sample's out-of-fold scores come to the driver.

Defined cases: NULL text is read as empty and scored by the intercepts; a
document with several labels has a category if one of them says so; without
labels, or with one class only, a model is the (smoothed) base rate; repeated
rows and NULL ids are scored row by row; an empty table gives no rows;
columns of the same names are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import small_batches, stage, text_batches, whole_text

SAMPLE_DOCS = 12_000
FOLDS = 4
HASH_BITS = 20
MAX_FEATURES = 4_096
LEAST_DOCS = 5       # documents of the sample that have a feature
LEAST_Z = 4.5        # of the difference between the two classes' rates
BEGINNINGS = (4, 5, 6)
ENDING = 5
STEPS = 150
RIDGE = 2e-4
CACHE_TOKENS = 400_000
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_/\\“”‘’«»¿¡…"

# Plain insults; a toxic text that has one is of the category insult. Fixed values.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting"]


class Linear(NamedTuple):
    """A fitted model: intercept, weight per feature index, weight per earlier category's score."""

    intercept: float
    weights: dict[int, float]
    earlier: list[float]


def token_features(token: str) -> list[int]:
    """Feature indices of a raw token: the word, its beginnings and its end."""
    word = token.lower().strip(PUNCTUATION)
    if not word:
        return []
    shapes = ["=" + word, *["^" + word[:n] for n in BEGINNINGS if len(word) >= n]]
    if len(word) > ENDING:
        shapes.append(word[-ENDING:] + "$")
    return [xxhash.xxh32_intdigest(shape) & ((1 << HASH_BITS) - 1) for shape in shapes]


class _TokenCache(dict):
    def __init__(self, value):
        super().__init__()
        self._value = value

    def __missing__(self, token):
        if len(self) > CACHE_TOKENS:
            self.clear()
        value = self[token] = self._value(token)
        return value


class _TokenScores:
    """Per model, what each token adds to the score; a new token's features are made once for all models."""

    def __init__(self, models: list[Linear]):
        self._weights = [m.weights for m in models]
        self._known: list[dict[str, float]] = [{} for _ in models]

    def sums(self, tokens: set[str]) -> list[float]:
        known = self._known
        if not known:
            return []
        if len(known[0]) > CACHE_TOKENS:
            for scores in known:
                scores.clear()
        for token in tokens.difference(known[0]):
            features = token_features(token)
            for scores, weights in zip(known, self._weights):
                scores[token] = sum([weights[i] for i in features if i in weights])
        return [math.fsum(map(scores.__getitem__, tokens)) for scores in known]


def sample_features(labelled: DataFrame, categories: list[str], folds: int = FOLDS) -> DataFrame:
    """doc_id, fold, categories, and the feature indices and counts of each sampled text; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _TokenCache(token_features)
        for batch in text_batches(batches, "t"):
            index, count = [], []
            for text in batch.column("t").to_pylist():
                found = [i for token in set(text.split()) for i in cache[token]]
                values, counts = np.unique(np.array(found, np.int32), return_counts=True)
                index.append(values)
                count.append(counts.astype(np.int32))
            kept = [c for c in batch.schema.names if c != "t"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(index, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int32()))],
                names=[*kept, "index", "count"])

    small_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).cast("int").alias("fold"),
                           *[F.col(c).cast("boolean").alias(c) for c in categories], whole_text().alias("t"))
    schema = "doc_id long, fold int, " + ", ".join(f"{c} boolean" for c in categories) + ", index array<int>, count array<int>"
    return stage(rows.mapInArrow(run, schema), "toxicity-sample")


class _Matrix(NamedTuple):
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    n_rows: int
    columns: np.ndarray    # feature index of each column

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.n_rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], len(self.columns))


def _chosen(row, index, y, train) -> np.ndarray:
    """Indices whose rates differ between the classes of the training rows."""
    n1, n0 = max(1, int((y & train).sum())), max(1, int((~y & train).sum()))
    used = train[row]
    size = 1 << HASH_BITS
    has1 = np.bincount(index[used & y[row]], minlength=size)
    has0 = np.bincount(index[used & ~y[row]], minlength=size)
    p = (has1 + has0) / (n1 + n0)
    z = np.abs(has1 / n1 - has0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    good = np.flatnonzero((has1 + has0 >= LEAST_DOCS) & (z >= LEAST_Z))
    return np.sort(good[np.argsort(-z[good], kind="stable")[:MAX_FEATURES]])


def fit_linear(row, index, count, earlier: np.ndarray, y: np.ndarray, train: np.ndarray) -> tuple[Linear, np.ndarray]:
    """A logistic regression on the training rows, and the scores of all rows."""
    n = len(y)
    base = (float((y & train).sum()) + 0.5) / (float(train.sum()) + 1.0)
    intercept = math.log(base / (1 - base))
    if not (y & train).any() or not (~y & train).any():
        return Linear(intercept, {}, [0.0] * earlier.shape[1]), np.full(n, intercept)
    columns = _chosen(row, index, y, train)
    place = np.searchsorted(columns, index)
    mine = (place < len(columns)) & (columns[np.minimum(place, max(0, len(columns) - 1))] == index) if len(columns) else np.zeros(len(index), bool)
    x = _Matrix(row[mine], place[mine], count[mine].astype(np.float64), n, columns)
    weight, total = train.astype(np.float64), float(train.sum())
    scale = np.maximum(np.abs(earlier[train]).max(axis=0, initial=1.0), 1.0)
    past = earlier / scale
    theta = np.zeros(len(columns) + past.shape[1] + 1)
    theta[-1] = intercept
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):    # Adam on the full batch
        score = x.times(theta[:len(columns)]) + past @ theta[len(columns):-1] + theta[-1]
        r = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * weight / total
        g = np.concatenate([x.back(r) + RIDGE * theta[:len(columns)], past.T @ r + RIDGE * theta[len(columns):-1], [r.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    score = x.times(theta[:len(columns)]) + past @ theta[len(columns):-1] + theta[-1]
    model = Linear(float(theta[-1]), dict(zip(columns.tolist(), theta[:len(columns)].tolist())),
                   (theta[len(columns):-1] / scale).tolist())
    return model, score


def _selected(sample: DataFrame, category: str, folds: int) -> list[int]:
    """The union of the best ``MAX_FEATURES`` indices of each model: of the sample without one fold, and of all of it."""
    hit = F.coalesce(F.col(category), F.lit(False))
    parts = [F.col("fold") != f for f in range(folds)] + [F.lit(True)]
    totals = sample.agg(*[F.count(F.when(p & h, 1)).alias(f"{name}{i}") for i, p in enumerate(parts)
                          for name, h in (("n", hit), ("c", ~hit))]).first()
    rates = (sample.select("fold", hit.alias("_hit"), F.explode("index").alias("index")).groupBy("index", "fold", "_hit")
             .agg(F.count(F.lit(1)).alias("docs")).groupBy("index")
             .agg(*[F.coalesce(F.sum(F.when(p & h, F.col("docs"))), F.lit(0)).alias(f"{name}{i}") for i, p in enumerate(parts)
                    for name, h in (("n", F.col("_hit")), ("c", ~F.col("_hit")))]))
    z = []
    for i in range(len(parts)):
        n1, n0 = max(1, totals[f"n{i}"]), max(1, totals[f"c{i}"])
        p = (F.col(f"n{i}") + F.col(f"c{i}")) / (n1 + n0)
        z.append(F.abs(F.col(f"n{i}") / n1 - F.col(f"c{i}") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n1 + 1 / n0)))
    enough = [(F.col(f"n{i}") + F.col(f"c{i}") >= LEAST_DOCS) & (z[i] >= LEAST_Z * (1 - 1e-9)) for i in range(len(parts))]
    scored = stage(rates.filter(reduce(lambda a, b: a | b, enough)).select(
        "index", *[F.when(e, x).alias(f"z{i}") for i, (e, x) in enumerate(zip(enough, z))]), "toxicity-features")
    # what each model may choose from: its own best, so that no model's choice depends on the others
    own = [scored.filter(F.col(f"z{i}").isNotNull()).orderBy(F.desc(f"z{i}"), "index").limit(MAX_FEATURES).select("index")
           for i in range(len(parts))]
    return sorted(r["index"] for r in reduce(DataFrame.union, own).distinct().collect())


def _trainer(category: str, before: list[str], folds: int):
    """Fit one model of a category: fold ``model`` left out and scored, or (the last) the whole sample."""
    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        fold = int(rows["model"].iloc[0])
        sizes = rows["index"].map(len).to_numpy()
        row = np.repeat(np.arange(len(rows)), sizes)
        index, count = (np.concatenate(rows[c].to_list()) if len(row) else np.empty(0, np.int32) for c in ("index", "count"))
        y = rows[category].fillna(False).to_numpy(bool)
        own = rows["fold"].to_numpy() == fold
        model, score = fit_linear(row, index, count, rows[before].to_numpy(np.float64), y, ~own)
        if fold < folds:      # the rows of the fold, scored by the model that has not seen them
            return pd.DataFrame({"doc_id": rows["doc_id"][own], "score": score[own], "model": None})
        return pd.DataFrame({"doc_id": [None], "score": [model.intercept], "model": [
            {"index": list(model.weights), "weight": list(model.weights.values()), "earlier": model.earlier}]})

    return train


def fit_chain(sample: DataFrame, categories: list[str], folds: int = FOLDS) -> tuple[list[Linear], DataFrame]:
    """The models of the chain, and the sample's out-of-fold scores (doc_id, one column per category)."""
    models, scored = [], sample.select("doc_id")
    for k, category in enumerate(categories):
        before = [f"score_{c}" for c in categories[:k]]

        chosen = _selected(sample, category, folds)
        pairs = F.filter(F.arrays_zip("index", "count"), lambda x: x["index"].isin(chosen) if chosen else F.lit(False))
        rows = sample.join(scored, "doc_id").select(
            "doc_id", "fold", category, F.transform(pairs, lambda x: x["index"]).alias("index"),
            F.transform(pairs, lambda x: x["count"]).alias("count"), *before,
            F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("model"))
        out = stage(rows.groupBy("model").applyInPandas(
            _trainer(category, before, folds), "doc_id long, score double, model struct<index: array<int>, weight: array<double>, earlier: array<double>>"),
            "toxicity-model")
        found = out.filter("model is not null").first()
        models.append(Linear(0.0, {}, [0.0] * k) if found is None else Linear(
            found["score"], dict(zip(found["model"]["index"], found["model"]["weight"])), list(found["model"]["earlier"])))
        scored = scored.join(out.filter("model is null").select("doc_id", F.col("score").alias(f"score_{category}")), "doc_id")
    return models, scored


def threshold(scored: DataFrame, sample: DataFrame, category: str) -> float:
    """The score from which out-of-fold precision and recall (F1) of a category are best."""
    rows = scored.join(sample.select("doc_id", category), "doc_id").select(f"score_{category}", category).toPandas()
    y = rows[category].fillna(False).to_numpy(bool)
    if not y.any():
        return math.inf
    order = np.argsort(-rows[f"score_{category}"].to_numpy(), kind="stable")
    score, hit = rows[f"score_{category}"].to_numpy()[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    best = int(np.argmax(f1))
    return float(score[best] if best + 1 == len(score) else (score[best] + score[best + 1]) / 2)


def score_chain(docs: DataFrame, models: list[Linear], categories: list[str], doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """doc_id and the score (log odds) of each category for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _TokenScores(models)
        for batch in text_batches(batches, "t"):
            out: list[list[float]] = [[] for _ in models]
            for value in batch.column("t").to_pylist():
                seen: list[float] = []
                for model, own, column in zip(models, scores.sums(set(value.split())), out):
                    seen.append(model.intercept + own + sum(a * b for a, b in zip(model.earlier, seen)))
                    column.append(seen[-1])
            yield pa.RecordBatch.from_arrays([batch.column("d"), *[pa.array(c, pa.float64()) for c in out]],
                                             names=["doc_id", *[f"score_{c}" for c in categories]])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), whole_text(text).alias("t"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"score_{c} double" for c in categories))


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], size: int = SAMPLE_DOCS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``size`` labelled documents (of the least id hashes): doc_id, text, the categories.

    Of several texts of one id the one of the least hash is taken, so the sample is the same at every run.
    A category is a condition over ``text`` and the label columns.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
              .orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(size))
    marks = labels.join(F.broadcast(chosen), "doc_id").withColumnRenamed("doc_id", "_id")
    texts = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
             .join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id").agg(F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"))).alias("text")))
    joined = texts.join(marks.drop("text"), F.col("doc_id") == F.col("_id"))
    return joined.groupBy("doc_id", "text").agg(
        *[F.max(F.coalesce(condition, F.lit(False))).alias(c) for c, condition in categories.items()])


def detect_toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """One row per document: doc_id, a probability per category, and whether the last category holds."""
    names = list(categories)
    sample = sample_features(labelled_sample(docs, labels, categories), names)
    models, scored = fit_chain(sample, names)
    least = threshold(stage(scored, "toxicity-scores"), sample, names[-1])
    probability = lambda c: 1 / (1 + F.exp(-F.col(f"score_{c}")))
    return score_chain(docs, models, names).select(
        "doc_id", *[probability(c).alias(f"p_{c}") for c in names], (F.col(f"score_{names[-1]}") >= F.lit(least)).alias(names[-1]))


def label_categories() -> dict[str, Column]:
    """The chain over the labels table: insult (a toxic text with a plain insult), then toxic."""
    toxic = F.col("toxic") == 1
    return {"insult": toxic & F.col("text").rlike(r"(?i)\b(" + "|".join(INSULTS) + r")\b"), "toxic": toxic}
