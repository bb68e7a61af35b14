"""Toxicity by a classifier chain of sparse linear models."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsieve.llm.common import each, first_by_hash, staged, without

#: Labelled rows that each combination of labels gives to the training sample, at most.
PER_COMBINATION = 1000
FOLDS = 3
#: Lengths of the word beginnings that are features beside the word itself.
PREFIXES = (3, 4, 5, 6)
#: Passes over the sample, rows of a step, and the strengths of the L1 and L2 penalties.
EPOCHS, STEP, L1, L2 = 16, 32, 15.0, 0.1
#: Distinct words whose features a worker remembers.
WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[int, ...]:
    """32-bit ids of a lower-case word and of its beginnings."""
    ids = [zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass"))]
    ids += [zlib.crc32(b"^" + word[:n].encode("utf-8", "surrogatepass")) for n in PREFIXES if len(word) >= n]
    return tuple(ids)


def text_features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, in ascending order."""
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.array([i for w in words for i in word_features(w)], dtype=np.uint32))


@dataclass
class Linear:
    """A logistic model: sparse weights of text features, and one dense weight
    for the probability of each earlier category."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def logit(self, features: np.ndarray, earlier: np.ndarray) -> float:
        at = np.searchsorted(self.features, features)
        at[at == len(self.features)] = 0
        held = self.features[at] == features if len(self.features) else np.zeros(len(features), dtype=bool)
        return float(self.weights[at[held]].sum() + earlier @ self.earlier + self.bias)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_linear(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Linear:
    """Follow-the-regularized-leader with an L1 penalty: features that do not
    tell the classes apart keep weight zero."""
    sizes = np.array([len(r) for r in rows])
    every = np.concatenate(rows) if len(rows) else np.zeros(0, np.uint32)
    names, place, count = np.unique(every, return_inverse=True, return_counts=True)
    often = count[place] >= 2  # a feature of one row can only learn that row by heart
    owner = np.repeat(np.arange(len(rows)), sizes)[often]
    place = place[often]
    width, extra = len(names), earlier.shape[1]
    z, n = np.zeros(width + extra + 1), np.zeros(width + extra + 1)
    lasso = np.r_[np.full(width, L1), np.zeros(extra + 1)]

    def solved(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - lasso[at], 0)
        return -shrunk / ((1.0 + np.sqrt(n[at])) / 0.2 + L2)

    first = np.searchsorted(owner, np.arange(len(rows) + 1))
    order, rng = np.arange(len(rows)), np.random.default_rng(0)
    dense = np.arange(width, width + extra + 1)
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for low in range(0, len(order), STEP):
            batch = order[low : low + STEP]
            taken = np.concatenate([place[first[i] : first[i + 1]] for i in batch])
            inner = np.repeat(np.arange(len(batch)), first[batch + 1] - first[batch])
            used, at = np.unique(taken, return_inverse=True)
            w, w_dense = solved(used), solved(dense)
            x_dense = np.c_[earlier[batch], np.ones(len(batch))]
            logit = np.bincount(inner, weights=w[at], minlength=len(batch)) + x_dense @ w_dense
            slope = (_sigmoid(logit) - y[batch]) * weight[batch]
            for where, now, g in (
                (used, w, np.bincount(at, weights=slope[inner], minlength=len(used))), (dense, w_dense, slope @ x_dense)
            ):
                rate = (np.sqrt(n[where] + g * g) - np.sqrt(n[where])) / 0.2
                z[where] += g - rate * now
                n[where] += g * g
    w = solved(np.arange(width + extra + 1))
    held = np.flatnonzero(w[:width])
    return Linear(names[held], w[held], w[width : width + extra], float(w[-1]))


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], per_combination: int) -> DataFrame:
    """(id, text, h, categories, weight): at most `per_combination` texts of
    each combination of labels, first in the order of a hash of the text;
    `weight` makes up for what was left out.

    Only ids, hashes and labels are joined and staged. The texts of the
    sample are then picked from `docs` by its ids, which are broadcast.
    """
    hashes = docs.select("id", F.xxhash64("text").alias("h"))
    rows = staged(hashes.join(labels, "id"), "toxicity-labels")
    sizes = rows.groupBy(*categories).agg(F.count(F.lit(1)).alias("size"))
    taken = rows.join(F.broadcast(first_by_hash(rows, categories, per_combination)), [*categories, "h"])
    taken = taken.dropDuplicates([*categories, "h"]).join(F.broadcast(sizes), categories)
    own = F.count(F.lit(1)).over(Window.partitionBy(*categories))
    taken = taken.withColumn("weight", F.greatest(F.lit(1.0), F.sqrt(F.col("size") / own))).drop("size")
    texts = docs.select("id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(taken), ["id", "h"])
    return texts.dropDuplicates([*categories, "h"])


class ToxicityChain:
    """Categories in chain order with the linear model of each."""

    def __init__(self, categories: list[str]):
        self.categories = categories
        self.models: list[Linear] = []

    def predict(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.categories))
        for k, model in enumerate(self.models):
            out[k] = _sigmoid(model.logit(features, out[:k]))
        return out


def _fitter(k: int, known: dict[int, list[float]], folds: int):
    """Fits category k on one problem: all rows but a fold, whose rows it then
    predicts, or, numbered `folds`, all rows."""

    def fit(table: pa.Table) -> pa.Table:
        data = sorted(table.to_pylist(), key=lambda r: r["row"])
        problem = data[0]["problem"]
        features = [np.frombuffer(r["features"], np.uint32) for r in data]
        earlier = np.array([known[r["row"]] for r in data]).reshape(len(data), k)
        train = [i for i, r in enumerate(data) if r["fold"] != problem]
        model = fit_linear(
            [features[i] for i in train], earlier[train], np.array([data[i]["y"][k] for i in train], dtype=float),
            np.array([data[i]["weight"] for i in train]),
        )
        out = [i for i, r in enumerate(data) if r["fold"] == problem]
        odds = [float(_sigmoid(model.logit(features[i], earlier[i]))) for i in out]
        whole = problem == folds
        return pa.table({
            "features": pa.array([model.features.tobytes() if whole else None], pa.binary()),
            "weights": pa.array([model.weights.tobytes() if whole else None], pa.binary()),
            "rest": pa.array([[*model.earlier, model.bias]], pa.list_(pa.float64())),
            "rows": pa.array([[data[i]["row"] for i in out]], pa.list_(pa.int64())),
            "odds": pa.array([odds], pa.list_(pa.float64())),
        })

    return fit


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: list[str], per_combination: int = PER_COMBINATION,
    folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text",
) -> ToxicityChain:
    """Fit on the texts of `docs` that `labels` gives a 0/1 value for each of
    `categories`.

    Rows with a null id, text or label are left out; the sample holds at most
    `per_combination` rows of each combination of labels. Category k is
    learned from the text and the probabilities of the categories before it;
    in training these are out-of-fold predictions, so that a later model
    never sees a probability that was fitted on the row itself. The folds of
    a category and the model of the whole sample are tasks of one job. The
    driver gets the models and the sample's probabilities, both bounded by
    the sample. Without rows every probability is one half.
    """
    chain = ToxicityChain(categories)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    labels = labels.select(F.col(id_col).alias("id"), *[F.col(c).cast("int").alias(c) for c in categories]).dropna()
    made = "row long, fold int, weight double, y array<int>, features binary"

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [text_features(t).tobytes() for t in each(batch.column("text"))]
            keep = batch.select(["row", "fold", "weight", "y"])
            yield keep.append_column("features", pa.array(features, pa.binary()))

    sample = _sample(docs, labels, categories, per_combination)
    sample = sample.select(
        F.xxhash64("h", *categories).alias("row"), F.pmod(F.hash("h"), F.lit(folds)).cast("int").alias("fold"),
        "weight", F.array(*categories).alias("y"), "text",
    )
    sample = staged(sample.mapInArrow(featurise, made), "toxicity-sample")
    problems = sample.withColumn("problem", F.explode(F.array(*[F.lit(k) for k in range(folds + 1)])))
    known: dict[int, list[float]] = {r[0]: [] for r in sample.select("row").collect()}
    if not known:
        return chain
    for k in range(len(categories)):
        fitted = problems.groupBy("problem").applyInArrow(
            _fitter(k, known, folds), "features binary, weights binary, rest array<double>, rows array<long>, odds array<double>"
        ).collect()
        found = {}
        for r in fitted:
            found |= dict(zip(r["rows"], r["odds"]))
            if r["features"] is not None:
                rest = np.array(r["rest"])
                chain.models.append(Linear(
                    np.frombuffer(r["features"], np.uint32), np.frombuffer(r["weights"], np.float64), rest[:-1], rest[-1]
                ))
        known = {row: [*p, found.get(row, 0.5)] for row, p in known.items()}
    return chain


def score_toxicity(
    docs: DataFrame, chain: ToxicityChain, text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """`docs` with p_<category> for each category of the chain, and `toxic`:
    the last category's probability is `threshold` or more.

    Null and empty texts have no features and get what the biases say, but are
    never toxic. Repeated rows score alike; input columns named like an added
    one are replaced.
    """
    names = [f"p_{c}" for c in chain.categories]
    source = without(docs, [*names, "toxic"])
    sent = source.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        active = np.unique(np.concatenate([m.features for m in own.models] or [np.zeros(0, np.uint32)])).tolist()
        active, seen = set(active), {}

        def told(word: str) -> tuple[int, ...]:
            """The features of a word that any model weighs."""
            if (found := seen.get(word)) is None:
                if len(seen) >= WORDS:
                    seen.clear()
                found = seen[word] = tuple(i for i in word_features(word) if i in active)
            return found

        for batch in batches:
            out = []
            for text in each(batch.column(text_col)):
                ids = {i for w in set(_WORD.findall((text or "").lower())) for i in told(w)}
                p = own.predict(np.array(sorted(ids), dtype=np.uint32)) if own.models else np.full(len(names), 0.5)
                out.append([*p, bool(text) and bool(own.models) and p[-1] >= threshold])
            for k, name in enumerate([*names, "toxic"]):
                kind = pa.bool_() if name == "toxic" else pa.float64()
                batch = batch.append_column(name, pa.array([r[k] for r in out], kind))
            yield batch

    added = [F.lit(0.0).alias(n) for n in names] + [F.lit(False).alias("toxic")]
    return source.mapInArrow(run, source.select("*", *added).schema)
