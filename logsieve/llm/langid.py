"""Language identification: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.common import each, first_by_hash, without

# Families of language codes. A code that is not listed is a family of its own.
FAMILIES = {
    "af": "germanic", "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic",
    "lb": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance", "it": "romance",
    "pt": "romance", "ro": "romance",
    "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic", "pl": "slavic",
    "ru": "slavic", "sk": "slavic", "sl": "slavic", "sr": "slavic", "uk": "slavic",
    "et": "uralic", "fi": "uralic", "hu": "uralic",
}
#: Hash buckets for byte n-grams of each length.
BUCKETS = 1 << 12
#: Lengths of the byte n-grams.
ORDERS = (1, 2, 3, 4)
#: Documents per language that the classifiers are fitted on, at most.
PER_LANGUAGE = 400
UNKNOWN = "und"
#: Score from which a prediction outweighs a document's own label.
SURE = 0.9
ADDED = ["lang_pred", "score"]

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)


def has_letter(text: str | None) -> bool:
    """A character of Unicode's letter categories; `½`, `²` and `Ⅷ` are none."""
    return text is not None and any(map(str.isalpha, text))


def features(text: str | None) -> np.ndarray | None:
    """Root-scaled, unit-length counts of hashed byte n-grams over the whole
    text; None if it has no letter."""
    if not has_letter(text):
        return None
    raw = np.frombuffer(f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(len(ORDERS) * BUCKETS, dtype=np.float32)
    for k, order in enumerate(ORDERS):
        n = len(raw) - order + 1
        if n <= 0:
            continue
        h = np.zeros(n, dtype=np.uint32)
        for j in range(order):
            h = (h ^ raw[j : j + n]) * _MIX[j]
        part = np.sqrt(np.bincount((h >> 15) % BUCKETS, minlength=BUCKETS))
        out[k * BUCKETS : (k + 1) * BUCKETS] = part / np.linalg.norm(part)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights (bias last) of a linear SVM with squared hinge loss, by dual
    coordinate descent; y is +1 or -1."""
    w, bias, alpha = np.zeros(x.shape[1], dtype=x.dtype), 0.0, np.zeros(len(x))
    diagonal = np.einsum("ij,ij->i", x, x) + 1 + 1 / (2 * c)
    order, rng = np.arange(len(x)), np.random.default_rng(0)
    for _ in range(rounds):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = y[i] * (x[i] @ w + bias) - 1 + alpha[i] / (2 * c)
            new = max(0.0, alpha[i] - gradient / diagonal[i])
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]))
                step = (new - alpha[i]) * y[i]
                w += x.dtype.type(step) * x[i]
                bias += step
                alpha[i] = new
        if moved < 1e-3:
            break
    return np.append(w, x.dtype.type(bias))


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(text, lang): at most `per_language` texts of each language, those
    that come first in the order of a hash of the text."""
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    rows = rows.join(F.broadcast(first_by_hash(rows, ["lang"], per_language)), ["lang", "h"])
    return rows.dropDuplicates(["lang", "h"]).select("text", "lang")


class LanguageModel:
    """One-versus-rest SVMs over families, one-versus-one SVMs inside each."""

    def __init__(self, languages: list[str], families: dict[str, str] = FAMILIES):
        self.languages = sorted(languages)
        self.family_of = {x: families.get(x, x) for x in self.languages}
        self.families = sorted(set(self.family_of.values()))
        self.members = {f: [x for x in self.languages if self.family_of[x] == f] for f in self.families}
        self.weights: dict[tuple[str, ...], np.ndarray] = {}

    def problems(self) -> list[tuple[str, ...]]:
        """("family", f) for each family, ("pair", a, b) for each pair in one."""
        pairs = [("pair", a, b) for f in self.families for a, b in combinations(self.members[f], 2)]
        return ([("family", f) for f in self.families] if len(self.families) > 1 else []) + pairs

    def sign(self, problem: tuple[str, ...], lang: str) -> int:
        """+1 or -1 for a row of `lang`; 0 if the problem doesn't use it."""
        if problem[0] == "family":
            return 1 if self.family_of[lang] == problem[1] else -1
        return 1 if lang == problem[1] else -1 if lang == problem[2] else 0

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        def margin(problem):
            w = self.weights[problem]
            return float(x @ w[:-1] + w[-1])

        family, sure = self.families[0], 1.0
        if len(self.families) > 1:
            scores = np.array([margin(("family", f)) for f in self.families])
            family, sure = self.families[int(scores.argmax())], _squash(scores.max())
        names = self.members[family]
        votes = dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            p = _squash(margin(("pair", a, b)))
            votes[a] += p
            votes[b] += 1 - p
        best = max(names, key=votes.__getitem__)
        return best, sure * (votes[best] / (len(names) - 1) if len(names) > 1 else 1.0)


def _squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(3 * margin, -30, 30))))


def fit_languages(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on the sample of `labelled` (text, lang).

    Rows with null text or language, or without a letter, are left out. Each
    binary problem is fitted in a task of its own, on at most `per_language`
    rows of each language. The driver gets the weights only.
    """
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    sample = training_sample(rows, per_language)
    model = LanguageModel([r[0] for r in rows.select("lang").distinct().collect()])
    problems = model.problems()
    if not problems:
        return model
    needed = [(k, lang) for k, p in enumerate(problems) for lang in model.languages if model.sign(p, lang)]
    uses = sample.sparkSession.createDataFrame(needed, "problem int, lang string")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["problem"].iloc[0])
        problem = problems[number]
        pdf = pdf.sort_values(["lang", "text"])
        pdf = pdf[[has_letter(t) for t in pdf["text"]]]
        x = np.empty((len(pdf), len(ORDERS) * BUCKETS), dtype=np.float32)
        for k, text in enumerate(pdf["text"]):
            x[k] = features(text)
        w = fit_svm(x, np.array([model.sign(problem, lang) for lang in pdf["lang"]], dtype=float))
        return pd.DataFrame({"problem": [number], "w": [w.tobytes()]})

    fitted = sample.join(F.broadcast(uses), "lang").groupBy("problem").applyInPandas(fit, "problem int, w binary")
    model.weights = {problems[r[0]]: np.frombuffer(r[1], np.float32) for r in fitted.collect()}
    return model


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score added, from the text alone.

    score, 0 to 1, is the squashed family margin times the mean squashed
    margin of the winner's pairs. A null or empty text, or one without a
    letter, is `und` with score 0; so is every text if the model has learned
    no language. Ties go to the language first in alphabetical order. Repeated
    rows give a row each; input columns named lang_pred or score are replaced.
    """
    source = without(docs, ADDED)
    sent = source.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = []
            for text in each(batch.column(text_col)):
                x = features(text) if own.languages else None
                found.append(own.predict(x) if x is not None else (UNKNOWN, 0.0))
            names, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield batch.append_column("lang_pred", names).append_column("score", scores)

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return source.mapInArrow(run, T.StructType([*source.schema.fields, *added]))


def rejected(lang_col: str | None = None, sure: float = SURE) -> Column:
    """A document that no language was found in; with `lang_col`, also one
    whose label there is contradicted with a score of `sure` or more. A null
    label contradicts nothing."""
    unknown = F.col("lang_pred") == UNKNOWN
    if lang_col is None:
        return unknown
    return unknown | F.coalesce((F.col(lang_col) != F.col("lang_pred")) & (F.col("score") >= sure), F.lit(False))
