"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= j) = sigmoid(theta_j - w.x), with one weight vector w for all grades and ordered thresholds theta. Features
are words and their first four to six letters; x is log2(1 + distinct words of the text that have the feature). The model is fitted
on a bounded sample of labelled rows (``SAMPLE`` of each label, chosen by hash of the id): labels tell toxic from clean,
and toxic rows are graded mild or severe by the share of their words that mark toxic rows. All texts are scored whole.

Odd input: null and empty texts have no features and severity of the bare thresholds; texts of any length are read whole (a
worker holds the distinct words of one); null labels and labels without a document are left out, and of several labels of
one id the larger counts; rows of equal texts get equal results, and copies of a text count once for the choice of features;
labelled rows beyond the sample are left out by hash of their id, ties by the id; columns of any name don't matter; without
labelled rows of both kinds every severity is 0; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import map_texts

#: Log odds at which a feature counts fully in the penalty; weaker ones are trusted by the square of the ratio.
ODDS = 4.0
#: Labelled rows of each kind that a fit reads at most; distinct toxic texts of a feature at least, and share of them.
SAMPLE, LEAST_DOCS, LEAST_SHARE = 3000, 6, 0.005
#: Grades: 0 clean, 1 mild, 2 severe. The bar of rejection is the expected grade with the fewest errors on the sample, a clean row rejected counting ``CARE`` times.
GRADES, CARE = 3, 4
_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[int]:
    """Ids (32 bits) of a word's features: itself and its beginnings."""
    return [zlib.crc32(f.encode()) for f in (word, *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) > n))]


def text_features(text: str | None, known: dict[str, list[int]], chosen: dict | None = None) -> dict[int, int]:
    """Distinct words of the text for each feature; only of features in ``chosen`` if given. ``known``: a bounded memory of words."""
    out: dict[int, int] = {}
    for w in set(_WORD.findall((text or "").lower())):
        if (f := known.get(w)) is None:
            f = features_of(w) if chosen is None else [i for i in features_of(w) if i in chosen]
            if len(known) < 300_000:
                known[w] = f
        for i in f:
            out[i] = out.get(i, 0) + 1
    return out


class Ordinal:
    """Weights by feature id, and thresholds in ascending order."""

    def __init__(self, weights: dict[int, float], thetas: list[float]):
        self.weights, self.thetas, self.reject = weights, thetas, 0.5

    def score(self, counts: dict[int, int]) -> float:
        return sum(self.weights[i] * math.log2(1 + counts[i]) for i in sorted(counts))

    def severity(self, score: float) -> tuple[float, int]:
        """(expected grade, likeliest grade) at w.x = score."""
        above = [1 / (1 + np.exp(min(700.0, t - score))) for t in self.thetas]
        each = -np.diff([1.0, *above, 0.0])
        return float(sum(above)), int(np.argmax(each))


def fit_ordinal(rows: Iterable[tuple[int, np.ndarray, np.ndarray]], columns: np.ndarray, trust: np.ndarray, grades: int = GRADES, l2: float = 0.4, steps: int = 1000) -> Ordinal:
    """Penalised maximum likelihood by Adam; values come multiplied by ``trust``, which the weights then take over. ``rows``: (grade, positions in ``columns`` of the features present, their values)."""
    rows = list(rows)
    if not rows:
        return Ordinal({}, [1e9] * (grades - 1))
    y = np.array([g for g, _, _ in rows])
    at = np.concatenate([np.full(len(c), k) for k, (_, c, _) in enumerate(rows)]).astype(np.int64)
    col = np.concatenate([c for _, c, _ in rows]).astype(np.int64)
    x = np.concatenate([v for _, _, v in rows])
    n, m, j = len(rows), len(columns), grades - 1
    p = np.zeros(m + j)
    p[m] = 1.0  # first threshold; the others are the logs of the gaps
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        score = np.bincount(at, p[col] * x, n)
        theta = p[m] + np.concatenate([[0], np.cumsum(np.exp(p[m + 1 :]))])
        cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - score[:, None], -40, 40)))
        cdf = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], 1)
        upper, lower = cdf[np.arange(n), y + 1], cdf[np.arange(n), y]
        d_score = 1 - upper - lower  # of the negative log-likelihood
        prob = np.maximum(upper - lower, 1e-12)
        d_theta = np.zeros(j)
        for k in range(j):
            slope = cdf[:, k + 1] * (1 - cdf[:, k + 1])
            d_theta[k] = np.sum(np.where(y == k, -slope / prob, np.where(y == k + 1, slope / prob, 0)))
        grad = np.empty_like(p)
        grad[:m] = np.bincount(col, d_score[at] * x, m) / n + l2 * p[:m] / n
        grad[m] = d_theta.sum() / n
        for k in range(1, j):
            grad[m + k] = d_theta[k:].sum() * np.exp(p[m + k]) / n
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        p -= 0.1 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    theta = p[m] + np.concatenate([[0], np.cumsum(np.exp(p[m + 1 :]))])
    return Ordinal({int(c): float(w * t) for c, w, t in zip(columns, p[:m], trust) if abs(w * t) > 1e-4}, theta.tolist())


def sample_of(labels: DataFrame, id_col: str, label: str, size: int) -> DataFrame:
    """At most ``size`` labelled ids of each kind, by hash of the id."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y is not null").groupBy("_id").agg(F.max("_y").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    return known.where("_y = 1").orderBy(*order).limit(size).unionByName(known.where("_y = 0").orderBy(*order).limit(size))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Ordinal:
    """Fits the model on at most ``sample`` rows of each label; what reaches the driver is bounded by that and by features of a text."""
    chosen = F.broadcast(sample_of(labels, id_col, label, sample))
    rows = documents.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("t")).join(chosen, "_id").select("t", "_y")

    def run(known, texts, ys):
        found = [sorted(text_features(t, known).items()) for t in texts]
        return {"y": ys, "n": [len(set(_WORD.findall((t or "").lower()))) for t in texts], "f": [np.array(f, "<u4").tobytes() for f in found]}

    got = [(r.y, r.n, *np.frombuffer(r.f, "<u4").reshape(-1, 2).T) for r in map_texts(rows, ["t", "_y"], run, "y int, n int, f binary", dict).collect()]
    distinct = {(y, f.tobytes()): f for y, _, f, _ in got}  # copies of a text count once
    bad, good = [f for (y, _), f in distinct.items() if y == 1], [f for (y, _), f in distinct.items() if y == 0]
    if not bad or not good:
        return Ordinal({}, [1e9] * (GRADES - 1))
    ids = np.unique(np.concatenate(bad + good))
    in_bad, in_good = (np.bincount(np.searchsorted(ids, np.concatenate(part)), minlength=len(ids)) for part in (bad, good))
    odds = np.log((in_bad + 0.5) / (len(bad) + 1)) - np.log((in_good + 0.5) / (len(good) + 1))
    z = odds / np.sqrt(1 / (in_bad + 0.5) + 1 / (in_good + 0.5))
    use = np.flatnonzero((in_bad >= max(LEAST_DOCS, LEAST_SHARE * len(bad))) & (z > 2.5))
    column = np.full(len(ids), -1)
    column[use] = np.arange(len(use))
    trust = (odds[use] / ODDS) ** 2

    def present(f, count):
        c = column[np.searchsorted(ids, f)]
        c, count = c[c >= 0], count[c >= 0]
        return c, np.log2(1 + count) * trust[c]

    share = lambda n, f, count: present(f, count)[1].sum() / max(1, n)
    middle = float(np.median([share(n, f, k) for y, n, f, k in got if y == 1]))
    model = fit_ordinal([(0 if y == 0 else 1 + (share(n, f, k) > middle), *present(f, k)) for y, n, f, k in got], ids[use], trust)
    counts = [{int(i): int(k) for i, k in zip(f, c) if int(i) in model.weights} for _, _, f, c in got]
    severity = np.array([model.severity(model.score(c))[0] for c in counts])
    toxic = np.array([y == 1 for y, *_ in got])
    bars = np.linspace(0.05, 0.95, 91)
    model.reject = float(bars[np.argmin([np.sum(toxic & (severity < b)) + CARE * np.sum(~toxic & (severity >= b)) for b in bars])])
    return model


def score(documents: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic) of every text."""
    weights = model.weights

    def run(known, texts, ids):
        out = {"doc_id": ids, "severity": [], "grade": [], "toxic": []}
        for t in texts:
            s, g = model.severity(model.score(text_features(t, known, weights)))
            out["severity"].append(s)
            out["grade"].append(g)
            out["toxic"].append(s >= model.reject)
        return out

    return map_texts(documents, [F.col(f"`{text_col}`"), F.col(f"`{id_col}`")], run, "doc_id long, severity double, grade int, toxic boolean", dict)


def keep_clean(documents: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """The rows whose expected severity is under the model's bar, with all their columns, in one pass and without a join."""
    from pyspark.sql.types import BooleanType

    weights = model.weights

    @F.pandas_udf(BooleanType())
    def clean(texts):
        import pandas as pd

        known: dict = {}
        out = [model.severity(model.score(text_features(t, known, weights)))[0] < model.reject for t in texts]
        return pd.Series(out, dtype=bool)

    return documents.where(clean(F.col(text_col)))


def query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(documents, fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))
