"""Toxicity: cumulative-link ordinal regression over sparse word counts.

Grades: 0 for documents labelled clean; a document labelled toxic has grade 1 to
3 by how often it uses marker words (once, twice, more).  Markers are words whose
document frequency among toxic training documents is far above that among clean
ones (z of ``min_z`` or more, in ``min_docs`` documents or more).  One weight
vector is shared by all thresholds: P(grade > k) = sigmoid(w.x - t_k), t rising;
x holds log(1 + count) of the model's words.  The expected severity is the sum
of these probabilities, and a document is toxic if P(grade > 0) is a half or more.

The model is fitted here on at most ``sample_per_class`` labelled documents of
either class, chosen by a hash of their id, of up to ``sample_chars`` characters;
scoring reads every text whole.  Its vocabulary has at most ``max_terms`` words.

Defined cases: null or empty text has severity by the thresholds alone, near 0;
with no labels of either class there is no model and severity is 0; repeated rows
are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.quality import labelled_sample

GRADES = 3
# Fixed value: characters dropped from words.
_DROP = ".,!?;:\"'()[]{}<>*#$%&|_~`"
_CLEAN = str.maketrans("", "", _DROP)
RETURNS = "severity double, p_mild double, p_medium double, p_severe double, toxic boolean, n_terms long"


@dataclass(frozen=True)
class OrdinalModel:
    terms: dict[str, float]
    cuts: tuple[float, ...]

    def score(self, text: str | None) -> tuple[list[float], int]:
        """P(grade > k) for each threshold, and the number of the model's words in the text."""
        counts = Counter(filter(self.terms.__contains__, words(text)))
        x = sum(self.terms[w] * math.log1p(k) for w, k in counts.items())
        return [1 / (1 + math.exp(min(60.0, max(-60.0, t - x)))) for t in self.cuts], sum(counts.values())


def words(text: str | None) -> list[str]:
    return (text or "").lower().translate(_CLEAN).split()


def pick_terms(bags: list[Counter], toxic: np.ndarray, min_z: float, min_docs: int,
               max_terms: int) -> tuple[list[str], set[str]]:
    """Words whose document frequencies differ between the classes, and the markers among them."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    for bag, t in zip(bags, toxic):
        (inside if t else outside).update(bag.keys())
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    scored = []
    for w in inside.keys() | outside.keys():
        a, b = inside[w], outside[w]
        if a + b >= min_docs:
            p = (a + b) / (n1 + n0)
            z = (a / n1 - b / n0) / math.sqrt(max(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
            if abs(z) >= min_z:
                scored.append((-abs(z), w, z > 0))
    scored.sort()
    return [w for _, w, _ in scored[:max_terms]], {w for _, w, up in scored[:max_terms] if up}


def fit(sample: list[tuple[str, int]], min_z: float = 5.0, min_docs: int = 5, max_terms: int = 400,
        steps: int = 400, rate: float = 0.1, ridge: float = 2e-5) -> OrdinalModel | None:
    toxic = np.array([y == 1 for _, y in sample], dtype=bool)
    if not len(sample) or toxic.all() or not toxic.any():
        return None
    bags = [Counter(words(t)) for t, _ in sample]
    terms, markers = pick_terms(bags, toxic, min_z, min_docs, max_terms)
    at = {w: i for i, w in enumerate(terms)}
    x = np.zeros((len(bags), len(terms)))
    for i, bag in enumerate(bags):
        for w, k in bag.items():
            if w in at:
                x[i, at[w]] = math.log1p(k)
    uses = np.array([sum(k for w, k in bag.items() if w in markers) for bag in bags])
    grade = np.where(toxic, np.clip(uses, 1, GRADES), 0)
    balance = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())[:, None]
    theta = np.concatenate([np.zeros(len(terms)), [0.0], np.zeros(GRADES - 1)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:len(terms)], theta[len(terms) + 1:]
        cuts = theta[len(terms)] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(gaps)))])
        p = 1 / (1 + np.exp(np.clip(cuts - (x @ w)[:, None], -60, 60)))
        # cumulative links: cell probabilities are differences of neighbouring P(grade > k)
        full = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
        cell = np.maximum(full[np.arange(len(p)), grade] - full[np.arange(len(p)), grade + 1], 1e-12)
        slope = p * (1 - p)
        upper = np.zeros_like(p)
        lower = np.zeros_like(p)
        has_low, has_up = grade > 0, grade < GRADES
        lower[has_low, grade[has_low] - 1] = (slope[has_low, grade[has_low] - 1] / cell[has_low])
        upper[has_up, grade[has_up]] = (slope[has_up, grade[has_up]] / cell[has_up])
        pull = (lower - upper) * balance  # derivative of the log likelihood by (w.x - t_k)
        by_cut = -pull.sum(axis=0)
        grad = np.concatenate([x.T @ pull.sum(axis=1), [by_cut.sum()],
                               [by_cut[k + 1:].sum() / (1 + math.exp(-gaps[k])) for k in range(GRADES - 1)]])
        grad -= ridge * np.concatenate([w, np.zeros(GRADES)])
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad ** 2
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-10)
    cuts = theta[len(terms)] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(theta[len(terms) + 1:])))])
    return OrdinalModel(dict(zip(terms, theta[:len(terms)].tolist())), tuple(cuts.tolist()))


def train(docs: DataFrame, labels: DataFrame, sample_per_class: int = 1_500,
          sample_chars: int = 20_000) -> OrdinalModel | None:
    return fit(labelled_sample(docs, labels, "toxic", sample_per_class, sample_chars))


def grade(text: str | None, model: OrdinalModel | None) -> tuple:
    """A row of ``RETURNS``."""
    if model is None:
        return (0.0, 0.0, 0.0, 0.0, False, 0)
    p, n = model.score(text)
    return (round(sum(p), 9), *(round(v, 9) for v in p), p[0] >= 0.5, n)


def toxicity_report(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, severity, P(grade > k) for the three thresholds, toxic, n_terms) per document."""
    @F.pandas_udf(RETURNS)
    def graded(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([grade(t, model) for t in texts], columns=[c.split()[0] for c in RETURNS.split(", ")])

    return docs.select(F.col(id_col).alias("doc_id"), graded(F.col(text_col)).alias("t")).select("doc_id", "t.*")
