"""Quality rules: base counts and a linear-chain CRF over the lines of a text.

The lines that hold a word form a sequence; a conditional random field with two
labels (content, boilerplate) and features of each line is decoded by Viterbi.
A document stays if at least ``min_content`` of its words lie in content lines
and the base rules pass.

The CRF is trained here, by exact likelihood (forward-backward, Adam), on at most
``sample_per_class`` labelled documents of either quality, chosen by a hash of
their id.  Sequences are these documents, each line with its document's label, and as
many spliced ones: pieces of a good and of a junk document in turn, each line with
the label of the document it came from, so that the model sees moves between the
labels.  Training documents over ``sample_chars`` are passed over; scoring reads
every text whole.

Defined cases: null or empty text has no words (all counts 0, base failed, not
kept); repeated rows are all returned; labels that are null or of one class only
give no model, and then the base rules alone decide; an empty table gives no
rows; extra columns are not carried by ``quality_report`` and stay in ``quality_filter``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Character classes of the base rules.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = b"abcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"
# Words of notices and navigation.
NOTICE = (b"copyright", b"license", b"cookie", b"subscribe", b"rights reserved", b"click here", b"sign in")
N_FEATURES = 14
MIN_WORDS = 50
RETURNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, content_share double")


@dataclass(frozen=True)
class LineCrf:
    """``weights``: score of content over boilerplate; ``moves``[a][b]: score of label b after a."""

    weights: tuple[float, ...]
    start: float
    moves: tuple[tuple[float, float], tuple[float, float]]

    def viterbi(self, features: np.ndarray) -> list[int]:
        """The best labels (1: content) of a sequence of lines."""
        unary = (features @ np.array(self.weights)).tolist()
        (m00, m01), (m10, m11) = self.moves
        zero, one = 0.0, self.start + unary[0]
        back = []
        for u in unary[1:]:
            from0 = 0 if zero + m00 >= one + m10 else 1
            from1 = 0 if zero + m01 > one + m11 else 1
            zero, one = (one + m10 if from0 else zero + m00), (one + m11 if from1 else zero + m01) + u
            back.append((from0, from1))
        label = 1 if one >= zero else 0
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _count(data: bytes, kinds: bytes) -> int:
    return len(data) - len(data.translate(None, kinds))


def repeated_places(words: list[bytes]) -> np.ndarray:
    """Which words lie in 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return np.zeros(n, dtype=bool)
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == n:
        return np.zeros(n, dtype=bool)
    _, pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
    _, inverse, counts = np.unique(pairs[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return covered


def line_features(lines: list[tuple[bytes, int, bool]], repeated: np.ndarray) -> np.ndarray:
    """One row per (line, its number of words, whether it equals an earlier line);
    ``repeated`` tells which words of the text are repeated."""
    if not lines:
        return np.zeros((0, N_FEATURES))
    rows, repeat_share = [], float(repeated.mean())
    heads = np.cumsum([0, *(k for _, k, _ in lines[:-1])])
    for (line, n_words, earlier), again in zip(lines, np.add.reduceat(repeated, heads, dtype=np.int64).tolist()):
        size = len(line)
        symbols, upper, lower = _count(line, SYMBOLS), _count(line, _UPPER), _count(line, _LOWER)
        low = line.lower()
        rows.append((
            1.0, min(1.0, 10 * symbols / size), float(symbols * 20 >= size),
            float(upper > lower), float(upper + lower == 0), float(n_words < 3),
            min(1.0, 20 * line.count(b"|") / size), min(1.0, 4 * _count(line, _DIGITS) / size),
            float(earlier), repeat_share, min(1.0, 20 * line.count(b"!") / size),
            float(line.rstrip()[-1:] in b".?!"), float(any(x in low for x in NOTICE)), again / n_words))
    return np.array(rows, dtype=np.float64).reshape(-1, N_FEATURES)


def split_lines(text: str | None) -> tuple[list[tuple[bytes, int, bool]], list[bytes]]:
    """The lines with a word, and all words."""
    seen: set[bytes] = set()
    lines, words = [], []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        own = line.split()
        if own:
            lines.append((line, len(own), line in seen))
            seen.add(line)
            words += own
    return lines, words


def assess(text: str | None, model: LineCrf | None, min_content: float) -> tuple:
    """A row of ``RETURNS``."""
    lines, words = split_lines(text)
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    repeated = repeated_places(words)
    n, repeats = len(words), int(repeated.sum())
    failed = n < MIN_WORDS or 100 * repeats > 50 * n
    share = 1.0 if n else 0.0
    if model and n:
        labels = model.viterbi(line_features(lines, repeated))
        share = sum(k for (_, k, _), y in zip(lines, labels) if y) / n
    return (n, len(text) - _count(raw, BLANKS), _count(raw, SYMBOLS), sum(e for *_, e in lines), repeats,
            failed, not failed and share >= min_content, share)


def quality_report(docs: DataFrame, model: LineCrf | None, min_content: float = 0.5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    @F.pandas_udf(RETURNS)
    def report(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in RETURNS.split(", ")]
        return pd.DataFrame([assess(t, model, min_content) for t in texts], columns=names)

    return docs.select(F.col(id_col).alias("doc_id"), report(F.col(text_col)).alias("q")).select("doc_id", "q.*")


def quality_filter(docs: DataFrame, model: LineCrf | None, min_content: float = 0.5,
                   text_col: str = "text") -> DataFrame:
    """The documents that stay."""
    @F.pandas_udf("boolean")
    def stays(texts: pd.Series) -> pd.Series:
        return pd.Series([assess(t, model, min_content)[6] for t in texts], dtype="bool")

    return docs.where(stays(F.col(text_col)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most 2 * ``per_class`` (text, label) of either class, by a hash of the id."""
    picks = None
    for value in (0, 1):
        own = (labels.where(F.col(label) == value).select(F.col(id_col).alias("_id"), F.lit(value).alias("_y"))
               .distinct().orderBy(F.xxhash64("_id"), "_id").limit(per_class))
        picks = own if picks is None else picks.unionByName(own)
    found = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
             .where(F.char_length("_text") <= max_chars)
             .join(F.broadcast(picks), "_id"))  # at most 2 * per_class ids
    rows = found.orderBy(F.xxhash64("_id"), "_id", "_text").limit(2 * per_class).collect()
    return [(r["_text"], r["_y"]) for r in rows]


def spliced(sample: list[tuple[str, int]], seed: int = 11) -> list[tuple[str, list[int]]]:
    """Texts of two to four pieces that come from a good and a junk document in turn, and
    the label of each line; every document of the larger class is used once."""
    rng = np.random.default_rng(seed)
    kinds: tuple[list, list] = [], []
    for text, y in sample:
        lines = [line for line in (text or "").split("\n") if line.encode("utf-8", "surrogatepass").split()]
        if lines:
            kinds[y].append(lines)
    out = []
    if all(kinds):
        for i in range(max(map(len, kinds))):
            label, lines, labels = int(rng.integers(2)), [], []
            for _ in range(int(rng.integers(2, 5))):
                own = kinds[label][i % len(kinds[label])]
                low = int(rng.integers(len(own)))
                piece = own[low:low + int(rng.integers(1, len(own) + 1))]
                lines += piece
                labels += [label] * len(piece)
                label = 1 - label
            out.append(("\n".join(lines), labels))
    return out


def fit_line_crf(sample: list[tuple[str, int]], steps: int = 150, rate: float = 0.15,
                 ridge: float = 1e-3, length: int = 48) -> LineCrf | None:
    """Train on (text, quality) and their splices; sequences are cut into pieces of ``length`` lines."""
    xs, ys = [], []
    for text, y in [*sample, *spliced(sample)]:
        lines, words = split_lines(text)
        if words:
            x = line_features(lines, repeated_places(words))
            labels = y if isinstance(y, list) else [y] * len(x)
            for at in range(0, len(x), length):
                xs.append(x[at:at + length])
                ys.append(labels[at:at + length])
    if len({y for own in ys for y in own}) < 2:
        return None
    n, longest = len(xs), max(map(len, xs))
    x = np.zeros((n, longest, N_FEATURES))
    there = np.zeros((n, longest), dtype=bool)
    gold = np.zeros((n, longest))
    for i, (piece, own) in enumerate(zip(xs, ys)):
        x[i, :len(piece)], there[i, :len(piece)], gold[i, :len(piece)] = piece, True, own
    pair = there[:, 1:]  # a move into each line but the first
    seen = np.array([[(pair & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    theta = np.zeros(N_FEATURES + 1 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, start, moves = theta[:N_FEATURES], theta[N_FEATURES], theta[N_FEATURES + 1:].reshape(2, 2)
        unary = np.zeros((n, longest, 2))
        unary[:, :, 1] = x @ w
        unary[:, 0, 1] += start
        alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
        alpha[:, 0] = unary[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1) + unary[:, t]
            alpha[:, t] = np.where(there[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(moves + (unary[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(there[:, t + 1, None], new, 0.0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        one = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * there
        both = np.exp(alpha[:, :-1, :, None] + moves + (unary[:, 1:] + beta[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * pair[:, :, None, None]
        miss = gold - one
        grad = np.concatenate([np.einsum("nt,ntf->f", miss, x), [miss[:, 0].sum()],
                               (seen - both.sum(axis=(0, 1))).ravel()]) / there.sum() - ridge * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad ** 2
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    m = theta[N_FEATURES + 1:].tolist()
    return LineCrf(tuple(theta[:N_FEATURES].tolist()), float(theta[N_FEATURES]), ((m[0], m[1]), (m[2], m[3])))


def train(docs: DataFrame, labels: DataFrame, sample_per_class: int = 600,
          sample_chars: int = 20_000) -> LineCrf | None:
    return fit_line_crf(labelled_sample(docs, labels, "quality", sample_per_class, sample_chars))
