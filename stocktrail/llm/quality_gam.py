"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns, held_out

SAMPLE = 20_000  # labelled rows the model is fitted to, at most
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 8
RATE = 0.15
L2 = 1.0
THRESHOLD = 0.7

FEATURES = (
    "log_chars", "symbols", "upper", "digits", "non_ascii", "newlines", "word_length", "distinct_words",
    "top_word", "wordless", "repeats_before", "symbol_ends", "log_line", "distinct_lines",
)
_CLASSES = np.zeros(256, np.int64)
_CLASSES[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 1
_CLASSES[ord("A") : ord("Z") + 1] = 2
_CLASSES[ord("0") : ord("9") + 1] = 3
_CLASSES[0x80:] = 4
_CLASSES[10] = 5
_SYMBOL_ENDS = tuple("!#$%&*+-/<=>@^_|~")


def features(text: str | None) -> list[float]:
    """Shape of a text; null and empty texts give zeros."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_CLASSES[np.frombuffer(data, np.uint8)], minlength=6) / len(data)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    counts = Counter(words)
    return [
        float(np.log1p(len(text))),
        *kinds[1:6].tolist(),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(c for w, c in counts.items() if w.endswith(_SYMBOL_ENDS)) / n,
        float(np.log1p(len(text) / len(lines))),
        len(set(lines)) / len(lines),
    ]


@dataclass
class Model:
    """Log-odds as a sum of table entries: one table per feature and one per chosen pair."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)  # bin borders of each feature
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row, by adding the entries of its bins."""
        if not self.tables:
            return np.full(len(x), self.base)
        bins = self.bins(x)
        total = np.full(len(x), self.base)
        for table, b in zip(self.tables, bins, strict=True):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-total))


def _leaf(g, h):
    return g / (h + L2)


def _gain(g, h):
    return g * g / (h + L2)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step function over bins fitted to gradient and curvature sums, by ``depth`` levels of cuts."""
    if depth == 0 or len(g) == 1:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    left_g, left_h = g.cumsum()[:-1], h.cumsum()[:-1]
    cut = 1 + int(np.argmax(_gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)))
    return np.concatenate([_shallow_tree(g[:cut], h[:cut], depth - 1), _shallow_tree(g[cut:], h[cut:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree with one cut on either axis: its gain and its values over the cells."""

    def corners(a):
        c = a.cumsum(0).cumsum(1)
        all_, rows, columns = c[-1, -1], c[:-1, -1:], c[-1:, :-1]
        c = c[:-1, :-1]
        return c, rows - c, columns - c, all_ - rows - columns + c

    gs, hs = corners(g), corners(h)
    gains = sum(_gain(a, b) for a, b in zip(gs, hs, strict=True))
    if not gains.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    top_left, top_right, low_left, low_right = (_leaf(a[i, j], b[i, j]) for a, b in zip(gs, hs, strict=True))
    values = np.empty_like(g)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :] = top_left, top_right
    values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = low_left, low_right
    return float(gains[i, j]), values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost shallow trees over one feature after another, then over the pairs that gain most.

    Without rows every score is 1: nothing is known against a text. Rows of one label only give
    that label's smoothed share.
    """
    if not len(y):
        return Model(1.0)
    share = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return Model(float(share))
    model = Model(float(np.log(share / (1 - share))))
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, f], steps)) for f in range(x.shape[1])]
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, n in enumerate(sizes):
            g, h = slopes()
            step = RATE * _shallow_tree(np.bincount(bins[f], g, n), np.bincount(bins[f], h, n))
            model.tables[f] += step
            total += step[bins[f]]

    coarse = [np.arange(n) * COARSE // n for n in sizes]

    def cells(i, j, values, m, n):
        return np.bincount(i * n + j, values, m * n).reshape(m, n)

    g, h = slopes()
    gains = []
    for i, j in combinations(range(len(sizes)), 2):
        a, b = coarse[i][bins[i]], coarse[j][bins[j]]
        gains.append((_quadrants(cells(a, b, g, COARSE, COARSE), cells(a, b, h, COARSE, COARSE))[0], i, j))
    chosen = sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:PAIRS]
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for _, i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = slopes()
            m, n = table.shape
            _, step = _quadrants(cells(bins[i], bins[j], g, m, n), cells(bins[i], bins[j], h, m, n))
            table += RATE * step
            total += RATE * step[bins[i], bins[j]]
    return model


def text_features(df: DataFrame, text: str, drop=()) -> DataFrame:
    """Add column ``features``, an array of the values named in `FEATURES`."""
    return append_columns(
        df, [text], "features array<double>", lambda: lambda texts: [[features(t) for t in texts]], drop
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit to at most ``sample`` labelled documents outside the held-out fold.

    The sample is the labels with the least hash of their id, so it is the same at every run and
    its ids are few enough to broadcast; texts are not shuffled. Rows without an id or label are
    no examples. Text is the only input; ids join labels to texts and nothing else.
    """
    spread = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = (
        labels.select("doc_id", F.col(label).cast("double").alias("y"))
        .where(F.col("y").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .orderBy(spread, "doc_id", "y")
        .limit(sample)
    )
    texts = docs.select("doc_id", F.col("text").alias("__text"))
    rows = text_features(texts.join(F.broadcast(chosen), "doc_id"), "__text", drop=["__text"])
    # Repeated ids may bring more rows than the sample has; the same bound holds for what is collected.
    got = rows.orderBy(spread, "doc_id", "y", "features").limit(sample).select("features", "y").toArrow()
    if not got.num_rows:
        return fit(np.empty((0, len(FEATURES))), np.empty(0))
    x = np.array(got.column("features").to_pylist())
    return fit(x, got.column("y").to_numpy())


def score(df: DataFrame, text: str, model: Model, out: str = "score", drop=()) -> DataFrame:
    """Add column ``out``: probability of label 1 of each whole text.

    Null and empty texts are scored as a text of no characters. Equal texts get equal scores, and
    all rows are kept; a column already named ``out`` is replaced, others pass through; an empty
    table gives an empty table. Works without a shuffle; the model is a few tables of numbers.
    """

    def start():
        def work(texts):
            x = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
            return [model.scores(x)]

        return work

    return append_columns(df, [text], f"`{out}` double", start, drop)
