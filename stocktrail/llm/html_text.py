"""Main text of web pages: a bidirectional LSTM in numpy labels every block of a page."""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.llm.html_blocks import WIDTH, blocks, vector

SAMPLE = 160  # pages the labeller is trained on, at most
VARIANTS = 8  # training pages of other layouts made of each
SEQUENCE = 48  # blocks of one training sequence
PAGE_BLOCKS = 96  # blocks of a sampled page that are trained on, at most; taken from its whole length
RUN_BLOCKS = 16  # neighbouring blocks that are taken together
HIDDEN = 12
EPOCHS = 12
BATCH = 64  # pages labelled at a time
CELLS = 8192  # padded blocks labelled at a time, unless one page alone has more
SEED = 7

# Names on a tag path that mark the article, and those that mark what is not of it.
MAIN_NAMES = ("<article>", "<main>", "r:main", "c:article", "i:article", "c:content", "i:content", "c:post", "c:entry", "c:story")
SIDE_NAMES = (
    "<nav>", "<header>", "<footer>", "<aside>", "<form>", "<button>", "<menu>", "<dialog>", "<label>", "r:navigation",
    "r:banner", "r:complementary", "r:search", "c:ad", "c:ads", "c:advert", "c:advertisement", "c:sponsored", "c:promo",
    "c:banner", "c:cookie", "c:cookies", "c:consent", "c:notice", "c:alert", "c:popup", "c:modal", "c:newsletter",
    "c:subscribe", "c:nav", "c:navbar", "c:menu", "c:breadcrumb", "c:breadcrumbs", "c:sidebar", "c:widget", "c:related",
    "c:share", "c:social", "c:footer", "c:header", "c:comment", "c:comments", "c:reply", "c:discussion", "i:comments",
    "i:sidebar", "i:nav", "i:menu", "i:footer", "i:header", "i:ad", "i:ads", "i:cookie",
)
LEAVES = ("<h1>", "<h2>", "<h3>", "<p>", "<li>", "<blockquote>", "<td>", "<pre>")
_MAIN, _SIDE = frozenset(MAIN_NAMES), frozenset(SIDE_NAMES)


def weak_label(path: tuple[str, ...], marked: bool) -> bool:
    """Training label from the page's own mark-up: in the article and in nothing that is not of it.

    ``marked`` tells whether the page marks its article at all; in others, what no name marks as
    something else counts as the article.
    """
    return not _SIDE.intersection(path) and (not marked or bool(_MAIN.intersection(path)))


def spread_runs(found: list) -> list:
    """At most `PAGE_BLOCKS` blocks of a page: all, or runs at even distances from its first to its last block."""
    if len(found) <= PAGE_BLOCKS:
        return found
    runs = PAGE_BLOCKS // RUN_BLOCKS
    starts = [(len(found) - RUN_BLOCKS) * k // (runs - 1) for k in range(runs)]
    return [block for start in starts for block in found[start : start + RUN_BLOCKS]]


def training_pages(page: str | None) -> list[list[tuple[tuple[str, ...], str, int, bool]]]:
    """A page as labelled blocks: as it is, and with blocks of other layouts put among its own.

    Inserted blocks take their words from the page and their path from `SIDE_NAMES`, so the
    labeller also learns names that the sample happens not to have; in the variants the article's
    mark is another of `MAIN_NAMES`. The random choices depend on the page alone.
    """
    found = spread_runs([(b.path, b.text, b.linked) for b in blocks(page)])
    if not found:
        return []
    marked = any(_MAIN.intersection(path) for path, _, _ in found)
    rows = [(path, text, linked, weak_label(path, marked)) for path, text, linked in found]
    pages = [rows]
    rng = random.Random(len(page))
    words = [w for _, text, _, _ in rows for w in text.split()]
    for _ in range(VARIANTS):
        other = rng.choice(MAIN_NAMES)
        root = ("<div>", other) if other[0] != "<" else (other,)
        variant = []
        for path, text, linked, label in rows:
            if label and marked:
                path = tuple(n for name in path for n in (root if name in _MAIN else (name,)))
            if label and rng.random() < 0.15:  # headings and short lines belong to articles, too
                text, path = " ".join(text.split()[: rng.randint(1, 5)]), (*path[:-1], rng.choice(LEAVES))
            variant.append((path, text, linked, label))
        for _ in range(rng.randint(4, 9)):
            side = rng.choice(SIDE_NAMES)
            place = rng.randint(0, len(variant))
            near = variant[place - 1][0] if place else ("<html>", "<body>")
            inside = near[: next((k + 1 for k, n in enumerate(near) if n in _MAIN), len(near))]
            above = inside if rng.random() < 0.5 else ("<html>", "<body>")
            box = (side,) if side[0] == "<" else (rng.choice(("<div>", "<section>", "<ul>", "<aside>", "<p>")), side)
            leaf = rng.choice(((), ("<p>",), ("<ul>", "<li>"), ("<div>",), ("<p>", "<a>"), ("<h2>",), ("<span>",)))
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(words))
                text = " ".join(words[at : at + rng.choice((1, 2, 5, 12, 30, 60))])
                linked = len(text) if "<a>" in leaf else 0
                variant.insert(place, ((*above, *box, *leaf), text, linked, False))
        pages.append(variant)
    return pages


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of two LSTMs (forward, backward) and of the output over both states."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(width: int = WIDTH, hidden: int = HIDDEN, seed: int = SEED) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {"out": rng.normal(0, 0.1, (2 * hidden, 1)), "skip": np.zeros((width, 1)), "bias": np.zeros(1)}
        for d in "fb":
            w[f"{d}x"] = rng.normal(0, 0.15, (width, 4 * hidden))
            w[f"{d}h"] = rng.normal(0, 0.15, (hidden, 4 * hidden))
            w[f"{d}0"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray) -> list[tuple]:
        """States of one direction over time; padding leaves a state as it was. x: time, page, width."""
        w, (steps, pages, _) = self.weights, x.shape
        n = w[f"{d}h"].shape[0]
        h, c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        inputs = x @ w[f"{d}x"] + w[f"{d}0"]
        out = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = inputs[t] + h @ w[f"{d}h"]
            i, f, o = _sigmoid(gates[:, :n]), _sigmoid(gates[:, n : 2 * n]), _sigmoid(gates[:, 2 * n : 3 * n])
            g = np.tanh(gates[:, 3 * n :])
            m = mask[t][:, None]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            out.append((t, h, c, i, f, o, g, tc))
            h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
            out[-1] += (h,)
        return out

    def _states(self, x, mask):
        runs = {d: self._run(d, x, mask) for d in "fb"}
        n = self.weights["fh"].shape[0]
        states = np.zeros((*mask.shape, 2 * n), np.float32)
        for k, d in enumerate("fb"):
            for step in runs[d]:
                states[step[0], :, k * n : (k + 1) * n] = step[-1]
        return runs, states

    def _scores(self, x, states):
        w = self.weights
        return _sigmoid((states @ w["out"] + x @ w["skip"] + w["bias"])[..., 0])

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability that each block is main text, for pages of any length."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if len(p)), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            size = 1
            while at + size < len(order) and size < BATCH and len(pages[order[at + size]]) * (size + 1) <= CELLS:
                size += 1
            part = order[at : at + size]
            x, mask = _padded([pages[k] for k in part])
            scores = self._scores(x, self._states(x, mask)[1])
            for j, k in enumerate(part):
                out[k] = scores[: len(pages[k]), j]
            at += size
        return out

    def gradients(self, x, mask, y) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over real blocks, by back-propagation through time."""
        w, n = self.weights, self.weights["fh"].shape[0]
        runs, states = self._states(x, mask)
        d_score = ((self._scores(x, states) - y) * mask / max(1, mask.sum()))[..., None]
        grads = {
            "out": np.einsum("tph,tpo->ho", states, d_score), "skip": np.einsum("tpw,tpo->wo", x, d_score),
            "bias": d_score.sum((0, 1)),
        }
        d_states = d_score @ w["out"].T
        for k, d in enumerate("fb"):
            d_gates = np.zeros((*mask.shape, 4 * n), np.float32)
            d_h, d_c = np.zeros((x.shape[1], n), np.float32), np.zeros((x.shape[1], n), np.float32)
            recurrent = np.zeros_like(w[f"{d}h"])
            for t, h, c, i, f, o, g, tc, _ in reversed(runs[d]):
                m = mask[t][:, None]
                d_h = d_h + d_states[t, :, k * n : (k + 1) * n]
                inner = m * (d_c + d_h * o * (1 - tc * tc))
                z = d_gates[t]
                z[:, :n], z[:, n : 2 * n] = inner * g * i * (1 - i), inner * c * f * (1 - f)
                z[:, 2 * n : 3 * n], z[:, 3 * n :] = m * d_h * tc * o * (1 - o), inner * i * (1 - g * g)
                recurrent += h.T @ z
                d_h, d_c = z @ w[f"{d}h"].T + (1 - m) * d_h, inner * f + (1 - m) * d_c
            grads[f"{d}h"], grads[f"{d}0"] = recurrent, d_gates.sum((0, 1))
            grads[f"{d}x"] = np.einsum("tpw,tpg->wg", x, d_gates)
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for j, page in enumerate(pages):
        x[: len(page), j], mask[: len(page), j] = page, 1
    return x, mask


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Train by Adam on (vectors, labels) of block sequences; fixed order and start, so repeatable."""
    model = Labeller.fresh(seed=seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs if sequences else 0):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), 48):
            part = [sequences[k] for k in order[at : at + 48]]
            x, mask = _padded([v for v, _ in part])
            y = np.zeros(mask.shape, np.float32)
            for j, (_, labels) in enumerate(part):
                y[: len(labels), j] = labels
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                rate = 0.02 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                model.weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def train(pages: DataFrame, page_html: str = "html", sample: int = SAMPLE) -> Labeller:
    """Train on the ``sample`` pages of least hash, labelled by their own mark-up.

    Workers turn the sampled pages into vectors; the driver receives at most ``sample`` pages of
    a few variants of bounded length. Without pages the labeller keeps its start weights, and there is nothing it could label.
    """
    chosen = pages.where(F.col(page_html).isNotNull()).select(F.col(page_html).alias("__html")).orderBy(
        F.xxhash64(F.lit("sample"), "__html"), "__html"
    ).limit(sample)

    def start():
        def work(texts):
            xs, ys = [], []
            for t in texts:
                x, y = [], []
                for rows in training_pages(t):
                    for at in range(0, len(rows), SEQUENCE):
                        part = rows[at : at + SEQUENCE]
                        x.append(np.stack([vector(*r[:3]) for r in part]).tobytes())
                        y.append(bytes(r[3] for r in part))
                xs.append(x)
                ys.append(y)
            return [xs, ys]

        return work

    made = append_columns(chosen, ["__html"], "xs array<binary>, ys array<binary>", start, drop=["__html"])
    sequences = []
    for row in made.toLocalIterator():
        for x, y in zip(row["xs"], row["ys"], strict=True):
            sequences.append((np.frombuffer(x, np.float32).reshape(-1, WIDTH), np.frombuffer(y, np.uint8).astype(np.float32)))
    return fit(sequences)


def extract(df: DataFrame, page_html: str, model: Labeller, out: str = "text", drop=()) -> DataFrame:
    """Add column ``out``: the blocks of each whole page that are main text, one per line.

    Character references are decoded and white space inside a block is one space. Null, empty and
    blockless pages give the empty text. Repeated pages give the same text as often; a column
    already named ``out`` is replaced, others pass through; an empty table gives an empty table.
    """

    def start():
        def work(pages: list[str | None]) -> list[list]:
            texts = []
            for at in range(0, len(pages), BATCH):
                found = [[(b.path, b.text, b.linked) for b in blocks(p)] for p in pages[at : at + BATCH]]
                vectors = [np.stack([vector(*b) for b in page]) if page else np.empty((0, WIDTH)) for page in found]
                for page, scores in zip(found, model.probabilities(vectors), strict=True):
                    texts.append("\n".join(b[1] for b, s in zip(page, scores, strict=True) if s >= 0.5))
            return [texts]

        return work

    return append_columns(df, [page_html], f"`{out}` string", start, drop)
