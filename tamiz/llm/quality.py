"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other; each visit fits a shallow tree on that feature's
bins to the current gradient and adds its leaves to the feature's lookup table. The pairs whose joint
bins explain most of what is left get two-dimensional tables the same way. A text is scored by adding
one entry per table.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.common import Batches, held_out, map_batches, whole_texts

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
SPACE = b"\t\n\x0b\x0c\r "
PROSE_MARKS = b".,;:'\"-()?"

FEATURES = (
    "log_chars", "log_words", "word_length", "upper_share", "digit_share", "space_share", "prose_mark_share",
    "other_mark_share", "repeated_neighbours", "distinct_words", "top_word_share", "bare_mark_words",
    "marked_word_ends", "log_words_a_line", "repeated_lines", "longest_word",
)


def features(text: str) -> list[float]:
    """The features of one whole text; an empty one has zeros."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(raw), len(words)
    count = lambda kept: size - len(raw.translate(None, kept))
    upper, lower, digits, space, prose = map(count, (UPPER, LOWER, DIGITS, SPACE, PROSE_MARKS))
    letters = upper + lower
    seen = Counter(words)
    ends = Counter(w[-1] for w in words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    bare = sum(c for w, c in seen.items() if len(w) == 1 and not w.isalnum() and w[0] < 128)
    marked = sum(c for b, c in ends.items() if b < 128 and not chr(b).isalnum() and b not in PROSE_MARKS)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        (size - space) / n,
        upper / max(1, letters),
        digits / size,
        space / size,
        prose / n,
        (size - letters - digits - space - prose) / size,
        sum(map(eq, words, words[1:])) / n,
        len(seen) / n,
        max(seen.values()) / n,
        bare / n,
        marked / n,
        float(np.log1p(n / len(lines))),
        1 - len(set(lines)) / len(lines),
        float(np.log1p(max(map(len, seen)))),
    ]


def _featurise(batches: Batches) -> Batches:
    for batch in batches:
        rows = [features(t) for t in batch.column("text").to_pylist()]
        kept = batch.drop_columns(["text"])
        values = pa.array(rows, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, values], [*kept.schema.names, "features"])


class BoostedTables:
    """The additive model: a table per feature, a table per chosen pair of features."""

    def __init__(self, bins: int = 48, pair_bins: int = 12, rounds: int = 120, pairs: int = 6, pair_rounds: int = 40, rate: float = 0.12, ridge: float = 2.0):
        self.bins, self.pair_bins, self.rounds = bins, pair_bins, rounds
        self.pairs, self.pair_rounds, self.rate, self.ridge = pairs, pair_rounds, rate, ridge
        self.base, self.cuts, self.tables = 0.0, [], []
        self.pair_cuts, self.pair_tables = [], {}

    def _cuts(self, column: np.ndarray, bins: int) -> np.ndarray:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        if len(middles) < bins:
            return middles
        return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))

    def _gain(self, g, h):
        return g * g / (h + self.ridge)

    def _tree(self, g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
        """Steps per bin from a tree with few leaves, grown by the best cut first."""
        edges, best = [0, len(g)], None
        cg, ch = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
        while len(edges) <= leaves:
            best = (1e-6, None)
            for lo, hi in zip(edges, edges[1:]):
                if hi - lo < 2:
                    continue
                at = np.arange(lo + 1, hi)
                left_g, left_h = cg[at] - cg[lo], ch[at] - ch[lo]
                gain = self._gain(left_g, left_h) + self._gain(cg[hi] - cg[at], ch[hi] - ch[at]) - self._gain(cg[hi] - cg[lo], ch[hi] - ch[lo])
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), int(at[k]))
            if best[1] is None:
                break
            edges = sorted([*edges, best[1]])
        step = np.zeros(len(g))
        for lo, hi in zip(edges, edges[1:]):
            step[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + self.ridge)
        return step

    def _tree_of_pair(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """Steps per cell: one cut of the first feature, then one of the second on either side."""
        whole, best = self._gain(g.sum(), h.sum()), (0.0, None)
        cg, ch = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
        corner = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
        gains = [self._gain(a, b) for a, b in zip(corner(cg), corner(ch))]
        upper, lower = gains[0] + gains[1], gains[2] + gains[3]
        if not upper.size:
            return np.zeros_like(g), 0.0
        total = upper.max(1) + lower.max(1) - whole
        i = int(np.argmax(total))
        best = (float(total[i]), (i, int(np.argmax(upper[i])), int(np.argmax(lower[i]))))
        i, j, k = best[1]
        step = np.zeros_like(g)
        for rows, cut in ((slice(0, i + 1), j), (slice(i + 1, None), k)):
            for cols in (slice(0, cut + 1), slice(cut + 1, None)):
                step[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + self.ridge)
        return step, best[0]

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTables:
        """``x``: rows by features; ``y``: 0 or 1. With no row, or one class only, the score is constant."""
        n, d = x.shape if x.ndim == 2 else (0, 0)
        positive = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(positive / (1 - positive)))
        self.cuts = [self._cuts(x[:, j], self.bins) for j in range(d)] if n else []
        self.pair_cuts = [self._cuts(x[:, j], self.pair_bins) for j in range(d)] if n else []
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pair_tables = {}
        if not n or y.min() == y.max():
            return self
        margin = np.full(n, self.base)
        bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]

        def gradient():
            p = 1 / (1 + np.exp(-margin))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for j, at in enumerate(bins):
                g, h = gradient()
                step = self.rate * self._tree(np.bincount(at, g, len(self.tables[j])), np.bincount(at, h, len(self.tables[j])))
                self.tables[j] += step
                margin += step[at]
        coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.pair_cuts)]
        sizes = [len(c) + 1 for c in self.pair_cuts]

        def cells(j, k):
            return coarse[j] * sizes[k] + coarse[k]

        def sums(at, j, k, values):
            return np.bincount(at, values, sizes[j] * sizes[k]).reshape(sizes[j], sizes[k])

        g, h = gradient()
        ranked = sorted(
            ((self._tree_of_pair(sums(at := cells(j, k), j, k, g), sums(at, j, k, h))[1], j, k) for j in range(d) for k in range(j + 1, d)),
            reverse=True,
        )
        chosen = [(j, k, cells(j, k)) for _, j, k in ranked[: self.pairs]]
        self.pair_tables = {(j, k): np.zeros((sizes[j], sizes[k])) for j, k, _ in chosen}
        for _ in range(self.pair_rounds):
            for j, k, at in chosen:
                g, h = gradient()
                step = self.rate * self._tree_of_pair(sums(at, j, k, g), sums(at, j, k, h))[0]
                self.pair_tables[j, k] += step
                margin += step.ravel()[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: bins by binary search, then additions of table entries."""
        margin = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            margin += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (j, k), table in self.pair_tables.items():
            at = [np.searchsorted(self.pair_cuts[i], x[:, i], side="right") for i in (j, k)]
            margin += table[at[0], at[1]]
        return 1 / (1 + np.exp(-margin))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents outside the held-out part.

    Which ones depends on a hash of the id only. A document labelled both ways counts as class 1; rows
    without id or label are left out, as are labels other than 0 and 1."""
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), parts, part))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # at most `rows` pairs of numbers
    return whole_texts(docs, "doc_id").join(F.broadcast(chosen), "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, parts: int = 4, part: int = 2) -> BoostedTables:
    """Fit on a bounded sample: at most ``sample_rows`` feature rows reach the driver."""
    sample = map_batches(
        labelled_sample(docs, labels, "quality", parts, part, sample_rows), _featurise, "doc_id long, label int, features array<double>"
    )
    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample_rows).toArrow()
    y = np.array(rows.column("label").to_pylist(), dtype=float)
    x = np.array(rows.column("features").to_pylist(), dtype=float).reshape(len(y), len(FEATURES))
    return BoostedTables().fit(x, y)


def score_quality(docs: DataFrame, model: BoostedTables) -> DataFrame:
    """``docs`` with ``score``: probability that a text is of class 1, in one pass without a shuffle.

    Rows stay as they are, repeated ones and those without an id included; a NULL text counts as empty.
    An empty text has the score of an all-zero feature row. Columns named ``score`` are replaced."""
    docs = docs.drop("score")
    names = docs.columns

    def score(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            x = np.array([features(t or "") for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], [*names, "score"])

    return map_batches(docs, score, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their columns unchanged."""
    model = fit_quality(docs, labels)
    return score_quality(docs, model).where(F.col("score") >= threshold).drop("score")
