"""Toxicity by maximum-scoring segments.

Each token has a log-odds score between the two classes under an informative Dirichlet prior, drawn towards zero by
its own uncertainty; every token also costs a little. A linear-time scan finds every maximal segment of a text, extreme-value
statistics say how surprising the best one is for a text of that length, and a logistic curve fitted on
training texts turns that into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.common import Batches, map_batches
from tamiz.llm.quality import labelled_sample
from tamiz.session import materialise

WORD = re.compile(r"\w+")
#: Contexts that a worker holds before it passes them on.
CONTEXTS_HELD = 200_000


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), left to right, in linear time."""
    # start, end, sum before, sum through, and the last earlier segment whose sum before is smaller: with
    # these links no segment is passed over twice
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, left = i, before
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            start, _, left, _, earlier = found[j]
            del found[j:]
            j = earlier
        found.append((start, i + 1, left, total, j))
    return [(a, b, right - left) for a, b, left, right, _ in found]


@dataclass
class ToxicModel:
    """``scores``: log-odds of tokens, of either sign; a token without one has 0. Each token costs ``cost`` besides."""

    scores: dict[str, float] = field(default_factory=dict)
    cost: float = 0.5
    decay: float = 1.0  # of the extreme-value law
    scale: float = 1.0
    slope: float = 1.0
    shift: float = 0.0
    significance: float = 0.01

    def token_scores(self, found: list[str]) -> np.ndarray:
        return np.fromiter(map(self.scores.get, found, repeat(0.0)), np.float64, len(found)) - self.cost

    def segments(self, found: list[str]) -> list[tuple[int, int, float]]:
        """The maximal segments of a text's tokens, (first, end exclusive, score)."""
        each = self.token_scores(found)
        gains = np.flatnonzero(each > 0)
        if not len(gains):
            return []
        # a segment begins and ends with a gain; the stretch between two acts as one token of its sum
        through = np.r_[0.0, np.cumsum(each)]
        between = through[gains[1:]] - through[gains[:-1] + 1]
        scores = np.empty(2 * len(gains) - 1)
        scores[::2], scores[1::2] = each[gains], between
        place = gains.tolist()
        return [(place[a // 2], place[(b - 1) // 2] + 1, score) for a, b, score in maximal_segments(scores.tolist())]

    def expected(self, n: int, score: float) -> float:
        """How many segments of that score a clean text of ``n`` tokens has."""
        return self.scale * max(n, 1) * float(np.exp(-self.decay * score))

    def statistic(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        return -float(np.log(self.expected(n, max((s for *_, s in segments), default=0.0))))

    def probability(self, statistic) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(statistic, dtype=float) + self.shift, -60, 60)))

    def read(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The text's statistic and its significant segments, as character spans."""
        found = words(text)
        segments = self.segments(found)
        told = [x for x in segments if self.expected(len(found), x[2]) <= self.significance]
        if told:
            spans = [m.span() for m in WORD.finditer(text)]
            # lower case may make two words of one; then the place is not known word by word
            told = [(spans[a][0], spans[b - 1][1], score) for a, b, score in told] if len(spans) == len(found) else [(0, len(text), told[0][2])]
        return self.statistic(len(found), segments), told


def _counts(batches: Batches) -> Batches:
    seen = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            seen[label].update(words(text))
    tokens = list(seen[0].keys() | seen[1].keys())
    for at in range(0, len(tokens), 50_000):
        part = tokens[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), *(pa.array([seen[k][t] for t in part], pa.int64()) for k in (1, 0))], ["token", "n1", "n0"]
        )


def _contexts(telling: frozenset[str]):
    """(token, hash of its neighbours, label)."""

    def listed(seen: set) -> pa.RecordBatch:
        columns = list(zip(*seen)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["token", "context", "label"])

    def find(batches: Batches) -> Batches:
        seen = set()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = words(text)
                if telling.isdisjoint(found):
                    continue
                padded = ["", *found, ""]
                seen.update((w, xxhash.xxh64_intdigest(f"{padded[i]} {padded[i + 2]}") >> 1, label) for i, w in enumerate(found) if w in telling)
            if len(seen) > CONTEXTS_HELD:
                yield listed(seen)
                seen.clear()
        yield listed(seen)

    return find


def _log_odds(n1, n0, total1, total0, strength):
    """Log-odds of a token between the classes and its z-score; the prior has the shares of both together."""
    prior = strength * (n1 + n0) / (total1 + total0)
    odds = lambda n, total: F.log((n + prior) / (total + strength - n - prior))
    delta = odds(n1, total1) - odds(n0, total0)
    return delta, delta / F.sqrt(1 / (n1 + prior) + 1 / (n0 + prior))


def _shrunken(delta: np.ndarray, z: np.ndarray, errors: float) -> np.ndarray:
    """Log-odds without ``errors`` standard errors of theirs, but not beyond zero."""
    return np.sign(delta) * np.maximum(0.0, np.abs(delta) * (1 - errors / np.maximum(np.abs(z), 1e-9)))


def _decay(shares: np.ndarray, scores: np.ndarray, cost: float) -> float:
    """The positive root of ``sum(p * exp(x * s)) = 1``."""
    rest = max(1e-12, 1 - shares.sum())
    excess = lambda x: float((shares * np.exp(x * (scores - cost))).sum() + rest * np.exp(-x * cost)) - 1
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, parts: int = 5, part: int = 0,
    prior_share: float = 0.015, errors: float = 1.5, cost: float = 0.5,
) -> ToxicModel:
    """Fit on at most ``sample_rows`` labelled texts, which bound the tokens of the model too.

    Every token of the sample is scored by its log-odds less ``errors`` standard errors; evidence for the clean class
    counts as that for the other does, and a token whose evidence is within its error has 0. Evidence
    is counted once per pair of neighbours, so that many copies of one text count as one. Without labels, or with one class only, the score is the constant share of class 1."""
    sample = materialise(labelled_sample(docs, labels, "toxic", parts, part, sample_rows), "toxic-sample")
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    share = (n1 + 1) / (n1 + n0 + 2)
    flat = ToxicModel(cost=cost, slope=0.0, shift=float(np.log(share / (1 - share))))
    if not n1 or not n0:
        return flat
    counted = map_batches(sample.select("label", "text"), _counts, "token string, n1 long, n0 long")
    counts = materialise(counted.groupBy("token").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "toxic-counts")
    total1, total0 = counts.agg(F.sum("n1"), F.sum("n0")).first()
    if not total1 or not total0:
        return flat
    strength = prior_share * (total1 + total0)
    delta, z = _log_odds(F.col("n1"), F.col("n0"), total1, total0, strength)
    # neighbours can only take evidence away, so no other token can get a score
    telling = frozenset(r["token"] for r in counts.select("token", z.alias("z")).where(F.abs("z") > errors).collect())
    if not telling:
        return flat
    contexts = map_batches(sample.select("label", "text"), _contexts(telling), "token string, context long, label int")
    evidence = (
        contexts.distinct().groupBy("token").agg(F.sum("label").cast("long").alias("n1"), F.sum(1 - F.col("label")).cast("long").alias("n0"))
        .select("token", "n0", delta.alias("delta"), z.alias("z"), (strength * (F.col("n1") + F.col("n0")) / (total1 + total0)).alias("prior"))
        .where(F.abs("z") > errors).orderBy("token").collect()
    )
    scores = _shrunken(*(np.array([r[c] for r in evidence], dtype=float) for c in ("delta", "z")), errors)
    if not (scores > cost).any():
        return flat
    model = ToxicModel(dict(zip((r["token"] for r in evidence), scores.tolist())), cost)
    shares = np.array([(r["n0"] + r["prior"]) / (total0 + strength) for r in evidence])
    model.decay = _decay(shares, scores, cost)
    return _calibrate(model, sample, float(scores[scores > cost].min() - cost))


def _calibrate(model: ToxicModel, sample: DataFrame, least: float) -> ToxicModel:
    """Scale of the extreme-value law from the clean texts, then the logistic curve from all."""

    def best(batches: Batches) -> Batches:
        for batch in batches:
            n, top = [], []
            for text in batch.column("text").to_pylist():
                found = words(text)
                segments = model.segments(found)
                n.append(len(found))
                top.append(max((s for *_, s in segments), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(n, pa.int64()), pa.array(top, pa.float64())], ["label", "n", "top"])

    rows = map_batches(sample.select("label", "text"), best, "label int, n long, top double").orderBy("label", "n", "top").toArrow()
    label, n, top = (np.array(rows.column(c).to_pylist(), dtype=float) for c in ("label", "n", "top"))
    clean = label == 0
    # a clean text without a segment is known only to stay below the least score a token can have
    exposure = np.maximum(n, 1)[clean] * np.exp(-model.decay * np.where(top[clean] > 0, top[clean], least))
    model.scale = float(((top[clean] > 0).sum() + 0.5) / exposure.sum())
    x = model.decay * top - np.log(model.scale * np.maximum(n, 1))
    centre, spread = float(x.mean()), float(x.std()) or 1.0
    design = np.c_[(x - centre) / spread, np.ones(len(x))]
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (label - p) - 1e-2 * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    model.slope, model.shift = float(w[0] / spread), float(w[1] - w[0] * centre / spread)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with ``score``, ``n_passages`` and ``passages`` (start:end in code points, comma-joined).

    One pass, no shuffle; rows stay as they are. A NULL or empty text has the score of a text without
    any telling token. Columns of these names are replaced."""
    added = ("score", "n_passages", "passages")
    docs = docs.drop(*added)
    names = docs.columns

    def score(batches: Batches) -> Batches:
        for batch in batches:
            read = [model.read(t or "") for t in batch.column("text").to_pylist()]
            passages = [",".join(f"{a}:{b}" for a, b, _ in x) for _, x in read]
            columns = [
                pa.array(model.probability([s for s, _ in read]), pa.float64()),
                pa.array([len(x) for _, x in read], pa.int64()),
                pa.array(passages, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *added])

    kinds = (T.DoubleType(), T.LongType(), T.StringType())
    return map_batches(docs, score, T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)]))
