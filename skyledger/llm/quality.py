"""Quality classifier by positive-unlabelled learning with a non-negative risk.

The trusted positives are documents labelled good, the unlabelled ones are any documents of the web text;
documents labelled bad are never shown to the classifier as such. With class prior p the risk of a scorer g is

    p * E+[loss(g)] + max(0, Eu[loss(-g)] - p * E+[loss(-g)]),

the second part being the risk on negatives; when a step makes it negative, the step is undone in its
direction, which keeps the scorer from explaining the positives away (non-negative PU learning). The prior is
estimated from the labelled rows outside the held-out fold. The scorer is linear in text statistics and their
sizes, so its state is two short vectors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import held_out, sample_ids, training_labels

#: Bound on the sample of each kind, positives and unlabelled, that the classifier is fitted on.
SAMPLE = 6_000

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 space, 2 lower, 3 upper, 4 digit, 5 sentence mark, 6 symbol, 7 beyond ASCII
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 2, 3, 4, 7
_KIND[[ord(c) for c in ".,;:'\"?!()-"]] = 5
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_MARKS = [ord(c) for c in ".,;:'\"?!()-#$%&*+/<=>@[\\]^_`{|}~"]
N_FEATURES = 8 + len(_MARKS) + 16


def features(text: str) -> np.ndarray:
    """Statistics of one text, all of it. An empty text has zeros."""
    out = np.zeros(N_FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return out
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    out[:8] = np.bincount(_KIND, weights=bins, minlength=8) / n
    out[8 : 8 + len(_MARKS)] = np.sqrt(bins[_MARKS] / n)
    words, lines = text.split(), text.split("\n")
    k = len(words)
    rest = out[8 + len(_MARKS) :]
    rest[0], rest[1] = math.log1p(k), math.log1p(len(lines))
    if k:
        counts = Counter(words)
        sizes = np.fromiter(map(len, words), np.int64, k)
        rest[2] = len(counts) / k
        rest[3] = math.log1p(k) * (1 - len(counts) / k)
        rest[4] = counts.most_common(1)[0][1] / k
        rest[5] = sum(map(str.__eq__, words, words[1:])) / k
        rest[6] = sizes.mean() / 10
        rest[7] = sizes.std() / 10
        rest[8] = np.log1p(sizes.max())
        rest[9] = sum(map(str.isupper, words)) / k
        rest[10] = sum(map(str.isalpha, words)) / k
        rest[11] = sum(map(str.istitle, words)) / k
        rest[12] = len(set(zip(words, words[1:]))) / max(k - 1, 1)
        rest[13] = (sizes == 1).mean()
    rest[14] = len(set(lines)) / len(lines)
    rest[15] = math.log1p(n / len(lines))
    return out


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the statistics of the text."""
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py() or "") for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", x array<double>")


class Scorer:
    """g(x) = w . (z, |z| - 1) + b with z the standardised statistics, cut off at 8; the score is sigmoid(g)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias

    @staticmethod
    def wide(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / scale, -8, 8)
        return np.concatenate([z, np.abs(z) - 1], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        g = self.wide(x, self.mean, self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-3) -> Scorer:
    """Minimise the non-negative PU risk with logistic loss by full-batch Adam steps."""
    if not len(positive) or not len(unlabelled):
        return Scorer(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), math.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    mean, scale = positive.mean(axis=0), positive.std(axis=0) + 1e-3
    p, u = Scorer.wide(positive, mean, scale), Scorer.wide(unlabelled, mean, scale)
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)
    soft = lambda z: np.logaddexp(0, z)  # noqa: E731  loss(g) = soft(-g)
    sigm = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, rounds + 1):
        gp, gu = p @ w + b, u @ w + b
        negative = soft(gu).mean() - prior * soft(gp).mean()
        # Slopes of loss(-g) = soft(g) on both, and of loss(g) on positives.
        neg_p, neg_u = -prior * sigm(gp) / len(p), sigm(gu) / len(u)
        pos_p = -prior * sigm(-gp) / len(p)
        dp, du = (pos_p + neg_p, neg_u) if negative >= 0 else (-neg_p, -neg_u)
        grad = np.r_[dp @ p + du @ u + decay * w, dp.sum() + du.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Scorer(mean, scale, w, b)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 23) -> Scorer:
    """Fit on bounded samples. Their ids are few, so they are broadcast; only statistics reach the driver."""
    known = training_labels(labels, "quality")
    total, good = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    prior = min(0.99, max(0.01, (good or 0) / total)) if total else 0.5
    trusted = F.broadcast(sample_ids(known.where("label = 1").select("doc_id"), sample, seed))
    positive = featured(docs.join(trusted, "doc_id", "left_semi"), ["doc_id"])
    web = featured(sample_ids(docs.where(~held_out()), sample, seed + 1), ["doc_id"])
    # A doc_id counts once among the trusted, however many rows repeat it.
    positive = positive.groupBy("doc_id").agg(F.min("x").alias("x"))
    rows = [sorted((r.doc_id or 0, tuple(r.x)) for r in part.collect()) for part in (positive, web)]
    x = [np.array([r[1] for r in part], dtype=float).reshape(len(part), N_FEATURES) for part in rows]
    return fit(x[0], x[1], prior)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    score is the chance that the text is good, from the whole text alone; predicted is 1 from ``threshold``
    on. Null texts count as empty and are scored like any text, a very long text is scored whole. A null doc_id is not
    held out. Labels with a null doc_id or label are not used; without any labels every score is 0.5. Ties need no order.
    Repeated rows give repeated results, an empty table gives an empty one; other columns are not read, whatever their names.
    """
    scorer = train(docs.select("doc_id", "text"), labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py() or "") for t in batch.column(1)]).reshape(batch.num_rows, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scorer.score(x), pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier does not reject, with docs' columns and no shuffle.

    Null and empty texts are scored like any other text. A null doc_id, repeated rows and other columns, whatever their
    names, pass through; rows with equal texts go or stay together. A very long text is scored whole. An empty table gives
    an empty one; labels with a null doc_id or label are not used.
    """
    scorer = train(docs.select("doc_id", "text"), labels)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index("text"))
            x = np.array([features(t.as_py() or "") for t in texts]).reshape(batch.num_rows, N_FEATURES)
            yield batch.filter(pa.array(scorer.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
