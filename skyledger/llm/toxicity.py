"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters and digits, tagged clean or toxic. Labels are of documents, so tokens are labelled
first: a word, or a beginning of words, whose training documents are toxic more often than chance allows
(binomial tail, corrected for the number of words tried) makes its tokens in toxic documents toxic, all other
tokens are clean. The field has hashed letter features for each token and a weight for each pair of neighbouring
tags, fitted by its likelihood. A document's marginals come from one forward and one backward pass; they add up to
the chance that no token is toxic, which a slope and a shift fitted to the training documents turn into the
document's score; tokens over the threshold give the offending offsets.

Passes run over all tokens of a batch as one chain cut into rows that advance together; a document's first
token has a matrix with equal rows, which forgets what was before, so documents do not meet and texts of any
length cost the same for each token.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .learning import held_out, sample_ids, training_labels

#: Bound on the labelled documents that the field is fitted on.
SAMPLE = 2_500
#: Longest text, in bytes, that is learned from unless a caller says otherwise: with SAMPLE a bound on what the driver holds.
MAX_BYTES = 20_000
SLOTS = 1 << 16
TOKEN = re.compile(r"[^\W_]+")
ROW = 256
CACHE = 300_000


def token_features(token: str) -> list[int]:
    """Hashed features: the word, its beginnings and its runs of three and four letters."""
    w = f"^{token.lower()}$".encode("utf-8", "surrogatepass")
    grams = [b"w" + w, *(b"p" + w[:n] for n in (4, 5, 6, 7, 8, 9)), *(w[i : i + 3] for i in range(len(w) - 2)), *(w[i : i + 4] for i in range(len(w) - 3))]
    return [zlib.crc32(g) % SLOTS for g in grams]


class Field:
    """weights of features, bias, start, and trans[i, j] for tag i before tag j; slope and shift of the document score."""

    def __init__(self):
        self.weights, self.bias, self.start, self.trans = np.zeros(SLOTS), -4.0, 0.0, np.zeros((2, 2))
        self.slope, self.shift = 1.0, -3.0
        self._cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}}

    def emission(self, token: str) -> float:
        """Log odds of toxic from the token alone."""
        e = self._cache.get(token)
        if e is None:
            if len(self._cache) >= CACHE:
                self._cache.clear()
            e = self._cache[token] = float(self.weights[token_features(token)].sum()) + self.bias
        return e

    def passes(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: forward odds, backward odds, exp(e). first: where documents begin."""
        n = len(e)
        x = np.exp(np.clip(e, -30, 30))
        a = np.exp(np.clip(self.trans, -15, 15))
        s = math.exp(max(-15.0, min(15.0, self.start)))
        rows = -(-n // ROW)
        pad = rows * ROW - n
        kind = x.dtype
        xs = np.r_[x, np.ones(pad, kind)].reshape(rows, ROW).T.copy()
        begins = np.r_[first, np.ones(pad, bool)].reshape(rows, ROW).T.copy()
        m00, m10, m01, m11 = (np.where(begins, kind.type(one), kind.type(two)) for one, two in ((1, a[0, 0]), (1, a[1, 0]), (s, a[0, 1]), (s, a[1, 1])))
        m01 *= xs
        m11 *= xs
        # Product of each row's matrices.
        p00, p01, p10, p11 = (np.full(rows, z, kind) for z in (1, 0, 0, 1))
        for t in range(ROW):
            p00, p01, p10, p11 = p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t], p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t]
            top = np.maximum(p00 + p01, p10 + p11)
            p00, p01, p10, p11 = p00 / top, p01 / top, p10 / top, p11 / top
        # What comes into each row from the left and from the right.
        left, right = np.ones(rows, kind), np.ones(rows, kind)
        for k in range(1, rows):
            left[k] = (p01[k - 1] + left[k - 1] * p11[k - 1]) / (p00[k - 1] + left[k - 1] * p10[k - 1] + 1e-30)
        for k in range(rows - 2, -1, -1):
            right[k] = (p10[k + 1] + p11[k + 1] * right[k + 1]) / (p00[k + 1] + p01[k + 1] * right[k + 1] + 1e-30)
        forward, backward = np.empty((ROW, rows), kind), np.empty((ROW, rows), kind)
        r = left
        for t in range(ROW):
            r = forward[t] = (m01[t] + r * m11[t]) / (m00[t] + r * m10[t])
        b = right
        for t in range(ROW - 1, -1, -1):
            backward[t] = b
            b = (m10[t] + m11[t] * b) / (m00[t] + m01[t] * b)
        return forward.T.ravel()[:n], backward.T.ravel()[:n], x

    def evidence(self, q: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """Minus the log chance that no token of a document is toxic, every token counting: many weak ones add up."""
        return np.bincount(doc, weights=-np.log1p(-np.minimum(q, 1 - 1e-6)), minlength=n_docs)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Chance that a document is toxic."""
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(evidence + 0.01) + self.shift, -40, 40)))

    def calibrate(self, evidence: np.ndarray, labels: np.ndarray) -> None:
        """Fit slope and shift to labelled documents by logistic regression (Newton steps, slope over 0)."""
        x = np.stack([np.log(evidence + 0.01), np.ones(len(evidence))], axis=1)
        w = np.array([self.slope, self.shift])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            slope = x.T @ (p - labels) + 0.01 * w
            curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            w = w - step * min(1, 2 / (np.abs(step).max() + 1e-12))
        self.slope, self.shift = max(float(w[0]), 1e-3), float(w[1])

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Chance of toxic for each token."""
        if not len(e):
            return np.zeros(0)
        f, b, _ = self.passes(e, first)
        return f * b / (1 + f * b)


def tail(k: int, n: int, p: float) -> float:
    """Chance of k or more of n."""
    if not k:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(x - top) for x in logs)


def units(token: str) -> list[str]:
    w = token.lower()
    return [w, *(w[:n] + "*" for n in (4, 5, 6, 7, 8) if len(w) > n)]


def toxic_units(types: list[str], documents: list[np.ndarray], labels: list[int], share: float = 0.5, alpha: float = 0.05) -> set[str]:
    """Words and beginnings of words that toxic documents hold more often than chance allows.

    documents lists each document's distinct types, as positions in ``types``.
    """
    seen, toxic = Counter(), Counter()
    for own, y in zip(documents, labels):
        found = {u for t in own.tolist() for u in units(types[t])}
        seen.update(found)
        if y:
            toxic.update(found)
    p = min(max(sum(labels) / max(len(labels), 1), 1e-6), 1 - 1e-6)
    return {u for u, k in toxic.items() if k >= 3 and k >= share * seen[u] and tail(k, seen[u], p) * len(seen) < alpha}


def fit(rows: Iterator[tuple[str, int]], rounds: int = 30, rate: float = 0.25, decay: float = 1e-6) -> Field:
    """Fit the field to labelled documents (text, 0 or 1) by Adam steps on its log likelihood.

    Texts are read one after the other and kept as numbers of their tokens' types.
    """
    field = Field()
    order: dict[str, int] = {}
    parts, labels = [], []
    for text, y in rows:
        parts.append(np.fromiter((order.setdefault(t[0], len(order)) for t in TOKEN.finditer(text)), np.int32))
        labels.append(int(y))
    names = list(order)
    bad = toxic_units(names, [np.unique(x) for x in parts], labels)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    types = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    del parts, order
    n = len(types)
    if not n or not bad:
        field.slope, field.shift = 1e-3, math.log((sum(labels) + 0.5) / (len(labels) - sum(labels) + 1))
        return field
    is_bad = np.array([any(u in bad for u in units(t)) for t in names])
    y = is_bad[types] & np.repeat(np.array(labels, bool), sizes)
    first = np.zeros(n, bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    flat, count = array("H"), np.zeros(len(names), np.int32)
    for i, t in enumerate(names):
        own = token_features(t)
        count[i] = len(own)
        flat.extend(own)
    flat = np.frombuffer(flat, np.uint16)
    begin = np.cumsum(count) - count
    inner = np.flatnonzero(~first)
    seen = np.bincount(2 * y[inner - 1] + y[inner], minlength=4).reshape(2, 2) / n
    m, v = np.zeros(SLOTS + 6), np.zeros(SLOTS + 6)

    def emissions() -> np.ndarray:
        return (np.add.reduceat(field.weights.astype(np.float32)[flat], begin) + np.float32(field.bias))[types]

    for t in range(1, rounds + 1):
        f, b, x = field.passes(emissions(), first)
        q = f * b / (1 + f * b)
        a = np.exp(field.trans).astype(np.float32)
        r, c = f[inner - 1], x[inner] * b[inner]
        joint = [a[0, 0], a[0, 1] * c, a[1, 0] * r, a[1, 1] * r * c]
        total = joint[0] + joint[1] + joint[2] + joint[3]
        joint = np.array([float((z / total).sum(dtype=np.float64)) for z in joint]).reshape(2, 2) / n
        off = (q - y) / n
        by_type = np.bincount(types, weights=off, minlength=len(names)).astype(np.float32)
        slope = np.bincount(flat, weights=np.repeat(by_type, count), minlength=SLOTS)
        grad = np.r_[slope + decay * field.weights, off.sum(dtype=np.float64), off[first].sum(dtype=np.float64), (joint - seen).ravel()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        field.weights -= step[:SLOTS]
        field.bias -= step[SLOTS]
        field.start -= step[SLOTS + 1]
        field.trans -= step[SLOTS + 2 :].reshape(2, 2)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    field.calibrate(field.evidence(field.marginals(emissions(), first), doc, len(sizes)), np.array(labels, float))
    return field


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 29, max_bytes: int = MAX_BYTES) -> Field:
    """Fit on a bounded sample of labelled documents outside the held-out fold.

    About ``sample`` documents, one text each, of at most ``max_bytes``: longer ones are scored, but not learned from. So at
    most sample * max_bytes bytes of text reach the driver, whatever the table holds.
    """
    chosen = sample_ids(training_labels(labels, "toxic"), sample, seed)
    rows = docs.where(F.octet_length(text_or_empty()) <= max_bytes).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min(text_or_empty()).alias("text"))
    rows = sorted((r.doc_id, r.text, r.label) for r in rows.collect())
    return fit((text, int(label > 0)) for _, text, label in rows)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) for each row of docs.

    score is the chance that the whole text is toxic, predicted is 1 from ``threshold`` on, and
    spans lists (start, end) in code points of the tokens whose marginal reaches the threshold. Null and
    empty texts, and texts without letters or digits, have the score of a text without evidence and no spans. A null doc_id is not held out;
    labels with a null doc_id or label are not used; without toxic labels every score is that of clean text.
    A very long text is scored whole. Equal scores are equal texts' or chance, no order rests on them.
    Repeated rows give repeated results, an empty table gives an empty one; other columns are not read, whatever their names.
    """
    field = train(docs.select("doc_id", "text"), labels, sample, max_bytes=max_bytes)

    def part_of(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        split = [TOKEN.findall(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        emission = field.emission
        e = np.fromiter((emission(t) for tokens in split for t in tokens), float, n)
        first = np.zeros(n, bool)
        first[(ends - sizes)[sizes > 0]] = True
        q = field.marginals(e, first)
        doc = np.repeat(np.arange(len(texts)), sizes)
        score = field.score(field.evidence(q, doc, len(texts)))
        spans: list[list[dict]] = [[] for _ in texts]
        hot = defaultdict(set)
        for i in np.flatnonzero(q >= threshold).tolist():
            d = int(doc[i])
            hot[d].add(i - int(ends[d] - sizes[d]))
        for d, which in hot.items():
            spans[d] = [{"start": m.start(), "end": m.end()} for i, m in enumerate(TOKEN.finditer(texts[d])) if i in which]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([ids, pa.array(score, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            at, size, texts = 0, 0, []
            for i, t in enumerate(batch.column(1)):
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if size >= 2_000_000:
                    yield part_of(ids.slice(at, len(texts)), texts)
                    at, size, texts = i + 1, 0, []
            if texts:
                yield part_of(ids.slice(at, len(texts)), texts)

    schema = "doc_id long, score double, spans array<struct<start: long, end: long>>"
    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
