"""The queries of the quality classifier and the toxic-span field against plain versions, document by document."""

import math
import zlib

import numpy as np
import pytest

from skyledger.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r.doc_id: r.text or "" for r in docs.collect()}, {r.doc_id: r for r in labels.collect()}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_query_equals_the_scorer_text_by_text(spark, tables):
    docs, labels, texts, known = tables
    scorer = quality.train(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        x = quality.features(t)
        z = [max(-8.0, min(8.0, float(v))) for v in (x - scorer.mean) / scorer.scale]
        z += [abs(v) - 1 for v in z]
        want = 1 / (1 + math.exp(-max(-40.0, min(40.0, float(sum(a * b for a, b in zip(z, scorer.weights))) + scorer.bias))))
        assert got[d].score == pytest.approx(want, abs=1e-9) and got[d].held_out == held(d)
    fold = [d for d in known if held(d) and d in got and known[d].quality is not None]
    assert sum((got[d].score >= 0.3) == bool(known[d].quality) for d in fold) >= 0.9 * len(fold) > 0


def brute_field(field, text):
    """Document score and marginals by a forward and a backward pass in plain Python, tag by tag."""
    tokens = toxicity.TOKEN.findall(text)
    e = [sum(float(field.weights[f]) for f in toxicity.token_features(t)) + field.bias for t in tokens]
    trans = [[math.exp(max(-15.0, min(15.0, float(field.trans[i, j])))) for j in (0, 1)] for i in (0, 1)]
    own = [[1.0, math.exp(max(-30.0, min(30.0, x)))] for x in e]
    start = [1.0, math.exp(max(-15.0, min(15.0, field.start)))]
    ahead, back = [], [[1.0, 1.0]]
    for t, x in enumerate(own):
        row = [(start[j] if t == 0 else sum(ahead[-1][i] * trans[i][j] for i in (0, 1))) * x[j] for j in (0, 1)]
        ahead.append([v / sum(row) for v in row])
    for x in reversed(own[1:]):
        row = [sum(trans[i][j] * x[j] * back[0][j] for j in (0, 1)) for i in (0, 1)]
        back.insert(0, [v / sum(row) for v in row])
    q = [a[1] * b[1] / (a[0] * b[0] + a[1] * b[1]) for a, b in zip(ahead, back)] if tokens else []
    evidence = -sum(math.log1p(-min(x, 1 - 1e-6)) for x in q)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, field.slope * math.log(evidence + 0.01) + field.shift)))), q


def test_toxicity_query_equals_forward_backward_in_plain_python(spark, tables):
    docs, labels, texts, known = tables
    field = toxicity.train(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r for r in queries.op8_toxicity(spark, SF).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        score, q = brute_field(field, t)
        assert got[d].score == pytest.approx(score, abs=1e-6), d
        spans = [f"{m.start()}:{m.end()}" for m, x in zip(toxicity.TOKEN.finditer(t), q) if x >= 0.5 + 1e-9]
        assert set(spans) <= set((got[d].spans or "").split(",")) | {""} and got[d].predicted == int(got[d].score >= 0.5)
    fold = [d for d in known if held(d) and d in got and known[d].toxic is not None]
    assert sum(got[d].predicted == known[d].toxic for d in fold) >= 0.9 * len(fold) > 0


@pytest.mark.parametrize("name", ["op6_quality", "op8_toxicity"])
def test_labels_of_the_held_out_fold_change_nothing(spark, tables, name):
    docs, labels, *_ = tables
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.quality, 1 - r.toxic) if held(r.doc_id) else (r.doc_id, r.quality, r.toxic) for r in labels.collect()], "doc_id long, quality int, toxic int")
    score = {"op6_quality": quality.score_documents, "op8_toxicity": toxicity.score_documents}[name]
    a, b = ({r.doc_id: r.score for r in score(docs, x).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b, abs=1e-12)
