"""The pipeline and the registered queries against plain versions, on a small folder of tables with edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_operators import TEXTS, brute_base, brute_likeness, brute_print, brute_repeats, brute_sketch, components, words
from test_resemblance import kept_by_all_pairs

import corpus_pipeline
from skyledger.llm import line_dedup, mixing, pii, quality, queries
from skyledger.llm.common import documents, stage, table

#: Columns named like internal ones of some operators.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _lost string, _doc long, _copies int, _hash long, _k long, label int, id long, keys string"


def corpus():
    rng = random.Random(21)
    word = lambda: f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bdgklmnrst')}{rng.choice(['', 'a', 'en', 'is', 'or'])}"
    prose = lambda n: " ".join(word() for _ in range(n))
    licence = "Permission is hereby granted to use each of these files in full"
    rows = [(d, t) for d, t in TEXTS if d is not None and d != 17]
    rows += [(100 + i, f"{prose(60)}.\n{licence if i % 3 else licence.upper() + '  '}\n{prose(40)}.") for i in range(40)]
    rows += [(200 + i, "!!! ### " * (5 + i) + "zz" * i) for i in range(20)]
    base = [word() for _ in range(120)]
    rows += [(300 + i, " ".join(base[: 120 - 3 * i] + [word() for _ in range(3 * i)])) for i in range(12)]
    rows += [(400 + i, " ".join(base)) for i in range(5)] + [(500, prose(9000)), (501, None), (502, "")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = [(d, t, "en", None if d % 11 == 3 else f"s{d % 4}", len(t or ""), "x", 1, 2, 3, 4, 5, 6, "k") for d, t in corpus()]
    spark.createDataFrame(rows, CLASHING).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(d, 0 if 200 <= d < 220 else 1, int(d % 9 == 0)) for d, _ in corpus() if d % 2] + [(None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    rng = np.random.default_rng(5)
    v = rng.standard_normal((30, 8)).astype(np.float32)
    v[20:] = v[:10] + rng.standard_normal((10, 8)).astype(np.float32) * np.float32(0.05)
    vectors = [(i, [float(c) for c in x], 0) for i, x in enumerate(v)] + [(90, None, 1), (91, [0.0] * 8, 1), (92, [1.0, None] * 4, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return str(root)


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for t in ("documents", "labels", "embeddings"):
        table(spark, folder, t).limit(0).write.parquet(f"{root}/{t}.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    return str(root)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoder():
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})


def by_sql(sql, spark_rows, columns):
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(spark_rows, columns=columns).astype({"doc_id": "int64"}))
    return con.execute(sql)


def keep_lines(rows):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(d)
    gone = lambda d, x: len(holders.get(key(x), ())) >= 5 and d != max(holders[key(x)])
    return [(d, "\n".join(x for x in (t or "").split("\n") if not gone(d, x))) for d, t in rows]


def test_pipeline_against_plain_stages(spark, folder):
    docs, labels = documents(spark, folder), table(spark, folder, "labels")
    scorer = quality.train(docs.select("doc_id", "text"), labels)
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = [(d, t) for d, t in corpus() if scorer.score(np.array([quality.features(t or "")]))[0] >= 0.3]
    assert 60 < len(rows) < len(corpus())
    before = [("" if t is None else t) for _, t in rows]
    rows = keep_lines(rows)
    assert sum(a != t for a, (_, t) in zip(before, rows)) > 20
    kept = kept_by_all_pairs(rows)
    rows = [r for r in rows if r[0] in kept]
    taken = by_sql(mixing.ORACLE, [(d, t, source[d]) for d, t in rows], ["doc_id", "text", "source"]).fetchall()
    copies = {d: int(n / size + 0.5) if size else 0 for d, size, _, _, n in taken}
    enc = encoder()
    want = Counter()
    for d, t in rows:
        want[d, tuple(enc.encode_ordinary(t))] += copies[d]
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == +want and max(got.values()) > 1


def test_pipeline_stages_keep_columns_and_take_no_rows(spark, folder, empty):
    for root in (folder, empty):
        docs = documents(spark, root)
        for name, function in corpus_pipeline.STAGES[:-1]:
            before, docs = docs, stage(function(spark, docs, root), "test")
            assert docs.columns == before.columns and docs.schema == before.schema, name
    assert corpus_pipeline.run(spark, empty).count() == 0


def ordered(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_op1_query(spark, folder):
    rows = sorted(corpus())
    for (d, t), (_, after), r in zip(rows, rows[1:] + rows[:1], ordered(queries.op1_fingerprints(spark, folder))):
        t, after = t or "", after or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        text = lambda x: "".join(f"{h & (1 << 64) - 1:016x}" for h in brute_sketch(x))
        want = (d, len(t), sha(edited), text(t), text(edited), brute_likeness(t, edited), brute_likeness(t, after))
        assert tuple(r) == want


def test_op2_query(spark, folder):
    rows = sorted(corpus())
    prints = [brute_print(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = components(len(rows), near)
    want = [(d, f"{p:016x}", rows[k][0]) for (d, _), p, k in zip(rows, prints, root)]
    assert [tuple(r) for r in ordered(queries.op2_simhash(spark, folder))] == want


def test_op3_query(spark, folder):
    for (d, t), r in zip(sorted(corpus()), ordered(queries.op3_pii(spark, folder))):
        base = brute_base(t or "")
        assert r.doc_id == d and r.base_sha256 == sha(pii.joined(base))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(pii.joined(base).split(",")) <= set(r.spans.split(","))


def test_op4_query(spark, folder):
    rows = sorted(((r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()))
    v = np.array([x for _, x in rows if x and None not in x and any(x)], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    root = components(len(v), zip(*(x.tolist() for x in np.nonzero(near))))
    want = {i: (int(near[i].sum()), root[i], root[i] == i) for i in range(len(v))} | {i: (0, i, True) for i in (90, 91, 92)}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op4_embeddings(spark, folder).collect()} == want


def test_op5_query(spark, folder):
    enc = encoder()
    for (d, t), r in zip(sorted(corpus()), ordered(queries.op5_bpe(spark, folder))):
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        assert (r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) == (d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), sha(t or ""))


@pytest.mark.parametrize("name, least", [("op6_quality", 0.3), ("op8_toxicity", 0.5)])
def test_scoring_queries(spark, folder, name, least):
    got = ordered(queries.queries()[name](spark, folder))
    assert [r.doc_id for r in got] == sorted(d for d, _ in corpus())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    again = ordered(queries.queries()[name](spark, folder))
    assert [r.score for r in got] == [r.score for r in again]


def test_op7_query(spark, folder):
    want = [(d, (t or "").count("\n") + 1, (t or "").count("\n") - k.count("\n") if k or not t else (t or "").count("\n") + 1, sha(k)) for (d, t), (_, k) in zip(corpus(), keep_lines(corpus()))]
    got = {r.doc_id: (r.n_lines, r.kept_sha256) for r in queries.op7_line_dedup(spark, folder).collect()}
    assert got == {d: (n, s) for d, n, _, s in want}


def test_op9_query(spark, folder):
    want = [(d, n, gone, sha(kept)) for d, n, gone, kept in sorted(brute_repeats(corpus()))]
    assert [tuple(r) for r in ordered(queries.op9_substrings(spark, folder))] == want


def test_op10_query(spark, folder):
    rows = [(r.doc_id, r.text, r.source) for r in documents(spark, folder).collect()]
    want = by_sql(mixing.ORACLE, rows, ["doc_id", "text", "source"]).fetchall()
    got = [tuple(r) for r in queries.op10_mixing(spark, folder).collect()]
    assert sorted((d, s, z, round(t, 6), n) for d, s, z, t, n in got) == sorted((d, s, z, round(t, 6), n) for d, s, z, t, n in want)
    assert all(n <= 3 * s for _, s, _, _, n in got) and sum(len(words(t)) for _, t, _ in rows) == sum(s for _, s, *_ in got)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_take_no_rows(spark, empty, name):
    assert queries.queries()[name](spark, empty).count() == 0


def test_every_operator_is_registered_once():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert names == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_the_risk_of_positive_unlabelled_learning():
    """Loss and slope of the non-negative estimate, against numbers: the steps of fit lower it, and follow its slope."""
    rng = np.random.default_rng(2)
    positive, other = rng.normal(1, 1, (300, quality.N_FEATURES)), rng.normal(-1, 1, (300, quality.N_FEATURES))
    unlabelled = np.concatenate([rng.normal(1, 1, (120, quality.N_FEATURES)), other])
    prior = 120 / 420

    def risk(s):
        g = lambda x: quality.Scorer.wide(x, s.mean, s.scale) @ s.weights + s.bias
        soft = lambda z: np.logaddexp(0, z)
        negative = soft(g(unlabelled)).mean() - prior * soft(g(positive)).mean()
        return prior * soft(-g(positive)).mean() + max(0.0, negative)

    risks = [risk(quality.fit(positive, unlabelled, prior, rounds=n)) for n in (0, 1, 20, 200)]
    assert abs(risks[0] - np.log(2)) < 1e-12 and risks[0] > risks[1] > risks[2] > risks[3]
    # The first step of Adam is the sign of the slope, times the rate.
    first, none = (quality.fit(positive, unlabelled, prior, rounds=n) for n in (1, 0))
    for i in range(0, 2 * quality.N_FEATURES, 5):
        up, down = (quality.Scorer(none.mean, none.scale, none.weights + e * np.eye(2 * quality.N_FEATURES)[i], none.bias) for e in (1e-5, -1e-5))
        slope = (risk(up) - risk(down)) / 2e-5
        assert abs(first.weights[i] + 0.05 * np.sign(slope)) < 1e-3 or abs(slope) < 1e-4
    fitted = quality.fit(positive, unlabelled, prior)
    assert fitted.score(positive).mean() > 0.8 and fitted.score(other).mean() < 0.2
