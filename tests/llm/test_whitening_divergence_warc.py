"""Whitening, the divergence audit and WARC archives: brute force, SQL and edge cases."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import divergence, warc, whitening

# 11 ---------------------------------------------------------------------------------------------------------


def brute_whitening(rows, most=8):
    """{vec_id: (deviation, whitened)} up to the sign of each component, and the shares explained."""
    good = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = n * x - s
    a = y.astype(np.float64) / n
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return {k: (int((d * d).sum()), w) for (k, _), d, w in zip(good, y, a @ u / np.sqrt(e))}, e / ((a * a).sum() / n)


def check_whitening(got, rows, most=8, tolerance=1e-8):
    want, explained = brute_whitening(rows, most)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(want)
    signs = np.sign(sum(np.array([by[k][c].whitened for c in sorted(by[k])]) * want[k][1] for k in want))
    for k, (deviation, white) in want.items():
        mine = [by[k][c] for c in sorted(by[k])]
        assert [r.component for r in mine] == list(range(1, len(white) + 1))
        assert {int(r.deviation) for r in mine} == {deviation} and {r.n for r in mine} == {len(want)}
        assert np.allclose([r.whitened for r in mine], white * signs, atol=tolerance)
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-9) and max(r.identity_error for r in mine) < 1e-9


def test_whitening_equals_an_eigendecomposition(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    rows += [(-1, None), (-2, [None, *rows[0][1][1:]]), (-3, [float("nan"), *rows[0][1][1:]]), (-4, [float("inf"), *rows[0][1][1:]])]
    given = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, whitened string").repartition(7)
    check_whitening(whitening.whiten(given).collect(), rows)


def test_whitening_of_columns_that_nearly_depend_on_one_another(spark):
    """Condition number about 10^6, and more rows a batch than a block."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((9_000, 4)) * np.array([1e3, 10, 1, 1e-1])
    rows = [(i, [*map(float, v), float(v[0] + 0.01 * rng.standard_normal())]) for i, v in enumerate(base)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2)
    check_whitening(whitening.whiten(given, components=5).collect(), rows, 5, 1e-5)
    space = next(iter(whitening.fitted(given, components=5).values()))
    assert 2 <= len(space.factors) < whitening.ROUNDS


def test_whitening_of_dependent_columns_has_as_many_components_as_they_span(spark):
    rows = [(i, [float(i % 7), float(i % 5), float(i % 7 + i % 5), 3.0]) for i in range(200)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 400 and max(r.identity_error for r in got) < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None), (4, [None])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []
    rows = [(None, [1.0, 2.0, 3.0]), (2, [1.0, 2.5, 1e300]), (2, [0.0, 0.0, 0.0]), (5, [1.0]), (6, [4.0])]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.vec_id), r.n) for r in got if r.component == 1) == [("2", 3), ("2", 3), ("5", 2), ("6", 2), ("None", 3)]
    assert all(np.isfinite(r.whitened) for r in got)


# 12 ---------------------------------------------------------------------------------------------------------


def sql_audit(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    if rows:
        con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    return Counter(con.execute(divergence.ORACLE).fetchall())


def planted_documents():
    rng = np.random.default_rng(7)
    words = [f"term{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(400)] + ["Ünï", "ẞtraße", "ÉTÉ", "été", "的", "x", "X"]
    rows = []
    for i in range(240):
        pick = rng.zipf(1.3, rng.integers(1, 60)) % len(words)
        source = None if i % 29 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(words[int(w)] for w in pick) + f" 12 only{chr(97 + i % 26)}_a-b", None if i % 31 == 0 else ["en", "de", "fr"][i % 3], source))
    return rows + [(900, None, "en", "bare"), (901, "", "xx", "lone"), (901, "1 2 3", "yy", "a"), (902, "solo", "yy", "b"), (None, "été ÉTÉ", "en", "s1"), (903, "word " * 5000, "en", "")]


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_sql(spark, monkeypatch, small):
    if small:  # units, blocks, pieces and merges of skybands that planted rows are too few for
        for name, value in {"BLOCK": 2, "UNIT": 50, "MERGED": 60, "PIECE": 16, "HELD": 20}.items():
            monkeypatch.setattr(divergence, name, value)
    rows = planted_documents()
    docs = spark.createDataFrame([(*r, 7, "clash") for r in rows], "doc_id long, text string, lang string, source string, value int, term string").repartition(5)
    got = Counter(tuple(r) for r in divergence.audit_sources(docs).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == sql_audit(rows) and any(k[2] == "term" for k in got)


def test_divergence_of_nothing(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []


@pytest.mark.parametrize("k", [1, 3, 20])
def test_skyband_is_what_fewer_than_k_dominate(k):
    rng = np.random.default_rng(k)
    n, total = rng.integers(1, 30, 1500), rng.integers(1, 60, 1500)
    term = np.array([f"t{i:04d}" for i in rng.permutation(1500)], dtype=object)
    by = (n >= n[:, None]) & (total <= total[:, None]) & (term < term[:, None])
    assert sorted(divergence.skyband(n, total, term, k)) == np.flatnonzero(by.sum(axis=1) < k).tolist()


# 13 ---------------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, captured string"


def planted_pages():
    rows = [(i, f"http://www.h{i % 3}.example.com/{i % 4}?q={i}", "hot page" if i % 3 else f"\r\n\r\nWARC/1.1\r\n{i % 5}", "clash") for i in range(300)]
    return rows + [(None, None, None, ""), (3, "x\r\ny", "solo", ""), (3, "x", "solo", ""), (None, "http://[bad", "hot page", ""), (9, "", "ü" * 10, ""), (950, "http://a.b/", "", ""), (951, "http://a.b/", "z" * 300_000, "")]


def sql_captures(rows):
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar, captured varchar)")
    if rows:
        con.executemany("insert into pages values (?, ?, ?, ?)", rows)
    return Counter(con.execute(warc.ORACLE).fetchall())


def test_warc_round_trip(spark, monkeypatch):
    for name, value in {"MERGE_ROWS": 7, "ARCHIVE_BYTES": 3000, "VERY_COMMON": 2}.items():
        monkeypatch.setattr(warc, name, value)
    rows = planted_pages()
    index = warc.archive_and_index(spark.createDataFrame(rows, PAGES).repartition(5)).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index)
    assert got == sql_captures(rows)
    assert [warc.order(r) for r in index] == sorted(warc.order(r) for r in index) and len({r.archive for r in index}) > 5
    assert {r.url for r in index if r.page_id == 3} >= {"x%0D%0Ay", "x"}


def test_warc_archives_hold_what_the_index_says(spark, tmp_path):
    import gzip

    rows = planted_pages()
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "w"))
    runs = warc.read_captures(spark, str(tmp_path / "w")).collect()
    text = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None and r[0] != 3}
    for r in runs:
        raw = gzip.decompress((tmp_path / "w" / r.archive).read_bytes())[r.offset : r.offset + r.length]
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        if r.record_type == "response" and r.page_id in text:
            assert raw[:-4].endswith(b"\r\n\r\n" + text[r.page_id])


def test_warc_times_minimum_and_nothing(spark):
    rows = [(1, "http://a.example/", "same", "2020-02-03 04:05:06"), (2, "http://a.example/", "same", "2019-01-01 00:00:00"), (3, "http://b.example/", "longer payload", None), (4, "http://c.example/", "longer payload", None)]
    got = warc.archive_and_index(spark.createDataFrame(rows, PAGES), min_bytes=5, when="captured").collect()
    assert [(r.page_id, r.captured, r.record_type, r.refers_to) for r in got] == [
        (2, "20190101000000", "response", None),
        (1, "20200203040506", "response", None),
        (3, "20240101000000", "revisit", 4),
        (4, "20240101000000", "response", None),
    ]
    assert warc.archive_and_index(spark.createDataFrame([], PAGES)).collect() == []


def test_a_broken_archive_raises():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [(at, n) for at, n, *_ in warc.records(good * 2)] == [(0, len(good)), (len(good), len(good))]
    for bad in (good[1:], good[:-1], good.replace(b"3", b"4")):
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_loser_tree_merges_any_number_of_runs():
    rng = np.random.default_rng(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(((str(rng.integers(9)), str(rng.integers(9)), int(i), None, "", 0, "", None, f"r{j}", int(i)) for i in range(rng.integers(0, 30))), key=warc.order) for j in range(k)]
        assert list(warc.LoserTree(runs)) == sorted((r for run in runs for r in run), key=warc.order)


# all --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_divergence", "op13_warc"])
def test_queries_equal_sql(spark, sf_dir, name):
    from skyledger.llm import queries

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.fetchall())


def test_whitening_query_has_a_row_for_each_vector_and_component(spark, sf_dir):
    from skyledger.llm import queries

    got = queries.queries()["op11_whitening"](spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert got.groupBy("component").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") == vectors).count() == 8
