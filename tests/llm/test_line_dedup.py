"""Line dedup on texts of many lines, null ids and runs in buckets."""

import time
from collections import Counter

from skyledger.llm import line_dedup

LONG = "this line is long enough to be a key of its own, number {}"


def test_a_text_of_a_hundred_thousand_lost_lines_takes_seconds():
    lines = [LONG.format(i) for i in range(100_000)]
    gone = [line_dedup.hashlib.md5(x.encode()).digest() for x in lines[::2]]
    began = time.process_time()
    kept = line_dedup.kept_lines("\n".join(lines), gone, 40)
    assert time.process_time() - began < 5 and kept.split("\n") == lines[1::2]
    assert line_dedup.kept_lines("\n".join(lines[::2]), gone, 40) is None


def test_texts_of_many_lines_and_rows_without_id(spark):
    many = "\n".join(LONG.format(i) for i in range(3000))
    rows = [(i, many + f"\nshort {i}") for i in range(5)] + [(None, many), (None, f"{LONG.format(1)}\n\n{LONG.format('x')}"), (None, LONG.format("x")), (7, LONG.format("x") + "\n"), (8, LONG.format("x")), (9, f"\n {LONG.format('x').upper()}\t")]
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    # 5 documents and the one without id have the many lines; "x" is in 7, 8, 9 and the one without id: four only.
    want = Counter((i, 3001, 3000 if i < 4 else 0, f"short {i}" if i < 4 else many + "\nshort 4") for i in range(5))
    want += Counter([(None, 3000, 3000, ""), (None, 3, 1, f"\n{LONG.format('x')}"), (None, 1, 0, LONG.format("x"))])
    want += Counter([(7, 2, 0, LONG.format("x") + "\n"), (8, 1, 0, LONG.format("x")), (9, 2, 0, f"\n {LONG.format('x').upper()}\t")])
    assert got == want


def test_rows_without_id_count_as_one_document(spark):
    rows = [(None, LONG.format("y") + f"\n{i}") for i in range(9)] + [(i, LONG.format("y")) for i in range(3)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.n_dropped for r in got} == {0}
    got = line_dedup.dedup_lines(spark.createDataFrame([*rows, (3, LONG.format("y"))], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_dropped) for r in got) == [(False, 0, 1), (False, 1, 1), (False, 2, 1), (False, 3, 0)] + [(True, 0, 1)] * 9


def test_runs_are_read_bucket_by_bucket(spark):
    runs = line_dedup.LineRuns(spark, fanout=3, buckets=6)
    batch = lambda lo, hi: spark.range(lo, hi).selectExpr("cast(md5(cast(id % 50 as string)) as binary) as digest", "id as doc_id")
    try:
        for k in range(4):
            runs.add(batch(100 * k, 100 * k + 40 + 20 * k))
        plan = runs.runs[0].join(spark.range(9).selectExpr("cast(md5(cast(id as string)) as binary) as digest").repartition(6, "digest"), "digest", "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") <= 1  # the run is not shuffled
        assert sum(r.count() for r in runs.runs) == 50
        assert sum(r.n_docs for r in runs.frequent(1).collect()) == 280
    finally:
        runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
