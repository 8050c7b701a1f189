"""The pipeline's near-copy stage against a comparison of all pairs of texts."""

import itertools
import random

import corpus_pipeline
import numpy as np

from skyledger.llm import resemblance


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_by_all_pairs(rows):
    sets = [shingles(t) for _, t in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if 5 * both >= 4 * all_:
            of[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {d for i, (d, _) in enumerate(rows) if d is None or least[root(i)] == d}


def planted():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    common = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(120)]
        texts += [base, [w.upper() for w in base], base + common]
        # Other last words: resemblances from under 0.7 to over 0.95, and edits inside.
        texts += [base[:-k] + [word() for _ in range(k)] for k in range(2, 26, 2)]
        texts += [[word() if i in at else w for i, w in enumerate(base)] for at in (rng.sample(range(120), n) for n in (1, 2, 3, 4, 6))]
    # A hot group, exactly 0.8 (8 shared shingles of 10), just under, and short texts.
    hot = [word() for _ in range(200)]
    texts += [hot[:i] + [word()] + hot[i + 1 :] for i in range(0, 200, 4)]
    edge = [f"e{i}" for i in range(14)]
    texts += [edge[:13], edge[1:], [f"f{i}" for i in range(12)], [f"f{i}" for i in range(1, 13)], [f"f{i}" for i in range(3, 15)]]
    texts += [["one"], ["one", "two"], ["One"], [], []]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return [*rows, (None, rows[5][1]), (len(rows), None)]


def test_near_copies_are_those_that_all_pairs_find(spark, sf_dir):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).select("doc_id").collect()]
    want = kept_by_all_pairs(rows)
    assert len(got) == len(want) and set(got) == want


def test_no_rows(spark, sf_dir):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert corpus_pipeline.drop_near_copies(spark, docs, sf_dir).count() == 0


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(5)
    for n, d in ((0, 0), (1, 1), (40, 3), (150, 32), (150, 0), (5000, 900)):
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.union1d(a[d:], rng.integers(0, 1 << 64, d // 2, dtype=np.uint64))
        apart = sum(int(x).bit_count() for x in resemblance.parity(a) ^ resemblance.parity(b))
        assert apart <= len(np.setxor1d(a, b))


def test_crowded_shingles_are_compared_part_by_part(spark, monkeypatch):
    """Parts of three texts: most pairs of a shingle lie in two parts, and prefixes of crowded buckets are salted."""
    calls = []
    across = resemblance.pairs_across
    monkeypatch.setattr(resemblance, "PART", 3)
    monkeypatch.setattr(resemblance, "pairs_across", lambda rows: calls.append(rows.agg({"parts": "max"}).first()[0]) or across(rows))
    rng = random.Random(5)
    rows, common = planted(), [f"c{i}" for i in range(60)]
    # Texts that share a template and differ in the rest: one shingle has them all, few pairs are alike enough.
    for _ in range(40):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([5, 12, 14, 16, 30]))]
        rows.append((len(rows) + 1000, " ".join(common + own)))
        rows.append((len(rows) + 1000, " ".join(common + own[:-2] + ["x", "y"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in resemblance.one_of_each(docs).collect()}
    assert got == kept_by_all_pairs(rows) and calls and calls[0] > 1


def test_whole_sets_are_made_for_pairs_that_link_only(spark, monkeypatch):
    """Long texts of common blocks share first shingles, and 512 bits of parity allow all their pairs."""
    rng = random.Random(5)
    blocks = [" ".join(rng.choice("abcdefghij") * 2 + str(rng.randrange(10**6)) for _ in range(100)) for _ in range(40)]
    texts = [" ".join(rng.sample(blocks, 24)) for _ in range(24)]
    texts += [texts[3] + " one more word", texts[7] + " another word"]
    made, stage = {}, resemblance.stage

    def counted(df, name, *more):
        out = stage(df, name, *more)
        made[name] = made.get(name, 0) + (out.count() if name in ("candidate-sets", "candidate-parities") else 0)
        return out

    monkeypatch.setattr(resemblance, "stage", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in resemblance.alike_groups(docs).collect()}
    assert got == {i: {24: 3, 25: 7}.get(i, i) for i in range(26)}
    assert made["candidate-parities"] > 20 and made["candidate-sets"] <= 8


def test_fine_parities_never_tell_more_than_sets_differ():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 900, 1100, 5000):
        pool = np.unique(rng.integers(0, 1 << 63, 3 * n + 40, dtype=np.uint64))
        for other in (n, n + 1, n + n // 5, 2 * n):
            a, b = np.sort(pool[:n]), np.sort(pool[n // 9 : n // 9 + other])
            apart = resemblance.parities_apart(resemblance.fine_parity(a), resemblance.fine_parity(b))
            assert apart <= len(np.setxor1d(a, b))
