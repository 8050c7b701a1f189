"""Every operator against a brute-force version, on planted rows and on edge cases."""

import hashlib
import json
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash

from skyledger.llm import bpe, common, embeddings, line_dedup, mixing, pii, quality, recompress, simhash, sketch, toxicity
from skyledger.llm.common import connected_components

LINE = "This line of the licence stands in every one of the files here"
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    (0, "alpha beta gamma delta epsilon zeta eta theta"),
    (1, None),
    (2, ""),
    (3, "one"),
    (4, f"{LINE}\nbody a\n{LINE.upper()}  "),
    (5, f" {LINE}\nbody b"),
    (6, f"{LINE}\t\nbody c\n"),
    (7, f"{LINE}\r\nbody d"),
    (8, f"{LINE}\nbody e\n\n{LINE}"),
    (9, "x " * 3000 + PASSAGE + " tail"),
    (10, f"head {PASSAGE} y z"),
    (11, f"{PASSAGE}"),
    (12, "a a a a a a a a a a a a a a a a a a a a"),
    (13, "b a a a a a a a a a a a a a a a a"),
    (14, " ".join(f"w{i}" for i in range(200))),
    (15, " ".join(f"w{i}" for i in range(200))),
    (16, " ".join(f"w{i}" for i in range(200)) + " extra"),
    (17, "ünïcödé " * 30 + " nbsp em"),
    (17, "a row that repeats a doc_id with another text"),
    (18, "mail john@example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (555) 010-9999"),
    (None, "a document without an id, alpha beta gamma"),
    (None, None),
]
SCHEMA = "doc_id long, text string, source string, size long, component_id long, taken long"


def rows_of(texts):
    return [(d, t, None if i % 7 == 3 else f"src{i % 4}", i, -1, None) for i, (d, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(d, int(d % 3 > 0), int(d % 5 == 0)) for d in range(16)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def key(row):
    return tuple((x is not None, x) for x in row)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 1 ----------------------------------------------------------------------------------------------------------


def brute_sketch(text):
    """XXH64 with seed 42 of each word, chained over the words of a shingle, those in the lowest part kept."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    out = set()
    for i in range(max(1, len(h) - 4)) if h else ():
        seed = 42
        for x in h[i : i + 5]:
            seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
        signed = seed - (1 << 64) if seed >> 63 else seed
        if signed < -(1 << 63) + (1 << 64) // sketch.SCALE:
            out.add(signed)
    return sorted(out)


def brute_likeness(a, b):
    x, y = set(brute_sketch(a)), set(brute_sketch(b))
    return len(x & y) / len(x | y) if x | y else 1.0  # equal fingerprints


def test_sketch_of_a_union_is_the_union_of_sketches(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    short, long = ([" ".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n)] for n in (3, 400))
    of = lambda shingles: set().union(*(r.s for r in spark.createDataFrame([(x,) for x in shingles], "t string").select(sketch.sketch(F.col("t")).alias("s")).collect()))
    assert of(short) | of(long) == of(short + long) and of(long) < of(short + long) or of(short) <= of(long)


def test_sketches_without_ids(spark):
    rows = [(None, f"text {i} of those without an id") for i in range(40)] + [(4, "the fourth one"), (9, "the ninth one")]
    got = sketch.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == 42
    for r in got:
        following = {None: "the fourth one", 4: "the ninth one"}.get(r.doc_id)
        if following:
            cut = len(r.text) // 4
            assert r.edited == r.text[: len(r.text) - cut] + following[:cut]


def test_sketches(docs, nothing):
    unique = docs.where("doc_id is not null and text is not null and not (doc_id = 17 and text like 'a row%')")
    got = {r.doc_id: r for r in sketch.fingerprint_documents(unique).collect()}
    order = sorted(got)
    text = {d: t for d, t in TEXTS if d in got and not (t or "").startswith("a row")}
    for i, d in enumerate(order):
        t, following = text[d], text[order[(i + 1) % len(order)]]
        cut = len(t) // 4
        assert got[d].edited == t[: len(t) - cut] + following[:cut]
        assert got[d].next_sketch == got[order[(i + 1) % len(order)]].sketch
        assert got[d].sketch == brute_sketch(t) and got[d].edited_sketch == brute_sketch(got[d].edited)
        assert got[d].near_edited == brute_likeness(t, got[d].edited) and got[d].near_next == brute_likeness(t, following)
    assert got[14].sketch == got[15].sketch
    assert sketch.fingerprint_documents(docs).count() == len(TEXTS)
    assert sketch.fingerprint_documents(nothing).count() == 0
    one = sketch.fingerprint_documents(docs.where("doc_id = 14")).first()
    assert one.next_sketch == one.sketch


def test_sketch_keeps_the_fraction_and_estimates(spark):
    from pyspark.sql import functions as F

    a = " ".join(f"t{i}" for i in range(4000))
    b = " ".join(f"t{i}" for i in range(2000, 6000))
    r = (
        spark.createDataFrame([(a, b)], "a string, b string")
        .select(sketch.sketch(F.col("a")).alias("a"), sketch.sketch(F.col("b")).alias("b"))
        .select("a", sketch.likeness(F.col("a"), F.col("b")).alias("l"), sketch.containment(F.col("a"), F.col("b")).alias("c"))
        .first()
    )
    assert abs(len(r.a) - 3996 / sketch.SCALE) < 80
    assert abs(r.l - 1 / 3) < 0.07 and abs(r.c - 0.5) < 0.08


# 2 ----------------------------------------------------------------------------------------------------------


def brute_print(text, k=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash(docs, nothing):
    named = docs.where("doc_id is not null")
    rows = sorted((r.doc_id, r.text or "") for r in named.collect())
    prints = [brute_print(t) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = components(len(rows), linked)
    want = sorted((d, p, rows[r][0]) for (d, _), p, r in zip(rows, prints, root))
    got = sorted((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_groups(named).collect())
    assert got == want
    assert simhash.near_groups(docs).count() == len(TEXTS)
    assert simhash.near_groups(nothing).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, c in want if d == c} | {None}


def test_trie_join_finds_what_all_pairs_find():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    parts = [base]
    for k in range(1, 6):
        x = np.repeat(base[:40], 6)
        for _ in range(k):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
        parts.append(x)
    p = np.unique(np.concatenate(parts))
    want = components(len(p), zip(*(x.tolist() for x in np.nonzero(np.tril(np.bitwise_count(p[:, None] ^ p[None, :]) <= 3, -1)))))
    forest = simhash.Forest(len(p))
    for quarter in range(4):
        own = np.sort(simhash.rotated(p, quarter))
        a, b = (np.searchsorted(p, simhash.rotated(own[x], (4 - quarter) % 4)) for x in simhash.trie_links(own, 3))
        forest.union(a, b)
    assert forest.roots().tolist() == want


@pytest.mark.parametrize("split", [4, 60])
def test_crowded_nodes_are_cut_and_lose_no_link(spark, split):
    rng = np.random.default_rng(split)
    top = rng.integers(0, 1 << 16, 4)
    p = {int(top[i % 4]) << 48 | int(x) for i, x in enumerate(rng.integers(0, 1 << 18, 300))}
    p |= {x ^ (1 << int(b)) ^ (1 << int(c)) for x in list(p)[:120] for b, c in rng.integers(0, 64, (2, 2))}
    p = np.array(sorted(p), np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= 3
    want = components(len(p), zip(*(v.tolist() for v in np.nonzero(near))))
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fingerprint long").repartition(3)
    at = {int(x): i for i, x in enumerate(p.view(np.int64))}
    links = [(at[r.a], at[r.b]) for r in simhash.links(df, split=split).collect()]
    assert all(near[i, j] for i, j in links) or components(len(p), links) == want
    assert components(len(p), links) == want and len(set(want)) > 10


@pytest.mark.parametrize("hubs", [1, 40, 20_000])
def test_components(spark, monkeypatch, hubs):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 560)] + [(7, 7), (None, 3)]
    links += [(450, i) for i in range(401, 480)]  # a hub in the middle of its ids
    monkeypatch.setattr(common, "HUBS", hubs)
    want = components(600, [x for x in links if None not in x])
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(600))


# 3 ----------------------------------------------------------------------------------------------------------

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_personal_data_base_rules():
    rng = np.random.default_rng(3)
    for alphabet, n in (("aB1.@+-% ()4", 40), ("123. -+", 60), ("a@.", 12)):
        for _ in range(4000):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, n)))
            assert pii.spans_of(text)[0] == brute_base(text), text


def test_personal_data_disguises():
    cases = {
        "write to john.smith (at) example [dot] com now": ("email", "john.smith (at) example [dot] com"),
        "or john at example dot com": ("email", "john at example dot com"),
        "call plus one two three four five six seven eight nine zero now": ("phone", "plus one two three four five six seven eight nine zero"),
        "јоhn@ехample.com": ("email", "јоhn@ехample.com"),
        "card ４１１１１１１１１１１１１１１１!": ("card", "４１１１１１１１１１１１１１１１"),
        "jo​hn@example.com": ("email", "jo​hn@example.com"),
    }
    cases |= {
        "ask john at example.com for it": ("email", "john at example.com"),
        "ask John At Example Dot Com": ("email", "John At Example Dot Com"),
        "ask john dot smith at example dot com": ("email", "john dot smith at example dot com"),
        "to j\U0001d428hn@ex\U0001d41ample.com!": ("email", "j\U0001d428hn@ex\U0001d41ample.com"),
        "at 10 dot 0 dot 0 dot 1 it": ("ip", "10 dot 0 dot 0 dot 1"),
        "at 192[.]168[.]0[.]1": ("ip", "192[.]168[.]0[.]1"),
        "at \u09e7\u09e6.\u09e6.\u09e6.\u09e7 it": ("ip", "\u09e7\u09e6.\u09e6.\u09e6.\u09e7"),
        "card 4 one 1 one 1111 1111 one one one one": ("card", "4 one 1 one 1111 1111 one one one one"),
        "to john[@]example[.]com": ("email", "john[@]example[.]com"),
    }
    for text, (kind, piece) in cases.items():
        assert (kind, text.index(piece), text.index(piece) + len(piece)) in pii.spans_of(text)[1], text
    for text in ("we met at home. dot the i", "look at word.word", "one or two or three", "stone bone phone alone", "visit us at example.com", "available at shop.com", "see page one 2 three", "[.] (at) {dot}", "5 at 10.30 point 2"):
        assert pii.spans_of(text) == ([], [])


def test_personal_data_is_linear_and_whole(docs, nothing):
    long = "a1." * 300_000 + " x@y.zz " + "9" * 300_000
    assert ("email", 900_001, 900_007) in pii.spans_of(long)[0]
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(TEXTS)
    found = next(r for r in rows if r.doc_id == 18)
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 1, 1, 1)
    assert found.base_sha256 == hashlib.sha256(pii.joined(brute_base(dict(TEXTS)[18])).encode()).hexdigest()
    assert pii.find_personal_data(nothing).count() == 0


# 4 ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("part", [2000, 7])
def test_embeddings(spark, part):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((40, 16))
    vectors = [v.tolist() for v in base]
    vectors += [(base[0] + rng.standard_normal(16) * 0.05).tolist() for _ in range(30)]
    vectors += [base[1].tolist()] * 12 + [(2 * base[1]).tolist()]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [1.0] * 8]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    root = components(len(x), zip(*(v.tolist() for v in np.nonzero(near))))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embeddings.near_groups(df, part=part).collect()}
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == root
    assert all(got[1000 + i].n_links == 0 and got[1000 + i].kept for i in range(len(odd)))
    assert embeddings.near_groups(df.limit(0)).count() == 0


def test_embedding_hashes_do_not_depend_on_the_batch():
    rng = np.random.default_rng(13)
    raw = [embeddings.packed(v) for v in rng.standard_normal((301, 48)).astype(np.float32).astype(float)]
    assert len(raw[0]) == 1 + 4 * 48 and len(embeddings.packed(rng.standard_normal(48))) == 2 + 8 * 48
    unit = embeddings.units(raw)
    whole = embeddings.buckets(unit, 9, 40, embeddings.CELL, 1)
    for size in (1, 2, 7, 64):
        parts = [embeddings.buckets(unit[i : i + size], 9, 40, embeddings.CELL, 1) for i in range(0, len(unit), size)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_embedding_setting_follows_the_number_of_vectors():
    widths, tables = zip(*(embeddings.setting_for(n) for n in (0, 1, 100, 10_000, 10**6, 10**9)))
    assert list(widths) == sorted(widths) and list(tables) == sorted(tables)
    for n in (10_000, 10**9):
        width, count = embeddings.setting_for(n)
        assert n * embeddings.APART**width <= embeddings.CROWD and (1 - embeddings.TOGETHER**width) ** count <= embeddings.MISS
    # The two chances, measured.
    rng = np.random.default_rng(14)
    a = rng.standard_normal((300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((300, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    one, near, far = (embeddings.buckets(x, 1, 200, embeddings.CELL, 3) for x in (a, b, side))
    assert abs((one == near).mean() - embeddings.TOGETHER) < 0.02 and abs((one == far).mean() - embeddings.APART) < 0.02


def test_planted_pairs_near_the_threshold_are_found(spark):
    """2,000 pairs of cosine 0.95 to 0.97 among 6,000 vectors, against all pairs: recall over 0.99, no link below 0.95."""
    rng = np.random.default_rng(17)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((2000, 64))
    side -= (side * a[:2000]).sum(axis=1, keepdims=True) * a[:2000]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.97, (2000, 1))
    x = np.concatenate([a, c * a[:2000] + np.sqrt(1 - c * c) * side])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    assert want.sum() >= 4000
    got = {r.vec_id: r for r in embeddings.near_groups(df).collect()}
    assert all(got[i].n_links <= want[i] for i in range(len(x)))
    assert sum(r.n_links for r in got.values()) >= 0.99 * want.sum()
    assert sum(got[4000 + i].component_id == i for i in range(2000)) >= 1980


def test_near_pairs_of_cells_are_those_of_all_pairs():
    rng = np.random.default_rng(18)
    size = np.array([2, 1, 3, 64, 65, 700, 2, 3])
    unit = rng.standard_normal((size.sum(), 3))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cell = np.repeat(np.arange(len(size)), size)
    want = {(i, j) for i, j in zip(*np.nonzero((unit @ unit.T >= 0.9) & (cell[:, None] == cell))) if i < j}
    got = [(i, j) for a, b in embeddings.near_pairs(unit, size, 0.9) for i, j in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want


def test_embeddings_of_single_and_double_precision_link(spark):
    v = [float(np.float32(x)) for x in (0.1, 0.2, 0.3)]
    rows = [(1, v), (2, [0.1, 0.2, 0.3]), (3, [-x for x in v])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


# 5 ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_round_trip(docs, nothing, ranks):
    enc = bpe.encoding(*ranks)
    rows = bpe.encode_documents(docs, *ranks).collect()
    want = sorted(((d, enc.encode_ordinary(t or "")) for d, t in TEXTS), key=lambda r: key((r[0],)) + (tuple(r[1]),))
    assert sorted(((r.doc_id, r.ids) for r in rows), key=lambda r: key((r[0],)) + (tuple(r[1]),)) == want
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(enc.decode_bytes(r.ids)).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(r.ids)
    assert bpe.encode_documents(nothing, *ranks).count() == 0


def test_bpe_chunks_change_nothing(ranks, monkeypatch):
    enc = bpe.encoding(*ranks)
    monkeypatch.setattr(bpe, "LONG_SPACE", 9)
    monkeypatch.setattr(bpe, "_SPACES", re.compile(r"\s{9,}"))
    rng = np.random.default_rng(4)
    pieces = ["don't ", "it's", " ", "  ", "\n\n", " " * 12, "\t" * 10, "12", "é", "猫", "!", "...", "word", "'ll", " " * 9 + "x", " "]
    for _ in range(600):
        text = "".join(rng.choice(pieces, rng.integers(1, 60)))
        parts = list(bpe.chunks(text, 10))
        assert "".join(p for p, _ in parts) == text
        got = [i for p, whole in parts for i in (enc._core_bpe.encode_single_piece(p.encode()) if whole else enc.encode_ordinary(p))]
        assert got == enc.encode_ordinary(text), text


# 6, 8 -------------------------------------------------------------------------------------------------------


def test_folds(spark):
    from skyledger.llm.learning import fold

    got = {r.doc_id: r.f for r in spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", fold().alias("f")).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 5 for d in range(50)}


def made_corpus(spark):
    rng = np.random.default_rng(8)
    vocabulary = np.array([a + b for a in ("the", "an", "er", "on", "re") for b in ("sh", "ti", "ble", "st", "", "ou", "ea", "ing")])
    rows, marks = [], []
    for d in range(600):
        w = rng.choice(vocabulary, 120).tolist()
        bad, toxic = d % 6 == 0, d % 5 == 1
        if bad:
            w = [x + "***" for x in w] if d % 12 else w[:3] * 40
        if toxic:
            for i in rng.integers(0, 100, 3):
                w[i] = ["moron", "scum", "loweing", "loweiten"][d % 4] + ("" if d % 4 < 2 else "ab"[d % 2])
        rows.append((d, " ".join(w).capitalize() + "."))
        marks.append((d, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), marks


def test_classifiers_hold_out(spark):
    corpus, marks, want = made_corpus(spark)
    for operator, at in ((quality, 1), (toxicity, 2)):
        got = {r.doc_id: r for r in operator.score_documents(corpus, marks).collect()}
        held = [w for w in want if got[w[0]].held_out]
        assert {w[0] for w in held} == {d for d in range(600) if zlib.crc32(str(d).encode()) % 5 == 0}
        assert np.mean([got[w[0]].predicted == w[at] for w in held]) >= 0.95
        assert all(0 <= r.score <= 1 for r in got.values())
    spans = {r.doc_id: (r.text, r.spans) for r in toxicity.score_documents(corpus, marks).join(corpus, "doc_id").collect()}
    assert any("moron" in t[s.start : s.end] for t, x in spans.values() for s in x)


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_take_any_rows(docs, nothing, labels, operator):
    rows = operator.score_documents(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(r.score is not None and r.predicted in (0, 1) for r in rows)
    assert operator.score_documents(nothing, labels).count() == 0
    assert operator.score_documents(docs, labels.limit(0)).count() == len(TEXTS)


def test_field_passes_match_enumeration():
    rng = np.random.default_rng(6)
    field = toxicity.Field()
    field.trans, field.start = rng.standard_normal((2, 2)), 0.3
    sizes = [1, 5, 7, 2]
    e = rng.standard_normal(sum(sizes))
    first = np.zeros(len(e), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    got, at = field.marginals(e, first), 0
    for n in sizes:
        total, toxic = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            s = field.start * y[0] + sum(e[at + i] for i in range(n) if y[i]) + sum(field.trans[y[i - 1], y[i]] for i in range(1, n))
            total += np.exp(s)
            toxic += np.exp(s) * np.array(y)
        assert np.allclose(got[at : at + n], toxic / total)
        at += n
    long = rng.standard_normal(2000)
    start = np.zeros(2000, bool)
    start[0] = True
    assert np.isfinite(field.marginals(long, start)).all()


# 7 ----------------------------------------------------------------------------------------------------------


def brute_lines(rows, min_chars=40, min_docs=5):
    def k(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))

    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(k(line)) >= min_chars:
                holders.setdefault(k(line), set()).add(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(holders.get(k(x), ())) >= min_docs and max(holders[k(x)]) != (-1 if d is None else d))]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=key)


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(docs, nothing, batches):
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(docs, batches=batches).collect()), key=key)
    assert got == brute_lines(TEXTS)
    assert sum(r[2] for r in got) == 5
    assert line_dedup.dedup_lines(nothing).count() == 0


@pytest.mark.parametrize("very_common", [1, 10**9])
def test_very_common_lines_are_joined_alike(docs, monkeypatch, very_common):
    monkeypatch.setattr(line_dedup, "VERY_COMMON", very_common)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()), key=key)
    assert got == brute_lines(TEXTS)


def test_line_runs_are_disjoint_and_carry_the_counts(spark):
    runs, held = line_dedup.LineRuns(spark), {}
    rng = np.random.default_rng(12)
    for b in range(5):
        rows = {(b"k%d" % int(k), 10 * b + int(d)) for k, d in zip(rng.integers(0, 30, 60), rng.integers(0, 10, 60))}
        for k, d in rows:
            held.setdefault(k, set()).add(d)
        new = runs.add(spark.createDataFrame(sorted(rows), "digest binary, doc_id long"))
        assert {bytes(r.digest) for r in new.collect()} == {k for k, _ in rows if min(held[k]) >= 10 * b}
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    known = [bytes(r.digest) for r in runs.known().collect()]
    assert sorted(known) == sorted(held)  # no key twice
    want = sorted((k, len(d), max(d)) for k, d in held.items() if len(d) >= 5)
    assert sorted((bytes(r.digest), r.n_docs, r.last_doc) for r in runs.frequent(5).collect()) == want


# 9 ----------------------------------------------------------------------------------------------------------


def brute_repeats(rows, window=13):
    first = {}
    low = lambda d: float("-inf") if d is None else d
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            x = tuple(w[i : i + window])
            first[x] = min(first.get(x, float("inf")), low(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < low(d):
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=key)


def test_recompression(docs, nothing):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in recompress.remove_repeats(docs).collect()), key=key)
    assert got == brute_repeats(TEXTS)
    assert sum(r[2] for r in got) > 300
    assert recompress.remove_repeats(nothing).count() == 0


def repeats_of(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in recompress.remove_repeats(df).collect()), key=key)


def test_recompression_on_few_words(spark):
    rng = np.random.default_rng(9)
    rows = [(d, " ".join(rng.choice(list("abc"), rng.integers(0, 120), p=[0.8, 0.15, 0.05]))) for d in range(150)]
    rows += [(200 + d, " ".join(["a b"] * int(n))) for d, n in enumerate(rng.integers(1, 40, 20))]
    assert repeats_of(spark, rows) == brute_repeats(rows)


def test_recompression_of_long_repeats_nulls_and_repeated_ids(spark):
    rng = np.random.default_rng(19)
    word = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 3000, n))
    long, shared = word(900), word(260)
    rows = [(5, f"{word(30)} {long} {word(7)}"), (6, f"{word(9)} {long[:2000]} {shared}"), (7, long), (7, f"{shared} {word(40)}"), (3, f"{shared} {word(50)}"), (None, long), (None, long), (None, shared), (1, ""), (2, None)]
    rows += [(40 + i, f"{word(20)} {shared} {word(20)}") for i in range(30)] + [(90, word(60_000) + " " + long)]
    assert repeats_of(spark, rows) == brute_repeats(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    more = recompress.remove_repeats(df, rounds=((6, 5), (4, 3))).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in more), key=key) == brute_repeats(rows)


def test_recompression_tells_thue_morse_words_apart(spark):
    """Sums of powers modulo 2^64 cannot: such a word of letters and its complement have one digest."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    for n in (1024, 2048, 4096):
        one, other = ("".join("ab"[b ^ flip] for b in bits[:n]) for flip in (0, 1))
        head = " ".join(f"w{i}" for i in range(12))
        rows = [(1, f"{head} {one}"), (2, f"{head} {other}")]
        assert repeats_of(spark, rows, 1) == brute_repeats(rows) and brute_repeats(rows)[1][2] == 0


def test_words_are_named_without_a_call_for_each():
    """A digest by a call for each word took most of op9's time."""
    odd = ["é", "É", "日本", "nan", "a\0", "a\0b", "a\0c", "\0", "a" * 70, "a" * 71]
    text = " ".join([*odd, *(f"w{i}" for i in range(20_000)), *odd]).encode()
    recompress.Words([b"a b"], 2)  # what the first use imports does not count
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event.endswith("call") else None)
    try:
        w = recompress.Words([text], 2)
    finally:
        sys.setprofile(None)
    assert len(calls) < 2000
    names = w.token[:, ~w.boundary]
    assert len(set(zip(*names.tolist()))) == len(set(names[0].tolist())) == len(set(names[1].tolist())) == 20_010
    assert (names[:, :10] == names[:, -10:]).all()
    one = recompress.Words([text], 1)
    assert (one.token[0] == w.token[0]).all()
    # Every task must come to the same names.
    run = "import sys; from skyledger.llm import recompress as r; print(r.Words([sys.stdin.buffer.read()], 2).token.sum(axis=1).tolist())"
    other = subprocess.run([sys.executable, "-c", run], input=text, capture_output=True, check=True, cwd=Path(recompress.__file__).parents[2], timeout=120)
    assert json.loads(other.stdout) == w.token.sum(axis=1).tolist()


def test_equal_windows_have_equal_peaks():
    rng = np.random.default_rng(10)
    text = " ".join(rng.choice(["a", "b", "c", "d"], 4000))
    w = recompress.Words([text.encode()], 2)
    at = w.windows(13)
    top, digest = recompress.peaks(w, at), w.digests(at, 13)
    seen = {}
    for d, t in zip(zip(*digest.tolist()), top.tolist()):
        assert seen.setdefault(d, t) == t
    assert (top > 0).all()


def test_symbols_of_all_levels_stand_for_one_sequence_of_words():
    rng = np.random.default_rng(11)
    part = " ".join(rng.choice(["a", "b", "c"], 400))
    w = recompress.Words([" ".join([part, str(i), part]).encode() for i in range(5)], 2)
    spelled, levels = {}, w.levels(6)
    for level in levels:
        for k in np.flatnonzero(~level.boundary):
            d, at = w.doc[level.start[k]], level.start[k] - w.first[w.doc[level.start[k]]]
            text = tuple(w.split(d)[at : at + level.words[k]])
            assert len(text) == level.words[k] and spelled.setdefault(tuple(level.name[:, k].tolist()), text) == text
    assert max(level.words.max() for level in levels) >= 13
    assert len(set(spelled.values())) == len(spelled)


# 10 ---------------------------------------------------------------------------------------------------------


def test_mix(docs, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and sorted(r.size for r in rows) == sorted(len(words(t)) for _, t in TEXTS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(x[0].target for x in by.values()) - total) < 1e-6 * max(total, 1)
    for x in by.values():
        assert x[0].source_size == sum(r.size for r in x) and x[0].target <= 3 * x[0].source_size + 1e-9
        assert abs(sum(r.taken for r in x) - x[0].target) <= 2 * 32
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((key(r) for r in rows)) == sorted((key(r) for r in again))
    assert mixing.mix(nothing).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixing.mixed_documents(nothing).count() == 0


def test_shards_do_not_move_totals(docs):
    rows = mixing.mix(docs, block_words=4, shard_words=500).collect()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4 * 30
        assert all(0 <= r.taken <= 3 * r.size for r in own)


def test_apportion_is_sainte_lague(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(12)
    for seats in (0, 1, 7, 100, 1003):
        votes = [float(v) for v in rng.integers(0, 1000, 9)] + [0.0, 5000.0]
        won = [0] * len(votes)
        for _ in range(seats):
            best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        df = spark.createDataFrame([(0, i, v) for i, v in enumerate(votes)], "g int, k int, v double")
        got = {r.k: r.seats for r in mixing.apportion(df, ["g"], "k", "v", F.lit(seats)).collect()}
        assert [got[i] for i in range(len(votes))] == won
