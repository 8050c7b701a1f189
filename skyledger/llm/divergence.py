r"""Source divergence audit: how far the sources of a language are from one another, and which terms set one apart.

Terms are runs of ASCII letters and non-ASCII characters, A-Z in lower case. A language keeps the V terms that at least
three of its documents hold. A group - a source of a language, or the language as a whole - gives a kept term with ``count``
occurrences the share p = 1 + floor(10^9 (count + 1) / (N + V)), N being the group's occurrences of kept terms; two shares are
f = floor((p - q)^2 / q) apart. All arithmetic is on whole numbers.

* ``pair`` rows: for each two sources f summed over all kept terms. Terms are dealt to *units* by a hash, a unit being a
  share of a language's terms and two blocks of its sources; a unit's task adds up f for the terms that occur there, as
  a dense matrix of bounded size. Terms that neither source has are the same f each and are counted only.
* ``term`` rows: the terms that a source has more often than its language, the first 200 by f. f grows with the source's
  count and falls with the language's, and ties go to the earlier term, so a term that k others *dominate* - as many
  occurrences in the source or more, as few in the language or fewer, earlier in UTF-8 - has rank over k. Each partition
  keeps its k-skyband, the terms with fewer than k such others; skybands are merged the same way, and what is left is
  ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

WHOLE = 1_000_000_000
#: Bytes of terms stay, A-Z in lower case; all others become spaces. UTF-8 has non-ASCII characters in bytes from 0x80 on.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Terms that a task holds before it hands them on; bytes of a text that are split at once.
HELD, PIECE = 700_000, 1 << 20
#: Sources of a block, rows of a unit, and candidates of one group that meet in one task when skybands are merged.
BLOCK, UNIT, MERGED = 256, 100_000, 100_000
#: Rows and columns of the grid that a skyband is counted by.
CELLS = 128
#: A table of one row a group is broadcast up to so many rows, else joined as any other.
FEW = 100_000


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, those of a piece of it at a time."""
    plain, at = text.translate(_TERMS), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, found) in held.items():
                terms = list(n)
                for lo in range(0, len(terms), 50_000):
                    some = terms[lo : lo + 50_000]
                    group = [pa.repeat(pa.scalar(x, pa.binary()), len(some)).cast(pa.string()) for x in (lang, source)]
                    counts = [pa.array([c[t] for t in some], pa.int64()) for c in (n, found)]
                    yield pa.RecordBatch.from_arrays([*group, pa.array(some, pa.binary()).cast(pa.string()), *counts], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for lang, source, text in zip(*(c.cast(pa.binary()).to_pylist() for c in batch.slice(lo, 64).columns)):
                    n, found = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    own: set[bytes] = set()
                    for terms in pieces(text):
                        n.update(terms)
                        own.update(terms)
                    found.update(own)
                    size += len(n)
                    if size > HELD:
                        yield from emit()
                        size = 0
        yield from emit()

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = read.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # A task's counts are summed already: dealt out as they are, they are not hashed once more before the shuffle.
    found = found.repartition("lang", "source", "term")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, words: str, kept: str) -> Column:
    """p of n occurrences among ``words`` occurrences of ``kept`` terms; exact, as products have up to 31 digits."""
    return F.expr(f"1L + cast(cast({n} + 1 as decimal(20,0)) * {WHOLE}BD div cast({words} + {kept} as decimal(20,0)) as long)")


def apart(p: str, q: str) -> Column:
    """f of two shares: at most 10^18, so longs hold it."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def few(df: DataFrame) -> DataFrame:
    """df to be broadcast where it has at most FEW rows, else df as it is."""
    return F.broadcast(df) if df.count() <= FEW else df


def skyband(n: np.ndarray, total: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Positions of the terms that fewer than k others dominate: n as high, total as low, term earlier.

    In the order of falling n, rising total and term those that dominate a term come before it; and a term that k or more
    dominate is dominated by k of the skyband, so it is enough to look at what is kept. That is counted by a grid of total and
    term: cells below and before a term's own hold dominators only, and just its own row and column are compared one by one.
    """
    rank = np.empty(len(term), np.int64)
    rank[np.argsort(term, kind="stable")] = np.arange(len(term))
    order = np.lexsort((rank, total, -n))
    total, rank = total[order], rank[order]
    # A lower cell of both holds only lower totals and earlier terms; row and column 0 of the grid stay empty.
    row = np.searchsorted(np.unique(np.quantile(total, np.linspace(0, 1, CELLS)[1:-1])), total, side="right") + 1 if len(total) else total
    column = rank * CELLS // max(1, len(rank)) + 1
    grid = np.zeros((CELLS + 1, CELLS + 1), np.int64)
    kept = np.empty(0, np.int64)
    for lo in range(0, len(order), 1024):
        here = np.arange(lo, min(lo + 1024, len(order)))
        below = grid.cumsum(axis=0).cumsum(axis=1)
        by = below[row[here] - 1, column[here] - 1]
        here, by = here[by < k], by[by < k]
        t, u, r, c = total[here], rank[here], row[here], column[here]
        for own, all_, before in ((r, row[kept], None), (c, column[kept], row[kept])):
            some = np.argsort(all_, kind="stable")
            cells = np.unique(own)
            for cell, low, high in zip(cells, np.searchsorted(all_, cells, "left", some), np.searchsorted(all_, cells, "right", some)):
                mine, others = np.flatnonzero(own == cell), kept[some[low:high]]
                if len(others):
                    under = total[others] <= t[mine, None] if before is None else row[others] < r[mine, None]
                    by[mine] += (under & (rank[others] < u[mine, None])).sum(axis=1)
        by += (np.tri(len(t), k=-1, dtype=bool) & (t <= t[:, None]) & (u < u[:, None])).sum(axis=1)
        new = here[by < k]
        kept = np.concatenate([kept, new])
        np.add.at(grid, (row[new], column[new]), 1)
    return order[kept]


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of rows (lang, source, term, n, total) each partition's k-skyband for each (lang, source)."""
    names = ["lang", "source", "term", "n", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}  # [terms, n, total, rows after the last skyband]

        def kept(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            term, n, total = (np.concatenate(x) for x in parts[:3])
            at = skyband(n, total, term, k)
            return term[at], n[at], total[at]

        for batch in batches:
            lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            order = np.argsort(group, kind="stable")
            term = batch.column(2).to_numpy(zero_copy_only=False)
            n, total = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else ():
                g = int(group[at[0]])
                key = (lang.dictionary[g // len(source.dictionary)].as_py(), source.dictionary[g % len(source.dictionary)].as_py())
                parts = held.setdefault(key, [[], [], [], 0])
                for x, column in zip(parts, (term, n, total)):
                    x.append(column[at])
                parts[3] += len(at)
                if parts[3] > 20_000:
                    held[key] = [*([x] for x in kept(parts)), 0]
        for (a, b), parts in held.items():
            t, n, total = kept(parts)
            columns = [pa.array([a] * len(t), pa.string()), pa.array([b] * len(t), pa.string()), pa.array(t, pa.string()), pa.array(n), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*names).mapInArrow(run, "lang string, source string, term string, n long, total long")


def merged_skybands(rows: DataFrame, k: int) -> DataFrame:
    """The k-skyband of each (lang, source): of each partition first, then of shares of what is left until it is small."""
    left = stage(skybands(rows, k), "skybands")
    while True:
        most = left.groupBy("lang", "source").count().agg(F.max("count")).first()[0] or 0
        if most <= MERGED:
            return skybands(left.repartition("lang", "source"), k)
        salt = F.pmod(F.xxhash64("term"), F.lit(-(-most // (MERGED // 2))))
        before, left = left.count(), stage(skybands(left.repartition("lang", "source", salt), k), "skybands")
        if left.count() > 0.8 * before:
            return left  # these are nearly all in the skyband; the rank's own limit by partition bounds the rest


def pair_sums(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, g, h, value, present): f of sources g and h (places in their language) over the terms that occur in their
    units, and the number of these terms."""
    blocks = F.expr(f"ceil(sources / {BLOCK})").cast("int")
    buckets = F.expr(f"greatest(1, ceil(entries / {UNIT}))").cast("int")
    own = F.expr(f"cast(place div {BLOCK} as int)")
    # A row goes to one unit for each block that its own is compared with.
    others = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.least(own, b).alias("a"), F.greatest(own, b).alias("b"))))
    facts = groups.join(few(langs), "lang").select("lang", "source", "place", "words", "kept", "sources", "entries")
    terms = kept.join(few(facts), ["lang", "source"]).withColumn("p", share("n", "words", "kept"))
    terms = terms.select("lang", others.alias("x"), F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "term", "place", "p")
    zeros = facts.where("kept > 0").withColumn("p", share("0L", "words", "kept"))
    zeros = zeros.select("lang", others.alias("x"), "place", "p", buckets.alias("_n")).select("lang", "x", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("bucket"), F.lit(None).cast("string").alias("term"), "place", "p")
    rows = terms.unionByName(zeros).select("lang", "x.a", "x.b", "bucket", "term", "place", "p")

    def unit(key: tuple, table: pa.Table) -> pa.Table:
        lang, a, b = (x.as_py() for x in key[:3])
        zero = pc.is_null(table["term"])
        facts, found = table.filter(zero), table.filter(pc.invert(zero))
        places, p0 = facts["place"].to_numpy(), facts["p"].to_numpy()
        order = np.argsort(places)
        places, p0 = places[order], p0[order]
        term = found["term"].combine_chunks().dictionary_encode()
        which, count = term.indices.to_numpy(), len(term.dictionary)
        at, p = np.searchsorted(places, found["place"].to_numpy()), found["p"].to_numpy()
        sums, step = np.zeros((len(places), len(places)), np.int64), max(1, 1_000_000 // max(1, len(places)))
        for lo in range(0, count, step):
            dense = np.tile(p0, (min(step, count - lo), 1))
            here = (which >= lo) & (which < lo + step)
            dense[which[here] - lo, at[here]] = p[here]
            for g in range(len(places)):
                off = dense[:, g, None] - dense
                sums[g] += (off * off // dense).sum(axis=0)
        block = places // BLOCK
        want = (places[:, None] != places) & ((block[:, None] != block) | (a == b))
        g, h = np.nonzero(want)
        columns = [pa.array([lang] * len(g), pa.string()), pa.array(places[g], pa.int32()), pa.array(places[h], pa.int32()), pa.array(sums[g, h]), pa.array(np.full(len(g), count, np.int64))]
        return pa.Table.from_arrays(columns, names=["lang", "g", "h", "value", "present"])

    parts = rows.groupBy("lang", "a", "b", "bucket").applyInArrow(unit, "lang string, g int, h int, value long, present long")
    return parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"), F.sum("present").alias("present"))


def audit_sources(docs: DataFrame, top: int = 200, min_docs: int = 3) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module.

    A null text, lang or source counts as ''. A group without terms has its pair rows, a language without kept terms pairs
    of value 0; a language with one source has no pair rows. Rows that repeat a doc_id are documents of their own. Ties go by
    item in UTF-8. A very long text is read whole, a piece at a time. An empty table gives an empty result. Other columns
    are not read, whatever their names. The pairs of sources are the result itself: square in a language's sources, and
    the only rows that are.
    """
    w = W.partitionBy("lang", "term")
    counts = term_counts(docs).withColumn("in_lang", F.sum("docs").over(w)).withColumn("total", F.sum("n").over(w)).withColumn("first", F.min("source").over(w) == F.col("source"))
    kept = stage(counts.where(F.col("in_lang") >= min_docs).select("lang", "source", "term", "n", "total", "first"), "kept-terms")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.sum(F.col("first").cast("long")).alias("firsts"), F.count(F.lit(1)).alias("entries"))
    present = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = present.join(own, ["lang", "source"], "left").select("lang", "source", zero("words"), zero("firsts"), zero("entries"))
    # One row a group: ranking a language's sources takes as many rows as it has sources.
    groups = stage(groups.withColumn("place", (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("int")), "groups")
    langs = groups.groupBy("lang").agg(F.sum("words").alias("lang_words"), F.sum("firsts").alias("kept"), F.count(F.lit(1)).alias("sources"), F.sum("entries").alias("entries"))
    langs = stage(langs, "langs")
    groups = groups.drop("entries", "firsts")

    shares = F.when(F.col("kept") > 0, share("0L", "words", "kept"))
    of = lambda c: groups.join(langs, "lang").select("lang", F.col("source").alias(f"s_{c}"), F.col("place").alias(c), shares.alias(f"p_{c}"), F.col("kept").alias(f"kept_{c}"))
    pairs = of("g").join(of("h"), "lang").where("g <> h").join(pair_sums(kept, groups, langs), ["lang", "g", "h"], "left")
    absent = F.coalesce((F.col("kept_g") - F.coalesce("present", F.lit(0))) * apart("p_g", "p_h"), F.lit(0))
    pairs = pairs.select("lang", F.col("s_g").alias("source"), F.lit("pair").alias("part"), F.col("s_h").alias("item"), (F.coalesce("value", F.lit(0)) + absent).alias("value"))

    by_group = few(groups.join(langs, "lang").select("lang", "source", "words", "kept", "lang_words"))
    best = merged_skybands(kept, top).join(by_group, ["lang", "source"])
    best = best.withColumn("p", share("n", "words", "kept")).withColumn("q", share("total", "lang_words", "kept")).where("p > q")
    terms = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))
    ranked = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).cast("int")
    return pairs.withColumn("rank", ranked).unionByName(terms.withColumn("rank", ranked).where(F.col("rank") <= top))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), occurrences AS (
  SELECT id, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS u(t)
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY ALL
), kept AS (
  SELECT lang, term, count(*) AS total FROM occurrences GROUP BY ALL HAVING count(DISTINCT id) >= 3
), langs AS (
  SELECT d.lang, coalesce(v, 0) AS v, coalesce(words, 0) AS words FROM (SELECT DISTINCT lang FROM docs) d
  LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS words FROM kept GROUP BY lang) k USING (lang)
), groups AS (
  SELECT g.lang, g.source, l.v, l.words AS lang_words, coalesce(c.words, 0) AS words
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS words FROM counts JOIN kept USING (lang, term) GROUP BY ALL) c USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.words + g.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (g.lang_words + g.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""
