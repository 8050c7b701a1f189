"""Substring dedup by recompression.

A window is a run of consecutive words of one document. Each word that lies in a window whose words also start in
a document with a smaller doc_id is removed.

**Naming.** Texts are parsed in levels. A level first replaces each maximal run of one symbol by a symbol for
(symbol, length), then each pair (left, right) whose first symbol's coin says left and whose second's says right by a
symbol for the pair. The words are level 0. A name is a digest of what the symbol stands for, made from the names below
it and, at the bottom, from the bytes of the word; so equal runs and pairs have one name in every task, and a Spark
round only has to find out which names several documents hold. It stages those, and the next round goes on from them:

1. **Revealing**, levels 0 to 2. A symbol depends on its *context*, the words that fix its own parse and that of its
   neighbours. Each run of 8 words has a highest symbol: of those whose context it holds, one of the highest level there
   is, that spans most words. Of the runs in a window the one with the highest symbol stands for it: its *peak*, named by
   that symbol and its words. Equal windows have equal peaks and neighbouring windows share theirs, so there is about one
   for three words. Windows whose peak several documents hold make up *passages*; all later rounds read these alone.
2. **Long repeats**, the levels of ``ROUNDS``. A symbol that spans a window or more and that a document with a smaller
   doc_id holds settles all its words at once; what is settled is not sent again in the rounds below.
3. **Verifying.** The windows that are left and not settled are compared by their words' names.

**Exactness.** The first round only leaves out what cannot repeat. The others decide by names of 128 bits: two lanes of
64 bits that never mix, from SipHash-2-4 of the words' bytes under a key of each lane, each step a bijective, non-linear
finaliser of an odd multiple of what came before plus the next name. In 10^13 windows the chance that any two unequal
ones have one name is under 10^-12, whatever the words, unless somebody picks them for these keys.

Rounds deal packed rows by a part of the name. A batch sends a name once, with its smallest doc_id, however many of its
documents hold it; the others know their answer and only report it. So a passage in a third of all documents costs one
entry a batch. Texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

WINDOW, REVEALING = 13, 2
#: A window is so many words longer than the runs that may stand for it.
SPREAD = 5
#: Levels of the rounds that settle long repeats, in their order. More rounds send less and parse more often.
ROUNDS = ((6, 5, 4, 3),)
#: Bytes of text that are parsed together; a longer document is parsed alone.
CHUNK = 2_500_000
#: Entries that are sent together.
FLUSH = 1_200_000
#: Bytes of input for which there is a bucket.
BUCKET_BYTES = 16_000_000

_U = np.uint64
_ODD = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], _U)
#: Keys of SipHash, 16 bytes each.
LANE_KEYS = ("words, lane one.", "words, lane two.")
#: Rows without a doc_id have numbers from NO_ID up to LAST_NO_ID, by their texts; all real ids are greater.
NO_ID, NO_ID_BITS = -(1 << 63), 40
LAST_NO_ID = NO_ID + (1 << NO_ID_BITS) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Names of (a, b): names are arrays of one or two lanes."""
    return mixed(mixed(a + _U(salt)) * _ODD[: len(a)] + b)


def names_of(words: pa.Array, lanes: int) -> np.ndarray:
    """Names (lanes x n) of distinct words, by pandas' SipHash: no call for each word."""
    raw = words.to_numpy(zero_copy_only=False)
    return np.stack([pd.util.hash_array(raw, hash_key=key, categorize=False) for key in LANE_KEYS[:lanes]])


class Words:
    """The words of some texts: names with a boundary before, between and after texts.

    ``token`` (lanes x places) and ``boundary`` have one place for each word and boundary, ``doc`` is the text of each
    place, ``counts`` the number of words of each text, ``first`` the place of its first word. Words are numbered within
    these texts before they are named, so each distinct one is digested once.
    """

    def __init__(self, texts: list[bytes], lanes: int):
        self.texts = texts
        pieces = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        flat, sizes = pieces.values, np.diff(pieces.offsets.to_numpy())
        word = pc.greater(pc.binary_length(flat), 0)  # there are empty pieces at the ends of texts
        numbers = flat.filter(word).dictionary_encode()
        doc = np.repeat(np.arange(len(texts)), sizes)[word.to_numpy(zero_copy_only=False)]
        self.counts = np.bincount(doc, minlength=len(texts))
        total = len(doc)
        n = total + len(texts) + 1
        place = np.arange(total) + doc + 1
        self.token, self.boundary, self.doc = np.zeros((lanes, n), _U), np.ones(n, bool), np.zeros(n, np.int64)
        if total:
            self.token[:, place] = names_of(numbers.dictionary.cast(pa.large_binary()), lanes)[:, numbers.indices.to_numpy()]
        self.boundary[place], self.doc[place] = False, doc
        self.first = np.cumsum(self.counts + 1) - self.counts

    def split(self, text: int) -> list[bytes]:
        return self.texts[text].split()  # at ASCII white space

    def windows(self, window: int) -> np.ndarray:
        """Places at which a window of one text starts."""
        bad = np.r_[0, np.cumsum(self.boundary)]
        return np.flatnonzero(bad[window:] == bad[:-window]) if len(self.boundary) >= window else np.zeros(0, np.int64)

    def digests(self, at: np.ndarray, window: int) -> np.ndarray:
        """Names of the windows that start at ``at``."""
        total = np.full((len(self.token), len(at)), _U(window))
        for k in range(window):
            total = mixed(total * _ODD[: len(total)] + self.token[:, at + k])
        return total

    def levels(self, n: int) -> list[Symbols]:
        here = np.arange(len(self.boundary))
        out = [Symbols(self.token, np.ones(len(here), np.int64), here, here, here + 1, self.boundary)]
        for r in range(n):
            out.append(out[-1].round(0xA511 + 2 * r))
        return out


class Symbols:
    """One level of the parse: name, number of words, first place, context [low, high), and boundaries."""

    def __init__(self, name: np.ndarray, words: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, boundary: np.ndarray):
        self.name, self.words, self.start, self.low, self.high, self.boundary = name, words, start, low, high, boundary

    def round(self, salt: int) -> Symbols:
        """Runs become symbols, then pairs do."""
        # The outermost symbols are boundaries, so each other one has neighbours.
        new = np.ones(len(self.boundary), bool)
        new[1:] = (self.name[:, 1:] != self.name[:, :-1]).any(axis=0) | self.boundary[1:] | self.boundary[:-1]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(new)] - 1
        count = last - first + 1
        name = self.name[:, first]
        many = np.flatnonzero(count > 1)
        if len(many):
            name[:, many] = joined(name[:, many], count[many].astype(_U), salt + 0x51ED)
        words, start = np.add.reduceat(self.words, first), self.start[first]
        low, high, edge = self.low[np.maximum(first - 1, 0)], self.high[np.minimum(last + 1, len(new) - 1)], self.boundary[first]
        coin = (mixed(name[0] + _U(salt)) & _U(1)).astype(bool)  # True: right
        pair = np.zeros(len(edge), bool)  # with the next one
        pair[:-1] = ~coin[:-1] & coin[1:] & ~edge[:-1] & ~edge[1:]
        head = np.flatnonzero(~np.r_[False, pair[:-1]])
        two = np.flatnonzero(pair[head])
        left = head[two]
        out, width = name[:, head], words[head]
        out[:, two] = joined(name[:, left], name[:, left + 1], salt)
        width[two] += words[left + 1]
        other = np.minimum(head + 1, len(edge) - 1)
        right = coin[head] & ~pair[head]
        return Symbols(out, width, start[head], np.where(right, low[np.maximum(head - 1, 0)], low[head]), np.where(right, high[head], high[other]), edge[head])

    def long(self, window: int) -> np.ndarray:
        return np.flatnonzero((self.words >= window) & ~self.boundary)


def range_max(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """max(values[lo : hi + 1]) for each query, 0 where hi < lo."""
    out = np.zeros(len(lo), values.dtype)
    size = hi - lo + 1
    some = np.flatnonzero(size > 0)
    table, width = values, 1
    while len(some):
        now = some[(size[some] >= width) & (size[some] < 2 * width)]
        out[now] = np.maximum(table[lo[now]], table[hi[now] - width + 1])
        some = some[size[some] >= 2 * width]
        if len(some):
            table = np.maximum(table[:-width], table[width:])
            width *= 2
    return out


def highest(words: Words, at: np.ndarray, window: int, revealing: int = REVEALING) -> np.ndarray:
    """The highest symbol in ``window`` words from each place: its number of words in the upper bits, its name in the others."""
    n = len(words.boundary)
    best = np.zeros(len(at), _U)
    left = np.arange(len(at))
    for level in reversed(words.levels(revealing)):
        rank = (np.minimum(level.words, 63).astype(_U) << _U(58)) | (level.name[0] >> _U(6))
        rank[level.boundary] = 0
        # Contexts begin and end in the order of their symbols.
        before = np.r_[0, np.cumsum(np.bincount(level.low, minlength=n))]  # symbols whose context begins before a place
        ended = np.cumsum(np.bincount(level.high, minlength=n + 1))  # symbols whose context ends at a place or before
        start = at[left]
        best[left] = range_max(rank, before[start], ended[start + window] - 1)
        left = left[best[left] == 0]
        if not len(left):
            break
    return best


def peaks(words: Words, at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The peak of each window: 44 bits of its highest symbol, 20 of the digest of its words."""
    size = max(1, window - SPREAD)
    runs = words.windows(size)
    # A sum of multiples will do here, as peaks only leave out what cannot repeat.
    sums = np.zeros(len(runs), _U)
    for k in range(size):
        sums += words.token[0, runs + k] * _U(pow(int(_ODD[0, 0]), k + 1, 1 << 64))
    own = np.zeros(len(words.boundary), _U)
    own[runs] = (highest(words, runs, size) & ~_U(0xFFFFF)) | (mixed(sums) >> _U(44))
    best = own[at]
    for k in range(1, window - size + 1):
        best = np.maximum(best, own[at + k])
    return best


def pack(x: np.ndarray) -> bytes:
    """8-byte numbers byte plane by byte plane: sorted or small ones compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


#: Keys have one lane, or two: then ``more`` holds the second.
PACKED = "bucket int, known boolean, keys binary, more binary, docs binary"
#: Keys (lanes x n) with the id of the document of each.
Entries = Iterator[tuple[np.ndarray, np.ndarray]]


def heads(keys: np.ndarray) -> np.ndarray:
    """Where a key differs from the one before."""
    return np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]


def sort(keys: np.ndarray, docs: np.ndarray, *before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, *keys[::-1], *before))
    return keys[:, order], docs[order]


def send(entries: Entries, buckets: int, later_only: bool) -> Iterator[pa.RecordBatch]:
    """Pack (keys, docs) by bucket. A key goes once with its smallest doc; what is known already goes as known.

    later_only: known are documents that are not the smallest one; else all of a key that has several.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        keys, docs = np.concatenate([k for k, _ in held], axis=1), np.concatenate([d for _, d in held])
        keys, docs = sort(keys, docs, keys[0] & _U(buckets - 1))
        keep = heads(keys) | np.r_[True, docs[1:] != docs[:-1]]
        keys, docs = keys[:, keep], docs[keep]
        head = heads(keys)
        alone = head & np.r_[head[1:], True]
        rows = []
        for known, which in ((False, head), (True, ~head if later_only else ~alone)):
            k, d = keys[:, which], docs[which]
            bucket = (k[0] & _U(buckets - 1)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(d) else []
            for a, b in zip(cuts, [*cuts[1:], len(d)]):
                rows.append((int(bucket[a]), known, pack(k[0, a:b]), pack(k[1, a:b]) if len(k) > 1 else b"", pack(d[a:b])))
        kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["bucket", "known", "keys", "more", "docs"])

    size = 0
    for keys, docs in entries:
        if len(docs):
            held.append((keys, docs))
            size += len(docs)
        if size >= FLUSH:
            yield flush()
            held.clear()
            size = 0
    if held:
        yield flush()


def settle(packed: DataFrame, later_only: bool, name: str) -> DataFrame:
    """Staged (id, keys array<struct<key long, more long>>): for each document those of its keys that are shared, or
    with later_only those that a document with a smaller doc_id holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
            keys = keys.view(np.int64)
            for i in range(0, len(docs), 100_000):
                k = keys[:, i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(docs[i : i + 100_000]), pa.array(k[0]), pa.array(k[-1])], names=["id", "key", "more"])

        def finish(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            keys, docs = sort(np.concatenate([k for k, _ in held], axis=1), np.concatenate([d for _, d in held]))
            head = heads(keys)
            group = np.cumsum(head) - 1
            low, high = docs[head], docs[np.r_[head[1:], True]]
            hit = docs > np.maximum(low, LAST_NO_ID)[group] if later_only else (low < high)[group]
            yield from out(keys[:, hit], docs[hit])

        last, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != last:
                    yield from finish(held)
                    last, held = row["bucket"], []
                keys = np.stack([unpack(k, _U) for k in (row["keys"], row["more"]) if k])
                docs = unpack(row["docs"], np.int64)
                if row["known"]:
                    real = docs > (LAST_NO_ID if later_only else NO_ID - 1)
                    yield from out(keys[:, real], docs[real])
                else:
                    held.append((keys, docs))
        yield from finish(held)

    pairs = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "id long, key long, more long")
    return stage(pairs.groupBy("id").agg(F.collect_list(F.struct("key", "more")).alias("keys")), name)


def keys_of(column: pa.Array, i: int) -> np.ndarray | None:
    """Row i of a column of keys, lanes x n; null rows are None."""
    if not column[i].is_valid:
        return None
    both = column[i].values
    return np.stack([both.field(k).to_numpy(zero_copy_only=False).view(_U) for k in ("key", "more")])


def in_chunks(batches: Iterator[pa.RecordBatch], lanes: int, *extra: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Words, list[list]]]:
    """(rows, ids, words, columns of keys) of some rows (id, text) at a time; texts may be compressed."""
    import zstandard

    for batch in batches:
        text = batch.column("text")
        zipped = zstandard.ZstdDecompressor() if pa.types.is_binary(text.type) else None
        texts, size, start = [], 0, 0
        for i in range(batch.num_rows):
            raw = text[i].as_buffer().to_pybytes()
            texts.append(zipped.decompress(raw) if zipped else raw)
            size += len(texts[-1])
            if size >= CHUNK or i == batch.num_rows - 1:
                part = batch.slice(start, len(texts))
                more = [[keys_of(part.column(name), j) for j in range(part.num_rows)] for name in extra]
                yield part, part.column("id").to_numpy(zero_copy_only=False), Words(texts, lanes), more
                texts, size, start = [], 0, i + 1


def member(keys: np.ndarray, doc: np.ndarray, of: list) -> np.ndarray:
    """Whether keys[:, i] is one of the keys of text doc[i]."""
    hit = np.zeros(len(doc), bool)
    have = [d for d, k in enumerate(of) if k is not None and k.shape[1]]
    if not have or not len(doc):
        return hit
    lanes = len(keys)
    pool = np.concatenate([of[d][:lanes] for d in have], axis=1)
    owner = np.repeat(have, [of[d].shape[1] for d in have])
    # Sorted together with the text first, equal ones stand side by side, the pool's before the others.
    all_ = np.concatenate([pool, keys], axis=1)
    text, asks = np.r_[owner, doc], np.r_[np.zeros(len(owner), np.int8), np.ones(len(doc), np.int8)]
    order = np.lexsort((asks, *all_[::-1], text))
    all_, text = all_[:, order], text[order]
    new = np.r_[True, (all_[:, 1:] != all_[:, :-1]).any(axis=0) | (text[1:] != text[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    known = asks[order][first] == 0
    asked = order >= len(owner)
    hit[order[asked] - len(owner)] = known[asked]
    return hit


def covered(n: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:-1] > 0


def ranges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each run of True."""
    step = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def settled(words: Words, levels: list[Symbols], keys: list, window: int) -> np.ndarray:
    """Places in a long symbol that is one of the text's keys."""
    gone = np.zeros(len(words.boundary), bool)
    for level in levels[REVEALING + 1 :]:
        at = level.long(window)
        at = at[member(level.name[:, at], words.doc[level.start[at]], keys)]
        gone |= covered(len(gone), level.start[at], level.words[at])
    return gone


def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    zipper = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            raw = [zipper.compress(t.as_buffer().to_pybytes()) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("hash"), pa.array(raw, pa.binary())], names=["id", "hash", "text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: tuple[tuple[int, ...], ...] = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row of docs.

    Words are runs of characters other than ASCII white space, unchanged; kept words are joined by one space. A
    window is ``window`` consecutive words; texts with fewer have none and lose nothing, null and empty texts have
    no words. Windows are judged on the input. Only a smaller doc_id counts: a document's own repeats stay, and rows
    that repeat a doc_id do not remove each other's words. A null doc_id comes before all others, so rows with it lose
    nothing. A very long text is parsed whole, in one task. An empty table gives an empty result; other columns are not
    read, whatever their names. ``rounds`` changes the cost only.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(8, int(total // BUCKET_BYTES).bit_length())
    text = text_or_empty()
    unnamed = F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(1 << NO_ID_BITS))
    # Rows that repeat a doc_id are told apart by their texts.
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    travelling = texts.mapInArrow(squeezed, "id long, hash long, text binary")
    top = max(max(r) for r in rounds)

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Entries:
            for _, ids, words, _ in in_chunks(batches, 1):
                at = words.windows(window)
                high, doc = peaks(words, at, window), words.doc[at]
                new = np.r_[True, (high[1:] != high[:-1]) | (doc[1:] != doc[:-1])] if len(at) else np.zeros(0, bool)
                yield high[None, new], ids[doc[new]]

        yield from send(entries(), buckets, later_only=False)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, words, (keys,) in in_chunks(batches, 1, "keys"):
            hashes = rows.column("hash").to_numpy(zero_copy_only=False)
            at = words.windows(window)
            at = at[member(peaks(words, at, window)[None], words.doc[at], keys)]
            low, high = ranges(covered(len(words.boundary), at, window))
            doc = words.doc[low]
            start = low - words.first[doc]
            out, last, split = [], None, []
            for d, s, n in zip(doc.tolist(), start.tolist(), (high - low).tolist()):
                if d != last:
                    last, split = d, words.split(d)
                out.append(b" ".join(split[s : s + n]))
            for i in range(0, len(out), 10_000):
                part = slice(i, i + 10_000)
                columns = [pa.array(ids[doc[part]]), pa.array(hashes[doc[part]]), pa.array(start[part]), pa.array(out[part], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "hash", "start", "text"])

    def long_symbols(own: tuple[int, ...], first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def entries() -> Entries:
                for _, ids, words, keys in in_chunks(batches, 2, *([] if first else ["keys"])):
                    levels = words.levels(top)
                    gone = np.r_[0, np.cumsum(settled(words, levels, keys[0], window))] if keys else None
                    for n in own:
                        level = levels[n]
                        at = level.long(window)
                        if gone is not None:
                            start = level.start[at]
                            at = at[gone[start + level.words[at]] - gone[start] < level.words[at]]
                        yield level.name[:, at], ids[words.doc[level.start[at]]]

            yield from send(entries(), buckets, later_only=True)

        return run

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Entries:
            for _, ids, words, (keys,) in in_chunks(batches, 2, "keys"):
                gone = np.r_[0, np.cumsum(settled(words, words.levels(top), keys, window))]
                at = words.windows(window)
                at = at[gone[at + window] - gone[at] < window]
                yield words.digests(at, window), ids[words.doc[at]]

        yield from send(entries(), buckets, later_only=True)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, words, (keys, seen) in in_chunks(batches, 2, "keys", "seen"):
            start, hashes = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("start", "hash"))
            gone = settled(words, words.levels(top), keys, window)
            some = np.fromiter((k is not None for k in seen), bool, len(seen))
            before, at = np.r_[0, np.cumsum(gone)], words.windows(window)
            at = at[some[words.doc[at]] & (before[at + window] - before[at] < window)]
            at = at[member(words.digests(at, window), words.doc[at], seen)]
            low, high = ranges(gone | covered(len(gone), at, window))
            doc = words.doc[low]
            move = start[doc] - words.first[doc]
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(hashes[doc]), pa.array(low + move), pa.array(high + move)], names=["id", "hash", "low", "high"])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zipped = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                counts, removed, out = [], [], []
                for i in range(part.num_rows):
                    words = zipped.decompress(part.column("text")[i].as_buffer().to_pybytes()).split()
                    counts.append(len(words))
                    cut = part.column("cuts")[i]
                    if cut.is_valid:
                        pairs = zip(*(cut.values.field(k).to_numpy(zero_copy_only=False).tolist() for k in ("low", "high")))
                        stay, at = [], 0
                        for a, b in sorted(pairs):
                            stay += words[at:a]
                            at = max(at, b)
                        words = stay + words[at:]
                    removed.append(counts[-1] - len(words))
                    out.append(b" ".join(words))
                ids = part.column("id").to_numpy(zero_copy_only=False)
                columns = [pa.array(ids, mask=ids <= LAST_NO_ID), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    shared = settle(texts.mapInArrow(symbols, PACKED), False, "shared-peaks")
    found = stage(travelling.join(shared, "id").mapInArrow(passages, "id long, hash long, start long, text string"), "passages")
    keys: DataFrame | None = None
    for own in rounds:
        rest = found if keys is None else found.join(keys, "id", "left")
        now = settle(rest.mapInArrow(long_symbols(own, keys is None), PACKED), True, "long-symbols")
        if keys is not None:
            now = stage(keys.unionByName(now).groupBy("id").agg(F.flatten(F.collect_list("keys")).alias("keys")), "long-symbols")
        keys = now
    seen = settle(found.join(keys, "id", "left").mapInArrow(windows, PACKED), True, "windows").withColumnRenamed("keys", "seen")
    cuts = found.join(keys, "id", "left").join(seen, "id", "left").where("keys is not null or seen is not null").mapInArrow(marks, "id long, hash long, low long, high long")
    # A row's cuts are distinct, so equal rows with one doc_id share them.
    cuts = cuts.distinct().groupBy("id", "hash").agg(F.collect_list(F.struct("low", "high")).alias("cuts"))
    return travelling.join(cuts, ["id", "hash"], "left").mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept_text string")
