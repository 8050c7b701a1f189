r"""WARC archives of web pages and the index of their captures.

``write_archives`` makes one WARC/1.1 record of each page: a ``response`` with the page as its HTTP payload, or a ``revisit``
that refers to the response with an equal payload and holds the HTTP head alone. Records are text (UTF-8), so Spark's text
writer makes the archives, with the blank line that ends a record as its line separator, gzip-compressed and cut at so many
records that an archive has about ``ARCHIVE_BYTES`` of payload.

``read_captures`` reads archives back: every record is parsed by its lengths, payloads are hashed anew and compared with the
record's digest. Each archive gives one *run* of index rows, sorted by URL key and time and staged. ``capture_histories``
merges runs: ranges of (URL key, time) go to tasks, and a task merges what it has of k runs with a loser tree, so the
index comes out in global order, partition after partition. A range ends within a URL's history where that is long.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, stage

#: Payload bytes of an archive, about; index rows of a merge task, about.
ARCHIVE_BYTES, MERGE_ROWS = 32 << 20, 20_000
#: A payload is very common if one page in so many has it, so there are at most so many of them.
VERY_COMMON = 20_000
#: Pages without a time are taken one second apart from here on: 2024-01-01.
START, SECONDS = 1_704_067_200, 1_000_000_000
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "url_key string, captured string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long, length long"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 digest in base 32: five hexadecimal digits are four of it."""
    hexes = F.sha1(payload)
    digit = lambda v, shift: F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    value = lambda i: F.conv(F.substring(hexes, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
    values = F.transform(F.sequence(F.lit(0), F.lit(7)), value)
    return F.array_join(F.transform(values, lambda v: F.concat(*[digit(v, s) for s in (15, 10, 5, 0)])), "")


def decided(pages: DataFrame, min_bytes: int, when: str | None) -> tuple[DataFrame, int]:
    """(page_id, url, payload, bytes, digest, moment, keeper) a page, and the number of pages an archive should have.

    keeper is the largest page_id with the payload where several pages have it. Only pages whose payload is repeated look
    it up; very common payloads are broadcast, and their pages scattered, so no payload brings its pages to one task.
    """
    moment = F.unix_seconds(F.col(when).cast("timestamp")) if when else F.lit(START) + F.pmod("page_id", F.lit(SECONDS))
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.coalesce(moment, F.lit(START)).alias("moment"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("same", F.when(F.col("bytes") >= min_bytes, F.unhex(F.sha2("payload", 256))))
    groups = stage(rows.groupBy("same").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all_bytes")), "payloads")
    n, total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("all_bytes"), F.lit(0))).first()
    repeated = groups.where("same is not null and n > 1")
    limit = n // VERY_COMMON
    hot = F.broadcast(repeated.where(F.col("n") > limit).where(F.col("n") > 100).select(F.col("same").alias("_hot"), F.struct("keeper").alias("_hot_keeper")))
    cool = repeated.where((F.col("n") <= limit) | (F.col("n") <= 100)).select(F.col("same").alias("_cool"), F.struct("keeper").alias("_cool_keeper"))
    tagged = rows.join(hot, F.col("same") == F.col("_hot"), "left")
    # A null joins with nothing, so Spark would send all pages of very common payloads to one task: their keys are made up.
    scattered = F.when(F.col("_hot").isNull() & F.col("same").isNotNull(), F.col("same")).otherwise(F.encode(F.concat(F.lit("-"), F.xxhash64("page_id", "url", "moment").cast("string")), "utf-8"))
    found = tagged.withColumn("_key", scattered).join(cool, F.col("_key") == F.col("_cool"), "left")
    keeper = F.coalesce(F.col("_hot_keeper"), F.col("_cool_keeper"))
    out = found.select("page_id", "url", "payload", "bytes", base32_sha1(F.col("payload")).alias("digest"), "moment", keeper.alias("keeper"))
    return out, max(1, min(1_000_000, ARCHIVE_BYTES * n // max(1, total)))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, when: str | None = None) -> None:
    """Write pages (page_id, url, html) as WARC archives below ``folder``. See archive_and_index for what counts."""
    rows, records = decided(pages, min_bytes, when)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper.keeper"))
    time = F.date_format(F.expr("to_utc_timestamp(timestamp_seconds(moment), current_timezone())"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.concat(F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("\r\nWARC-Date: "), time),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("keeper.keeper")))).otherwise(""),
        F.concat(F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit(END)),
    )
    record = F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(folder)


def url_key(url: str | None) -> str:
    """The host's labels in reverse, lower case and comma-joined, then ')' and the rest: pages of a domain lie together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:  # not a URL
        return url
    if not host:
        return url
    labels = host.lower().removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def records(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each record of an archive; a broken archive raises."""
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if end < 0 or lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(fields["Content-Length"])
        if raw[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the WARC record at {at} does not end where it says")
        yield at, stop + 4 - at, fields, raw[end + 4 : stop]
        at = stop + 4


def page_of(urn: str | None) -> int | None:
    name = urn[10:-1] if urn else "none"
    return None if name == "none" else int(name)


def capture(offset: int, length: int, fields: dict[str, str], block: bytes) -> tuple:
    """An index row, of CAPTURE's columns but the archive."""
    head, _, payload = block.partition(b"\r\n\r\n")
    said = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size, digest = int(said["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of the WARC record at {offset} is not the one of its digest")
    url = fields.get("WARC-Target-URI")
    time = "".join(c for c in fields["WARC-Date"] if c.isdigit())
    return (url_key(url), time, page_of(fields["WARC-Record-ID"]), url, fields["WARC-Type"], size, digest, page_of(fields.get("WARC-Refers-To")), offset, length)


def order(row: tuple) -> tuple:
    """URL key, time, page_id with null first, then the place: no two captures are equal in it."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def capture_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in CAPTURE.split(", "))])


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """The index rows of all archives below ``folder``, each archive's sorted by URL key, time and page_id: one run each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name, raw = path.as_py().rsplit("/", 1)[-1], content.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows = [capture(*r) for r in records(raw)]
                yield from batches_of(iter(sorted(((*r[:8], name, *r[8:]) for r in rows), key=order)), capture_schema())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, CAPTURE)


class LoserTree:
    """Merges k sorted runs: the winner of all is on top, each inner node keeps the loser of its match."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.heads: list[tuple | None] = [order(r[0]) if r else None for r in runs]
        self.losers = [-1] * k
        self.winner = -1
        for i in range(k):
            self._play(i)

    def _beats(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return b is None or (a is not None and a <= b)

    def _play(self, run: int) -> None:
        """Play the matches from a run's leaf to the top. A node that has met no run yet keeps the first to come."""
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = run
                return
            if not self._beats(run, other):
                self.losers[node], run = run, other
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner] is not None:
            run = self.winner
            rows, at = self.runs[run], self.at[run]
            yield rows[at]
            self.at[run] = at + 1
            self.heads[run] = order(rows[at + 1]) if at + 1 < len(rows) else None
            self._play(run)


def capture_histories(runs: DataFrame) -> DataFrame:
    """Runs of index rows merged to one index in global order: partitions hold ascending ranges, each in order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(row[8], []).append(row)
        for rows in held.values():
            if any(order(a) > order(b) for a, b in zip(rows, rows[1:])):
                rows.sort(key=order)  # a run whose pieces came out of order
        yield from batches_of(iter(LoserTree(list(held.values()))), capture_schema())

    parts = max(1, -(-runs.count() // MERGE_ROWS))
    dealt = runs.repartitionByRange(parts, "url_key", "captured", "page_id", "archive", "offset")
    return dealt.mapInArrow(merge, CAPTURE)


def archive_and_index(pages: DataFrame, min_bytes: int = 0, when: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as WARC archives in the shared folder and read them back as one index.

    Returns a row for each page in the order of URL key, time and page_id: url_key, captured (14 digits, UTC), page_id, url,
    record_type (response or revisit), payload_bytes, payload_digest (base 32 of the full payload's SHA-1), refers_to (the
    response's page_id for revisits), archive, offset and length (of the uncompressed archive).

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is the response; rows that
    repeat its page_id are responses too. A null html is an empty payload. A null page_id is smaller than all others, and such
    pages alone are all responses. A null url has the key '' and stays null; line ends in a url are written as %0D and %0A.
    ``when`` names the column of the capture time; without it, or where it is null, times follow page_id. A very long page is
    one record: it must fit a task. An empty table gives an empty index. Other columns are not read, whatever their names.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "archives")
    write_archives(pages, folder, min_bytes, when)
    return capture_histories(stage(read_captures(spark, folder), "capture-runs"))


ORACLE = r"""
WITH read AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), kept AS (
  SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS keeper, sha1(payload) AS h FROM read
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM kept
"""
