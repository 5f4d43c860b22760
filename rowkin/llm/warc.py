"""WARC archives of captures, and the external merge of their indexes.

Writing. Each page becomes one WARC/1.1 record of UTF-8 text. Of records with equal payloads the one with the
largest page id is a response, the others are revisits that refer to it and hold no payload. Spark's text
writer stores the records: with CR LF CR LF as its line end, which also ends a WARC record, a part file is a
well-formed archive (gzip as a whole), written through Hadoop's file systems and so to any store that Spark
writes to. Equal payloads meet as (SHA-1, largest id) in a partial aggregate, so that a hot payload moves one
row a task; the payloads themselves move once, with their own record, dealt by digest to as many files as their bytes
ask for. Gzip compresses a file as a whole, so that `offset` is a place in the uncompressed archive.

Reading. binaryFile hands each archive to one task as one value, which walks its records by Content-Length and checks each
payload's digest. A file has at most MOST_BYTES before compression, or one record: the longest payload of the table
bounds the records of a file, also where one payload under one id fills a task.

Index merge. An archive's captures, sorted by (url key, time, page id), are a run. Runs are dealt to ranges of that
key by Spark's range partitioning, about RANGE_ROWS captures each, which splits a url with many captures between
ranges, and in each range a loser tree merges the runs' shares, k-way. The merge finds the runs by itself, as the ascending stretches of
what arrives: it needs no order from the shuffle, it only gains from it. The ranges one after the other hold
the captures in global order: every url's history is contiguous and in order of time.

Captures have no time of their own: they get page id seconds, modulo ten years, after EPOCH. It is written in UTC whatever
the session's zone, always with a four-digit year, so that dates sort as text; equal dates are in order of the page id.

Nulls and odd rows: a page id may be any bigint; a null payload is empty; a null url has the url key ")"; a null page id is record
"null"; pages that repeat an id are written as often as they occur, and the page id of the digest's response
is still one; an empty table gives an empty result. Extra columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_broadcast, written

CRLF = "\r\n"
EPOCH = "2024-01-01"
TEN_YEARS = 10 * 365 * 86_400
#: Payload bytes that a file is meant to have, and the most that it has unless one record has more.
FILE_BYTES, MOST_BYTES = 32 << 20, 1 << 30
#: Bytes of a record beside its payload and url.
HEADERS = 1024
RANGE_ROWS = 250_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a string's SHA-1: five hexadecimal digits are four base32 digits."""
    hexes = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hexes, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: str) -> str:
    """Sort-friendly url key: host labels from the top, then ) and the rest without fragment; in lower case."""
    rest = url.partition("://")[2]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return (",".join(reversed(rest[:cut].split("."))) + ")" + rest[cut:].partition("#")[0]).lower()


def capture_date(page_id: Column) -> Column:
    """WARC date of a page id, by arithmetic on days and seconds: no time zone is involved."""
    at = F.pmod(F.coalesce(page_id.cast("bigint"), F.lit(0).cast("bigint")), F.lit(TEN_YEARS))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(at / 86_400).cast("int")).cast("string")
    second = at % 86_400
    return F.concat(day, F.lit("T"), two(second / 3600), F.lit(":"), two(second % 3600 / 60), F.lit(":"), two(second % 60), F.lit("Z"))


def _no_breaks(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]", " ")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, files: int | None = None, max_broadcast: int = 100_000) -> DataFrame:
    """One row (value: string) per page: its whole WARC record without the last CR LF CR LF; dealt by digest to `files` partitions, if given."""
    p = pages.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    )
    p = p.withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload")})
    shared = p.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = written(shared, "warc-digests")  # read twice: to be counted and to be joined
    p = p.repartition(files, "digest") if files else p
    p = p.join(sized_broadcast(shared, max_broadcast), "digest", "left")
    revisit = (F.col("first") != F.col("id")) & (F.col("bytes") >= min_bytes)
    p = p.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"))
    block = F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), capture_date(F.col("id"))),
        F.concat(F.lit("WARC-Target-URI: "), _no_breaks(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first")))),
        F.when(F.col("revisit"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
        F.lit(""),
        block,
    ]
    return p.select(F.concat_ws(CRLF, *lines).alias("value"))


def write_warc(pages: DataFrame, path: str, url_col: str = "url", payload_col: str = "html", file_bytes: int = FILE_BYTES, most_bytes: int = MOST_BYTES, **columns) -> None:
    """Write pages' records under path, part-*.txt.gz, each a gzipped WARC file of about file_bytes of payload, and of
    at most most_bytes unless one record has more."""
    n = F.coalesce(F.octet_length(payload_col), F.lit(0)).cast("bigint") + F.coalesce(F.octet_length(url_col), F.lit(0)) + HEADERS
    total, longest = pages.agg(F.sum(n), F.max(n)).first()
    total, cores = total or 0, pages.sparkSession.sparkContext.defaultParallelism
    files = max(1, math.ceil(total / file_bytes), min(math.ceil(total / (1 << 20)), cores))
    out = records(pages, url_col=url_col, payload_col=payload_col, files=files, **columns)
    out = out.write.option("lineSep", CRLF * 2).option("compression", "gzip")
    out.option("maxRecordsPerFile", max(1, most_bytes // (longest or 1))).text(path)


def walk(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        head = archive.index(b"\r\n\r\n", at)
        lines = archive[at:head].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        start = head + 4
        end = start + int(headers["Content-Length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} isn't {headers['Content-Length']} bytes long")
        yield at, headers, archive[start:end]
        at = end + 4


def base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


READ = "url_key string, date string, number bigint, page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, archive string, offset bigint"


def _id_of(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:page:").removesuffix(">") if urn else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under path, its payload's digest checked; archive and offset say where it is.

    An archive's rows come sorted by (url_key, date, number), number being the page id: a local run of the index.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                content, rows = zlib.decompress(content, wbits=31) if content[:2] == b"\x1f\x8b" else content, []
                for at, h, block in walk(content):
                    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if kind == "response" and (base32(payload) != digest or len(payload) != int(h["WARC-Payload-Length"])):
                        raise ValueError(f"{name}, byte {at}: the payload isn't that of its digest")
                    page, url = _id_of(h["WARC-Record-ID"]), h["WARC-Target-URI"]
                    number = int(page) if page.lstrip("-").isdigit() else -1
                    refers_to = _id_of(h.get("WARC-Refers-To"))
                    rows.append((url_key(url), h["WARC-Date"], number, page, url, int(h["WARC-Payload-Length"]), digest, kind, refers_to, name, at))
                rows.sort(key=lambda r: r[:3])
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(scan, READ)


class LoserTree:
    """k-way merge of sorted runs: one comparison a level for each item, against the losers on the winner's way."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _less(self, i: int, j: int) -> bool:
        """Whether run i's head comes before run j's; an ended run comes last, equal heads by run."""
        a, b = self.at[i] < len(self.runs[i]), self.at[j] < len(self.runs[j])
        if not (a and b):
            return a
        x, y = self.runs[i][self.at[i]], self.runs[j][self.at[j]]
        return x < y or (x == y and i < j)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.tree[node]
            if other < 0:  # while the tree is built, the first to come waits for the second
                self.tree[node] = winner
                return
            if self._less(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        for _ in range(sum(map(len, self.runs))):
            i = self.tree[0]
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self._play(i)


def ascending_runs(keys: list) -> list[list]:
    runs: list[list] = []
    for x in keys:
        if runs and runs[-1][-1] <= x:
            runs[-1].append(x)
        else:
            runs.append([x])
    return runs


def merge_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """captures (of read_warc) in global order of (url_key, date, number), with range and place, which are that order.

    The runs are written to the shared folder, because range partitioning reads them twice: for its sample and to deal.
    A task holds its range's captures, about range_rows however many there are in all.
    """
    runs = written(captures, "warc-runs")
    rows, cores = runs.count(), captures.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, math.ceil(rows / range_rows), min(cores, math.ceil(rows / 1000)))
    dealt = runs.repartitionByRange(ranges, "url_key", "date", "number")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        held.clear()
        heads = list(zip(rows["url_key"], rows["date"], rows["number"], range(len(rows)), strict=True))
        order = [x[3] for x in LoserTree(ascending_runs(heads))]
        for at in range(0, len(order), 10_000):
            some = order[at : at + 10_000]
            yield rows.iloc[some].reset_index(drop=True).assign(place=range(at, at + len(some)))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    merged = dealt.mapInPandas(merge, f"{fields}, place bigint")
    return merged.withColumn("range", F.spark_partition_id())


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
d AS (
  SELECT *, list_aggregate(list_transform(generate_series(0, 31), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)),
      'string_agg', '') AS payload_digest
  FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM m
"""
