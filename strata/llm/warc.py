"""WARC archives and their capture index, by external merge.

Archives are written by Spark's text writer: a value is one record up to the end of its block, and the record
separator is the blank line that ends a WARC record. So every archive is a plain, compressed WARC file, written through
the commit protocol on any file system. Payloads are compared by their SHA-1 and length: of equal ones, the record of
the smallest page_id is the response, the others are revisits that refer to it and carry no payload. Only digests are
grouped, after partial aggregation; the pages meet the digests that occur more than once.

Reading back, each archive is one stream (compressed files are not split), cut at the version line and joined again
where a payload contains that line, as its content length tells. The captures of an archive, sorted by URL key and
timestamp, are its run. Runs are stored, dealt out by ranges of the key, and in each range a loser tree merges them: a
range receives slices of sorted runs, so every descent of the key starts a new slice. Ranges are sized by the number of
captures, and equal URLs are told apart by their timestamps and page_ids, so a URL that holds a third of all captures
is cut into several ranges too. The result is globally ordered: by partition, and within each.

Defined results: a null html is an empty payload; a null url has no target and an empty URL key; rows with a null
page_id are revisits of an equal payload with a page_id, else responses; fully repeated rows are the same capture
twice and get the same type; of captures of one URL and time the smaller page_id is first; very long payloads are one
record; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.common import ship_code, written

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_ARCHIVE = 20_000
CAPTURES_PER_RANGE = 200_000
MIN_REVISIT_BYTES = 0
#: fixed values: the digits of Spark's conv() in base 32, and those of RFC 4648
BASE32_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
KEY = ["urlkey", "timestamp", "page_id"]
CAPTURE = "urlkey string, timestamp string, page_id long, record_type string, payload_bytes long, " \
          "payload_digest string, refers_to long, archive string, offset long"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in base 32: 160 bits as four numbers of 40 bits, eight digits each."""
    text = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(text, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), *BASE32_DIGITS)


def with_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, captured, payload) with digest, ``first`` (the response's page_id) and record_type."""
    found = pages.withColumns({"digest": base32_sha1(F.col("payload")),
                               "bytes": F.length("payload").cast("long")})
    copies = (found.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
              .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
              .where("n > 1 and first is not null").drop("n"))
    joined = found.join(written(copies, "payloads"), ["digest", "bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response"))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def record_of(typed: DataFrame) -> Column:
    """The bytes of a record up to the end of its block."""
    revisit = F.col("record_type") == "revisit"
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    utc = F.to_utc_timestamp(F.timestamp_seconds("captured"), F.current_timezone())
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, F.lit(b"")).otherwise(F.concat(F.encode(http, "UTF-8"), F.col("payload")))
    head = F.concat(
        F.lit(VERSION.decode()),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", ident("page_id")),
        _line("WARC-Date", F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", target),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", ident("first")), _line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"))
    return F.concat(F.encode(head, "UTF-8"), block)


def write_archives(pages: DataFrame, folder: str, captured: Column, min_bytes: int = MIN_REVISIT_BYTES,
                   per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """Write one record per row of ``pages`` (page_id, url, html); ``captured`` is its time in seconds since 1970."""
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", captured.alias("captured"),
                          F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    typed = with_types(chosen, min_bytes)
    (typed.select(record_of(typed).cast("string").alias("value")).write.option("lineSep", END.decode())
     .option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(folder))


def url_key(url: str) -> str:
    """The host's labels from the right, then path and query, all in lower case."""
    rest = url.partition("://")[2] or url
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].partition("#")[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + (path or "/") if url else ""


def parse_record(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields and block of a record (without its version line); None if more of it must follow."""
    head, found, rest = record.partition(END)
    if not found:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    size = int(fields["Content-Length"])
    return (fields, rest[:size]) if len(rest) >= size + len(END) else None


def capture_of(fields: dict[str, str], block: bytes, archive: str, offset: int) -> tuple:
    ident = lambda x: None if x is None or x == "<urn:page:none>" else int(x[len("<urn:page:"):-1])
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block.partition(END)[2]
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (url_key(fields.get("WARC-Target-URI", "")), fields["WARC-Date"], ident(fields["WARC-Record-ID"]),
            fields["WARC-Type"], size, digest, ident(fields.get("WARC-Refers-To")), archive, offset)


def order(capture: tuple) -> tuple:
    """URL key, timestamp, page_id (null first)."""
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0


def capture_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of the archives in ``folder``; those of one archive are a sorted run."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, record, offset, run = None, None, 0, []
        for batch in source:
            for part, name in zip(batch.column("value").to_pylist(), batch.column("archive").to_pylist()):
                if name != archive:
                    if record is not None:
                        raise ValueError(f"{archive} ends within a record")
                    yield from captures(sorted(run, key=order))
                    archive, record, offset, run = name, None, 0, []
                    continue  # what stands before the first version line: nothing
                record = part if record is None else record + VERSION + part
                parsed = parse_record(record)
                if parsed:
                    run.append(capture_of(*parsed, archive, offset))
                    offset += len(VERSION) + len(record)
                    record = None
        if record is not None:
            raise ValueError(f"{archive} ends within a record")
        yield from captures(sorted(run, key=order))

    ship_code(spark)
    parts = spark.read.option("lineSep", VERSION.decode()).text(folder)
    return parts.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("archive")
                        ).mapInArrow(batches, CAPTURE)


def captures(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Captures as batches of the schema :data:`CAPTURE`."""
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split(" ") for f in CAPTURE.split(", ")]
    for at in range(0, len(rows), 8192):
        columns = zip(*rows[at:at + 8192])
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                         [n for n, _ in fields])


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, so the next least one costs one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.keys = [order(r[0]) if r else None for r in runs]
        self.size = max(1, len(runs))
        self.tree = [-1] * self.size
        for leaf in range(len(runs)):
            self._play(leaf, opening=True)

    def _before(self, a: int, b: int) -> bool:
        """Whether the head of run a goes before that of run b; finished runs go last, ties by number of the run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, leaf: int, opening: bool = False) -> None:
        winner, node = leaf, (leaf + self.size) >> 1
        while node:
            held = self.tree[node]
            if held < 0 and opening:  # the opponent has not come yet
                self.tree[node] = winner
                return
            if self._before(held, winner):
                self.tree[node], winner = winner, held
            node >>= 1
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.keys[winner := self.tree[0]] is not None:
            run, at = self.runs[winner], self.at[winner]
            yield run[at]
            self.at[winner] = at = at + 1
            self.keys[winner] = order(run[at]) if at < len(run) else None
            self._play(winner)


def merge_runs(runs: DataFrame, per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """The captures of all runs in global order of URL key, timestamp and page_id."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: list[list[tuple]] = []
        last = None
        for batch in source:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                key = order(row)
                if last is None or key < last:
                    slices.append([])
                slices[-1].append(row)
                last = key
        some = []
        for row in LoserTree(slices):
            some.append(row)
            if len(some) == 8192:
                yield from captures(some)
                some = []
        yield from captures(some)

    spark = runs.sparkSession
    ship_code(spark)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(runs.count() / per_range))
    return runs.repartitionByRange(ranges, *KEY).mapInArrow(batches, CAPTURE)


def capture_histories(spark: SparkSession, folder: str) -> DataFrame:
    """The globally ordered index of the archives in ``folder``."""
    return merge_runs(written(capture_runs(spark, folder), "capture-runs"))
