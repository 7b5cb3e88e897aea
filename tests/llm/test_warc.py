"""Archives, revisit records, and the merge of sorted runs."""

import base64
import gzip
import hashlib
import os
import random

from pyspark.sql import functions as F

from strata.llm import warc
from strata.session import scratch_dir

SCHEMA = "page_id long, url string, html string"


def histories(spark, pages, **options):
    folder = scratch_dir(spark, "test-warc")
    warc.write_archives(pages, folder, F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)), **options)
    return folder, warc.capture_histories(spark, folder)


def test_loser_tree_merges_like_sorted():
    rng = random.Random(4)
    for runs in (0, 1, 2, 3, 7, 8, 20):
        made = [sorted(((f"k{rng.randint(0, 9)}", "t", rng.randint(0, 99)) for _ in range(rng.randint(0, 30))),
                       key=warc.order) for _ in range(runs)]
        assert list(warc.LoserTree(made)) == sorted((x for r in made for x in r), key=warc.order)


def test_round_trip_with_awkward_payloads(spark):
    nasty = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 3
    rows = [(3, "http://b.example.com/x?q=1#f", nasty), (1, "http://a.example.com/", "same"),
            (9, "https://a.example.com/z", "same"), (2, "http://a.example.com/", "same"), (4, None, None), (5, "", ""),
            (None, "http://a.example.com/", "same"), (None, "no scheme\r\nX: y", "alone"),
            (7, "http://a.example.com/", "hé\U0001f600"), (8, "u", "y" * 300_000), (8, "u", "y" * 300_000)]
    folder, found = histories(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), per_archive=2)
    got = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                 for r in found.collect())
    firsts = {"same": 1, "": 4}
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = firsts.get(html or "")
        again = first is not None and page != first
        want.append((page or -1, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=lambda r: r[:4])
    names = [n for n in os.listdir(folder.replace("file:", "")) if n.startswith("part-")]
    text = gzip.open(f"{folder.replace('file:', '')}/{names[0]}").read()
    assert text.startswith(warc.VERSION) and text.endswith(warc.END)


def test_histories_are_in_global_order(spark):
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.concat(
        F.lit("http://h"), F.pmod(F.hash("id"), F.lit(7)), F.lit(".example.com/p")).alias("url"),
        F.col("id").cast("string").alias("html"))
    _, found = histories(spark, pages, per_archive=40)
    rows = [(r["urlkey"], r["timestamp"], r["page_id"]) for r in found.collect()]
    assert rows == sorted(rows) and len(rows) == 600
    assert rows[0][0].startswith("com,example,h")


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(i, "u", "ab") for i in range(4)], SCHEMA)
    _, found = histories(spark, pages, min_bytes=3)
    assert {r["record_type"] for r in found.collect()} == {"response"}


def test_empty_table(spark):
    _, found = histories(spark, spark.createDataFrame([], SCHEMA).withColumn("digest", F.lit(1)))
    assert found.count() == 0
