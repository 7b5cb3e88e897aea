"""Files by tasks: digests of any size in bounded memory, damaged blocks, copies, and first lines."""

import gzip
import hashlib
import os

from pyspark.sql import functions as F

from strata.plans import publish
from strata.sources import blocks
from strata.sources.files import file_checksums, first_lines


def files_of(folder, sizes):
    os.makedirs(folder, exist_ok=True)
    for i, size in enumerate(sizes):
        with open(f"{folder}/part-{i:02d} %20#.bin", "wb") as f:
            f.write(bytes((7 * i + k) % 251 for k in range(size)))


def test_digests_of_streams():
    data = bytes(range(256)) * 20
    for cut in (1, 7, 1000, 10**6):
        pieces = [data[i:i + cut] for i in range(0, len(data), cut)]
        for block in (1, 256, 999, 5120, 10**6):
            if block == 1 and cut > 1000:
                continue
            length, whole, parts = blocks.digests(iter(pieces), block)
            assert (length, whole) == (len(data), hashlib.sha256(data).hexdigest())
            assert parts == [hashlib.sha256(data[i:i + block]).hexdigest() for i in range(0, len(data), block)]
    assert blocks.digests(iter([]), 4) == (0, hashlib.sha256(b"").hexdigest(), [])


def test_a_sparse_file_over_two_gigabytes(spark, scratch):
    """More than one row may hold: the file is streamed, and never in memory as a whole."""
    path = f"{scratch}/large.bin"
    with open(path, "wb") as f:
        f.seek((2 << 30) + 5)
        f.write(b"x")
    row = file_checksums(spark, path, block_bytes=1 << 30).first()
    want = hashlib.sha256()
    for _ in range(2 << 10):
        want.update(bytes(1 << 20))
    want.update(bytes(5) + b"x")
    assert (row["length"], row["sha256"], len(row["blocks"])) == ((2 << 30) + 6, want.hexdigest(), 3)
    os.remove(path)


def test_a_damaged_block_is_located(spark, scratch):
    files_of(f"{scratch}/a", [1, 10, 5000, 4096])
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    pins = spark.createDataFrame(file_checksums(spark, f"{scratch}/a", block_bytes=1024).select(name, "blocks").collect(),
                                 "file string, blocks array<string>")
    with open(f"{scratch}/a/part-02 %20#.bin", "r+b") as f:
        f.seek(2050)
        f.write(b"\xff")
    with open(f"{scratch}/a/part-03 %20#.bin", "ab") as f:
        f.write(b"more")
    now = file_checksums(spark, f"{scratch}/a", block_bytes=1024).select(name, "blocks")
    assert sorted(map(tuple, blocks.damaged_blocks(now, pins, 1024).collect())) == [
        ("part-02 %20#.bin", 2, 2048), ("part-03 %20#.bin", 4, 4096)]


def test_twenty_files_are_installed_by_several_tasks(spark, scratch):
    files_of(f"{scratch}/landing", [1 + 3000 * i for i in range(20)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        names = blocks.listed(spark, f"{scratch}/landing")
        assert names.rdd.getNumPartitions() > 1
        done = publish.install(spark, f"{scratch}/landing", f"{scratch}/zone/files").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(done) == 20
    for r in done:
        data = open(f"{scratch}/landing/{r['file']}", "rb").read()
        assert data == open(f"{scratch}/zone/files/{r['file']}", "rb").read()
        assert r["written"] == r["length"] == len(data) and r["sha256"] == hashlib.sha256(data).hexdigest()


def test_a_repeated_copy_overwrites_what_a_lost_task_left(spark, scratch):
    files_of(f"{scratch}/landing", [5000])
    os.makedirs(f"{scratch}/zone/files")
    with open(f"{scratch}/zone/files/part-00 %20#.bin", "wb") as f:
        f.write(b"half of a copy" * 1000)
    publish.install(spark, f"{scratch}/landing", f"{scratch}/zone/files")
    assert open(f"{scratch}/zone/files/part-00 %20#.bin", "rb").read() == open(
        f"{scratch}/landing/part-00 %20#.bin", "rb").read()


def test_first_lines_read_the_beginning_only(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/in")
    for name, data in (("a.csv", b"h1,h2\r\n1,2\n"), ("b.csv", b""), ("c.csv", b"\nrest"), ("d.csv", b"no end")):
        with open(f"{scratch}/in/{name}", "wb") as f:
            f.write(data)
    with gzip.open(f"{scratch}/in/e.csv.gz", "wb") as f:
        f.write(b"packed\nrest")
    with open(f"{scratch}/in/f.csv", "wb") as f:
        f.write(b"head\n")
        f.seek(1 << 32)  # four gigabytes of nothing, never read
        f.write(b"x")
    got = {os.path.basename(r["path"]): r["line"] for r in first_lines(spark, f"{scratch}/in").collect()}
    assert got == {"a.csv": "h1,h2", "c.csv": "", "d.csv": "no end", "e.csv.gz": "packed", "f.csv": "head"}
    os.remove(f"{scratch}/in/f.csv")


def test_paths():
    assert blocks.opened("/a/b c")[1] == "/a/b c"
    assert blocks.opened("file:/a/b%20c")[1] == "/a/b%20c"
    assert blocks.opened("file:///a#b")[1] == "/a#b"
