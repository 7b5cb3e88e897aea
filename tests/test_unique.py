"""Uniqueness by hash runs against plain counting, and how many bytes it shuffles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from strata.operators import unique
from strata.operators.profile import duplicate_keys
from strata.plans import catalog


def same(df, keys, **options):
    plain = duplicate_keys(df, keys, options.pop("ignore_blank_keys", False)).first()
    got = unique.repeated_keys(df, keys, **options).first()
    assert tuple(got) == tuple(plain)
    return tuple(got)


def test_tables(spark):
    orders, lines = catalog.table(spark, SF01, "orders"), catalog.table(spark, SF01, "lineitem")
    assert same(orders, "o_orderkey") == (0, 0, 15000)
    assert same(lines, ["l_orderkey", "l_linenumber"])[0] > 0
    assert same(lines.repartition(7), "l_returnflag")[:2] == (3, 60000)


@pytest.mark.parametrize("bits", [30, 40, 62])
def test_hot_null_and_rare_keys(spark, bits):
    rng = random.Random(bits)
    rows = [("hot", 1)] * 500 + [(None, 2)] * 3 + [(None, None)] + [(f"k{i}", i) for i in range(3000)]
    rows += [(f"k{rng.randrange(3000)}", rng.randrange(3000)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    same(df, "k", bits=bits)
    same(df, ["k", "n"], bits=bits, slices=4)
    assert same(df.limit(0), "k", bits=bits) == (0, 0, 0)


def test_many_runs_and_a_filter_that_lets_too_much_through(spark, monkeypatch):
    df = spark.range(20000).select((F.col("id") % 15000).alias("k")).repartition(3)
    assert same(df, "k", bits=unique.FILTER_BITS) == (5000, 10000, 15000)  # the shortest hashes


def test_blank_keys_can_be_left_out(spark):
    df = spark.createDataFrame([("a",), ("a",), (" ",), (" ",), (None,), ("b",)], "k string")
    assert tuple(unique.repeated_keys(df, "k", ignore_blank_keys=True).first()) == (1, 2, 2)


def test_bits_are_bounded(spark):
    with pytest.raises(ValueError, match="bits"):
        unique.repeated_keys(spark.range(3), "id", bits=63)


def test_packing():
    rng = np.random.default_rng(1)
    for values in ([], [0], [5], [0, 1, 2], [1 << 62], rng.integers(0, 1 << 40, 1000)):
        values = np.unique(np.array(values, np.int64))
        assert (unique.unpack(unique.pack(values)) == values).all()
    keys = np.unique(rng.integers(0, 1 << unique.BITS, unique.RUN_KEYS))
    assert len(unique.pack(keys)) < 2.7 * len(keys)  # bytes a key; a shuffled row of key and count has 24 and more
