"""Versioned layers: what readers see when a run stops at any step, two runs at once, and which folders are removed."""

import os

import pytest

from conftest import SF001
from strata.plans import catalog, flow, publish
from strata.plans.lake import Lake
from strata.plans.layers import LayerPaths, fingerprint_of
from strata.sources import fs
from strata.spec import GOLD_TABLES


def run(spark, root, **options):
    return catalog.run_feed(spark, catalog.feed(spark, SF001), root, **options)


def state(spark, root):
    """What a reader finds: the fingerprint of every table, through the commit."""
    paths = Lake(spark, root).paths()
    return {name: fingerprint_of(spark.read.parquet(location)) for name, _, location in paths.registry()}


class Killed(BaseException):
    """Stands for the end of the driver."""


STEPS = [(flow, "quality_gate"), (flow, "build_silver"), (flow.quality, "enforce"), (flow, "build_gold"),
         (flow.gold, "customer_risk"), (Lake, "commit")]


def test_a_run_killed_at_any_step_leaves_the_last_layers(spark, scratch, monkeypatch):
    root = f"{scratch}/lake"
    first = run(spark, root)
    before = state(spark, root)
    assert before == first.fingerprints and first.commit == 1
    other = catalog.feed(spark, SF001).limit(700)

    def killed(*_, **__):
        raise Killed

    for where, name in STEPS:
        with monkeypatch.context() as m, pytest.raises(Killed):
            m.setattr(where, name, killed)
            flow.run_layers(spark, other, root, source_label="other")
        assert state(spark, root) == before
    # the commit file itself cut short: readers pass over it, and the next run takes the number after it
    fs.write_text(spark, f"{root}/_commits/customer_churn-0000000002.json", '{"run": "x", "tables": {"bro')
    assert state(spark, root) == before
    assert run(spark, root).commit == 3
    assert {n for n, _, _ in publish.discover_tables(spark, root)} == set(before)


def test_nothing_is_renamed_or_removed_by_a_run(spark, scratch):
    root = f"{scratch}/lake"
    inodes = lambda: {os.stat(os.path.join(d, n)).st_ino for d, _, names in os.walk(root) for n in names}
    run(spark, root)
    before = inodes()
    run(spark, root)
    assert before <= inodes()
    assert not os.path.exists(f"{root}/_staging")


def test_two_runs_that_end_together_get_two_commits(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    a, b = lake.begin(), lake.begin()
    taken = lake._numbers
    lake._numbers = lambda: []  # neither has seen the other's commit
    first, second = lake.commit(a), lake.commit(b)
    lake._numbers = taken
    assert (first.number, second.number) == (1, 2) and lake.current().run == b.run


def test_vacuum_keeps_what_commits_name_and_runs_under_way(spark, scratch):
    root = f"{scratch}/lake"
    runs = [run(spark, root) for _ in range(3)]
    lake = Lake(spark, root)
    assert lake.vacuum(keep=2) == []  # all are young
    spark.range(1).write.parquet(lake.begin().bronze)  # begun, not committed
    gone = lake.vacuum(keep=2, older_than_s=0)
    assert runs[0].paths.bronze in gone and len(gone) == len(GOLD_TABLES) + 3
    assert [c.number for c in lake.commits()] == [2, 3]
    assert state(spark, root) == runs[2].fingerprints


def test_plain_layers_are_read_where_nothing_is_committed(spark, scratch):
    paths = LayerPaths(f"{scratch}/plain")
    catalog.q_executive_kpis(spark, SF001).write.parquet(paths.gold("gold_executive_kpis"))
    assert flow.read_gold(spark, f"{scratch}/plain", "gold_executive_kpis").count() == 1


def test_registered_tables_follow_the_commit(spark, scratch):
    root = f"{scratch}/lake"
    read = lambda: spark.sql("SELECT total_customers FROM lake_pub.gold_executive_kpis").first()[0]
    run(spark, root)
    publish.publish(spark, publish.discover_tables(spark, root), "lake_pub", dry_run=False)
    assert read() == 1500
    flow.run_layers(spark, catalog.feed(spark, SF001).limit(700), root, source_label="other")
    assert read() == 1500  # until it is published again
    publish.publish(spark, publish.discover_tables(spark, root), "lake_pub", dry_run=False)
    assert read() == 700
    spark.sql("DROP SCHEMA lake_pub CASCADE")


def test_fingerprints_count_repeated_rows_and_ignore_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k long, v string")
    same = fingerprint_of(df.orderBy("v").repartition(3))
    assert same == fingerprint_of(df) and same["rows"] == 3
    assert fingerprint_of(df.distinct()) != same
    assert fingerprint_of(df.replace(1, 3, "k")) != same
    assert fingerprint_of(df.limit(0)) == {"rows": 0, "first": "0", "second": "0"}
