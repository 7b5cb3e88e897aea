"""URL rules and the exactness of the filter cascade."""

from pyspark.sql import functions as F

from conftest import SF001, plan_text
from strata.llm import queries, urlfilter


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("key-"), F.pmod("id", F.lit(3000))).alias("key"))
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("key-"), "id").alias("key"))
    for bits in (urlfilter.MAX_LEVEL_BITS, 0):  # as an expression, and by the join for large lists
        cascade = urlfilter.Cascade(spark, universe, listed, bits)
        assert len(cascade.levels) > 1
        marked = cascade.mark(universe, "key")
        wrong = marked.where(F.col("listed") != (F.pmod(F.substring("key", 5, 9).cast("int"), F.lit(3)) == 0))
        assert wrong.count() == 0 and marked.count() == 4000


def test_lookup_has_no_join(spark):
    universe = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = urlfilter.Cascade(spark, universe, universe.where("key < 'k3'"))
    plan = plan_text(cascade.mark(universe, "key"))
    assert "Join" not in plan and "Python" not in plan


def test_rules_and_edge_cases(spark):
    rows = [(1, "http://a.EXAMPLE.org/en/17"), (2, "http://example.org/es/x"), (3, "http://example.org"),
            (4, "http://notexample.org/es/"), (5, "http://x.com/fr/a"), (6, "http://x.com/de/?q"), (7, "http://x.net/de/"),
            (8, None), (9, "x.org/"), (10, ""), (None, "ftp://x.com#/fr/"), (7, "http://x.net/de/"),
            (11, "http://a.org/es/://b.com/fr/"), (12, "http://org/"), (13, "http://a\nb.net/p\nq?")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit(0) for c in ("host", "key", "row", "listed", "verdict")})
    listed = spark.createDataFrame([("x.net/de/",), ("",)], "key string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(
        pages, queries.URL_RULES, listed).select("row.page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {
        (1, "a.example.org", "/en/17", "example.org/en/1", "block"), (2, "example.org", "/es/x", "example.org/es/", "block"),
        (3, "example.org", "", None, "allow"), (4, "notexample.org", "/es/", "org/", "allow"),
        (5, "x.com", "/fr/a", "com/fr/", "allow"), (6, "x.com", "/de/", "com/de/", "block"),
        (7, "x.net", "/de/", None, "block"), (8, "", "", None, "block"), (9, "", "", None, "block"),
        (10, "", "", None, "block"), (None, "x.com", "", None, "allow"),
        (11, "a.org", "/es/://b.com/fr/", "org/", "allow"), (12, "org", "/", "org/", "allow"),
        (13, "a\nb.net", "/p\nq", None, "allow")}
    none = pages.limit(0)
    assert urlfilter.judge_urls(none, queries.URL_RULES, listed).count() == 0
    empty = urlfilter.judge_urls(pages, [], listed.limit(0))
    assert {r["verdict"] for r in empty.collect()} == {"allow"} and empty.count() == len(rows)


def test_query_equals_plain_membership(spark):
    got = queries.op4_url_filter(spark, SF001)
    labels = got.where(F.col("host").rlike("(^|[.])(" + "|".join(queries.LISTED_LABELS) + ")([.]|$)"))
    assert labels.where("not listed").count() == 0
    assert got.where("listed").count() == labels.count() > 0
