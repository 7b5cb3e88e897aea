"""Benchmark decontamination: copies, re-parameterised questions, inconsistent ones, and clean documents."""

import edge
import pytest

from conftest import SF001
from strata.llm import decontam
from strata.llm.common import table

ITEM = ("A farmer named Tom has 12 apples and gives Tom a box of 12 kg while Anna buys 30 oranges at the market and "
        "then Anna sells half of the 30 oranges to Tom for a small price")
OTHER = "Why does the moon look larger near the horizon than when it is high above in the sky at night"


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, OTHER), (3, None), (4, "two words"), (None, "short but full item"),
                                  (2, OTHER)], "item_id long, text string")


def pairs(spark, docs, bench=None, **options):
    found = decontam.leaks(docs, bench if bench is not None else benchmark(spark), **options)
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in found.collect()}


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 0])
def test_kinds_of_leaks(spark, max_words):
    renamed = ITEM.replace("Tom", "Jim").replace("Anna", "Mary").replace("12", "45").replace("30", "7")
    inconsistent = ITEM.replace("named Tom", "named Jim").replace("12 apples", "99 apples").replace("buys 30", "buys 7")
    half = " ".join(OTHER.split()[:14])
    few = " ".join(OTHER.split()[:9])
    filler = edge.sentence(1, 50)
    texts = [f"{filler} {ITEM} {filler}", f"{filler} {renamed}", f"{inconsistent} {filler}", f"{filler}\n{half}\n{filler}",
             f"{few} {filler}", filler, f"{OTHER} {renamed}", "a short but full item stands here"]
    got = pairs(spark, documents(spark, texts), max_words=max_words)
    assert got == {(0, 1): "copy", (1, 1): "re-parameterised", (3, 2): "copy", (6, 2): "copy",
                   (6, 1): "re-parameterised", (7, None): "copy"}


def test_passages_in_documents_equal_a_brute_force_search(spark):
    docs, bench = (table(spark, SF001, n, k, "text") for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    grams = {}
    for r in bench.collect():
        words = r["text"].split()
        for i in range(len(words) - 9):
            grams.setdefault(tuple(words[i:i + 10]), set()).add(r["item_id"])
    want = set()
    for r in docs.collect():
        words = (r["text"] or "").split()
        for i in range(len(words) - 9):
            want |= {(r["doc_id"], item) for item in grams.get(tuple(words[i:i + 10]), ())}
    assert want and set(pairs(spark, docs, bench)) == want


def test_edge_cases(spark):
    docs = edge.documents(spark)
    assert pairs(spark, docs) == {}
    bench = spark.createDataFrame([(9, edge.sentence(2, 60)), (8, edge.sentence(1, 80))], "item_id long, text string")
    assert set(pairs(spark, docs, bench)) == {(5, 9), (None, 8)}
    clean = decontam.without_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 3
    assert clean.where("doc_id = 5").count() == 1  # its other text holds no item
    assert decontam.without_leaks(edge.none(spark), bench).count() == 0
    assert decontam.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_template_tokens():
    token = lambda w: decontam.token_of(w)[0]
    assert [token(w) for w in ("12", "3,000.5", "(7)", "5kg", "40%", "miles", "Tom,", "\"the\"", "...", "twelve", "Twenty-five,", "one-way")] == [
        "<number>", "<number>", "<number>", "<quantity>", "<quantity>", "<unit>", "tom", "the", "", "<number>", "<number>",
        "one-way"]
    names = ("Tom", "McDonald", "O'Neil", "Jean-Luc", "DeMarco", "Ann's")
    assert all(decontam.token_of(w)[1] for w in names) and not any(
        decontam.token_of(w)[1] for w in ("tom", "iPhone", "NASA", "A", "B2B", "Twelve"))
    assert decontam.token_of("Anna")[1] and not decontam.token_of("USA")[1]
    assert decontam.token_of("end.")[2] and decontam.token_of('end."')[2] and not decontam.token_of("end,")[2]


QUESTION = "Tom has 12 apples. Anna buys 5 more apples. Tom eats 3 apples today. Anna sells 4 apples to neighbours."


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 0])
def test_capitalised_words_at_sentence_starts_are_read_both_ways(spark, max_words):
    heading = "What colour is the old barn door"
    bench = spark.createDataFrame([(1, QUESTION), (2, heading), (3, "Give the colour of that barn")],
                                  "item_id long, text string")
    renamed = QUESTION
    for old, new in (("Tom", "Jim"), ("Anna", "Mary"), ("12", "45"), ("5", "8"), ("3", "6"), ("4", "9")):
        renamed = renamed.replace(old, new)
    texts = [renamed, f"Exercise {renamed}", f"in the heading {heading} and so on", heading.lower(),
             f"as a title Give The Colour of that barn {edge.sentence(1, 9)}", QUESTION.lower()]
    got = pairs(spark, documents(spark, texts), bench, max_words=max_words)
    assert got == {(0, 1): "re-parameterised", (1, 1): "re-parameterised", (2, 2): "copy", (3, 2): "copy", (4, 3): "copy",
                   (5, 1): "copy"}


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 0])
def test_copies_of_items_full_of_numbers_are_found(spark, max_words):
    full, short = "Compute 12 + 34 - 5 * 6 km in 7 hours 8 days 9 km", "12 km + 3 km"
    bench = spark.createDataFrame([(1, full), (2, short), (3, "two words"), (4, " "), (5, None), (6, "7 + 8")],
                                  "item_id long, text string")
    texts = [f"{edge.sentence(1, 9)} {full} {edge.sentence(2, 9)}", f"{edge.sentence(3, 9)} {short}",
             f"{edge.sentence(4, 9)} 13 km + 4 km", " ".join(full.split()[4:])]
    found = decontam.leaks(documents(spark, texts), bench, max_words=max_words).collect()
    n = len(full.split()) - decontam.WINDOW + 1
    assert sorted((r["doc_id"], r["item_id"], r["n_windows"], r["matched"], r["kind"]) for r in found) == [
        (0, 1, n, n, "copy"), (1, 2, 1, 1, "copy"), (3, 1, n, n - 4, "copy")]
    assert decontam.unmatched_items(bench) == 2


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 0])
def test_one_changed_value_does_not_hide_what_stands_around_it(spark, max_words):
    long = f"{edge.sentence(5, 60)} 2 apples {edge.sentence(6, 60)} 2 days {edge.sentence(7, 60)}"
    bench = spark.createDataFrame([(1, long), (2, QUESTION)], "item_id long, text string")
    renamed = QUESTION.replace("Tom", "Jim").replace("Anna", "Mary")
    texts = [long.replace("2 apples", "5 apples"), renamed.replace("today. Mary", "today. So Mary"),
             f"{edge.sentence(8, 20)} 2 apples {edge.sentence(9, 20)}"]
    got = pairs(spark, documents(spark, texts), bench, max_words=max_words)
    assert got == {(0, 1): "copy", (1, 2): "re-parameterised"}


def test_values_that_agree():
    window = lambda at, *slots: {"item_position": at, "slots": list(slots)}
    kept = lambda *windows: [w["item_position"] for w in decontam.agreeing(list(windows))]
    assert kept(window(0, (1, "a", "x", True)), window(9, (10, "a", "y", True)), window(20)) == [20]
    assert kept(*(window(i, (i, "a", "xxy"[i], True)) for i in range(3))) == [0, 1]
    assert kept(*(window(i, (i, "a", "xyy"[i], not i)) for i in range(3))) == [0]
    assert kept(*(window(i, (i, "a", "xyy"[i], False)) for i in range(3))) == [1, 2]


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 0])
def test_number_words_names_and_units_are_slots(spark, max_words):
    item = ("McDonald and O'Neil share twelve cakes with Jean-Luc, then O'Neil walks 5 miles and eats 3 cakes in 2 hours "
            "while Jean-Luc waits for McDonald")
    renamed = item
    for old, new in (("McDonald", "DeMarco"), ("O'Neil", "Van-Dyke"), ("Jean-Luc", "Bob"), ("twelve", "forty-two"),
                     ("5", "seven"), ("3", "1,5"), ("2 hours", "2 days")):
        renamed = renamed.replace(old, new)
    bench = spark.createDataFrame([(1, item), (2, "wait in the second hour or in the last minute before they leave")],
                                  "item_id long, text string")
    texts = [renamed, "Wait in the second hour or in the last minute before they leave.",
             "wait in the second week or in the last month before they leave", f"{edge.sentence(1, 30)}"]
    got = pairs(spark, documents(spark, texts), bench, max_words=max_words)
    assert got == {(0, 1): "re-parameterised", (1, 2): "copy"}


def test_items_without_spaces(spark):
    item = "\u4e00\u4e2a\u519c\u592b\u6709\u5341\u4e8c\u4e2a\u82f9\u679c\u4ed6\u7ed9\u4e86\u5b89\u5a1c\u4e94\u4e2a\u8fd8\u5269\u591a\u5c11"
    bench = spark.createDataFrame([(1, item), (1, item), (2, "\u82f9\u679c"), (None, "Antidisestablishmentarianism  today"), (4, None)],
                                  "item_id long, text string")
    texts = ["\u524d" * 30 + item + "\u540e" * 30, item[:-1], "so antidisestablishmentarianism\ntoday", "\u82f9\u679c", None]
    assert pairs(spark, documents(spark, texts), bench) == {(0, 1): "copy", (2, None): "copy"}
    assert decontam.unmatched_items(bench) == 1
    parts = decontam.short_leaks(documents(spark, texts), bench.withColumnRenamed("text", "_t").na.drop(subset=["_t"]), chars=10)
    assert sorted((r["doc_id"], r["item_id"]) for r in parts.collect() if r["item_id"]) == [(0, 1)]


def test_batches_find_the_texts_that_single_texts_do(spark):
    known = sorted({decontam.literal_of(w) for w in (ITEM + " " + OTHER).split()})
    templates = decontam.Templates(known, [5, 8])
    texts = [" " + ITEM, "", "one", ITEM.replace("Tom", "Jim") + "\n", edge.sentence(1, 40), OTHER[:30], OTHER[30:], "\t\v " + OTHER]
    import pyarrow as pa

    assert templates.rows_with_windows(pa.array(texts)) == [i for i, t in enumerate(texts) if any(templates.windows(t))]
