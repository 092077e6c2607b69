"""Odd inputs: pages, messages and ids that once cost quadratic work, rows without an id, long documents in fitting."""

import time

import numpy as np
import pytest

from tesselar.llm import decontamination, quality_model, toxicity, url_lists
from tesselar.llm.html_tree import parse

DOCS = "doc_id long, text string, llm_number string, number string, item string"


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<" + "a" * n,
        lambda n: "<a" * n,
        lambda n: "<a" * n + ">",
        lambda n: '<a "' * n + ">",
        lambda n: "<i>" * n + "</b>" * n,
        lambda n: "<div>" * n,
        lambda n: "<!" * n,
        lambda n: "<!--" * n,
    ],
)
def test_parsing_takes_time_in_proportion(make):
    def seconds(n):
        started = time.process_time()
        parse(make(n))
        return time.process_time() - started

    seconds(1000)
    assert seconds(80_000) <= 4 * max(seconds(40_000), 0.05)


def segments(page):
    return [text for _, text, _ in parse(page).segments]


def test_ends_without_starts_and_open_ends():
    assert segments("<p>one<div>two</div>three</p>four") == ["one", "two", "three", "four"]
    assert segments("<p>x<!-- y") == ["x"] and segments("<p>a<b") == ["a<b"]
    assert segments("a < b <c>d</c> x<") == ["a < b", "d", "x<"]
    assert segments("<p>one</b>two</i></p>") == ["onetwo"]


def test_rows_that_share_an_id_or_have_none(spark):
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30))), (2, "alpha beta gamma")], "item_id long, text string")
    passage = " ".join(f"w{i}" for i in range(5, 17))
    texts = ["nothing here", f"before {passage} behind", "Alpha beta gamma alpha", None, "", passage]
    for doc_id in (None, 7):
        docs = spark.createDataFrame([(doc_id, t, "a", "b", "c") for t in texts], DOCS)
        rows = decontamination.contamination(docs, benchmark, "llm_number", "number").collect()
        found = sorted((r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows)
        assert found == [(0, 0, 0, False), (0, 0, 0, False), (2, 0, 0, False), (4, 3, 1, True), (12, 12, 1, True), (14, 12, 1, True)]
        assert {r["llm_number"] for r in rows} == {"a"} and {r["number"] for r in rows} == {"b"}
        clean = decontamination.clean_documents(docs, benchmark)
        assert clean.columns == docs.columns and clean.count() == 3


def test_many_rows_without_an_id_cost_as_much_as_with_one(spark):
    benchmark = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(300)], "item_id long, text string")

    def seconds(ids):
        rows = [(ids(i), " ".join(f"w{i % 300}x{j}" for j in range(12)), "a", "b", "c") for i in range(1500)]
        docs = spark.createDataFrame(rows, DOCS).cache()
        assert docs.count() == 1500
        started = time.perf_counter()
        assert decontamination.contamination(docs, benchmark).where("n_hit = 12").count() == 1500
        return time.perf_counter() - started

    seconds(lambda i: i)
    assert seconds(lambda i: None) <= 2 * seconds(lambda i: i) + 1


def test_every_passage_of_a_long_document_is_learned_from(spark):
    text = "good words here. " * 4000
    rows = [(i, text if i == 1 else "short one", 1 if i == 1 else 0) for i in range(1, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    bags = frame.selectExpr("quality AS label", "text").mapInArrow(quality_model._training_rows, "label int, x binary").toPandas()
    sizes = bags["x"].map(lambda x: len(np.frombuffer(x, np.float32)) // quality_model.N_FEATURES)
    assert sizes.max() == -(-12_000 // quality_model.PASSAGE_WORDS)


def test_a_quotation_lasts_over_its_sentence_ends():
    machine = toxicity.grammar()
    lexicon = toxicity.Lexicon({"idiot": 3.0, "moron": 3.0})
    tokens = [lexicon[t] for t in toxicity.TOKEN.findall('he said: "fine. idiot here." the moron left.')]
    quoted, outside = toxicity.clause_weights(tokens, machine, lexicon)
    assert quoted < outside == 3.0


def test_a_capture_of_a_far_date_adds_one_bucket(spark, monkeypatch):
    written = {}
    keep = url_lists.materialize
    monkeypatch.setattr(url_lists, "materialize", lambda df, name: written.setdefault(name, keep(df, name)))
    entries = spark.sql("SELECT 'block' AS list, concat('h', id, '.org') AS scope, 'add' AS op, timestamp'2023-01-15' AS at FROM range(50)")
    captures = spark.sql(
        "SELECT id AS page_id, concat('http://h', id, '.org/x') AS url, timestamp'2023-01-01' + make_interval(0, 0, 0, CAST(id * 20 AS INT)) AS fetched_at FROM range(20)"
        " UNION ALL SELECT 100, 'http://h3.org/', timestamp'9999-12-01' UNION ALL SELECT 101, 'http://h4.org/', timestamp'0001-01-02' UNION ALL SELECT 102, 'http://h5.org/', NULL"
    )
    found = {r["page_id"]: r["blocked"] for r in url_lists.evaluate_captures(captures, entries).collect()}
    assert found == {i: i > 0 for i in range(20)} | {100: True, 101: False, 102: False}
    assert written["list-buckets"].count() <= 50 * 16
