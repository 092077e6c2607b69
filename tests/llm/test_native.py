"""URL lists, quality rules, quotations and decontamination on small cases."""

import datetime as dt
import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesselar.llm import decontamination, quality_rules, quotations, url_lists

DOCS = "doc_id long, text string, words string, n_words string"


def brute_hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item_id, item in items:
        w = split(item)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item_id))
    joined = ",".join(sorted(found)).encode()
    return len(words), len(hit), len(found), hashlib.sha256(joined).hexdigest(), bool(hit)


ITEM = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    None,
    "",
    "...",
    ITEM,
    "ONE, two-three four FIVE six seven eight nine ten",
    "x " + ITEM + " y " + ITEM,
    "one two three four five six seven eight nine",
    "a b a b a b a b a b a b a b a b a b a b",
    "éa ÉA éa Straße ΣΑΣ ΣΑΣ. k l m n o p q",
    "tiny item here and more",
    " ".join(["word"] * 3000) + " " + ITEM,
]
ITEMS = [(1, ITEM), (2, "a b a b a b a b a b a b"), (3, "tiny item"), (4, ""), (5, None), (6, "ΣΑΣ ΣΑΣ. k l m n o p q r"), (10, ITEM), (10, ITEM)]


def test_decontamination_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "w", "n") for i, t in enumerate(TEXTS)] + [(3, ITEM, "w", "n"), (None, ITEM, "", "")], DOCS)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontamination.contamination(docs, benchmark).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = ITEM if row["doc_id"] is None else TEXTS[row["doc_id"]]
        assert tuple(row)[1:] == brute_hits(text, ITEMS), row
    kept = decontamination.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if not brute_hits(t, ITEMS)[4]}


def test_decontamination_without_rows(spark):
    docs = spark.createDataFrame([(1, ITEM, "", "")], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in decontamination.contamination(docs, none).collect()] == [False]
    assert decontamination.contamination(docs.limit(0), none).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=6), st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=4))
def test_decontamination_of_repetitive_texts(spark, texts, items):
    texts, items = [" ".join(t) for t in texts], [(i, " ".join(t)) for i, t in enumerate(items)]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    rows = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def brute_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_quality_signals_equal_brute_force(spark):
    texts = [None, "", " \n\t", "a", "a b c a b c a b c", "x x x x x", "line\nline\n\nother\n line", "#* $%&|<>", "é ß z 😀 w", "A B " * 200]
    docs = spark.createDataFrame([(i, t, "w", "n") for i, t in enumerate(texts)] * 2, DOCS)
    rows = quality_rules.quality_verdicts(docs).collect()
    assert len(rows) == 2 * len(texts)
    for row in rows:
        expected = brute_signals(texts[row["doc_id"]])
        assert tuple(row)[1:6] == expected
        assert row["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (row["kept"] and row["base_failed"])
    assert quality_rules.quality_verdicts(docs.limit(0)).count() == 0


def test_accuracies_of_rules_that_agree():
    good, bad = (1,) * len(quality_rules.RULES), (-1,) * len(quality_rules.RULES)
    prior, right, wrong = quality_rules.fit_accuracies([(good, 900), (bad, 100)])
    assert prior == pytest.approx(0.9, abs=0.01)
    assert min(right) > 0.99 and min(wrong) > 0.98
    one_against = (-1, *good[1:])
    assert quality_rules.posterior(one_against, prior, right, wrong) > 0.5


def test_intervals_and_captures(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    entries = [
        ("block", "bad.example.com", "add", day(10)),
        ("block", "bad.example.com", "remove", day(100)),
        ("block", "bad.example.com", "add", day(200)),
        ("allow", "ok.bad.example.com", "add", day(0)),
        ("block", "site.org/dir", "add", day(0)),
        ("block", "site.org/dir", "add", day(0)),
        ("block", None, "add", day(0)),
    ]
    captures = [
        (1, "http://bad.example.com/x", day(9)),
        (2, "http://bad.example.com/x", day(10)),
        (3, "http://u:p@a.BAD.example.com:80/x", day(99)),
        (4, "http://bad.example.com/x", day(100)),
        (5, "http://bad.example.com/x", day(900)),
        (6, "http://ok.bad.example.com/", day(50)),
        (7, "https://site.org/dir/page?q", day(1)),
        (8, "https://site.org/dirt", day(1)),
        (9, None, day(1)),
        (10, "no url", day(1)),
        (11, "http://bad.example.com", None),
        (12, "http://notbad.example.com", day(50)),
        (12, "http://notbad.example.com", day(50)),
    ]
    spans = spark.createDataFrame(entries, "list string, scope string, op string, at timestamp")
    asked = spark.createDataFrame([(*c, "x") for c in captures], "page_id long, url string, fetched_at timestamp, scope string")
    rows = {r["page_id"]: r for r in url_lists.evaluate_captures(asked, spans).collect()}
    assert {i for i, r in rows.items() if r["blocked"]} == {2, 3, 5, 7}
    assert rows[6]["n_active"] == 2 and rows[6]["scope"] == "ok.bad.example.com"
    assert len(rows) == 12
    assert url_lists.evaluate_captures(asked.limit(0), spans).count() == 0
    assert not any(r["blocked"] for r in url_lists.evaluate_captures(asked, spans.limit(0)).collect())


def test_quotation_links(spark):
    rows = [
        (1, 0, "user", "First line\nSecond line"),
        (1, 1, "assistant", "> first  LINE\n> Second line\nAnswer"),
        (1, 2, "user", "> > First line\n> > Second line\n> Answer\n\nThanks\n"),
        (1, 3, "user", ">> Second line\nNo level one"),
        (1, 4, "user", "> unknown words\nbody"),
        (2, 0, "user", None),
        (2, 1, "user", "> Answer"),
        (None, 0, "user", "x"),
        (3, 5, "user", "same"),
        (3, 6, "user", "> same\nsame"),
        (3, 6, "user", "> same\nsame"),
    ]
    messages = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    found = quotations.link_quotations(messages).collect()
    assert len(found) == len(rows)
    at = {(r["conv_id"], r["turn"]): r for r in found}
    assert [at[1, t]["parent_turn"] for t in range(5)] == [None, 0, 1, None, None]
    assert [at[1, t]["depth"] for t in range(5)] == [0, 1, 2, 0, 0]
    assert [at[1, t]["root_turn"] for t in range(5)] == [0, 0, 0, 3, 4]
    assert [at[1, t]["n_linked"] for t in range(5)] == [0, 1, 2, 1, 0]
    assert at[1, 2]["body"] == "Thanks" and at[2, 0]["body"] == "" and at[2, 1]["parent_turn"] is None
    assert at[3, 6]["parent_turn"] == 5
    assert quotations.link_quotations(messages.limit(0)).count() == 0
