"""The stages of the corpus pipeline and the whole of it on odd rows, empty tables and clashing columns."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.session import TABLES
from tests.llm.test_free import brute_near
from tesselar.workspace import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, label int, llm_row string"
PASSAGE = " ".join(f"bench{i}" for i in range(14))
GOOD = "The river runs through a quiet valley, and every spring the farmers there mend their fences. "
TEXTS = [
    None,
    "",
    "  ",
    GOOD * 6,
    GOOD * 6,
    GOOD * 6 + "One more word follows.",
    " ".join(f"other{i}" for i in range(200)),
    f"Before it {PASSAGE} and behind it.",
    "word " * 20_000,
    "You idiot, you are a worthless moron.",
]


@pytest.fixture(scope="module")
def tables(spark):
    """A folder with the tables that the stages read, and documents of every odd kind."""
    folder = new_path(spark, "pipeline-tables")
    rows = [(i, t, "en", "s", 1, 0.1, 1, 1, "x") for i, t in enumerate(TEXTS)]
    rows += [(None, t, None, None, None, None, None, None, None) for t in TEXTS] + [(3, TEXTS[3], "de", "s", 1, 0.1, 1, 1, "x"), (3, "another text of that id", "", "", 0, 0.0, 0, 0, "")]
    labelled = [(100 + i, (GOOD if i % 2 else "buy ### now $$$ !!! ") * (3 + i % 5) + (" you idiot" if i % 3 == 0 else ""), "en", "s", 1, 0.5, 2, 0, "y") for i in range(120)]
    docs = spark.createDataFrame(rows + labelled, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(100 + i, i % 2, int(i % 3 == 0)) for i in range(120)] + [(1, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    benchmark = spark.createDataFrame([(1, PASSAGE), (2, None), (None, "")], "item_id long, text string")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return folder


STAGES = corpus_pipeline.STAGES[:-1]


def rows_of(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("name, stage", STAGES, ids=[name for name, _ in STAGES])
def test_a_stage_returns_rows_of_its_input(spark, tables, name, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = stage(spark, docs, tables)
    assert kept.columns == docs.columns
    before, after = rows_of(docs), rows_of(kept)
    assert not after - before
    assert stage(spark, docs.limit(0), tables).count() == 0
    if name in ("quality classifier", "toxicity"):
        # One verdict for every text.
        assert all(after[row] in (0, n) for row, n in before.items())
        texts = lambda rows: {row[1] for row in rows}
        assert not texts(after) & texts(before - after)


def test_one_of_each_group_stays(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, tables)
    texts = [row["text"] for row in docs.collect()]
    groups = {group for at, (_, _, group) in brute_near(texts).items() if texts[at] and texts[at].strip()}
    words = [row["text"] for row in kept.collect() if row["text"] and row["text"].strip()]
    assert len(words) == len(groups)


def test_contaminated_documents_go(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = rows_of(corpus_pipeline.drop_contaminated(spark, docs, tables))
    held = re.compile(r"bench\d+(?:\W+bench\d+){9}")
    assert kept == Counter({row: n for row, n in rows_of(docs).items() if not held.search(row[1] or "")})


def test_run_packs_what_the_stages_leave(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in STAGES:
        docs = spark.createDataFrame(stage(spark, docs, tables).collect(), docs.schema)
    expected = corpus_pipeline.pack_sequences(spark, docs, tables)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, tables)
    assert rows_of(found.select(*columns)) == rows_of(expected.select(*columns))
    assert sum(rows_of(found).values()) >= 1


def test_run_on_empty_tables(spark):
    folder = new_path(spark, "empty-tables")
    for name in TABLES:
        if name in ("documents", "labels", "benchmark"):
            spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
