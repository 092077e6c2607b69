"""Whole results of the training-data operators: cases of the second round's advice."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tesselar.llm import html_tree, near_duplicates, packing, token_files
from tesselar.llm.encode import WordEncoder
from tests.llm.test_free import DOCS, TEXTS

ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>\n", "<|ENDOFTEXT|> <|endoftext|", *TEXTS]


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame([(i, t, "", "") for i, t in enumerate(ADDED)], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_with_added_tokens_equals_the_loaded_tokenizer(name):
    path = public_tokenizers.path(name)
    whole, encoder = Tokenizer.from_file(path), WordEncoder(path, added_tokens=True)
    expected = [whole.encode(t or "", add_special_tokens=False).ids for t in ADDED]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(ADDED)] == expected


def test_queries_use_the_tokenizer_as_loaded(spark, sf_dir):
    def expected(name, end_id):
        whole = Tokenizer.from_file(public_tokenizers.path(name))
        ids = [np.array([*whole.encode(t or "", add_special_tokens=False).ids, end_id], "<u4") for t in ADDED]
        return {i: (len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids) if len(x) <= packing.CAPACITY}

    files = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_files.op3_token_files(spark, sf_dir).collect()}
    wanted = expected("word_bpe_49k.json", token_files.END_ID)
    assert {i: files[i] for i in wanted} == wanted
    wanted = expected("byte_bpe_50k.json", packing.END_ID)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for packed in (packing.op4_best_fit_packing(spark, sf_dir), corpus_pipeline.pack_sequences(spark, docs, sf_dir)):
        found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packed.collect()}
        assert {i: found[i] for i in wanted} == wanted


def test_local_search_empties_bins_until_none_has_a_step():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(300, 1500, 700).tolist())
    n_bins = lambda bins: sum(one.copies for one in bins)
    bins = packing.best_fit(counts, packing.CAPACITY)
    better = packing.improve(bins, packing.CAPACITY)
    assert packing.piece_counts(better) == counts
    assert max(one.fill for one in better) <= packing.CAPACITY
    # Best fit alone is above the bound here: the search must remove bins.
    assert packing.fewest_bins(counts, packing.CAPACITY) <= n_bins(better) < n_bins(bins)
    # More than forty single pieces to empty, and again a local optimum or the bound.
    apart = packing.improve([packing.Bins(Counter({length: 1}), n) for length, n in counts.items()], packing.CAPACITY)
    assert n_bins(apart) <= 1.02 * packing.fewest_bins(counts, packing.CAPACITY)
    for found in (better, apart):
        again = packing._Search(found, packing.CAPACITY)
        open_bins = [key for key, one in again.kinds.items() if one.fill < packing.CAPACITY]
        assert n_bins(found) == packing.fewest_bins(counts, packing.CAPACITY) or not any(again.step(key) for key in open_bins)


def test_fewest_bins_is_a_bound():
    assert packing.fewest_bins({6: 3}, 10) == 3 and packing.fewest_bins({5: 3}, 10) == 2
    assert packing.fewest_bins({10: 1}, 10) == 1 and packing.fewest_bins({7: 1, 4: 3}, 10) == 3
    assert packing.fewest_bins({}, 10) == 0


def texts_of(page):
    return [text for _, text, _ in html_tree.parse(page).segments]


def test_head_without_end_tag():
    article = "<article><p>Text"
    for page in (
        "<html><head><title>T</title>" + article,
        "<head><meta charset=utf-8><link rel=x><base href=y><style>p{}</style><script>s</script><noscript>n</noscript><template><p>no</p></template>" + article,
        "<head><title>T</title></html>" + article,
        "<html><head><title>T</title></head><body>" + article,
    ):
        assert texts_of(page) == ["Text"], page
    assert texts_of("<head><title>T</title> \n Bare &amp; text<p>Text") == ["Bare & text", "Text"]
    assert texts_of("<head><title>T</title>\n<script>s</script>\n</head>") == []


def test_one_of_each_group_keeps_every_group(spark):
    near = [f"w{i}" for i in range(60)]
    rows = [
        (None, "a unique text without an id"),
        (None, "two copies both without an id"),
        (None, "two copies both  without an id"),
        (None, " ".join(near)),
        (None, " ".join([*near[:-1], "other"])),
        (None, None),
        (None, ""),
        (5, "one text of the id five"),
        (5, "quite another text under the same id"),
        (7, "a copy with and without id"),
        (None, "a copy with and without id"),
        (9, " ".join(f"v{i}" for i in range(60))),
        (8, " ".join([*(f"v{i}" for i in range(59)), "z"])),
        (1, ""),
        (1, ""),
    ]
    docs = spark.createDataFrame([(i, t, str(k), "") for k, (i, t) in enumerate(rows)], "doc_id long, text string, row string, piece string").repartition(4)
    kept = near_duplicates.one_of_each_group(docs)
    assert kept.columns == docs.columns
    found = sorted(int(r["row"]) for r in kept.collect())
    one_of = lambda *some: len(set(found) & set(some)) == 1
    assert one_of(1, 2) and one_of(3, 4) and one_of(13, 14)
    assert set(found) - {1, 2, 3, 4, 13, 14} == {0, 5, 6, 7, 8, 9, 12}
    result = near_duplicates.near_duplicates(docs)
    assert result.count() == len(rows)
    assert sorted(r["n_links"] for r in result.where("doc_id is null").collect()) == [0] * 6 + [1] * 2
