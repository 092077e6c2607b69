"""Token files, packing, near duplicates, classifiers and extraction on small cases."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tesselar.llm import html_extraction, near_duplicates, packing, quality_model, token_files, toxicity
from tesselar.llm.components import connected_components
from tesselar.llm.encode import WordEncoder
from tesselar.llm.grams import gram_hashes, normalised
from tesselar.workspace import new_path

TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "It's he'll  don't,stop 12,345 x2y...",
    "tab\there nbsp\x1cfs  end ",
    "ÉCOLE Straße ΣΑΣ 'quoted' — dash≠ é ñ",
    "<|endoftext|> <|startoftext|> a<b>c",
    "word " * 5000,
    "nospaces" * 3000,
    "line one\nline two\r\n\n  indented\n",
    "日本語 テキスト 😀😀",
]
DOCS = "doc_id long, text string, piece string, start string"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_encoder_equals_the_tokenizer(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng = random.Random(3)
    made = ["".join(rng.choice("ab1é'., \n\t—€#") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    for memory in (10, 100_000):
        encoder = WordEncoder(path, memory=memory)
        for texts in (TEXTS, made, TEXTS):
            expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == expected


def test_segment_round_trip():
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 2 ** rng.integers(1, 32), n).astype(np.uint32) for n in (0, 1, 7, 513, 3000)]
    segment = token_files.Segment(token_files.write_segment([(i if i else None, x) for i, x in enumerate(ids)]))
    flat = np.concatenate(ids)
    assert segment.tokens(0, len(flat)).tolist() == flat.tolist()
    assert [segment.token(i) for i in range(0, len(flat), 7)] == flat[::7].tolist()
    for a, b in ((0, 0), (3, 4), (510, 1100), (1025, 3521)):
        assert segment.tokens(a, b).tolist() == flat[a:b].tolist()
    assert segment.nulls.tolist() == [1, 0, 0, 0, 0]
    assert token_files.Segment(token_files.write_segment([])).tokens(0, 0).tolist() == []


def test_token_files(spark):
    rows = [(i, t, "p", "s") for i, t in enumerate(TEXTS)] + [(None, "null id", "", ""), (4, TEXTS[4], "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    path = new_path(spark, "tokens-test")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(docs, tokenizer, path)
    found = [tuple(r) for r in token_files.read_index(spark, path).orderBy("start").collect()]
    whole = Tokenizer.from_file(tokenizer)
    whole.encode_special_tokens = True
    start, expected = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    empty = new_path(spark, "tokens-test")
    token_files.write_tokens(docs.limit(0), tokenizer, empty)
    assert token_files.read_index(spark, empty).count() == 0


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]


@pytest.mark.parametrize("seed", range(6))
def test_local_search(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.integers(1, 60, 300).tolist())
    start = [packing.Bins(Counter({length: 1}), n) for length, n in counts.items()] if seed % 2 else packing.best_fit(counts, 64)
    better = packing.improve(start, 64)
    assert packing.piece_counts(start) == packing.piece_counts(better) == counts
    assert max(bins.fill for bins in better) <= 64
    n_bins, least = sum(bins.copies for bins in better), -(-sum(length * n for length, n in counts.items()) // 64)
    assert n_bins <= sum(bins.copies for bins in start)
    assert sum(bins.copies for bins in packing.best_fit(counts, 64)) <= 1.25 * least


def test_plan_of_many_pieces_costs_as_much_as_of_few():
    """A thousand million times the pieces: the same kinds of lengths, so about as many kinds of bins."""
    rng = np.random.default_rng(7)
    few = Counter(np.minimum(rng.geometric(0.004, 4000), 2047).tolist())
    many = Counter({length: n * 10**9 + 7 for length, n in few.items()})
    bins = packing.plan(many, 2048)
    assert packing.piece_counts(bins) == many
    least = -(-sum(length * n for length, n in many.items()) // 2048)
    assert least <= sum(b.copies for b in bins) <= 1.001 * least
    assert len(bins) <= 4 * 2048


def test_pack(spark):
    rows = [(i, t, "p", "s") for i, t in enumerate(TEXTS * 4)] + [(0, TEXTS[4], "", ""), (None, "word " * 6143, "", ""), (None, "word " * 6143, "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(tokenizer)
    whole.encode_special_tokens = True
    ids = [np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t, *_ in rows]
    for parts in (1, 7):
        found = packing.pack(docs.repartition(parts), tokenizer).toPandas()
        total = sum(map(len, ids))
        assert found["length"].sum() == total
        for _, one in found.groupby("sequence_id"):
            one = one.sort_values("offset")
            assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]
            assert one["length"].sum() <= packing.CAPACITY
        assert found["sequence_id"].nunique() == -(-total // packing.CAPACITY)
        # The pieces of every document, long ones too: where they start and what they hold.
        pieces = Counter()
        for (doc_id, *_), all_ids in zip(rows, ids, strict=True):
            first = len(all_ids) % packing.CAPACITY or min(len(all_ids), packing.CAPACITY)
            edges = [0, *range(first, len(all_ids) + 1, packing.CAPACITY)]
            for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                pieces[doc_id, piece, a, b - a, zlib.crc32(all_ids[a:b].tobytes())] += 1
        got = Counter((None if r[0] != r[0] else int(r[0]), *map(int, r[1:])) for r in found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
        assert got == pieces
    assert packing.pack(docs.limit(0), tokenizer).count() == 0


def brute_near(texts, threshold=0.8):
    keys = [normalised(t) for t in texts]
    sets = [set(gram_hashes(k, 5).tolist()) for k in keys]
    n = len(texts)
    klass = [min(j for j in range(n) if keys[j] == keys[i]) if keys[i] else i for i in range(n)]
    reps = [i for i in range(n) if klass[i] == i and keys[i]]
    links = {(a, b) for a in reps for b in reps if a != b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}
    group = list(range(n))
    for _ in range(n):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    return {i: (klass[i], sum(a == klass[i] for a, _ in links), group[klass[i]]) for i in range(n)}


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK_TEXTS", block)
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 5000)}"
    texts = [None, "", "  ", "one two", "one two", "one  two\n", "one two three four five", "five"]
    for size in (2, 3, 12):
        base = [word() for _ in range(200)]
        for _ in range(size):
            changed = list(base)
            for _ in range(rng.randint(0, 6)):
                changed[rng.randrange(200)] = word()
            texts.append(" ".join(changed))
    texts += [texts[-1]] * 3 + [" ".join(word() for _ in range(150)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "p", "s") for i, t in enumerate(texts)], DOCS)
    found = {r["doc_id"]: tuple(r)[1:] for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == brute_near(texts)
    kept = near_duplicates.one_of_each_group(docs.unionAll(docs))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({g for _, _, g in found.values()})
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = near_duplicates.banding(threshold, 0.99, 512)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(label)):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = connected_components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in found} == label
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def held_out_rows(spark, frame, label):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(f"{label} is not null")
    return frame.where("held_out").join(labels, "doc_id").select("score", label).toPandas()


def test_quality_on_held_out_documents(spark):
    rows = held_out_rows(spark, quality_model.op8_quality(spark, "/root/testdata/sf0.01"), "quality")
    assert ((rows["score"] >= quality_model.PREDICT) == (rows["quality"] == 1)).mean() > 0.95


def test_toxicity_on_held_out_documents(spark):
    rows = held_out_rows(spark, toxicity.op7_toxicity(spark, "/root/testdata/sf0.01"), "toxic")
    assert ((rows["score"] >= toxicity.PREDICT) == (rows["toxic"] == 1)).mean() > 0.93


ODD = [(1, None, 1), (2, "", 2), (None, " \n", 3), (4, "x" * 100_000, 4), (5, "a " * 50_000, 5), (5, "a " * 50_000, 5)]


def test_classifiers_take_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1, None), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for given in (labels, none):
        quality = quality_model.score_quality(docs, quality_model.fit_quality(docs, given), "s").collect()
        toxic = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, given), "s").collect()
        for rows in (quality, toxic):
            assert len(rows) == len(ODD) and all(0 <= r["s"] <= 1 for r in rows)
    assert quality_model.score_quality(docs.limit(0), quality_model.fit_quality(docs, labels)).count() == 0


def test_attention_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality_model.N_FEATURES)).astype(np.float64) for n in (1, 4, 2)]
    model = quality_model.fit(bags, np.array([1.0, 0.0, 1.0]))
    model.p = {k: np.asarray(v, np.float64) for k, v in model.p.items()}
    x, starts, y = np.concatenate(bags), np.array([0, 1, 5]), np.array([0.0, 1.0, 1.0])

    def loss():
        logit = model.forward(x, starts)["logit"]
        return np.mean(np.logaddexp(0, logit) - y * logit)

    gradient = model.gradients(x, starts, y)
    for name, at in (("W", (3, 5)), ("V", (2, 1)), ("U", (4, 3)), ("w", (2,)), ("c", (1,)), ("b", (0,))):
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-5
        up = loss()
        model.p[name][at] = kept - 1e-5
        down = loss()
        model.p[name][at] = kept
        assert gradient[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)
    assert model.forward(x, starts)["a"][1:5].sum() == pytest.approx(1)


def test_grammar_reads_context():
    machine, lexicon = toxicity.grammar(), toxicity.Lexicon({"idiot": 3.0, "lowe*": 2.0})

    def weights(text):
        return toxicity.clause_weights([lexicon[t] for t in toxicity.TOKEN.findall(text.lower())], machine, lexicon)

    plain = weights("What an idiot.")[0]
    assert weights("He is not an idiot.")[0] < plain and weights('She said "idiot" there.')[0] < plain
    assert weights("You are an idiot.")[0] > plain
    assert len(weights("idiot. loweish; fine.")) == 2 and weights("nothing here") == []


def test_tree_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    tree = html_extraction.parse("<div><p>a</p><ul><li>b<li>c</ul></div><footer>d</footer>")
    x = html_extraction.element_features(tree)
    model = html_extraction.TreeModel(rng.normal(size=x.shape[1]), rng.normal(size=(html_extraction.N_TAGS, 2, 2)))
    n = len(tree.tag)
    total, mass = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [(code >> i) & 1 for i in range(n)]
        energy = sum(float(x[i] @ model.unary) * y[i] for i in range(n))
        energy += sum(model.pair[html_extraction._TAG.get(tree.tag[i], html_extraction.N_TAGS - 1)][y[tree.parent[i]], y[i]] for i in range(1, n))
        total += np.exp(energy)
        mass += np.exp(energy) * np.array(y)
    p, _, log_total = model.marginals(tree, x)
    assert p == pytest.approx(mass / total) and log_total == pytest.approx(np.log(total))


@pytest.fixture(scope="module")
def model():
    return html_extraction.train()


def test_extraction_on_unseen_pages(model):
    right = total = 0
    for tree, y in html_extraction.training_set(html_extraction.labelled_pages(60, seed=99)):
        p = model.marginals(tree, html_extraction.element_features(tree))[0]
        right += sum((p[e] >= 0.5) == y[e] for e, _, _ in tree.segments)
        total += len(tree.segments)
    assert right / total > 0.98


def test_extraction_of_a_page(spark, model):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script><style>p{}</style></head><body>"
        '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- x --><div class="ad">Buy now.</div>'
        "<article><h1>Title &amp; more</h1><p><b>First   para\ngraph, long enough to read.<br>Next.<p>Second paragraph &lt;here&gt;, "
        "with a <a href=x>link</a> in it.<div class='cookie-notice'>We use cookies.</div></article>"
        '<section class="comments"><p>Great read, thanks a lot for this, really.</p></section><form><label>Mail</label><input></form>'
        "<footer>&copy; site</footer></body></html>"
    )
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (None, "u", "<p"), (5, "u", "<div>" * 3000), (5, "u", "a < b <<< > & &bogus;")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    found = html_extraction.extract(pages, model).collect()
    assert len(found) == len(rows)
    assert found[0]["text"] == "Title & more\n\nFirst para graph, long enough to read. Next.\n\nSecond paragraph <here>, with a link in it."
    assert found[1]["text"] == "" and found[2]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in found)
