"""Vector links, phrase collocations and source divergence against brute force on small cases."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tesselar.llm import collocations, flat_graph, hat_trie, source_divergence, vector_links
from tesselar.llm.word_pointers import Words, slices

VECTORS = "vec_id long, embedding array<double>, key string, row string, unit string, label int"
DOCS = "doc_id long, text string, lang string, source string, term string, n long, row string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _direction(vector):
    if vector is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
        return None
    vector = np.array(vector) / np.abs(vector).max()
    return vector / np.linalg.norm(vector)


def _brute_links(rows, cosine=0.9):
    units = [_direction(vector) for _, vector in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in combinations(range(len(rows)), 2):
        if units[a] is None or units[b] is None or len(units[a]) != len(units[b]) or units[a] @ units[b] < cosine:
            continue
        links[a] += 1
        links[b] += 1
        parent[root(a)] = root(b)
    groups = defaultdict(list)
    for a, (vec_id, _) in enumerate(rows):
        groups[root(a)].append(vec_id)
    least = {key: min((i for i in ids if i is not None), default=None) for key, ids in groups.items()}
    return sorted(((vec_id, links[a], least[root(a)], vec_id == least[root(a)]) for a, (vec_id, _) in enumerate(rows)), key=repr)


def _found_links(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "k", "r", "u", 0) for i, v in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in vector_links.near_vectors(frame, **options).collect()), key=repr)


def test_odd_vectors(spark):
    one, other = [1.0, 2.0, 3.0], [-3.0, 1.0, 0.5]
    rows = [
        (7, one), (3, one), (3, one), (9, [10.0, 20.0, 30.0]), (4, [1.0, 2.1, 2.9]), (5, other), (None, other), (None, [0.0, 1.0, 0.0]),
        (10, None), (11, []), (12, [0.0, 0.0, 0.0]), (13, [1.0, None, 2.0]), (14, [math.nan, 1.0, 2.0]), (15, [math.inf, 1.0, 2.0]),
        (16, [1.0, 2.0]), (17, [1.0, 2.05]), (18, [1e300, 2e300, 3e300]), (19, [1e-300, 2e-300, 3e-300]), (20, [-0.0, 1.0, 0.0]), (None, None),
    ]
    assert _found_links(spark, rows) == _brute_links(rows)
    empty = spark.createDataFrame([], VECTORS)
    assert vector_links.near_vectors(empty).collect() == []


def _clustered(n, dim, copies, seed=0):
    rng = np.random.default_rng(seed)
    far = rng.normal(size=(n, dim))
    near = rng.normal(size=dim) + 0.1 * rng.normal(size=(copies, dim))
    rows = np.concatenate([far, near, near[:40], rng.normal(size=(8, 1, dim)).repeat(5, axis=1).reshape(40, dim) + 0.05 * rng.normal(size=(40, dim))])
    rows = rows[rng.permutation(len(rows))]
    return [(i, row.tolist()) for i, row in enumerate(rows)]


@pytest.mark.parametrize("shard", [64, 2048])
def test_links_equal_brute_force(spark, shard):
    """Also with shards so small that a group of near copies fills several blocks."""
    rows = _clustered(300, 16, 150)
    expected = _brute_links(rows)
    found = _found_links(spark, rows, shard=shard)
    assert [f[2:] for f in found] == [e[2:] for e in expected]
    got, all_ = sum(f[1] for f in found), sum(e[1] for e in expected)
    assert all(f[1] <= e[1] for f, e in zip(found, expected, strict=True))
    assert got >= 0.97 * all_, (got, all_)


def test_graph_is_pruned_and_found_from_the_medoid():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    edges = flat_graph.build(vectors)
    assert edges.shape == (600, flat_graph.DEGREE) and (edges != np.arange(600)[:, None]).all()
    for node in range(0, 600, 50):
        ends = edges[node][edges[node] >= 0]
        assert len(set(ends.tolist())) == len(ends)
    found = flat_graph.beam_search(vectors, edges, flat_graph.medoid(vectors), vectors)
    assert (found[:, 0] == np.arange(600)).mean() > 0.95


def test_robust_prune_drops_covered_candidates():
    vectors = np.array([[1.0, 0.0], [0.98, 0.2], [0.95, 0.31], [0.0, 1.0]])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    chosen = flat_graph.robust_prune(vectors, np.array([0]), np.array([[0, 1, 2, 3, 3, -1]]), 4, 1.2)
    # Node 2 lies next to 1; 3 is far from both but nearer to 1 than 0 is, by less than the factor.
    assert chosen[0].tolist()[0] == 1 and 2 not in chosen[0] and 0 not in chosen[0]


# Word pointers


def test_word_pointers_and_runs():
    texts = [None, "", "  ", "Ab aB ab", "é" * 30 + " é" + "E" * 17, "x" * 8 + " " + "x" * 9 + " " + "x" * 16 + " " + "x" * 17, "straße" * 4000, "a"]
    column = pa.array(["zz", *texts, "zz"]).slice(1, len(texts))
    words = Words(column, source_divergence.LETTERS)
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    expected = [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in pattern.findall(t or "")]
    assert list(zip(words.row.tolist(), words.texts(np.arange(len(words))).to_pylist(), strict=True)) == expected
    order, run = source_divergence.sorted_runs(words)
    in_order = [expected[i][1].encode() for i in order]
    assert in_order == sorted(in_order)
    assert [a == b for a, b in zip(in_order[1:], in_order[:-1], strict=True)] == (np.diff(run) == 0).tolist()
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    assert sum((s.column("text").to_pylist() for s in slices([batch], limit=10)), []) == texts
    assert Words(pa.array([], pa.string()), source_divergence.LETTERS).texts(np.arange(0)).to_pylist() == []


def test_sorted_runs_of_random_words():
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 24, 33]))) for _ in range(3000))
    words = Words(pa.array([text]), source_divergence.LETTERS)
    order, run = source_divergence.sorted_runs(words)
    in_order = [text.split()[i] for i in order]
    assert in_order == sorted(in_order) and len(set(in_order)) == run[-1] + 1


# Collocations


@pytest.mark.parametrize("width", [2, 3, 4])
def test_hat_trie_counts(width):
    rng = np.random.default_rng(width)
    trie, expected, taken = hat_trie.HatTrie(burst=16), Counter(), []
    for _ in range(30):
        rows = rng.zipf(1.3, size=(200, width)).astype(np.uint64) % np.uint64(50)
        rows[rng.random(200) < 0.3, 0] = np.uint64(2**64 - 1)
        trie.add(rows)
        expected.update(map(tuple, rows.tolist()))
        if trie.size > 1500:
            taken.append(trie.take(700))
            assert trie.size <= 700
    taken.append(trie.take(0))
    assert trie.size == 0 and trie.take(0) is None
    found = Counter()
    for rows, counts in taken:
        assert (np.lexsort(rows.T[::-1]) == np.arange(len(rows))).all()
        for row, n in zip(map(tuple, rows.tolist()), counts.tolist(), strict=True):
            found[row] += n
    assert found == expected


def test_packed_runs():
    rng = np.random.default_rng(0)
    rows = np.unique(rng.integers(0, 1 << 63, (50, 3), dtype=np.uint64) * np.uint64(2), axis=0)
    counts = rng.integers(1, 100, len(rows))
    back, n = collocations._unpack_run(collocations._pack_run(rows, counts), 3)
    assert (back == rows).all() and (n == counts).all()


def _brute_phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in chosen.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in chosen.items() if len(q) > len(p)
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(result)


ODD_TEXTS = [None, "", " \t ", ".,;", "One two, three. one TWO three", "ein\x00wort a\x00 a b \x1c c\x85d", "É é É é", "word " * 4000, "x" * 50_000 + " y"]


@pytest.mark.parametrize("trie_rows", [50, 1 << 20])
def test_collocations_equal_brute_force(spark, trie_rows, monkeypatch):
    monkeypatch.setattr(collocations, "PART_ROWS", 200)
    rng = random.Random(2)
    made = [(" ".join(rng.choice("abcdef") + rng.choice(["", "", "", ".", "\n", ","]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, ""])) for _ in range(120)]
    rows = made + [(t, "en") for t in ODD_TEXTS] + made[:20]
    frame = spark.createDataFrame([(i, t, lang, "s", "t", 1, "r") for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    found = sorted(tuple(r) for r in collocations.collocations(frame, 4, 25, trie_rows).collect())
    assert found == _brute_phrases(rows, 4, 25)
    assert collocations.collocations(frame.limit(0)).collect() == []


# Source divergence


def _brute_divergence(rows, least, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    result = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {source: c for (of, source), c in counts.items() if of == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        p = {source: shares(count) for source, count in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for source in groups:
            pairs = [(sum(apart(p[source][t], p[other][t]) for t in kept), other) for other in groups if other != source]
            terms = [(apart(p[source][t], q[t]), t) for t in kept if groups[source][t] and p[source][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                result += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)]
    return sorted(result)


@pytest.mark.parametrize("blocks", [(64, 4096), (2, 5)])
def test_source_divergence_equals_brute_force(spark, blocks, monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_SOURCES", blocks[0])
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", blocks[1])
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abÉz") for _ in range(rng.choice([1, 2, 3, 12]))) for _ in range(60)]
    made = [
        (" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "S", "é", None]))
        for _ in range(150)
    ]
    rows = made + [(t, "en", "odd") for t in ODD_TEXTS] + made[:10] + [("", "xx", "a"), (None, "xx", "b"), ("lonely", "yy", "a")]
    frame = spark.createDataFrame([(i, t, lang, s, "t", 1, "r") for i, (t, lang, s) in enumerate(rows)], DOCS).repartition(3)
    found = sorted(tuple(r) for r in source_divergence.source_divergence(frame, 5).collect())
    assert found == _brute_divergence(rows, 5, 10)
    assert source_divergence.source_divergence(frame.where(F.lit(False))).collect() == []
