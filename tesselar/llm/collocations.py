"""Phrase collocation mining: HAT-trie counts of word sequences, and how closely their words belong together.

Words are counted first; their 64-bit ids are checked to be different for different words. Every task then counts the
sequences of its texts in HAT-tries, one per language and length, spills whole subtrees as sorted runs, cut by prefix
partition, and the runs of a partition are merged. A word below the count cannot be in a phrase, nor a pair below it
in a longer one; bitmaps of fixed size tell, with false alarms that cost work and change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselar.llm.grams import BASE, mix
from tesselar.llm.hat_trie import HatTrie, row_codes, sum_equal
from tesselar.llm.word_pointers import Words, byte_set, slices
from tesselar.workspace import materialize

MIN_COUNT = 30
TOP = 2000
LONGEST = 4
#: A candidate goes where a longer one has this share of its count, in hundredths.
COVERED = 80
#: Fixed value of the contract: twice a million.
SCORE_SCALE = 2_000_000
UNKNOWN_LANG = "und"
#: Full stop, comma, semicolon, colon, exclamation and question mark, line feed to carriage return.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~(BREAKS | byte_set((0x20, 0x20), (0x09, 0x09)))
#: Bits of the bitmaps (16 MB and 128 KB).
FILTER_BITS, HOT_BITS = 27, 20
#: Sequences held in the memory of a task, and occurrences that a prefix partition is made for.
TRIE_ROWS, PART_ROWS = 1 << 19, 1 << 19
#: Bytes of text that a task holds the words of.
SLICE_BYTES = 4 << 20
RUN = "lang string, width int, part long, run binary"


def _lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


class _Texts:
    """The words of a slice with their ids, languages and pieces."""

    def __init__(self, part: pa.RecordBatch, seed: int):
        self.words = Words(part.column("text"), WORD)
        self.ids = self.words.hashes(seed)
        langs = part.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[self.words.row]
        self.lang_codes = np.array([_lang_code(lang) for lang in self.langs], np.uint64)[self.lang]
        #: Equal for words of one piece of one text.
        self.piece = np.cumsum(BREAKS[self.words.raw], dtype=np.int64)[self.words.start] + self.words.row

    def by_lang(self, which: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        """The words ``which`` of each language."""
        lang = self.lang[which]
        order = np.argsort(lang, kind="stable") if len(self.langs) > 1 else np.arange(len(which))
        edges = np.searchsorted(lang[order], np.arange(len(self.langs) + 1))
        for at, name in enumerate(self.langs):
            if edges[at] < edges[at + 1]:
                yield name, which[order[edges[at] : edges[at + 1]]]


def _slots(codes: np.ndarray, lang_codes: np.ndarray | np.uint64, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit of a word or pair of a language in a bitmap."""
    return (mix(codes ^ lang_codes) >> np.uint64(64 - bits)).astype(np.int64)


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            texts = _Texts(part, seed)
            for lang, which in texts.by_lang(np.arange(len(texts.words))):
                ids, first, n = np.unique(texts.ids[which], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(ids), pa.string()),
                        texts.words.texts(which[first]),
                        pa.array(ids.view(np.int64)),
                        pa.array(_slots(ids, _lang_code(lang))),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["lang", "word", "id", "slot", "n"],
                )

    return run


def _bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """The bits ``slot`` of ``rows`` that are set, as bytes: 2 ** bits / 8 of them, whatever the number of rows."""
    # The functions number bits from 1.
    slot = F.shiftright("slot", FILTER_BITS - bits) + 1
    pieces = rows.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces.collect():
        start = (row["piece"] - 1) * len(row["bits"])
        end = min(start + len(row["bits"]), len(bitmap))
        bitmap[start:end] = np.frombuffer(row["bits"], np.uint8)[: end - start]
    return bitmap


def _has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _pack_run(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Columns but the last as differences, which are mostly nought in sorted rows."""
    columns = [np.diff(column, prepend=np.uint64(0)) for column in rows.T[:-1]]
    flat = np.concatenate([*columns, rows[:, -1], counts.astype(np.uint64)])
    return len(rows).to_bytes(8, "little") + pa.compress(flat.tobytes(), "zstd", asbytes=True)


def _unpack_run(run: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(run[:8], "little")
    flat = np.frombuffer(pa.decompress(run[8:], n * (width + 1) * 8, "zstd", asbytes=True), np.uint64).reshape(width + 1, n)
    columns = [np.cumsum(column, dtype=np.uint64) for column in flat[: width - 1]]
    return np.column_stack([*columns, flat[width - 1]]), flat[width].astype(np.int64)


def _count_sequences(pairs: bool, known, hot, seed: int, part_bits: int, limit: int):
    """Sorted runs of the pairs of known words, or of the sequences of three and more whose pairs are all known."""

    def cut(lang: str, rows: np.ndarray, counts: np.ndarray) -> Iterator[tuple[str, int, int, bytes]]:
        width = rows.shape[1]
        prefix = row_codes(rows[:, : 1 if width == 2 else 2])
        # A prefix of many sequences is dealt by the whole sequence.
        busy = _has(hot.value, _slots(prefix, _lang_code(lang), HOT_BITS))
        code = np.where(busy, mix(row_codes(rows)), prefix)
        part = (code >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(rows), np.int64)
        order = np.argsort(part, kind="stable")
        edges = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(part)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            chosen = order[start:end]
            yield lang, width, int(part[chosen[0]]), _pack_run(rows[chosen], counts[chosen])

    def spill(tries: dict[tuple[str, int], HatTrie], leave: int) -> Iterator[pa.RecordBatch]:
        runs = []
        # Largest trie first, until few enough sequences stay in all of them.
        for key in sorted(tries, key=lambda k: -tries[k].size):
            others = sum(trie.size for k, trie in tries.items() if k != key)
            taken = tries[key].take(max(0, leave - others))
            if taken is not None:
                runs.extend(cut(key[0], *taken))
            if others <= leave and leave:
                break
        for start in range(0, len(runs), 64):
            columns = zip(*runs[start : start + 64], strict=True)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "width", "part", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = known.value
        tries: dict[tuple[str, int], HatTrie] = {}
        for part in slices(batches, limit=SLICE_BYTES):
            texts = _Texts(part, seed)
            ids = texts.ids
            if len(ids) < 2:
                continue
            together = texts.piece[1:] == texts.piece[:-1]
            if pairs:
                good = _has(bitmap, _slots(ids, texts.lang_codes))
                widths = {2: together & good[1:] & good[:-1]}
            else:
                code = row_codes(np.column_stack([ids[:-1], ids[1:]]))
                good = together & _has(bitmap, _slots(code, texts.lang_codes[:-1]))
                widths, begin = {}, good
                for width in range(3, LONGEST + 1):
                    begin = begin[:-1] & good[width - 2 :]
                    widths[width] = begin
            for width, begin in widths.items():
                for lang, which in texts.by_lang(np.flatnonzero(begin)):
                    rows = np.column_stack([ids[which + at] for at in range(width)])
                    tries.setdefault((lang, width), HatTrie()).add(rows)
            if sum(trie.size for trie in tries.values()) > limit:
                yield from spill(tries, limit // 2)
        yield from spill(tries, 0)

    return run


def _merge_runs(min_count: int):
    """The sequences of ``min_count`` or more of every (lang, width, part) of a partition sorted by them."""

    def merged(lang: str, width: int, runs: list[bytes]) -> pa.RecordBatch:
        unpacked = [_unpack_run(run, width) for run in runs]
        rows, counts = sum_equal(np.concatenate([r for r, _ in unpacked]), np.concatenate([c for _, c in unpacked]))
        rows, counts = rows[counts >= min_count], counts[counts >= min_count]
        ends = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(rows), pa.string()),
                pa.ListArray.from_arrays(ends, pa.array(rows.ravel().view(np.int64))),
                pa.array(counts),
                pa.array(_slots(row_codes(rows), _lang_code(lang))),
            ],
            ["lang", "ids", "n", "slot"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, runs = None, []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("lang", "width", "part", "run")]
            for lang, width, part, packed in zip(*columns, strict=True):
                if key is not None and key != (lang, width, part):
                    yield merged(key[0], key[1], runs)
                    runs = []
                key = (lang, width, part)
                runs.append(packed)
        if key is not None:
            yield merged(key[0], key[1], runs)

    return run


def _frequent_sequences(texts: DataFrame, pairs: bool, known: DataFrame, hot: DataFrame, seed: int, words: int, min_count: int, limit: int) -> DataFrame:
    context = texts.sparkSession.sparkContext
    known, hot = context.broadcast(_bitmap(known, FILTER_BITS)), context.broadcast(_bitmap(hot, HOT_BITS))
    part_bits = max(0, (words // PART_ROWS).bit_length())
    runs = texts.mapInArrow(_count_sequences(pairs, known, hot, seed, part_bits, limit), RUN)
    key = ["lang", "width", "part"]
    merged = runs.repartition(*key).sortWithinPartitions(*key).mapInArrow(_merge_runs(min_count), "lang string, ids array<long>, n long, slot long")
    return materialize(merged, "sequences")


def _word_counts(texts: DataFrame) -> tuple[DataFrame, int]:
    """Occurrences of every word of every language with its id, and the seed of the ids."""
    seed = 0
    while True:
        rows = texts.mapInArrow(_count_words(seed), "lang string, word string, id long, slot long, n long")
        counts = rows.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.first("id").alias("id"), F.first("slot").alias("slot"))
        counts = materialize(counts, "word-counts")
        if counts.groupBy("id").agg(F.min("word").alias("low"), F.max("word").alias("high")).where("low <> high").isEmpty():
            return counts, seed
        seed += 1


def phrase_counts(documents: DataFrame, min_count: int = MIN_COUNT, trie_rows: int = TRIE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``words``, ``phrase``, ``f`` of all phrases of one to four words found ``min_count`` times or more, and
    ``lang``, ``n`` with all word occurrences of each language."""
    texts = documents.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), "text")
    counts, seed = _word_counts(texts)
    totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    every = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    frequent = counts.where(F.col("n") >= min_count)

    def hot(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("n") >= PART_ROWS // 8)

    pairs = _frequent_sequences(texts, True, frequent, hot(frequent), seed, every, min_count, trie_rows)
    longer = _frequent_sequences(texts, False, pairs, hot(pairs), seed, every, min_count, trie_rows)
    spelled = pairs.unionAll(longer).select("lang", "ids", "n", F.posexplode("ids").alias("at", "id"))
    spelled = spelled.join(frequent.select("lang", "id", "word"), ["lang", "id"]).groupBy("lang", "ids", "n")
    spelled = spelled.agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.select("lang", F.col("words.word").alias("words"), F.col("n").alias("f"))
    single = frequent.select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    phrases = single.unionAll(spelled).withColumn("phrase", F.array_join("words", " "))
    return materialize(phrases, "phrases"), totals


def _exact(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(28,0)")


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A null text has no words, a null language is ``und``; repeated rows count each; ties go by count, then by the bytes
    of the phrase; a text of any length is one piece at most; other columns are ignored; an empty table gives no rows.
    """
    phrases, totals = phrase_counts(documents, min_count, trie_rows)
    counts = phrases.select("lang", "phrase", "f")
    size = F.size("words")
    candidates = phrases.where(size > 1)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang",
        "phrase",
        "f",
        "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("right"),
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.call_function("div", F.lit(SCORE_SCALE) * _exact("f"), _exact("l") + _exact("r")).cast("long")
    scored = cuts.groupBy("lang", "phrase", "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # Every shorter phrase inside a candidate, with the largest count of a candidate around it.
    inside = candidates.where(size > 2).withColumn("width", F.explode(F.sequence(F.lit(2), size - 1)))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), size - F.col("width") + 1)))
    inside = inside.select("lang", F.array_join(F.slice("words", F.col("start"), F.col("width")), " ").alias("phrase"), "f")
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact("longer") < COVERED * _exact("f"))
    )
    # The best of every part of a language first, so that no task sorts a whole one.
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("cut.score"), F.desc("f"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    kept = kept.withColumn("part", part).withColumn("rank", in_part).where(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = rf"""
WITH d AS (SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) AS words FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k)),
f AS MATERIALIZED (SELECT lang, k, words, array_to_string(words, ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, k, words),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.lang, u.phrase, u.f, l.f AS l, r.f AS r, {SCORE_SCALE} * u.f // (l.f + r.f) AS score,
  row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY {SCORE_SCALE} * u.f // (l.f + r.f), cut) AS place
  FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.words[1:cut], ' ')
  JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.words[cut + 1:u.k], ' ')),
i AS (SELECT lang, array_to_string(words[a:a + b - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - b + 2)) AS a FROM (SELECT *, unnest(range(2, k)) AS b FROM c)) GROUP BY ALL),
o AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.f DESC, encode(s.phrase)) AS rank
  FROM s LEFT JOIN i ON i.lang = s.lang AND i.phrase = s.phrase WHERE place = 1 AND (longer IS NULL OR 100 * longer < {COVERED} * s.f))
SELECT o.lang, rank, phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM o JOIN n USING (lang) WHERE rank <= {TOP}
"""
