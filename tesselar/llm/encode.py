"""Token ids of whole texts, encoded unit by unit with a bounded memory of units.

A unit is a word with the blanks and line feeds before it, or a part of one. Both vocabularies split a text before white
space, and between a letter or digit and ASCII punctuation, so the ids of a text are the ids of its units one after
another. The units of a slice are found and told apart in NumPy over the bytes of the column; a different unit
is looked up once a slice among those remembered, flat arrays too, and encoded by the tokenizer only if it is not there.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tesselar.llm.word_pointers import Pointers, byte_set, text_bytes

#: Other white space could belong to one token with a blank behind it: such texts are encoded in one piece.
OTHER_SPACE = re.compile(r"[^\S \n]")
ID_BYTES = 4
SPACE = byte_set((0x20, 0x20), (0x0A, 0x0A))
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
#: ASCII punctuation without the apostrophe, which may belong to a token with letters.
PUNCTUATION = byte_set((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
#: Bytes that other white space begins with, and what an added token begins with: rows with one are looked at closely.
SUSPECT = byte_set((0x09, 0x09), (0x0B, 0x0D), (0x1C, 0x1F), (0xE1, 0xE3))
LATIN, LATIN_SPACES, NO_LETTERS = 0xC3, (0x85, 0xA0), (0x97, 0xB7)
#: Bytes of words that no tokenizer may change the length of: ASCII without control characters, and Latin-1 letters.
PLAIN = byte_set((0x21, 0x7E), (0x80, 0xBF), (LATIN, LATIN))
#: Words that are encoded as one text.
STRUNG = 128
#: Texts of a call that are worked on together.
SLICE_ROWS = 512


class Remembered:
    """Different units and their ids in flat arrays, sorted by the hash of the unit."""

    def __init__(self):
        self.hashes = np.empty(0, np.uint64)
        self.units = Pointers(np.zeros(8, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64))
        self.first, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray, units: Pointers) -> np.ndarray:
        """The place of every unit, or -1."""
        if not len(self):
            return np.full(len(units), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        like = np.flatnonzero(self.hashes[place] == hashes)
        found = np.full(len(units), -1)
        found[like] = np.where(_equal(units, like, self.units, place[like]), place[like], -1)
        return found

    def add(self, hashes: np.ndarray, units: Pointers, size: np.ndarray, flat: np.ndarray) -> None:
        """Add units that are not there, with their ids one after another."""
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        data, start = _joined(units)
        start += len(self.units.data) - 8
        self.units = Pointers(
            np.concatenate([self.units.data[:-8], data]),
            np.insert(self.units.start, at, start[order]),
            np.insert(self.units.length, at, units.length[order]),
        )
        first = len(self.flat) + np.cumsum(size) - size
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.first, self.size = np.insert(self.first, at, first[order]), np.insert(self.size, at, size[order])
        self.flat = np.concatenate([self.flat, flat])


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    Remembers the units of late: at most ``memory`` new ones, and as many of the time before. With ``added_tokens``
    the tokenizer stays as loaded, so the content of an added token is that token's id; else it is text like any other.
    """

    def __init__(self, path: str, memory: int = 400_000, longest: int = 48, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        contents = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        #: Texts that are encoded in one piece.
        self.whole = re.compile("|".join([OTHER_SPACE.pattern, *map(re.escape, contents)]))
        self.suspect = SUSPECT.copy()
        self.suspect[[content.encode()[0] for content in contents if content]] = True
        #: Whether a blank is part of the token behind it.
        self.blanks = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        #: Bytes of the text that a token stands for, in vocabularies with a letter for every byte.
        vocabulary, suffix = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.token_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token.removesuffix(suffix)) or len(token)
        self.memory, self.longest = memory, longest
        self.known, self.older = Remembered(), Remembered()

    def _encode(self, units: Pointers) -> tuple[np.ndarray, np.ndarray]:
        """Of new units the number of ids, and the ids one after another."""
        data, start = _joined(units)
        odd = np.concatenate([[0], np.cumsum(~PLAIN[data])])
        strung = (odd[start + units.length] - odd[start] == 1) & (data[start] == ord(" ")) & (units.length > 1)
        size = np.zeros(len(units), np.int64)
        # The ids of a chunk of units, and the number of its first id among those of the chunk before it.
        found: list[tuple[np.ndarray, np.ndarray]] = []
        chosen = np.flatnonzero(strung)
        for at in range(0, len(chosen), 256 * STRUNG):
            part = chosen[at : at + 256 * STRUNG]
            counts, ids, failed = self._strung(Pointers(data, start[part], units.length[part]))
            size[part] = counts
            found.append((part[~failed], ids))
            strung[part[failed]] = False
        whole = data.tobytes()
        chosen = np.flatnonzero(~strung)
        for at in range(0, len(chosen), 4096):
            part = chosen[at : at + 4096]
            places = zip(start[part].tolist(), units.length[part].tolist(), strict=True)
            texts = [whole[a : a + n].decode("utf-8", "surrogatepass") for a, n in places]
            encoded = [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            size[part] = list(map(len, encoded))
            found.append((part, np.fromiter(chain.from_iterable(encoded), "<u4")))
        flat = np.empty(size.sum(), "<u4")
        first = np.cumsum(size) - size
        for part, ids in found:
            flat[_places(first[part], size[part])] = ids
        return size, flat

    def _strung(self, units: Pointers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encodes words with one blank in front that are strung together: the tokenizer splits before blanks.

        The number of ids of every unit, the ids, and which units have none because the tokens do not end where they do.
        """
        data, _ = _joined(units)
        end = np.cumsum(units.length)
        group_end = np.append(end[STRUNG - 1 : len(units) - 1 : STRUNG], end[-1])
        whole, edges = data.tobytes(), [0, *group_end.tolist()]
        texts = [whole[a:b].decode("utf-8", "surrogatepass") for a, b in pairwise(edges)]
        encoded = [one.ids for one in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(encoded), "<u4")
        # Where the tokens and the units of each group end, in bytes that tokens stand for.
        n_ids = np.array(list(map(len, encoded)))
        group, id_group = np.arange(len(units)) // STRUNG, np.repeat(np.arange(len(texts)), n_ids)
        unit_bytes, id_bytes = units.length - (not self.blanks), self.token_bytes[ids]
        right = np.bincount(group, unit_bytes, len(texts)) == np.bincount(id_group, id_bytes, len(texts))
        kept, ids, id_bytes = right[group], ids[right[id_group]], id_bytes[right[id_group]]
        unit_end, id_end = np.cumsum(np.where(kept, unit_bytes, 0)), np.cumsum(id_bytes)
        last = np.searchsorted(id_end, unit_end, "right")
        wrong = np.concatenate([[0], id_end])[last] != unit_end
        failed = ~kept | np.isin(group, group[wrong])
        counts = np.diff(np.concatenate([[0], last]))
        return np.where(failed, 0, counts), ids[np.repeat(~failed, counts)], failed

    def _look_up(self, hashes: np.ndarray, units: Pointers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of different units the first id and the number of ids, and where these are."""
        if len(self.known) > self.memory:
            self.older, self.known = self.known, Remembered()
        first, size = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        missing, flats, before = np.arange(len(units)), [], 0
        moved = missing[:0]
        for store in (self.known, self.older):
            found = store.find(hashes[missing], units.at(missing))
            here, place = missing[found >= 0], found[found >= 0]
            first[here], size[here] = before + store.first[place], store.size[place]
            missing, moved = missing[found < 0], here
            flats.append(store.flat)
            before += len(store.flat)
        counts, ids = self._encode(units.at(missing)) if len(missing) else (size[:0], np.empty(0, "<u4"))
        first[missing], size[missing] = before + np.cumsum(counts) - counts, counts
        flat = np.concatenate([*flats, ids])
        late = np.concatenate([moved, missing])
        late = late[units.length[late] <= self.longest]
        if len(late):
            self.known.add(hashes[late], units.at(late), size[late], flat[_places(first[late], size[late])])
        return first, size, flat

    def ids(self, texts: Iterable[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text as bytes; a null text has none."""
        column = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        found: list[bytes] = []
        for start in range(0, len(column), SLICE_ROWS):
            found.extend(self._slice(column.slice(start, SLICE_ROWS)))
        return found

    def _slice(self, texts: pa.Array) -> list[bytes]:
        raw, offsets = text_bytes(texts)
        if not len(raw):
            return [b""] * len(texts)
        apart = self._in_one_piece(raw, offsets, texts)
        units, row = _units(raw, offsets, apart)
        distinct, inverse, hashes = _distinct(units)
        first, size, flat = self._look_up(hashes, units.at(distinct))
        # The ids of all units one after another.
        count = size[inverse]
        end = np.cumsum(count)
        joined = flat[_places(first[inverse], count)].tobytes()
        row_end = np.concatenate([[0], end])[np.searchsorted(row, np.arange(len(texts) + 1))] * ID_BYTES
        return [joined[a:b] for a, b in zip(row_end[:-1].tolist(), row_end[1:].tolist(), strict=True)]

    def _in_one_piece(self, raw: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Which rows hold other white space or an added token."""
        odd = self.suspect[raw]
        latin = np.flatnonzero(raw[:-1] == 0xC2)
        odd[latin[np.isin(raw[latin + 1], LATIN_SPACES)]] = True
        rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)
        apart = np.zeros(len(texts), bool)
        for at in rows.tolist():
            apart[at] = self.whole.search(texts[at].as_py()) is not None
        return apart


def _units(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> tuple[Pointers, np.ndarray]:
    """The units of all rows and the row of each; a row that is to be encoded in one piece is one unit."""
    space = SPACE[raw]
    letter = ALPHANUMERIC[raw]
    # Letters of two bytes in Latin-1, but the signs of multiplication and division.
    second = np.flatnonzero(raw[:-1] == LATIN) + 1
    letter[second[~np.isin(raw[second], NO_LETTERS)]] = True
    begins = np.zeros(len(raw) + 1, bool)
    begins[1:-1] = (space[1:] & ~space[:-1]) | (PUNCTUATION[raw[1:]] & letter[:-1])
    for row in np.flatnonzero(apart).tolist():
        begins[offsets[row] : offsets[row + 1]] = False
    begins[offsets] = True
    start = np.flatnonzero(begins[:-1])
    length = np.diff(np.append(start, len(raw)))
    row = np.searchsorted(offsets, start, "right") - 1
    return Pointers(np.concatenate([raw, np.zeros(8, np.uint8)]), start, length), row


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For runs of ``count`` places from ``first`` on, all their places one after another."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - count), count)


def _joined(units: Pointers) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the units one after another, with eight zeros behind them, and where each begins."""
    data = units.data[_places(units.start, units.length)]
    return np.concatenate([data, np.zeros(8, np.uint8)]), np.cumsum(units.length) - units.length


def _equal(units: Pointers, which: np.ndarray, others: Pointers, like: np.ndarray) -> np.ndarray:
    """Whether the units ``which`` have the bytes of the units ``like`` of the others."""
    equal = units.length[which] == others.length[like]
    live, depth = np.flatnonzero(equal), 0
    while len(live):
        same = units.eight(which[live], depth) == others.eight(like[live], depth)
        equal[live[~same]] = False
        depth += 1
        live = live[same & (units.length[which[live]] > 8 * depth)]
    return equal


def _distinct(units: Pointers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place of every different unit, for each unit the number of its like, and the hashes of the different ones;
    exact, whatever the hashes do."""
    hashes = units.hashes()
    found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    if _equal(units, np.arange(len(units)), units, first[inverse]).all():
        return first, inverse, found
    whole = units.data.tobytes()
    texts = [whole[a : a + n] for a, n in zip(units.start.tolist(), units.length.tolist(), strict=True)]
    seen: dict[bytes, int] = {}
    numbers = np.array([seen.setdefault(text, len(seen)) for text in texts])
    first = np.unique(numbers, return_index=True)[1]
    return first, numbers, hashes[first]


@functools.cache
def encoder(path: str, added_tokens: bool = False) -> WordEncoder:
    """The encoder of this Python process: later tasks of the process know the units of earlier ones."""
    return WordEncoder(path, added_tokens=added_tokens)
