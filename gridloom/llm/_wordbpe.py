"""Byte-pair merges over batches of words, all words in step.

The vocabulary file (json of the ``tokenizers`` library) lower-cases a text,
splits it into pre-tokens that never cross white space, and merges the byte
symbols of each pre-token by rank. A slab of texts is cut into white-space words by
numpy; each worker keeps the ids of the words it has met in a table by 64-bit hash, so
a frequent word is merged once. New words are cut into pre-tokens: printable ASCII and
Latin letters by a pattern over all of them at once, other words by the library's own
normaliser and pattern, whose letters, numbers, lower case and composition are those
of the library's Unicode version and not of Python's. The distinct pre-tokens of all
new words, of either kind, are one ragged array of symbol ids. In every round each
pre-token finds its own lowest rank and merges all occurrences of that pair at once;
pre-tokens without a pair left drop out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gridloom.llm import _ragged as R
from gridloom.llm._ragged import span_hashes

NONE = np.iinfo(np.int32).max
KEPT_WORDS = 700_000
#: Printable ASCII and Latin letters up to U+017F, lower-cased within that range: all of a known class, none changed by composition.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-įĲ-ſ]+").fullmatch
#: Kinds of bytes in simple words: pre-tokens are runs of letters, single digits, runs of other marks. The apostrophe and < may begin more.
_LETTER, _DIGIT, _MARK = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _MARK
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[39, 60]] = 0
#: The end of patterns that simple words follow.
RUNS = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _all(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each span has only set flags."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[ends] - total[starts] == ends - starts


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, self.suffix = spec["model"]["vocab"], spec["model"].get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.fill(keys, np.array([vocab[a + b] for a, b in pairs], np.int32))
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int32)
        self.last = np.array([vocab[c + self.suffix] for c in symbols], np.int32)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.marks = sorted({x[:2] for x in self.special})
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        first = pattern.removesuffix(RUNS).split("|")
        self.simple = pattern.endswith(RUNS) and all(x.startswith("'") for x in first if x) and all(m[0] == "<" for m in self.marks)
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self.normal = whole.normalizer.normalize_str if whole.normalizer else str
        self.find = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        #: The same pattern over the lower-case letters, digits and marks of PLAIN, and line feeds as tokens.
        self.find_plain = re.compile(pattern.replace(r"\p{L}", "a-zÀ-ÖØ-öø-ſ").replace(r"\p{N}", "0-9") + r"|\n").findall
        self.forget()

    def fill(self, keys: np.ndarray, made: np.ndarray) -> None:
        """An open-addressing table of the pairs: key, rank, made symbol."""
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        self.mask = (1 << int(64 - self.shift)) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks, self.made = np.full(self.mask + 1, NONE, np.int32), np.zeros(self.mask + 1, np.int32)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slot(keys).tolist(), strict=True)):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.ranks[slot], self.made[slot] = key, rank, made[rank]

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, made symbol) of each pair; NONE for a pair that never merges."""
        key = left.astype(np.int64) * self.size + right
        at = self.slot(key)
        found = self.keys[at]
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            again = self.keys[at[open_]]
            open_ = open_[(again != key[open_]) & (again != -1)]
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.made[at]

    def merge(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the non-empty sequences ids[at[i]:at[i+1]]; (ids, offsets) of what survives."""
        n = len(at) - 1
        seq = np.repeat(np.arange(n), np.diff(at))
        done_ids, done_seq = [], []
        while len(ids):
            inner = seq[1:] == seq[:-1]
            rank = np.full(len(ids), NONE, np.int32)
            made = np.zeros(len(ids), np.int32)
            place = np.flatnonzero(inner)
            rank[place], made[place] = self.lookup(ids[place], ids[place + 1])
            first = np.flatnonzero(np.concatenate(([True], ~inner)))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            least_of = np.repeat(least, size)
            over = least_of == NONE
            if over.any():
                done_ids.append(ids[over])
                done_seq.append(seq[over])
                left = ~over
                ids, seq, rank, made, least_of = ids[left], seq[left], rank[left], made[left], least_of[left]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == least_of)
            run = np.concatenate(([True], np.diff(hit) > 1))
            if not run.all():  # overlapping pairs of one repeated symbol: from the left, every other one
                start = np.flatnonzero(run)
                hit = hit[(np.arange(len(hit)) - np.repeat(start, np.diff(np.append(start, len(hit))))) % 2 == 0]
            ids = ids.copy()
            ids[hit] = made[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, seq = ids[keep], seq[keep]
        if not done_ids:
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64)
        ids, seq = np.concatenate(done_ids), np.concatenate(done_seq)
        order = np.argsort(seq, kind="stable")
        return ids[order], np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=n))))

    def pretokens(self, word: str) -> list[tuple[str, int]]:
        """The pre-tokens of a word with special strings or characters outside PLAIN; special ones with their id, others with -1."""
        out = []
        for piece in self.cut_special.split(word) if self.cut_special else (word,):
            if piece in self.special:
                out.append((piece, self.special[piece]))
            elif piece:
                out += [(token, -1) for token, _ in self.find(self.normal(piece))]
        return out

    def encode_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by word) of the white-space words data[starts[i]:ends[i]]."""
        n = len(starts)
        low, whole = R._LOWER[data], data.tobytes()
        simple = _all(_KIND[data] > 0, starts, ends) if self.simple else np.zeros(n, bool)
        bodies, words, plain, odd = [], [], [], []
        for i in np.flatnonzero(~simple).tolist():
            word = whole[starts[i] : ends[i]].decode()
            fits = PLAIN(word) is not None and not any(m in word for m in self.marks)
            (plain if fits else odd).append(i)
            (words if fits else bodies).append(word)
        begin, stop = np.zeros(len(data) + 1, np.int8), np.zeros(len(data) + 1, np.int8)
        begin[starts[simple]], stop[ends[simple]] = 1, 1
        kind = _KIND[data]
        inside = np.cumsum(begin - stop)[:-1] > 0
        turn = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)))
        first = np.flatnonzero(inside & (turn | (begin[:-1] > 0)))  # where pre-tokens of simple words begin
        number = np.flatnonzero(simple)
        owner = number[np.searchsorted(starts[simple], first, side="right") - 1]
        starts, ends = first, np.minimum(np.append(first[1:], len(data)), ends[owner])
        fixed = np.full(len(first), -1, np.int64)
        if plain:
            joined = "\n".join(words).lower()
            tokens = self.find_plain(joined)  # they cover every character
            held = np.frombuffer(joined.encode(), np.uint8)
            lead = np.append(np.flatnonzero((held & 0xC0) != 0x80), len(held))
            after = lead[np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))]
            before = np.concatenate(([0], after[:-1]))
            line = held[before] == 10
            owner = np.concatenate((owner, np.array(plain)[np.cumsum(line)[~line]]))
            fixed = np.concatenate((fixed, np.full(len(line) - int(line.sum()), -1)))
            starts, ends = np.concatenate((starts, before[~line] + len(low))), np.concatenate((ends, after[~line] + len(low)))
            low = np.concatenate((low, held))
        if odd:
            found = [self.pretokens(word) for word in bodies]
            tokens = [t.encode() for f in found for t, _ in f]
            size = np.fromiter(map(len, tokens), np.int64, len(tokens))
            after = np.cumsum(size) + len(low)
            owner = np.concatenate((owner, np.repeat(np.array(odd), [len(f) for f in found])))
            fixed = np.concatenate((fixed, np.array([i for f in found for _, i in f], np.int64)))
            starts, ends = np.concatenate((starts, after - size)), np.concatenate((ends, after))
            low = np.concatenate((low, np.frombuffer(b"".join(tokens), np.uint8)))
        if plain or odd:
            order = np.argsort(owner, kind="stable")
            starts, ends, owner, fixed = starts[order], ends[order], owner[order], fixed[order]
        data = low
        key = span_hashes(data, starts, ends)
        special = fixed >= 0
        key[special] = fixed[special].astype(np.uint64)  # ids stand for themselves
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        starts, ends, fixed = starts[first], ends[first], fixed[first]  # each distinct pre-token once
        ends = np.where(fixed >= 0, starts + 1, ends)  # one symbol, which is the special id
        at = np.concatenate(([0], np.cumsum(ends - starts)))
        own = data[np.arange(int(at[-1])) + np.repeat(starts - at[:-1], ends - starts)]
        ids = self.inner[own]
        ids[at[1:] - 1] = np.where(fixed >= 0, fixed, self.last[own[at[1:] - 1]])
        ids, at = self.merge(ids, at)
        size = np.diff(at)[place]
        to = np.concatenate(([0], np.cumsum(size)))
        whole = ids[np.arange(int(to[-1])) + np.repeat(at[:-1][place] - to[:-1], size)]
        return whole, to[np.searchsorted(owner, np.arange(n + 1))]

    def forget(self) -> None:
        self.words = WordTable()
        self.ids, self.at = np.empty(0, np.int32), np.zeros(1, np.int64)

    def places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each white-space word among the kept words, word offsets by text); learns the words that are new."""
        starts, ends, by = R.word_spans(data, offsets)
        key = span_hashes(data, starts, ends)
        if len(self.at) > KEPT_WORDS:
            self.forget()
        place = self.words.find(key)
        new = np.flatnonzero(place < 0)
        if len(new):
            keys, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            order = np.argsort(first)  # as they come in the slab
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            keys, first, back = keys[order], first[order], rank[back]
            ids, at = self.encode_words(data, starts[new[first]], ends[new[first]])
            place[new] = len(self.at) - 1 + back
            self.words.add(keys)
            self.ids, self.at = np.concatenate((self.ids, ids)), np.concatenate((self.at, at[1:] + self.at[-1]))
        return place, by

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, past the last, ids, offsets by text) by slab of whole texts; null is empty."""
        for lo, hi, data, offsets in R.slabs(*R.text_bytes(column)):
            place, by = self.places(data, offsets)
            size = np.diff(self.at)[place]
            to = np.concatenate(([0], np.cumsum(size)))
            yield lo, hi, self.ids[np.arange(int(to[-1])) + np.repeat(self.at[:-1][place] - to[:-1], size)], to[by]

    def count(self, column: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        out = [np.empty(0, np.int64)]
        for _, _, data, offsets in R.slabs(*R.text_bytes(column)):
            place, by = self.places(data, offsets)
            out.append(np.diff(np.concatenate(([0], np.cumsum(np.diff(self.at)[place])))[by]))
        return np.concatenate(out)


class WordTable:
    """An open-addressing table of 64-bit word hashes, numbered in the order they were added."""

    def __init__(self):
        self.count = 0
        self.room(1 << 16)

    def room(self, size: int) -> None:
        self.shift, self.mask = np.uint64(65 - size.bit_length()), size - 1
        self.keys, self.number = np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def probe(self, key: np.ndarray) -> np.ndarray:
        """The slot of each key, or the empty slot where it would go."""
        at = ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.number[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            again = at[open_]
            open_ = open_[(self.keys[again] != key[open_]) & (self.number[again] >= 0)]
        return at

    def find(self, key: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is not held."""
        return self.number[self.probe(key)].astype(np.int64)

    def add(self, key: np.ndarray) -> None:
        """Distinct keys that are not held yet."""
        if 3 * (self.count + len(key)) > len(self.keys):
            held = np.flatnonzero(self.number >= 0)
            old, number = self.keys[held], self.number[held]
            self.room(1 << int(6 * (self.count + len(key))).bit_length())
            self._put(old, number)
        self._put(key, np.arange(self.count, self.count + len(key), dtype=np.int32))
        self.count += len(key)

    def _put(self, key: np.ndarray, number: np.ndarray) -> None:
        while len(key):
            at = self.probe(key)
            self.keys[at], self.number[at] = key, number  # of keys that meet in an empty slot one stays
            left = self.number[at] != number
            key, number = key[left], number[left]


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One instance in a worker for each file."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
