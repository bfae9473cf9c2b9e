"""SentencePiece BPE, encoded by backtracking instead of a merge queue, and decoded.

Encoding a segment: an Aho-Corasick automaton over the reachable pieces gives the
matches at each position, longest first. A match is taken if it is compatible
with the token before it, that is, if merging the two tokens' joint text gives
exactly these two again (remembered by pair). Where no match fits, the position is
marked in a bitfield of failed positions and the token before is taken back; a
match that ends on a marked position is passed over. A token sequence whose
neighbours are all compatible is the one that merging by score gives.

A text is cut first where no merge can reach across: before a run of spaces that
follows another character (no piece has a space after another character; this is
checked when the file is loaded), and then between any two characters that stand
side by side in no piece. Characters that no piece holds become byte tokens. Pieces of nothing but spaces share one score, so which of them
arise depends on the order of equal scores; segments with two spaces or more are
merged directly. Segments are remembered in a worker up to a bound.

Null text is empty: no ids, and "" decoded. Very long texts are taken whole; one word that
is very long takes memory in proportion to it. Repeated rows, empty tables and other
columns: see ``encode_decode``.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm._spark import map_texts

SPACE = "▁"
KEPT_SEGMENTS = 600_000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
LEAST = float("-inf")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def wire(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            c = data[i]
            i += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while i < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[i : i + size]
        i += size


class PieceCodec:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(wire(f.read()))
        pieces = [dict(wire(v)) for k, v in message if k == 1]
        trainer = dict(wire(next(v for k, v in message if k == 2)))
        normalizer = dict(wire(next(v for k, v in message if k == 3)))
        if trainer.get(3) != 2 or not trainer.get(35) or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError(f"{path}: a BPE model with byte fallback, a dummy prefix and no normalisation is needed")
        self.text = [p[1].decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: holds pieces of a kind that is not supported")
        self.kind = kinds
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.text, kinds, strict=True)) if k == NORMAL}
        self.score = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        self.byte = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, kinds, strict=True)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        if any(SPACE in t.lstrip(SPACE) for t in self.ids):
            raise ValueError(f"{path}: a piece has a space after another character")
        known = {c for t in self.ids for c in t}
        #: Characters that part segments: a line feed, if no piece has it.
        parted = "" if "\n" in known else "\n"
        self.segments = re.compile(rf"\n| *[^ \n]+| +" if parted else r" *[^ ]+| +").findall
        self.scores = {t: self.score[i] for t, i in self.ids.items()}
        self.known = frozenset(known)
        #: Neighbours within some piece; no merge reaches across any others.
        self.joined = {a + b for t in self.ids for a, b in pairwise(t)}
        self.parts: dict[str, list[int]] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if self.merge(t) == [i]:
                self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, tuple[str, str]] = {}

    def merge(self, s: str) -> list[int]:
        """Ids by merging the best-scored neighbours, from the left where scores are equal; bytes for unknown characters."""
        if len(s) <= 24:
            return self.merge_short(list(s))
        part = list(s)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(part) and (k := self.ids.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-self.score[k], i, self.text[k]))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if not part[i] or (j := after[i]) >= len(part) or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, ""
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out: list[int] = []
        for p in part:
            if p:
                out += [self.ids[p]] if p in self.ids else [self.byte[b] for b in p.encode()]
        return out

    def merge_short(self, part: list[str]) -> list[int]:
        """``merge`` by looking at all neighbours in each round."""
        scores = self.scores
        while len(part) > 1:
            found = [scores.get(a + b, LEAST) for a, b in pairwise(part)]
            best = max(found)
            if best == LEAST:
                break
            i = found.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
        out: list[int] = []
        for p in part:
            if p in self.ids:
                out.append(self.ids[p])
            else:
                out += [self.byte[b] for b in p.encode()]
        return out

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            known = self.pairs[a, b] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return known

    def backtrack(self, s: str) -> list[int]:
        """Ids of a segment, by longest matches and taking back."""
        n = len(s)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (i, size) in self.automaton.iter(s):
            matches[end - size + 1].append((size, i))  # ends rise, so sizes rise
        failed = bytearray(n // 8 + 1)
        tokens: list[int] = []
        starts: list[int] = []
        pos, shorter = 0, n + 1
        while pos < n:
            for size, i in reversed(matches[pos]):
                end = pos + size
                if size < shorter and not failed[end >> 3] >> (end & 7) & 1 and (not tokens or self.compatible(tokens[-1], i)):
                    tokens.append(i)
                    starts.append(pos)
                    pos, shorter = end, n + 1
                    break
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                if not tokens:
                    raise AssertionError("no encoding")
                tokens.pop()
                shorter, pos = pos - starts[-1], starts.pop()
        return tokens

    def encode_segment(self, s: str) -> list[int]:
        """s: with spaces as the vocabulary writes them."""
        if SPACE * 2 in s:
            return self.merge(s)
        out: list[int] = []
        joined, lo = self.joined, 0
        cuts = [i for i, (a, b) in enumerate(pairwise(s), 1) if a + b not in joined]
        for hi in [*cuts, len(s)]:
            part, lo = s[lo:hi], hi
            if (ids := self.parts.get(part)) is None:
                ids = self.parts[part] = self.backtrack(part) if self.known.issuperset(part) else [self.byte[b] for b in part.encode()]
            out += ids
        return out

    def split(self, text: str) -> list[str]:
        """Segments, with plain spaces; the first has the dummy prefix."""
        return self.segments(" " + text.replace(SPACE, " ")) if text else []

    def decode_ids(self, ids: list[int]) -> str:
        """Text of ids, the leading space kept."""
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append({NORMAL: self.text[i].replace(SPACE, " "), UNKNOWN: " ⁇ "}.get(self.kind[i], ""))
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for s in self.split(text) for i in self.encode_segment(s.replace(" ", SPACE))]

    def decode(self, ids: list[int]) -> str:
        """The text; the space that encoding puts in front is taken off."""
        return self.decode_ids(ids).removeprefix(" ")

    def learn(self, texts: list[list[str]], limit: int = KEPT_SEGMENTS) -> dict[str, tuple[str, str]]:
        """(ids in decimal with commas, decoded text) by segment, for every segment of these split texts."""
        wanted: set[str] = set()
        for segments in texts:
            wanted.update(segments)
        if len(self.kept) + len(wanted) > limit:
            self.kept = {w: self.kept[w] for w in wanted if w in self.kept}
        if len(self.pairs) > limit:
            self.pairs.clear()
        if len(self.parts) > limit:
            self.parts.clear()
        for w in wanted:
            if w not in self.kept:
                ids = self.encode_segment(w.replace(" ", SPACE))
                decoded = self.decode_ids(ids)
                self.kept[w] = (",".join(map(str, ids)), w if decoded == w else decoded)
        return self.kept


_loaded: dict[str, PieceCodec] = {}


def load(path: str) -> PieceCodec:
    if path not in _loaded:
        _loaded[path] = PieceCodec(path)
    return _loaded[path]


def pieces(texts: list, size: int = 8 << 20) -> Iterator[list]:
    """Runs of texts of about ``size`` characters."""
    lo = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield texts[lo : i + 1]
            lo, total = i + 1, 0
    if lo < len(texts):
        yield texts[lo:]


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, keep_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of every row; with keep_ids also ids (array) and decoded (string).

    Null text is empty. Rows, ids and order within a partition stay as they are;
    other columns are ignored; an empty table gives an empty table.
    """
    path = model or default_model()
    more = ", ids array<int>, decoded string" if keep_ids else ""

    def kernel(batch: pa.RecordBatch) -> list:
        from hashlib import sha256

        from gridloom.llm import piece_codec
        codec = piece_codec.load(path)
        columns: list[list] = [[], [], []] + [[], []] * keep_ids
        for some in pieces(batch.column(batch.num_columns - 1).fill_null("").to_pylist()):
            split = [codec.split(t) for t in some]
            kept = codec.learn(split)
            for segments in split:
                both = [kept[s] for s in segments]
                listed = ",".join([x for x, _ in both])
                decoded = "".join([y for _, y in both]).removeprefix(" ")
                columns[0].append(listed.count(",") + 1 if listed else 0)
                columns[1].append(sha256(listed.encode()).hexdigest())
                columns[2].append(sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    columns[3].append([int(x) for x in listed.split(",")] if listed else [])
                    columns[4].append(decoded)
        return [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()], strict=False)]

    return map_texts(docs, [id_col, text_col], "n_tokens long, ids_sha256 string, decoded_sha256 string" + more, kernel)
