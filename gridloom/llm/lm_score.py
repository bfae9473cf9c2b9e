"""Log-probabilities of texts under a smoothed three-word model, walked as a weighted automaton with failure arcs.

Tokens are the lower-cased (A-Z) words and one end token. Words score
p(w) = (c(w) + 1) / (N + V + 1) at the root. A history h (one word, or two; the start
counts as one) seen c(h) times keeps m(h) = a * c(h)**GROWTH pseudo-counts for the
history h' without its first word: p(w | h) = (c(h w) + m(h) p(w | h')) / (c(h) + m(h)).
``a`` is estimated for each length from the training counts alone: the value under
which leaving out each occurrence in turn gives as many new continuations as there are
continuations seen once.

As an automaton: the states are the root, the words and the pairs of words seen in
training; a state has an arc for each continuation seen, weighted log10 p(w | h), that
leads to the longest state that ends the history read; and a failure arc to the state of
h', weighted log10(m(h) / (c(h) + m(h))). The root has an arc for every word. Texts are
read once from left to right: all texts of a chunk in step, each carrying its state;
where a state has no arc for the next word, failure arcs are followed until one has.
Texts longer than LANE tokens are read in lanes side by side; a lane first reads the two
tokens before it, which is all the state depends on.

No executor needs the whole automaton. Texts are gathered to chunks of a few million
tokens. Each chunk asks for the states and arcs its own texts can reach:

1. One pass turns each chunk into numbers of its own vocabulary (hashes) and writes
   it to the shared folder.
2. Each chunk counts its words, pairs and triples and deals them out by hash, sorted and
   packed into byte planes; equal hashes meet and their counts are summed. Chunks get
   back only totals that differ from their own counts. The number of parts follows the
   number of chunks. Words and pairs go first, triples after them, each round in an
   exchange of its own, whose files go as soon as its totals are written.
3. Chunk and totals meet; the chunk's slice of the automaton is built and walked.

Every training text is counted, nothing is pruned. Words, pairs and triples are known by
56-bit hashes when they are dealt. Null text is empty (one token, the end). Repeated rows count and score as
they stand; rows that share an id give a row each. A very long text is a chunk of its
own. Columns besides id and text are ignored, whatever their names; an empty table gives
none. Without training texts every word has probability 1 / (0 + 0 + 1).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import _ragged as R
from gridloom.llm._ragged import from_planes, from_sorted_planes, sorted_planes, to_planes
from gridloom.llm._spark import schema_of, slots, stage
from gridloom.plans.shared import shuffles_go

CHUNK_TOKENS = 1_500_000
GROWTH = 0.75
LANE = 512
CHUNKS_TO_A_PART = 4
END, START = np.uint64(0xE4D), np.uint64(0x57A47)
WORD, PAIR, TRIPLE = 0, 1, 2
#: What is dealt out together: about half of the bytes each. The disk holds one round's exchange at a time.
ROUNDS = ((WORD, PAIR), (TRIPLE,))


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, place of each item among them, how often each occurs)."""
    order = np.argsort(x)
    held = x[order]
    new = np.ones(len(x), bool)
    new[1:] = held[1:] != held[:-1]
    place = np.empty(len(x), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    first = np.flatnonzero(new)
    return held[first], place, np.diff(np.append(first, len(x)))


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), *schema_of("learn array<boolean>, sizes binary, vocabulary binary, words binary").fields])


def _chunks(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """docs (id, learn, text) as rows of chunks: words as ranks, most frequent first, in the chunk's own vocabulary of hashes."""
    kinds = _chunk_schema(docs.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)
        chunk = TaskContext.get().partitionId() << 24
        ids, learn, words, sizes, held = [], [], [], [], 0

        def made() -> pa.RecordBatch:
            whole = np.concatenate(words)
            values, place, counts = distinct(whole) if len(whole) else (whole, np.empty(0, np.int64), np.empty(0, np.int64))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = [[chunk], [ids], [learn], [packed(to_planes(np.concatenate(sizes).astype("<u4")))], [packed(to_planes(values[order]))], [packed(to_planes(rank[place]))]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            data, offsets = R.text_bytes(batch.column(2))
            for lo, hi, d, at in R.slabs(data, offsets):
                w, by = R.word_hashes(d, at)
                ids += batch.column(0).slice(lo, hi - lo).to_pylist()
                learn += batch.column(1).slice(lo, hi - lo).to_pylist()
                words.append(w)
                sizes.append(np.diff(by))
                held += len(w) + hi - lo
                if held >= chunk_tokens:
                    yield made()
                    chunk += 1
                    ids, learn, words, sizes, held = [], [], [], [], 0
        if ids:
            yield made()

    return docs.mapInArrow(run, kinds)


class Chunk:
    """The tokens of a chunk as numbers of its words, and its distinct words, pairs and (unless left out) triples."""

    def __init__(self, sizes: bytes, vocabulary: bytes, words: bytes, learn: list, triples: bool = True):
        size = from_planes(sizes, "<u4").astype(np.int64)
        words = from_planes(words, "<u4").astype(np.int64)
        known = from_planes(vocabulary, "<u8")
        self.hashes = np.concatenate((known, [END, START]))
        self.end, self.start = len(known), len(known) + 1
        self.at = np.concatenate(([0], np.cumsum(size + 1)))
        n, v = int(self.at[-1]), len(self.hashes)
        self.word, before = np.empty(n, np.int32), np.empty(n, np.int64)
        last = np.zeros(n, bool)
        last[self.at[1:] - 1] = True
        self.word[~last] = words
        self.word[last] = self.end
        del words
        before[1:] = self.word[:-1]
        before[self.at[:-1]] = self.start
        before *= v
        before += self.word
        self.learned = np.repeat(np.array([bool(x) for x in learn], bool), size + 1)
        self.pairs, self.pair, _ = distinct(before)
        self.has_triples = triples
        if not triples:
            return
        self.later = np.ones(n, bool)  # whether a token has two before it, the start included
        self.later[self.at[:-1]] = False
        before = self.pair[:-1][self.later[1:]].astype(np.int64)
        before *= v
        before += self.word[self.later]
        self.triples, self.triple, _ = distinct(before)

    def counts(self) -> list[np.ndarray]:
        """Of words, of pairs, of triples in training texts; the start counts once a text."""
        words = np.bincount(self.word[self.learned], minlength=len(self.hashes))
        words[self.start] = words[self.end]
        out = [words, np.bincount(self.pair[self.learned], minlength=len(self.pairs))]
        return [*out, np.bincount(self.triple[self.learned[self.later]], minlength=len(self.triples))] if self.has_triples else out

    def names(self) -> list[np.ndarray]:
        """56-bit hashes of the words (the start left out), pairs and triples. The least bit tells pairs that end a text."""
        v, p = len(self.hashes), R.powers(4)
        first, second = np.divmod(self.pairs, v)
        pairs = R.mix(self.hashes[first] * p[1] + self.hashes[second] * p[2])
        triples = []
        if self.has_triples:
            pair, third = np.divmod(self.triples, v)
            triples = [R.mix(pairs[pair] * p[1] + self.hashes[third] * p[3]) >> np.uint64(8)]
        pairs >>= np.uint64(8)
        return [self.hashes[:-1] >> np.uint64(8), (pairs & ~np.uint64(1)) | (second == self.end).astype(np.uint64), *triples]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 56-bit hash, by range."""
    return ((hashes >> np.uint64(24)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def packed(planes: bytes) -> bytes:
    """Planes without what their high bytes repeat."""
    return pa.compress(planes, codec="zstd", asbytes=True) + len(planes).to_bytes(8, "little")


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), codec="zstd", asbytes=True)


def _requests(chunks: DataFrame, parts: int, kinds: tuple[int, ...]) -> DataFrame:
    """chunk, part, kind, hashes, counts: what a chunk counted of these kinds and needs the totals of, dealt by hash."""
    schema = "chunk long, part int, kind int, hashes binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(*(unpacked(row[c]) for c in ("sizes", "vocabulary", "words")), row["learn"], TRIPLE in kinds)
                for kind, (hashes, counts) in enumerate(zip(c.names(), c.counts(), strict=True)):
                    if kind not in kinds:
                        continue
                    order = np.argsort(hashes)
                    hashes, counts = hashes[order], counts[order].astype("<u4")
                    part = part_of(hashes, parts)
                    cut = np.searchsorted(part, np.arange(parts + 1)).tolist()
                    own = [p for p in range(parts) if cut[p] < cut[p + 1]]
                    columns = [[row["chunk"]] * len(own), own, [kind] * len(own), [packed(sorted_planes(hashes[cut[p] : cut[p + 1]])) for p in own], [packed(to_planes(counts[cut[p] : cut[p + 1]])) for p in own]]
                    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["chunk", "part", "kind", "hashes", "counts"])

    return chunks.mapInArrow(run, schema)


_ANSWER = "chunk long, part int, kind int, places binary, totals binary, levels binary, numbers binary"
#: Counts below EXACT have a level each in the histogram of counts, larger ones 32 levels to a doubling.
EXACT = 1 << 11


def level(count: np.ndarray) -> np.ndarray:
    """The count that stands for a count: itself, or the least of its level."""
    step = np.maximum(np.int64(1), np.int64(1) << np.maximum(np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) - 5, 0))
    return np.where(count < EXACT, count, count // step * step)


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk that asked: where its counts fall short of the totals. Its least chunk also gets the part's histogram of totals."""
    part, kind = key[0].as_py(), key[1].as_py()
    rows = table.sort_by("chunk")
    chunk = rows.column("chunk").to_pylist()
    asked = [from_sorted_planes(unpacked(x.as_py()), "<u8") for x in rows.column("hashes")]
    own = [from_planes(unpacked(x.as_py()), "<u4").astype(np.int64) for x in rows.column("counts")]
    values, place, _ = distinct(np.concatenate(asked))
    totals = np.bincount(place, weights=np.concatenate(own), minlength=len(values)).astype(np.int64)
    ending = (values & np.uint64(1)).astype(np.int64) if kind == PAIR else np.zeros(len(values), np.int64)
    # levels are even for what may go on, odd for pairs that end a text
    levels, numbers = np.unique(2 * level(totals[totals > 0]) + ending[totals > 0], return_counts=True)
    total = totals.sum() if kind == WORD else 0
    out: list[list] = [[] for _ in range(7)]
    lo = 0
    for i, counts in enumerate(own):
        whole = totals[place[lo : lo + len(counts)]]
        lo += len(counts)
        more = np.flatnonzero(whole != counts)
        first = (np.append(levels, -1), np.append(numbers, total)) if i == 0 else (np.empty(0, np.int64),) * 2
        for c, v in zip(out, (chunk[i], part, kind, packed(sorted_planes(more.astype("<u4"))), packed(to_planes(whole[more].astype("<u8"))), *(f.astype("<i8").tobytes() for f in first)), strict=True):
            c.append(v)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["chunk", "part", "kind", "places", "totals", "levels", "numbers"])


def _totals(chunks: DataFrame, parts: int) -> DataFrame:
    """The answers to all requests, round by round."""
    with shuffles_go(chunks.sparkSession):
        rounds = [stage(_requests(chunks, parts, kinds).groupBy("part", "kind").applyInArrow(_answer, _ANSWER), "totals") for kinds in ROUNDS]
    return functools.reduce(DataFrame.union, rounds)


def _histogram(answers: DataFrame) -> dict[int, dict[int, int]]:
    """By kind: how many distinct items have a level; level -1: the sum over all. A few thousand numbers, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = [np.frombuffer(x, "<i8") for x in batch.column(1).to_pylist()]
            numbers = [np.frombuffer(x, "<i8") for x in batch.column(2).to_pylist()]
            kind = np.repeat(batch.column(0).to_numpy(), [len(x) for x in levels])
            join = lambda x: pa.array(np.concatenate(x) if x else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), join(levels), join(numbers)], ["kind", "level", "n"])

    out: dict[int, dict[int, int]] = {WORD: {}, PAIR: {}, TRIPLE: {}}
    for kind, at, n in answers.select("kind", "levels", "numbers").mapInArrow(run, "kind int, level long, n long").groupBy("kind", "level").agg(F.sum("n")).collect():
        out[kind][at] = n
    return out


def mass_factor(counts: np.ndarray, numbers: np.ndarray, once: int) -> float:
    """a, such that histories seen ``counts`` times (``numbers`` of each) are expected to meet ``once`` new continuations when each occurrence is left out in turn."""
    lo, hi = 1e-3, 1e6
    if not len(counts):
        return 1.0
    for _ in range(100):
        a = (lo * hi) ** 0.5
        m = a * counts**GROWTH
        if (numbers * counts * m / (counts - 1 + m)).sum() < once:
            lo = a
        else:
            hi = a
    return a


def mass_factors(held: dict[int, dict[int, int]]) -> tuple[float, float]:
    """a for histories of one word and of two."""
    out = []
    for kind in (WORD, PAIR):
        some = sorted((k // 2, n) for k, n in held[kind].items() if k >= 0 and k % 2 == 0)
        once = sum(held[kind + 1].get(k, 0) for k in (2, 3))
        out.append(mass_factor(np.array([k for k, _ in some], float), np.array([n for _, n in some], float), once))
    return out[0], out[1]


def _filled(counts: np.ndarray, hashes: np.ndarray, answers: list[dict], parts: int) -> np.ndarray:
    """The chunk's counts with the totals it was sent."""
    order = np.argsort(hashes)
    part = part_of(hashes[order], parts)
    first = np.searchsorted(part, np.arange(parts + 1))
    out = counts.astype(np.int64)
    for a in answers:
        out[order[first[a["part"]] + from_sorted_planes(unpacked(a["places"]), "<u4").astype(np.int64)]] = from_planes(unpacked(a["totals"]), "<u8").astype(np.int64)
    return out


def mixed(counts: np.ndarray, seen: np.ndarray, mass: np.ndarray, history: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """(c + m p) / (s + m) for s and m of each history, or p where that was never seen; few arrays are held at a time."""
    m = mass[history]
    out = m * lower
    out += counts
    m += seen[history]
    with np.errstate(divide="ignore", invalid="ignore"):
        out /= m
    del m
    np.copyto(out, lower, where=(seen == 0)[history])
    return out


class Automaton:
    """The states, arcs and failure arcs that a chunk can reach; weights are log10.

    States: a number of the vocabulary for a history of one word, then the pairs, then the root. Arcs are kept sorted
    by (state, word).
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], total: int, known: int, factors: tuple[float, float]):
        words, pairs, triples = counts
        v = self.size = len(chunk.hashes)
        self.base = v + len(pairs)
        p1 = (words + 1.0) / (total + known + 1)
        self.root, self.after_root = np.log10(p1), np.where(words > 0, np.arange(v), self.base)
        last = np.empty(len(triples), np.int32)
        last[chunk.triple] = chunk.pair[chunk.later]  # the pair that ends a triple
        m1, m2 = factors[0] * words**GROWTH, factors[1] * pairs**GROWTH
        second = (chunk.pairs % v).astype(np.int32)
        p2 = mixed(pairs, words, m1, (chunk.pairs // v).astype(np.int32), p1[second])
        with np.errstate(divide="ignore", invalid="ignore"):
            lost = [np.where(c > 0, np.log10(m / (c + m)), 0.0) for c, m in ((words, m1), (pairs, m2))]
        self.failure = np.concatenate((*lost, [0.0]))
        self.fallback = np.concatenate((np.full(v, self.base, np.int32), second, np.array([self.base], np.int32)))
        del lost, second
        p3 = mixed(triples, pairs, m2, (chunk.triples // v).astype(np.int32), p2[last])
        two, three = pairs > 0, triples > 0
        cut = np.count_nonzero(two)
        self.weight = np.empty(cut + np.count_nonzero(three))
        self.weight[:cut], self.weight[cut:] = p2[two], p3[three]
        del p2, p3, m1, m2
        np.log10(self.weight, out=self.weight)
        self.keys = np.empty(len(self.weight), np.int64)
        self.keys[:cut], self.keys[cut:] = chunk.pairs[two], chunk.triples[three]
        self.keys[cut:] += v * v
        # a pair that ends a text is no history: its state has no arcs and nothing is read from it
        self.target = np.empty(len(self.weight), np.int32)
        self.target[:cut], self.target[cut:] = np.flatnonzero(two), last[three]
        self.target += v
        self.begin = chunk.start if words[chunk.start] > 0 else self.base

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states, weights) after reading a word in each state."""
        state, weight = state.copy(), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            s, w = state[open_], word[open_]
            at_root = s == self.base
            done = open_[at_root]
            weight[done] += self.root[word[done]]
            state[done] = self.after_root[word[done]]
            open_, s, w = open_[~at_root], s[~at_root], w[~at_root]
            key = s * self.size + w
            order = np.argsort(key)  # searched in order, neighbours are near in memory
            open_, key = open_[order], key[order]
            at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            taken, at = open_[hit], at[hit]
            weight[taken] += self.weight[at]
            state[taken] = self.target[at]
            open_ = open_[~hit]
            weight[open_] += self.failure[state[open_]]
            state[open_] = self.fallback[state[open_]]
        return state, weight

    def walk(self, word: np.ndarray, at: np.ndarray, lane: int = LANE) -> np.ndarray:
        """The sum of the weights along each text. lane: two at least."""
        size = np.diff(at)
        lanes = -(-size // lane)
        text = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = at[text] + nth * lane
        end = np.minimum(begin + lane, at[text + 1])
        order = np.argsort(begin - end, kind="stable")  # longest first: lanes that are done are the last ones
        text, nth, begin, end = text[order], nth[order], begin[order], end[order]
        state = np.full(len(text), self.begin)
        warm = np.flatnonzero(nth > 0)
        if len(warm):  # the two tokens before a lane bring it to its state from the root
            now = np.full(len(warm), self.base)
            for back in (2, 1):
                now, _ = self.step(now, word[begin[warm] - back])
            state[warm] = now
        total = np.zeros(len(text))
        length = end - begin
        for i in range(int(length.max()) if len(length) else 0):
            n = int(np.searchsorted(-length, -i, side="left"))  # lanes longer than i
            state[:n], more = self.step(state[:n], word[begin[:n] + i])
            total[:n] += more
        return np.bincount(text, weights=total, minlength=len(size))


def score_texts(docs: DataFrame, *, learn: Column, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """id, held_out (not learn), n_tokens, n_known, train_tokens, base_score (words alone), score of every row."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(True)).alias("learn"), F.col(text_col).alias("text"))
    chunks = stage(_chunks(narrow, chunk_tokens), "chunks")
    parts = max(2 * slots(spark), -(-chunks.count() // CHUNKS_TO_A_PART))
    answers = _totals(chunks, parts)
    held = _histogram(answers)
    total, known = held[WORD].get(-1, 0), sum(n for k, n in held[WORD].items() if k >= 0)
    factors = mass_factors(held)
    schema = T.StructType([T.StructField("id", narrow.schema["id"].dataType), *schema_of("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        tables = []
        sent = right.to_pylist()
        arrow = to_arrow_schema(schema)
        for row in left.to_pylist():
            c = Chunk(*(unpacked(row[c]) for c in ("sizes", "vocabulary", "words")), row["learn"])
            counts = c.counts()
            for kind, names in enumerate(c.names()):
                counts[kind][: len(names)] = _filled(counts[kind][: len(names)], names, [a for a in sent if a["kind"] == kind], parts)
            counts[WORD][c.start] = counts[WORD][c.end]
            held = Automaton(c, counts, total, known, factors)
            n = np.diff(c.at)
            columns = [row["ids"], [not x for x in row["learn"]], n, np.add.reduceat((counts[WORD] > 0)[c.word].astype(np.int64), c.at[:-1]), np.full(len(n), total), np.add.reduceat(held.root[c.word], c.at[:-1]), held.walk(c.word, c.at)]
            tables.append(pa.table([pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow))
        return pa.concat_tables(tables) if tables else arrow.empty_table()

    return chunks.groupBy("chunk").cogroup(answers.select("chunk", "part", "kind", "places", "totals").groupBy("chunk")).applyInArrow(run, schema).withColumnRenamed("id", id_col)
