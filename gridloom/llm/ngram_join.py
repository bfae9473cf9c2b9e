"""Near-duplicate components: the n-gram Jaccard join by prefix trees.

A text's set is its distinct k-word shingles (64-bit hashes of lower-cased words; a
text of fewer words is one shingle; without words it is empty and linked with
nothing). Two texts link when percent * |union| <= 100 * |intersection|; a component
is closed under links. Results are exact up to collisions of 64-bit hashes.

1. Every text gets its size, a 128-bit digest of its set and a parity sketch whose
   width is a power of two of at least twelve times the share of bits in which linked
   sets may differ. Equal sets become one class, so copies, however many, are one set.
2. Signatures find what may link without a common shingle being enough. Sizes are cut
   into intervals such that linked sets lie in one or in neighbouring ones; a set
   works in the families of its own interval and the next, so linked sets share one. A
   family hashes shingles into a fixed number of groups; a signature is the sum of the
   hashes of a group's shingles, for groups of two or more. Linked sets differ in d
   shingles at most, d known from the size, which touch d groups at most: a set with more
   than d such groups has a signature in common with every set it links to. A set with
   fewer also posts finer groups, until it has more than d, or a group for each shingle. Two linked
   sets meet at the coarser of the levels at which either has enough. Texts that share
   only frequent shingles share no signature, so the volume is linear in the input.
3. Signatures are dealt by hash, packed; the number of parts follows the input. Only
   those that several sets share go on. Sets of compatible size whose parity sketches
   differ in at most (n + m)(1 - t)/(1 + t) bits (no linked pair differs in more) are
   candidates; a spanning forest of them leaves a task, never all pairs. A signature of
   very many sets is split by set; leaders of its parts, with the reach of what they
   stand for, are compared once more. Components of the forests bound the links.
4. Candidate components are cut into blocks of bounded size. In a block, sets go into
   a prefix tree over the global order; a probe walks it with its overlap so far,
   skips subtrees that cannot reach the overlap they need, and links at the ends. Each
   set ends linked to a leader. Between blocks, leaders are joined block by block;
   leaders further apart than the distance once for themselves and once for each that
   leads others have no links between their sets (the Jaccard distance is a metric);
   nearer ones that are not yet connected have their sets joined.

Shingles are ordered by their hash, the same order in every task.

Null text is empty. A row without an id has its n_shingles and a null component, and is
linked with nothing. Ids are meant to be distinct: rows that share one have each their
own n_shingles, and links of either may join both. Very long texts are taken whole, one
at a time. An empty table gives no rows. Columns besides id and text are ignored by
``components_of`` and kept by ``keep_one``. percent must be above 50.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import _ragged as R
from gridloom.llm._spark import schema_of, slots, stage, whole_ids
from gridloom.operators.components import connected_components

BLOCK = 128
POSTED = 4_000_000
#: Parts follow the volume alone, whatever the session's partitions: one for so many postings, and LEAST_PARTS for a small cluster.
PART_POSTINGS, LEAST_PARTS = 2_000_000, 48
PARITY = 128
#: A group gives a signature from so many shingles on: one shingle alone may be in any text.
FULL = 2
SPLIT = 256
BROADCAST_ROWS = 300_000
POSTING = np.dtype([("token", "<u8"), ("id", "<i8")])
GROUPED = np.dtype([("token", "<u8"), ("id", "<i8"), ("sub", "<i4")])


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, sorted distinct shingles of each text, offsets by text) by slab."""
    data, offsets = R.text_bytes(column)
    for lo, _, d, at in R.slabs(data, offsets):
        words, by = R.word_hashes(d, at)
        hashed, of = R.shingle_hashes(words, by, k)
        count = np.diff(by)
        few = np.flatnonzero((count > 0) & (count < k))
        owner = R.owners(of)
        if len(few):  # the whole sequence as one; salted by its length
            short = np.zeros(len(few), np.uint64)
            for i in range(k - 1):
                has = count[few] > i
                short[has] += words[by[few][has] + i] * R.powers(k)[i]
            hashed = np.concatenate((hashed, R.mix(short ^ R.mix(count[few].astype(np.uint64)))))
            owner = np.concatenate((owner, few))
        order = np.argsort(hashed)
        order = order[np.argsort(owner[order], kind="stable")]
        hashed, owner = hashed[order], owner[order]
        new = np.ones(len(hashed), bool)
        new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
        hashed, owner = hashed[new], owner[new]
        yield lo, hashed, np.searchsorted(owner, np.arange(len(at)))


class Families:
    """Size intervals and the number of groups of each family, for one percentage."""

    def __init__(self, percent: int, largest: int):
        if percent <= 50:
            raise ValueError("percent must be above 50")
        self.percent = percent
        low = [1]
        while low[-1] <= largest:
            low.append(100 * low[-1] // percent + 1)
        low.append(100 * low[-1] // percent + 1)
        self.low = np.array(low, np.int64)
        self.top = self.low[1:] - 1  # the largest size of each interval
        self.groups = np.array([self._groups(i) for i in range(len(self.top))], np.int64)

    def _groups(self, i: int) -> int:
        """Groups of family i: enough that its sets have more than ``apart`` that are full, on average."""
        least = int(self.low[max(i - 1, 0)])
        sizes = (least, int(self.low[i]), int(self.top[i]))
        g = max(int(self.apart(np.array([n]), i)[0]) + 1 for n in sizes)
        while g < 4 * least:
            if all(self._likely(n, g) >= int(self.apart(np.array([n]), i)[0]) + 1 for n in sizes):
                break
            g += max(1, g // 16)
        return g

    def _likely(self, n: int, g: int) -> float:
        """How many of g groups hold FULL of n shingles or more on average; more groups cost more than the finer level of those that fall short."""
        load = n / g
        return g * (1 - float(np.exp(-load) * sum(load**j / math.factorial(j) for j in range(FULL))))

    def interval(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, side="right") - 1

    def apart(self, n: np.ndarray, family: np.ndarray | int) -> np.ndarray:
        """In how many shingles a set of n differs at most from a set that it links to in the family."""
        p = self.percent
        return np.minimum(n * (100 - p) // p, (n + self.top[family]) * (100 - p) // (100 + p))

    def signatures(self, hashed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signatures, set of each) of the non-empty sets hashed[at[i]:at[i+1]]; sets that link to no other set may have none."""
        size = np.diff(at)
        out, owner = [], []
        mixed = R.mix(hashed + np.uint64(0x51))
        for step in (0, 1):
            family = self.interval(size) + step
            apart = self.apart(size, family)
            left = np.flatnonzero(apart > 0)
            level = 0
            while len(left):
                n = size[left]
                groups = np.minimum(self.groups[family[left]] << level, 1 << 40)
                single = groups >= 4 * self.top[family[left]]  # a group for each shingle, for all of a family at once
                first = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(int(first[-1])) + np.repeat(at[left] - first[:-1], n)
                of = np.repeat(np.arange(len(left)), n)
                salt = R.mix((family[left].astype(np.uint64) << np.uint64(8)) + np.uint64(level))
                spot = (R.mix(hashed[place] ^ np.repeat(salt, n)) >> np.uint64(24)).astype(np.int64)  # 40 bits
                if single.any():
                    one = single[of]
                    own = R.mix(hashed[place[one]] + np.repeat(salt, n)[one])
                    out.append(own)
                    owner.append(left[of[one]])
                    keep = ~one
                    place, of, spot = place[keep], of[keep], spot[keep]
                room = np.where(single, 0, groups)
                base = np.concatenate(([0], np.cumsum(room)))
                key = base[of] + ((spot >> 8) * room[of] >> 32)
                total, count = np.zeros(int(base[-1]), np.uint64), np.bincount(key, minlength=int(base[-1]))
                np.add.at(total, key, mixed[place])
                full = np.flatnonzero(count >= FULL)
                of_group = np.repeat(np.arange(len(left)), room)[full]
                out.append(R.mix(total[full] + R.mix(salt[of_group] + (full - base[of_group]).astype(np.uint64))))
                owner.append(left[of_group])
                enough = single | (np.bincount(of_group, minlength=len(left)) > apart[left])
                left, level = left[~enough], level + 1
        return (np.concatenate(out), np.concatenate(owner)) if out else (np.empty(0, np.uint64), np.empty(0, np.int64))


def digests(hashed: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    size = np.diff(at)
    full = np.flatnonzero(size)
    out = []
    for salt in (0x51, 0xA7):
        total = np.zeros(len(size), np.uint64)
        if len(full):
            total[full] = np.add.reduceat(R.mix(hashed ^ R.mix(np.array([salt], np.uint64))), at[:-1][full])
        out.append(total.view(np.int64))
    return out


def parity(hashed: np.ndarray, percent: int) -> bytes:
    """Bit i: whether an odd number of shingles have hash i modulo the width."""
    width = max(PARITY, 1 << (12 * len(hashed) * (100 - percent) // (100 + percent)).bit_length())
    bit = (R.mix(hashed + np.uint64(77)) >> np.uint64(32)).astype(np.int64) % width
    return np.packbits((np.bincount(bit, minlength=width) & 1).astype(np.uint8)).tobytes()


class Sketches:
    """Parity sketches of several widths."""

    def __init__(self, sketches: list[bytes]):
        self.words = [np.frombuffer(s, "<u8") for s in sketches]
        self.width = np.array([len(w) for w in self.words], np.int64)

    def folded(self, i: int, width: int) -> np.ndarray:
        return np.bitwise_xor.reduce(self.words[i].reshape(-1, width), axis=0)

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """Bits in which sketch i differs from each of the others, at the narrower width of the two."""
        out = np.empty(len(others), np.int64)
        for w in np.unique(self.width[others]).tolist():
            own = np.flatnonzero(self.width[others] == w)
            width = min(w, int(self.width[i]))
            table = np.stack([self.words[j] for j in others[own].tolist()])
            if width < w:
                table = np.bitwise_xor.reduce(table.reshape(len(own), -1, width), axis=1)
            out[own] = np.bitwise_count(self.folded(i, width) ^ table).sum(axis=1, dtype=np.int64)
        return out


def part_of(token: np.ndarray, parts: int) -> np.ndarray:
    return ((token >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


_SIGNED = "id long, n int, h1 long, h2 long, parity binary"


def _signed(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """id, n, h1, h2 of each text; parity where the task meets the set for the first time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, h1, h2, bits = [], [], [], []
            for _, hashed, at in shingle_sets(batch.column(1), k):
                one, two = digests(hashed, at)
                n.append(np.diff(at))
                h1.append(one)
                h2.append(two)
                for name, a, b in zip(one.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    fresh = a < b and name not in seen
                    seen.add(name)
                    bits.append(parity(hashed[a:b], percent) if fresh else None)
            join = lambda x, t: pa.array(np.concatenate(x).astype(t) if x else np.empty(0, t))
            yield pa.RecordBatch.from_arrays([batch.column(0), join(n, np.int32), join(h1, np.int64), join(h2, np.int64), pa.array(bits, pa.binary())], ["id", "n", "h1", "h2", "parity"])

    return texts.mapInArrow(run, schema_of(_SIGNED))


def _postings(texts: DataFrame, k: int, percent: int, largest: int, parts: int) -> DataFrame:
    """part, tokens, ids: (signature, set) of the sets that a task meets, packed by hash range of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families = Families(percent, largest)
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def made() -> pa.RecordBatch:
            token, name = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(token)
            token, name = token[order], name[order]
            cut = np.searchsorted(part_of(token, parts), np.arange(parts + 1)).tolist()
            own = [p for p in range(parts) if cut[p] < cut[p + 1]]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([R.sorted_planes(token[cut[p] : cut[p + 1]]) for p in own], pa.binary()), pa.array([name[cut[p] : cut[p + 1]].tobytes() for p in own], pa.binary())], ["part", "tokens", "ids"])

        for batch in batches:
            for _, hashed, at in shingle_sets(batch.column(0), k):
                names = digests(hashed, at)[0]
                size = np.diff(at)
                new = []
                for i, name in enumerate(names.tolist()):
                    if size[i] and name not in seen:
                        seen.add(name)
                        new.append(i)
                new = np.array(new, np.int64)
                first = np.concatenate(([0], np.cumsum(size[new])))
                token, of = families.signatures(hashed[np.arange(int(first[-1])) + np.repeat(at[new] - first[:-1], size[new])], first)
                held.append((token, names[new[of]]))
                count += len(token)
                if count >= POSTED:
                    yield made()
                    held, count = [], 0
        if count:
            yield made()

    return texts.select("text").mapInArrow(run, schema_of("part int, tokens binary, ids binary"))


def _shared_only(parts: int):
    """Of a part's postings those of signatures that several sets share; very large ones split by set over other parts."""

    def run(table: pa.Table) -> pa.Table:
        token = np.concatenate([R.from_sorted_planes(r.as_py(), "<u8") for r in table.column("tokens")])
        rows = np.empty(len(token), POSTING)
        rows["token"], rows["id"] = token, np.concatenate([np.frombuffer(r.as_py(), "<i8") for r in table.column("ids")])
        order = np.lexsort((rows["id"], rows["token"]))
        rows = rows[order]
        rows = rows[np.concatenate(([True], rows[1:] != rows[:-1]))]
        first = np.flatnonzero(np.concatenate(([True], rows["token"][1:] != rows["token"][:-1])))
        size = np.diff(np.append(first, len(rows)))
        several = np.repeat(size > 1, size)
        out = np.empty(int(several.sum()), GROUPED)
        out["token"], out["id"] = rows["token"][several], rows["id"][several]
        group = np.repeat(size, size)[several]
        ways = -(-group // SPLIT)
        spread = R.mix(out["id"].view(np.uint64)) % ways.astype(np.uint64)
        out["sub"] = np.where(ways > 1, spread.astype(np.int64) + 1, 0)
        part = part_of(out["token"], parts)
        part = np.where(out["sub"] > 0, (R.mix(out["token"] + out["sub"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64), part)
        order = np.argsort(part, kind="stable")
        out, part = out[order], part[order]
        own = np.unique(part)
        cut = np.append(np.searchsorted(part, own), len(part)).tolist()
        return pa.table({"part": pa.array(own.astype(np.int32)), "rows": pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    return run


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, id: the sets whose sketches a part needs."""
    for batch in batches:
        ids = [np.unique(np.frombuffer(r, GROUPED)["id"]) for r in batch.column(1).to_pylist()]
        part = np.repeat(batch.column(0).to_numpy(), [len(i) for i in ids])
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int64))], ["part", "id"])


def _grow(lo, hi, radius, sketches: Sketches, percent: int) -> list[list[int]]:
    """Components of sets that may link, as lists of places, the first reached from.

    A place stands for sets of lo to hi shingles whose sketches lie within the radius of its own. Tight components
    take one comparison a set.
    """
    out, left = [], np.arange(len(lo))
    while len(left):
        members = [int(left[0])]
        left, i = left[1:], 0
        while i < len(members) and len(left):
            x = members[i]
            fits = 100 * np.minimum(hi[x], hi[left]) >= percent * np.maximum(lo[x], lo[left])
            near = left[fits]
            if len(near):
                differ = sketches.differ(x, near) - radius[x] - radius[near]
                fits[fits] = (100 + percent) * differ <= (100 - percent) * (hi[x] + hi[near])
            members += left[fits].tolist()
            left = left[~fits]
            i += 1
        out.append(members)
    return out


_FOREST = "kind int, src long, dst long, token long, lo int, hi int, radius int, parity binary"


def _forest(percent: int):
    """Edges (kind 0) of a spanning forest of each shingle's candidates; for parts of split shingles leaders (kind 1)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(8)]
        if left.num_rows and right.num_rows:
            rows = np.unique(np.concatenate([np.frombuffer(r.as_py(), GROUPED) for r in left.column("rows")]))
            ids, first = np.unique(right.column("id").to_numpy(), return_index=True)
            n_of = right.column("n").to_numpy()[first].astype(np.int64)
            bits_of = right.column("parity").take(pa.array(first)).to_pylist()
            rows = rows[np.lexsort((rows["id"], rows["sub"], rows["token"]))]
            place = np.searchsorted(ids, rows["id"])
            start = np.flatnonzero(np.concatenate(([True], (rows["token"][1:] != rows["token"][:-1]) | (rows["sub"][1:] != rows["sub"][:-1]))))
            seen: set[bytes] = set()
            for a, b in zip(start.tolist(), np.append(start[1:], len(rows)).tolist(), strict=True):
                own, sub = place[a:b], rows["sub"][a]
                if not sub and (name := own.tobytes()) in seen:
                    continue
                if not sub:
                    seen.add(name)
                n, sketches = n_of[own], Sketches([bits_of[j] for j in own.tolist()])
                for members in _grow(n, n, np.zeros(len(own), np.int64), sketches, percent):
                    leader = members[0]
                    columns[0] += [0] * (len(members) - 1)
                    columns[1] += [int(ids[own[leader]])] * (len(members) - 1)
                    columns[2] += ids[own[members[1:]]].tolist()
                    for c in columns[3:]:
                        c += [None] * (len(members) - 1)
                    if sub:
                        radius = int(sketches.differ(leader, np.array(members)).max())
                        narrowest = int(sketches.width[members].min())  # at this width the radius holds for every member
                        for c, v in zip(columns, (1, int(ids[own[leader]]), None, int(rows["token"][a].view(np.int64)), int(n[members].min()), int(n[members].max()), radius, sketches.folded(leader, narrowest).tobytes()), strict=True):
                            c.append(v)
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "src", "dst", "token", "lo", "hi", "radius", "parity"])

    return run


def _leaders(percent: int):
    """Edges between the leaders of a split shingle's parts whose sets may link."""

    def run(table: pa.Table) -> pa.Table:
        ids, lo, hi, radius = (table.column(c).to_numpy().astype(np.int64) for c in ("src", "lo", "hi", "radius"))
        sketches = Sketches(table.column("parity").to_pylist())
        pairs = [(int(ids[m[0]]), int(ids[j])) for m in _grow(lo, hi, radius, sketches, percent) for j in m[1:]]
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], names=["src", "dst"])

    return run


class PrefixTree:
    """Increasing whole-number sequences in a compressed prefix tree; ``probe`` finds those that overlap enough."""

    def __init__(self, percent: int):
        self.percent = percent
        self.root: list = [np.empty(0, np.int64), {}, None, 0, 1 << 60]  # label, children, ends (ids), largest and least set below

    def insert(self, x: np.ndarray, name: int) -> None:
        node, pos, n = self.root, 0, len(x)
        while True:
            node[3], node[4] = max(node[3], n), min(node[4], n)
            if pos == n:
                node[2] = [*(node[2] or []), name]
                return
            child = node[1].get(int(x[pos]))
            if child is None:
                node[1][int(x[pos])] = [x[pos:], {}, [name], n, n]
                return
            label = child[0]
            m = min(len(label), n - pos)
            differ = np.flatnonzero(label[:m] != x[pos : pos + m])
            m = int(differ[0]) if len(differ) else m
            if m < len(label):
                middle = [label[:m], {int(label[m]): child}, None, child[3], child[4]]
                child[0] = label[m:]
                node[1][int(x[pos])] = middle
                child = middle
            node, pos = child, pos + m

    def probe(self, x: np.ndarray, within: np.ndarray, skip=None) -> Iterator[tuple[int, int, int]]:
        """(name, its size, overlap) of the sets whose overlap with x reaches percent of the union. within: membership of x by number; skip: names not of interest."""
        n, p = len(x), self.percent
        held = [(c, 0, 0) for c in self.root[1].values()]
        while held:
            (label, children, ends, most, least), depth, overlap = held.pop()
            if 100 * min(n, most) < p * max(n, least):
                continue
            if skip is not None and not children and all(map(skip, ends)):
                continue
            overlap += int(np.count_nonzero(within[label]))
            depth += len(label)
            rest = min(most - depth, n - int(np.searchsorted(x, label[-1], side="right")))
            if (100 + p) * (overlap + rest) < p * (n + least):
                continue
            if ends and (100 + p) * overlap >= p * (n + depth):
                for name in ends:
                    yield name, depth, overlap
            held += [(c, depth, overlap) for c in children.values()]


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def ordered_sets(texts: pa.Array, k: int) -> tuple[list[np.ndarray], int]:
    """Each text's shingles as increasing numbers of the shared order within these texts, and how many numbers there are."""
    hashed, sizes = [], []
    for _, h, at in shingle_sets(texts, k):
        hashed.append(h)
        sizes.append(np.diff(at))
    if not hashed:
        return [], 0
    flat = np.concatenate(hashed)
    values, numbers = np.unique(flat, return_inverse=True)
    at = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).tolist()
    return [numbers[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], len(values)


def link_block(sets: list[np.ndarray], universe: int, percent: int, pivot: int = -1) -> tuple[list[tuple[int, int]], list[int]]:
    """(links that join up every component among the sets, the leader of each set: itself, or a set it links to). The pivot leads before all others."""
    union, links, leader = Union(len(sets)), [], list(range(len(sets)))
    leaders, others = PrefixTree(percent), PrefixTree(percent)
    roots_of_others: set[int] = set()
    within = np.zeros(universe, bool)
    for i in sorted(range(len(sets)), key=lambda j: (j != pivot, len(sets[j]), j)):
        x = sets[i]
        if not len(x):
            continue
        within[x] = True
        for j, _, _ in leaders.probe(x, within):
            if leader[i] == i:
                leader[i] = j
            if union.find(i) != union.find(j):
                union.join(i, j)
                links.append((j, i))
        if {union.find(r) for r in roots_of_others} - {union.find(i)}:
            for j, _, _ in others.probe(x, within, skip=lambda j: union.find(j) == union.find(i)):
                if union.find(i) != union.find(j):
                    union.join(i, j)
                    links.append((j, i))
        within[x] = False
        if leader[i] == i:
            leaders.insert(x, i)
        else:
            others.insert(x, i)
            roots_of_others = {union.find(r) for r in roots_of_others} | {union.find(i)}
    return links, leader


def join_sets(left: list[np.ndarray], right: list[np.ndarray], universe: int, percent: int) -> Iterator[tuple[int, int, int, int]]:
    """(place in left, place in right, overlap, union) of the pairs that reach percent."""
    tree = PrefixTree(percent)
    for j, y in enumerate(right):
        if len(y):
            tree.insert(y, j)
    within = np.zeros(universe, bool)
    for i, x in enumerate(left):
        if len(x):
            within[x] = True
            for j, m, overlap in tree.probe(x, within):
                yield i, j, overlap, len(x) + m - overlap
            within[x] = False


def _links(members: DataFrame, k: int, percent: int, sets: int | None = None) -> DataFrame:
    """src, dst: links that join up the components of members (id, text, comp), whose comp bounds the links; sets: how many they are, where known."""
    at_once = 2 * slots(members.sparkSession)
    sizes = stage(members.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.max(F.struct("degree", "id"))["id"].alias("pivot")), "sizes", sets)
    held = stage(members.drop("degree").join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))), "members")
    # the set that most candidates were reached from joins every block of its component
    guests = held.where("id = pivot and blocks > 1").withColumn("own", F.col("block")).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).where("block <> own").drop("own")
    dealt = held.unionByName(guests).repartition(at_once, "comp", "block")
    keep = schema_of("id long, leader long, root long, comp long, blocks long, text string, more boolean")

    def local(table: pa.Table) -> pa.Table:
        ids, texts = table.column("id").to_pylist(), table.column("text").combine_chunks()
        sets, universe = ordered_sets(texts, k)
        pivot = table.column("pivot")[0].as_py()
        links, leader = link_block(sets, universe, percent, ids.index(pivot) if pivot in ids else -1)
        union = Union(len(ids))
        for a, b in links:
            union.join(a, b)
        many = table.column("blocks")[0].as_py() > 1
        led = {j for i, j in enumerate(leader) if i != j}  # leaders of others than themselves
        names = texts.to_pylist() if many else [None] * len(ids)
        return pa.table([pa.array(ids, pa.int64()), pa.array([ids[j] for j in leader], pa.int64()), pa.array([ids[union.find(i)] for i in range(len(ids))], pa.int64()), table.column("comp").cast(pa.int64()), table.column("blocks").cast(pa.int64()), pa.array([t if leader[i] == i else None for i, t in enumerate(names)], pa.string()), pa.array([i in led for i in range(len(ids))])], names=keep.fieldNames())

    done = stage(dealt.groupBy("comp", "block").applyInArrow(local, keep), "blocks")
    links = done.where("id <> root").select(F.col("root").alias("src"), F.col("id").alias("dst"))
    far = 100 - 3 * (100 - percent)
    leaders = done.where("id = leader and blocks > 1").drop("more").dropDuplicates(["comp", "id"])
    leading = done.where("more and blocks > 1").select("id", F.lit(1).alias("more")).distinct()
    leaders = leaders.join(leading, "id", "left").withColumn("more", F.coalesce("more", F.lit(0)))
    if not leaders.limit(1).count():
        return links

    # leaders of different blocks of one component, block by block
    fewer = leaders.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    parted = leaders.select("comp", "id", "more", "text").join(fewer, "comp").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    paired = parted.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).select("comp", "id", "more", "text", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")).repartition(at_once, "comp", "a", "b")
    near = "src long, dst long, linked boolean"

    def between(table: pa.Table) -> pa.Table:
        ids, part, more = (table.column(c).to_pylist() for c in ("id", "part", "more"))
        sets, universe = ordered_sets(table.column("text").combine_chunks(), k)
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        left, right = [i for i, p in enumerate(part) if p == a], [i for i, p in enumerate(part) if p == b]
        bound = lambda i, j: 100 - (100 - percent) * (1 + more[i] + more[j])
        found = []
        for i, j, o, u in join_sets([sets[i] for i in left], [sets[j] for j in right], universe, max(far, 1)):
            i, j = left[i], right[j]
            # a leader of none but itself reaches no further than itself
            if (a != b or ids[i] < ids[j]) and 100 * o >= bound(i, j) * u:
                found.append((ids[i], ids[j], 100 * o >= percent * u))
        if far < 1:  # leaders that share nothing may still lead sets that are linked
            held = {(i, j) for i, j, _ in found}
            found += [(ids[i], ids[j], False) for i in left for j in right if (a != b or ids[i] < ids[j]) and bound(i, j) <= 0 and (ids[i], ids[j]) not in held]
        return pa.table([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], names=["src", "dst", "linked"])

    pairs = stage(paired.groupBy("comp", "a", "b").applyInArrow(between, near), "leaders")
    links = links.unionByName(pairs.where("linked").select("src", "dst"))
    label = stage(connected_components(links), "labels", sets)
    open_pairs = pairs.where("not linked")
    for side in ("src", "dst"):
        named = label.select(F.col("node").alias(side), F.col("component").alias(f"{side}_c"))
        open_pairs = open_pairs.join(named, side, "left").withColumn(f"{side}_c", F.coalesce(f"{side}_c", side))
    open_pairs = stage(open_pairs.where("src_c <> dst_c").select("src", "dst"), "open")
    if not open_pairs.limit(1).count():
        return links
    # a leader's sets meet another's in blocks, so neither is ever whole in one task
    led = done.select("id", "leader").distinct()
    room = led.groupBy("leader").agg(F.ceil(F.count("*") / (4 * BLOCK)).alias("runs"))
    led = stage(led.join(room, "leader").withColumn("run", F.pmod(F.xxhash64("id"), F.col("runs"))), "led", done.count())
    room = led.select("leader", "runs").distinct()
    sided = open_pairs.join(room.select(F.col("leader").alias("src"), F.col("runs").alias("a_runs")), "src").join(room.select(F.col("leader").alias("dst"), F.col("runs").alias("b_runs")), "dst")
    sided = sided.withColumn("a", F.explode(F.expr("sequence(0L, a_runs - 1)"))).withColumn("b", F.explode(F.expr("sequence(0L, b_runs - 1)")))
    sided = sided.select("src", "dst", "a", "b", F.explode(F.array(F.struct(F.col("src").alias("leader"), F.col("a").alias("run"), F.lit(0).alias("side")), F.struct(F.col("dst").alias("leader"), F.col("b").alias("run"), F.lit(1).alias("side")))).alias("x")).select("src", "dst", "a", "b", "x.leader", "x.run", "x.side")
    texts = held.select("id", "text").dropDuplicates(["id"]).join(led.select("id", "leader", "run"), "id")
    met = sided.join(texts, ["leader", "run"]).repartition(at_once, "src", "dst", "a", "b")

    def across(table: pa.Table) -> pa.Table:
        ids, side = table.column("id").to_pylist(), table.column("side").to_pylist()
        sets, universe = ordered_sets(table.column("text").combine_chunks(), k)
        left, right = [i for i, s in enumerate(side) if s == 0], [i for i, s in enumerate(side) if s == 1]
        found = [(ids[left[i]], ids[right[j]]) for i, j, _, _ in join_sets([sets[i] for i in left], [sets[j] for j in right], universe, percent)]
        return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["src", "dst"])

    return links.unionByName(stage(met.groupBy("src", "dst", "a", "b").applyInArrow(across, "src long, dst long"), "across"))


def components_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id of every row; component_id is the least id reachable by links. ids are whole numbers; a null id has a null component."""
    spark = docs.sparkSession
    narrow = docs.select(whole_ids(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stage(_signed(narrow, k, percent), "sets")
    size = rows.agg(F.max("n"), F.sum(F.col("n").cast("long")), F.count("*")).first()
    largest, shingles, texts = int(size[0] or 0), int(size[1] or 0), int(size[2])
    parts = max(LEAST_PARTS, shingles * (100 - percent) // (25 * PART_POSTINGS))
    classes = stage(rows.where("n > 0 and id is not null").groupBy("n", "h1", "h2").agg(F.min("id").alias("rep")), "classes", texts)
    shared = stage(_postings(narrow.where("id is not null"), k, percent, largest, parts).groupBy("part").applyInArrow(_shared_only(parts), schema_of("part int, rows binary")), "shared")
    sketches = rows.where("parity is not null").select("h1", "n", "parity").dropDuplicates(["h1"])
    asked = shared.mapInArrow(_sets_of, schema_of("part int, id long"))
    told = asked.join(sketches, asked["id"] == sketches["h1"]).select("part", "id", "n", "parity")
    forest = stage(shared.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_forest(percent), schema_of(_FOREST)), "forest")
    between = forest.where("kind = 1").groupBy("token").applyInArrow(_leaders(percent), schema_of("src long, dst long"))
    # of a split signature's leaders, each hangs under one other at most
    edges = stage(forest.where("kind = 0").select("src", "dst").unionByName(between).distinct(), "edges", forest.count())
    candidates = stage(connected_components(edges), "candidates", classes.count())
    degrees = edges.groupBy(F.col("src").alias("h1")).agg(F.count("*").alias("degree"))
    found = classes.join(candidates, classes["h1"] == candidates["node"]).join(degrees, "h1", "left")
    chosen = stage(found.select("rep", F.col("component").alias("comp"), F.coalesce("degree", F.lit(0)).alias("degree")), "chosen")
    sets = chosen.count()
    wanted = F.broadcast(chosen) if sets <= BROADCAST_ROWS else chosen
    members = narrow.join(wanted, narrow["id"] == wanted["rep"]).select("id", "text", "comp", "degree")
    labels = connected_components(_links(members, k, percent, sets))
    named = stage(classes.join(labels, classes["rep"] == labels["node"], "left").select("n", "h1", "h2", F.coalesce("component", "rep").alias("component_id")), "named", classes.count())
    return rows.select("id", "n", "h1", "h2").join(named, ["n", "h1", "h2"], "left").select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component, with all their columns; rows without an id stay."""
    found = components_of(docs, id_col=id_col, text_col=text_col, k=k, percent=percent)
    dropped = found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("__dropped")).distinct()
    return docs.join(dropped, docs[f"`{id_col}`"] == dropped["__dropped"], "left_anti")
