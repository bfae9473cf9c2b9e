"""Exact duplicates by Patricia tries over whole normalised texts.

Texts are equal when their UTF-8 bytes without ``[\\x20\\x09-\\x0D]`` are. Of equal
texts the one with most code points before that stays, then the smallest id.

1. Each task goes over its rows in chunks of bounded size and groups equal texts of
   a chunk, so a group of copies, however hot, leaves at most one text a chunk. Rows
   get (rep, idx): the chunk's group and their place in it. Written once to the
   shared folder.
   A dictionary does this first summing up; whether texts of different chunks are
   equal is decided by the tries.
2. The chunk texts are dealt by length and content hash. A task inserts their full
   bytes into a compressed radix trie; a terminal node holds the best owner, the
   number of rows and the chunk groups (16 bytes each, counted). Beyond a memory budget the trie writes its
   largest subtree to a temporary file and takes up that subtree after the others.
3. Owners go back to rows by (rep, idx div SLOT): a key that covers SLOT rows at
   most, so a hot group is dealt evenly.

Null text is the empty text (all empty texts are equal). Null ids come after all
others. Of rows that are equal in id and text, one stays. A very long text is a chunk of
its own and one trie key. An empty table gives no rows. Columns of ``docs`` keep
their names; the new ones step aside (see ``mark_copies``).
"""

from __future__ import annotations

import pickle
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import _ragged as R
from gridloom.llm._spark import fresh, schema_of, slots, stage

SLOT = 128
CHUNK_BYTES = 24 << 20
TRIE_BYTES = 96 << 20
NODE_BYTES = 400
VALUE_BYTES = 16


class Node:
    __slots__ = ("edges", "value")

    def __init__(self, value=None):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.value = value


def common(a: bytes, b: bytes) -> int:
    """Length of the common start of two byte strings."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class RadixTrie:
    """Byte strings with merged values; ``merge(old, new)`` gives the value of a string met again."""

    def __init__(self, merge, budget: int = TRIE_BYTES):
        self.merge, self.budget = merge, budget
        self.root, self.bytes = Node(), 0
        self.spilled: dict[bytes, object] = {}

    def insert(self, key: bytes, value) -> None:
        for prefix, file in self.spilled.items():
            if key.startswith(prefix):
                pickle.dump((key, value), file, pickle.HIGHEST_PROTOCOL)
                return
        node, pos = self.root, 0
        while pos < len(key):
            edge = node.edges.get(key[pos])
            if edge is None:
                node.edges[key[pos]] = (key[pos:], leaf := Node())
                self.bytes += len(key) - pos + NODE_BYTES
                node, pos = leaf, len(key)
                continue
            label, child = edge
            if key.startswith(label, pos):
                node, pos = child, pos + len(label)
                continue
            n = common(label, key[pos : pos + len(label)])
            middle = Node()
            middle.edges[label[n]] = (label[n:], child)
            node.edges[key[pos]] = (label[:n], middle)
            self.bytes += NODE_BYTES
            node, pos = middle, pos + n
        node.value = value if node.value is None else self.merge(node.value, value)
        self.bytes += VALUE_BYTES
        if self.bytes > self.budget:
            self.spill()

    def terminals(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        held = [(node, prefix)]
        while held:
            node, prefix = held.pop()
            if node.value is not None:
                yield prefix, node.value
            held += [(child, prefix + label) for label, child in node.edges.values()]

    def size(self, node: Node) -> int:
        total, held = 0, [node]
        while held:
            node = held.pop()
            total += NODE_BYTES + sum(len(label) for label, _ in node.edges.values())
            held += [child for _, child in node.edges.values()]
        return total

    def spill(self) -> None:
        """Write the largest subtree below the first fork to a file of its own."""
        node, prefix = self.root, b""
        while len(node.edges) == 1 and node.value is None:
            label, node = next(iter(node.edges.values()))
            prefix += label
        if len(node.edges) < 2:  # one text: nothing to part
            self.budget = 2 * self.bytes
            return
        sizes = {first: self.size(child) + len(label) for first, (label, child) in node.edges.items()}
        first = max(sizes, key=sizes.get)
        label, child = node.edges.pop(first)
        file = tempfile.TemporaryFile()
        for item in self.terminals(child, prefix + label):
            pickle.dump(item, file, pickle.HIGHEST_PROTOCOL)
        self.spilled[prefix + label[:1]] = file
        self.bytes = max(0, self.bytes - sizes[first])

    def values(self) -> Iterator[object]:
        """The value of each distinct string; empties the trie."""
        root, self.root = self.root, Node()
        yield from (value for _, value in self.terminals(root, b""))
        del root
        for file in self.spilled.values():
            below = RadixTrie(self.merge, self.budget)
            file.seek(0)
            while True:
                try:
                    below.insert(*pickle.load(file))
                except EOFError:
                    break
            file.close()
            yield from below.values()


def normalised(text: bytes) -> bytes:
    return text.translate(None, R.WHITE)


def _merge(old: list, new: list) -> list:
    """[best owner, rows, chunk groups]"""
    old[0] = min(old[0], new[0])
    old[1] += new[1]
    old[2].extend(new[2])
    return old


_MARKS = schema_of("sha string, rep long, idx long, first boolean, size long, best_chars long, best_id long, best_idx long, n_bytes long")


def _chunks(df: DataFrame, id_col: str, text_col: str, marks: list[str]) -> DataFrame:
    """df with its chunk groups; a group's first row also has its size and best owner."""
    schema = T.StructType(df.schema.fields + [T.StructField(n, f.dataType) for n, f in zip(marks, _MARKS.fields, strict=True)])
    id_at, text_at = df.columns.index(id_col), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        base, groups_made = TaskContext.get().partitionId() << 33, 0

        def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal groups_made
            groups: dict[bytes, list] = {}
            rows = []
            for batch in held:
                text = batch.column(text_at).fill_null("")
                for body, chars, doc in zip(text.cast(pa.binary()).to_pylist(), pc.utf8_length(text).to_pylist(), batch.column(id_at).to_pylist(), strict=True):
                    body = normalised(body)
                    group = groups.get(body)
                    if group is None:
                        group = groups[body] = [base + groups_made, sha256(body).hexdigest(), 0, None, len(body)]
                        groups_made += 1
                    owner = (-chars, doc is None, doc or 0, group[2])
                    group[3] = owner if group[3] is None else min(group[3], owner)
                    rows.append((group, group[2]))
                    group[2] += 1
            groups.clear()
            lo = 0
            for batch in held:
                some = rows[lo : lo + batch.num_rows]
                lo += batch.num_rows
                made = [
                    pa.array([g[1] for g, _ in some], pa.string()),
                    pa.array([g[0] for g, _ in some], pa.int64()),
                    pa.array([i for _, i in some], pa.int64()),
                    pa.array([i == 0 for _, i in some], pa.bool_()),
                    pa.array([None if i else g[2] for g, i in some], pa.int64()),
                    pa.array([None if i else -g[3][0] for g, i in some], pa.int64()),
                    pa.array([None if i or g[3][1] else g[3][2] for g, i in some], pa.int64()),
                    pa.array([None if i else g[3][3] for g, i in some], pa.int64()),
                    pa.array([None if i else g[4] for g, i in some], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip([*batch.columns, *made], arrow, strict=True)], schema=arrow)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                held.append(part := batch.slice(lo, 2000))
                size += part.nbytes
                if size >= CHUNK_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return df.mapInArrow(run, schema)


def mark_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """(docs with four columns more, their names: text_sha256, keep_id, group_size, kept, with underscores in front where docs has such a name)."""
    marks, shadow = [], docs
    for f in [*_MARKS.fieldNames(), "text_sha256", "keep_id", "group_size", "kept", "slot", "rep2", "keep_rep", "keep_idx"]:
        marks.append(fresh(shadow, f))
        shadow = shadow.withColumn(marks[-1], F.lit(None))
    sha, rep, idx, first, size, best_chars, best_id, best_idx, n_bytes, out_sha, keep_id, group_size, kept, slot, rep2, keep_rep, keep_idx = marks
    spark = docs.sparkSession
    rows = stage(_chunks(docs, id_col, text_col, marks[:9]), "chunks")
    texts = rows.where(F.col(first)).select(rep, size, best_chars, best_id, best_idx, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"), F.col(sha).alias("content"), F.col(n_bytes).alias("length"))
    dealt = texts.repartition(slots(spark), "length", F.xxhash64("content")).drop("length", "content")
    owned = schema_of(f"{rep2} long, n_slots long, {keep_id} long, {keep_rep} long, {keep_idx} long, {group_size} long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie(_merge)
        for batch in batches:
            for r, n, chars, doc, i, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                trie.insert(normalised(body), [(-chars, doc is None, doc or 0, r, i), n, array("q", (r, n))])
        columns: list[list] = [[] for _ in range(6)]

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], owned.fieldNames())

        for (_, missing, doc, r, i), n, groups in trie.values():
            for own, rows_of in zip(groups[::2], groups[1::2], strict=True):
                for c, v in zip(columns, (own, (rows_of + SLOT - 1) // SLOT, None if missing else doc, r, i, n), strict=True):
                    c.append(v)
            if len(columns[0]) >= 20_000:
                yield made()
                columns = [[] for _ in range(6)]
        yield made()

    owners = dealt.mapInArrow(run, owned).withColumn(slot, F.explode(F.expr("sequence(0L, n_slots - 1)"))).drop("n_slots")
    joined = rows.join(owners, (F.col(rep) == F.col(rep2)) & (F.floor(F.col(idx) / SLOT) == F.col(slot)))
    stays = (F.col(rep) == F.col(keep_rep)) & (F.col(idx) == F.col(keep_idx))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(sha).alias(out_sha), F.col(keep_id), F.col(group_size), stays.alias(kept)), [out_sha, keep_id, group_size, kept]


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marked, names = mark_copies(docs, id_col=id_col, text_col=text_col)
    return marked.where(F.col(names[3])).select(*[F.col(f"`{c}`") for c in docs.columns])
