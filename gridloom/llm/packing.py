"""Packing along a space-filling curve.

A document's token ids index rows of a fixed pseudo-random table, whose mean is the
document's place in a few dimensions; documents with like words lie near one
another. Places are centred on the corpus mean and scaled by the corpus spread (both
weighted by tokens, over all documents), so that they fill the curve's cells whatever
the language; cut to whole numbers they become a Hilbert key. Documents are
range-sorted by (key, row) and laid end to end; every ``length`` tokens of that line
are a sequence, so only the line's end falls short. The end is cut into sequences
whose lengths are powers of two, which need no padding.

1. One pass makes (row, sums over the table, number of ids, ids); written once to the
   shared folder. The corpus mean and spread come from these sums.
2. Only (row, key, number) is range-sorted; running sums within a partition, and one
   sum for each partition on the driver (as many numbers as partitions), place every
   document on the line. Equal keys are parted by row, so a hot key is no hot task.
3. Ids are joined to places by row and cut into pieces.

Null text is empty: one token, the end id. Repeated rows and ids are packed like any
rows. An empty table gives no pieces. Each id lies in exactly one piece. A very long
text is one row of ids, cut over as many sequences as it fills. Only the id and the
text column are read; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm._spark import schema_of, slots, stage
from gridloom.llm.token_counts import default_vocabulary

DIMENSIONS, BITS = 4, 15
#: A spread takes a document from the middle to 1/(1 + exp(-1.7 / REACH)) of the cube; the mean lies beside its first cut.
REACH, ASIDE = 1.5, 0.35
_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def projection(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A fixed table of standard normal numbers, a column for each token id."""
    return np.random.default_rng(20240229).standard_normal((dimensions, size))


def hilbert(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of rows of whole numbers below 2**bits (J. Skilling's transposition, 2004)."""
    x = places.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


SUMS = [f"s{i}" for i in range(DIMENSIONS)]


def _coded(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), narrow.schema["doc_id"], *schema_of(", ".join(f"{c} double" for c in SUMS) + ", n long, ids binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        from gridloom.llm import _wordbpe

        merger = _wordbpe.load(path)
        table = projection(max(merger.size, end_id + 1, *(i + 1 for i in merger.special.values())))
        kind = np.dtype("<u2") if table.shape[1] <= 1 << 16 else np.dtype("<u4")
        arrow = to_arrow_schema(schema)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi, words, by in merger.encode(batch.column(1)):
                n = hi - lo
                at = by + np.arange(n + 1)  # an end id more for each text
                ids = np.insert(words, by[1:], end_id)
                sums = [np.add.reduceat(column[ids], at[:-1]) for column in table]
                body, size = ids.astype(kind).tobytes(), kind.itemsize
                made = [body[size * a : size * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), batch.column(0).slice(lo, n), *map(pa.array, sums), pa.array(np.diff(at).astype(np.int64)), pa.array(made, pa.binary())], schema=arrow)
                row += n

    return narrow.mapInArrow(run, schema)


def _places(coded: DataFrame) -> DataFrame:
    """row, part, before: the ids of its partition that come before it on the curve; n."""
    total = coded.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS], *[F.sum(F.col(c) * F.col(c) / F.col("n")).alias(f"{c}_2") for c in SUMS]).first()
    tokens = total["n"] or 1
    mean = [(total[c] or 0.0) / tokens for c in SUMS]
    spread = [max((total[f"{c}_2"] or 0.0) / tokens - m * m, 1e-12) ** 0.5 for c, m in zip(SUMS, mean, strict=True)]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            places = [((batch.column(2 + i).to_numpy() / n - mean[i]) / spread[i] / REACH + ASIDE) * 1.7 for i in range(DIMENSIONS)]
            cells = np.clip(np.stack([(1 << BITS) / (1 + np.exp(-p)) for p in places], axis=1), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert(cells))], ["row", "n", "key"])

    keys = coded.select("row", "n", *SUMS).mapInArrow(keyed, "row long, n long, key long")
    dealt = keys.repartitionByRange(slots(coded.sparkSession), "key", "row").sortWithinPartitions("key", "row").select("row", "n")
    schema = "row long, n long, part long, before long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            total = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(n), part, np.int64)), pa.array(before + total - n)], ["row", "n", "part", "before"])
            before += int(total[-1]) if len(n) else 0

    return dealt.mapInArrow(run, schema)


def tail_bounds(total: int, length: int) -> list[int]:
    """Ends of the sequences after the last full one: the rest in falling powers of two."""
    at = total - total % length
    ends = []
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return ends


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = 2, length: int = 4096, keep_ids: bool = False) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with keep_ids also ids (array)."""
    from zlib import crc32

    spark = docs.sparkSession
    coded = stage(_coded(docs, id_col, text_col, vocabulary or default_vocabulary(), end_id), "coded")
    places = stage(_places(coded), "places")
    totals = sorted(places.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a number for each partition
    bases, total = [], 0
    for part, n in totals:
        bases.append((part, total))
        total += n
    first_tail, ends = total // length, tail_bounds(total, length)
    base = F.broadcast(spark.createDataFrame(bases, "part long, base long"))  # as many rows as partitions
    starts = places.join(base, "part").select("row", (F.col("base") + F.col("before")).alias("at"))
    rows = coded.select("row", "doc_id", "n", "ids").join(starts, "row").select("doc_id", "n", "ids", "at")
    schema = T.StructType([coded.schema["doc_id"], *schema_of(_PIECES + (", ids array<int>" if keep_ids else "")).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            out: list[list] = [[] for _ in range(7 + keep_ids)]
            for doc, n, body, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(body, f"<u{len(body) // n}").astype("<u4")
                done = 0
                while done < n:
                    here = at + done
                    sequence = here // length
                    begin, end = sequence * length, (sequence + 1) * length
                    if sequence == first_tail:
                        for i, stop in enumerate(ends):
                            if here < stop:
                                sequence, end = first_tail + i, stop
                                break
                            begin = stop
                    size = min(n - done, end - here)
                    piece = ids[done : done + size]
                    for c, v in zip(out, (doc, done, size, crc32(piece.tobytes()), n, sequence, here - begin, piece.tolist() if keep_ids else None), strict=False):
                        c.append(v)
                    done += size
            arrow = to_arrow_schema(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
