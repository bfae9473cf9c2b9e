"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over hashed
byte trigrams tells the languages with a one from those with a zero: its weights are
log ratios of smoothed trigram shares, from counts over every training text. A
text's margin for a bit is the mean weight of its trigrams. Decoding adds, for each
language, the logistic loss of every bit against its codeword, weighted by how well
that bit did on the training counts, and takes the least; two languages nearly as
near make the text ambiguous.

Up to seven languages the code is exhaustive (every split once); beyond that it is
a fixed pseudo-random code of 12 bits per doubling of the languages.

Counts are added up by language: each task sends one array of BUCKETS numbers for a
language; FAN of them are summed at a time, in as many steps as the number of tasks
asks for, so the driver gets one array per language.

A text that is null or has no letter is `und` with score 0. Without any training
language every text is `und`; with one, that one. Null languages are not learned. Of
languages that are equally near the first by name is taken, and the text is ambiguous.
Repeated rows count and are told like any rows. Very long texts are taken whole, one at
a time. Columns besides those named are ignored by ``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import _ragged as R
from gridloom.llm._spark import append_columns, map_texts

BUCKETS = 1 << 15
NEAR = 20.0
FAN = 64
UNKNOWN = "und"


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each byte trigram within a text, offsets by text); A-Z as a-z, white space and digits as one space."""
    plain = _PLAIN[data].astype(np.uint32)
    count = np.maximum(np.diff(at) - 2, 0)
    out = np.concatenate(([0], np.cumsum(count)))
    if len(plain) < 3:
        return np.empty(0, np.uint32), np.zeros(len(at), np.int64)
    code = (plain[:-2] << 16) | (plain[1:-1] << 8) | plain[2:]
    whole = np.ones(len(code), bool)
    for back in (1, 2):  # trigrams that reach into the next text
        over = at[1:-1] - back
        whole[over[(over >= 0) & (over < len(code))]] = False
    return ((code[whole] * np.uint32(2654435761)) >> np.uint32(17)), out


_PLAIN = R._LOWER.copy()
_PLAIN[R._IS_WHITE] = 32
_PLAIN[48:58] = 32


def codebook(n: int) -> np.ndarray:
    """n codewords of +1 and -1, one row each; every column has both signs."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        rows = np.arange(1, 1 << (n - 1))
        return np.where((rows[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).astype(np.int8)
    bits = 12 * int(np.ceil(np.log2(n)))
    code = np.random.default_rng(97).choice(np.array([-1, 1], np.int8), (n, bits))
    code[0, (code == code[0]).all(axis=0)] *= -1
    return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        """Mean weight of a text's trigrams, by bit."""
        data, offsets = R.text_bytes(column)
        out = np.zeros((len(offsets) - 1, self.code.shape[1]))
        for lo, hi, d, at in R.slabs(data, offsets, 512 << 10):
            bucket, by = trigrams(d, at)
            size = np.diff(by)
            full = np.flatnonzero(size)
            if len(full):
                for b in range(out.shape[1]):
                    out[lo + full, b] = np.add.reduceat(self.weights[b][bucket], by[:-1][full]) / size[full]
        return out

    def decode(self, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        n = len(column)
        written = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), written
        z = self.margins(column)[:, None, :] * self.code[None, :, :] * NEAR
        loss = (np.logaddexp(0, -z) * self.trust).sum(axis=2)
        least = loss.min(axis=1, keepdims=True)
        share = np.exp(least - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        score = np.where(written, share[np.arange(n), best], 0.0)
        return [self.languages[b] if w else UNKNOWN for b, w in zip(best.tolist(), written.tolist(), strict=True)], score, written & (score < 0.6)


def fit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", learn: Column | None = None) -> Model:
    """A model from every row with a language (and ``learn`` true). Languages are few; one count array each comes to the driver."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = (rows.where(learn) if learn is not None else rows).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            data, offsets = R.text_bytes(batch.column(1))
            for lo, hi, d, at in R.slabs(data, offsets, 512 << 10):
                bucket, by = trigrams(d, at)
                lang = np.repeat(codes[lo:hi], np.diff(by)).astype(np.int64)
                counts = np.bincount(lang * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for k in np.unique(codes[lo:hi]).tolist():
                    held[names[k]] = held.get(names[k], 0) + counts[k]
        group = TaskContext.get().partitionId() if TaskContext.get() else 0
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([group] * len(held), pa.int64()), pa.array([c.astype("<i8").tobytes() for c in held.values()], pa.binary())], ["lang", "part", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS, np.int64)
        for c in table.column("counts").to_pylist():
            total += np.frombuffer(c, "<i8")
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    tasks = max(rows.rdd.getNumPartitions(), 1)
    counted = rows.mapInArrow(run, "lang string, part long, counts binary")
    while True:
        counted = counted.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("lang", "part").applyInArrow(add, "lang string, part long, counts binary")
        tasks = -(-tasks // FAN)
        if tasks == 1:
            break
    found = sorted((r["lang"], np.frombuffer(bytes(r["counts"]), "<i8").astype(float)) for r in counted.collect())
    return model([x for x, _ in found], [c for _, c in found])


def model(languages: list[str], counts: list[np.ndarray]) -> Model:
    code = codebook(len(languages))
    weights = np.zeros((code.shape[1], BUCKETS), np.float32)
    trust = np.ones(code.shape[1])
    if code.shape[1]:
        share = np.array([(c + 0.5) / (c.sum() + 0.5 * BUCKETS) for c in counts])  # every language weighs the same
        for b in range(code.shape[1]):
            one, zero = share[code[:, b] > 0].mean(axis=0), share[code[:, b] < 0].mean(axis=0)
            weights[b] = np.log(one / zero)
            means = (share * weights[b]).sum(axis=1) * code[:, b]
            trust[b] = 1 / (1 + np.exp(-NEAR * means.min()))
        trust /= trust.sum() / len(trust)
    return Model(languages, code, weights, trust)


def _columns(held: Model, column: pa.Array) -> list[pa.Array]:
    lang, score, ambiguous = held.decode(column)
    return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())]


def predict(docs: DataFrame, held: Model, columns: list, *, text_col: str = "text") -> DataFrame:
    """The columns, then lang_pred, score, ambiguous of every row."""
    return map_texts(docs, [*columns, F.col(text_col)], "lang_pred string, score double, ambiguous boolean", lambda batch: _columns(held, batch.column(batch.num_columns - 1)))


def keep_known(docs: DataFrame, held: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known and not ambiguous, with all their columns."""
    marked, (lang, _, ambiguous) = append_columns(docs, text_col, [("lang_pred", "string"), ("lang_score", "double"), ("ambiguous", "boolean")], lambda column: _columns(held, column))
    return marked.where((F.col(lang) != UNKNOWN) & ~F.col(ambiguous)).select(*[F.col(f"`{c}`") for c in docs.columns])
