"""Quality rules whose thresholds adapt to each language and source.

Base figures of every whole text (``text_figures``) are counted by vectorised
kernels. Three of them become ratios in whole numbers (``RULES``). A quantile
sketch by language and source holds how many texts fall in each bucket of a ratio;
buckets are exact below 64 and a thirty-second of their value wide above, so a
quantile is off by 3 % at most. Sketches merge by adding counts, which is what the
aggregation does, so a hot source is summed before it is shuffled, and a sketch
never has more than about a thousand buckets however many texts it covers.

A threshold is ``q75 + spread * (q75 - q25)`` of the group's own distribution: there
are no fixed limits, floors or ceilings. Some rules look at the texts that have any
(``among``), since most texts repeat no line at all. So that few texts do not make a
wild limit, a group's sketch is pooled with its language's, which is pooled with that
of everything: ``prior`` texts' worth of the wider distribution are added to the
narrower counts, at every size alike; a group of many texts is ruled by its own. A text
is kept if it passes the base rules and every threshold of its own group.

The thresholds are joined to the texts by (language, source). The table has one row
per group; its rows are counted and it is broadcast only up to ``broadcast_groups``
rows, beyond which it is joined by shuffle, where Spark splits a hot group.

Null text has no words and fails the base rules. Null language or source is a group
of its own. Repeated rows are judged (and counted) like any rows. Very long texts are
taken whole, one at a time. An empty table gives no rows and no thresholds. ``judge``
reads four columns and ignores others; ``keep_good`` keeps all, and its own step aside
from clashing names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import _ragged as R
from gridloom.llm._spark import append_columns, fresh, map_texts, stage

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LEADS = (np.arange(256) & 0xC0) != 0x80

FIGURES = [(n, "long") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("n_lines", "long")]
#: name: (numerator, denominator, factor, among, spread); a ratio is numerator * factor div denominator; its quartiles are those of all texts, or of those with some.
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000, "all", 3),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, "some", 1),
    "long_words": ("word_chars", "n_words", 10, "all", 3),
}
QUARTERS = (25, 75)
#: A text counts as so many in whole-number sketches, so that shares of the wider distribution can be added.
UNIT = 1_000_000


def _runs(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text's items."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[at[1:]] - total[at[:-1]]


def repeated_window_words(words: np.ndarray, at: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of k words found twice or more in that text."""
    windows, out = R.shingle_hashes(words, at, k)
    if not len(windows):
        return np.zeros(len(at) - 1, np.int64)
    text = R.owners(out)
    key = windows ^ R.mix(text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    held = key[order]
    same = held[1:] == held[:-1]
    if not same.any():
        return np.zeros(len(at) - 1, np.int64)
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first = np.flatnonzero(twice)
    first = first - out[text[first]] + at[text[first]]  # windows to words
    change = np.bincount(first, minlength=len(words) + 1) - np.bincount(first + k, minlength=len(words) + 1)
    return _runs(np.cumsum(change[: len(words)]) > 0, at)


def text_figures(column: pa.Array) -> list[pa.Array]:
    """The FIGURES of each text."""
    data, offsets = R.text_bytes(column)
    made: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in FIGURES]
    for _, _, d, at in R.slabs(data, offsets):
        words, by = R.word_hashes(d, at, lower=False)
        if len(d) == 0:
            figures = [np.zeros(len(at) - 1, np.int64)] * len(FIGURES)
        else:
            white = R._IS_WHITE[d]
            edge = d == 10
            cut = np.unique(np.concatenate((at[:-1], np.flatnonzero(edge) + 1, at[1:])))
            starts, ends = cut[:-1], cut[1:].copy()
            ends[edge[ends - 1]] -= 1
            full = np.concatenate(([0], np.cumsum(~white)))
            some = full[ends] > full[starts]  # lines with a word
            starts, ends = starts[some], ends[some]
            text = np.searchsorted(at, starts, side="right") - 1
            lines = R.span_hashes(d, starts, ends) ^ R.mix(text.astype(np.uint64) + np.uint64(1))
            _, first = np.unique(lines, return_index=True)
            n_lines = np.bincount(text, minlength=len(at) - 1)
            figures = [np.diff(by), _runs(_LEADS[d] & ~white, at), _runs(_IS_SYMBOL[d], at), n_lines - np.bincount(text[first], minlength=len(at) - 1), repeated_window_words(words, by), n_lines]
        for out, f in zip(made, figures, strict=True):
            out.append(f)
    return [pa.array(np.concatenate(x).astype(np.int64)) for x in made]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def bucket(v: Column) -> Column:
    """Sketch bucket of a whole number from 0: itself below 64, else 32 buckets to each power of two."""
    power = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return (power * 32 + F.floor(v / F.pow(F.lit(2), power))).cast("long")


def bucket_top(b: Column) -> Column:
    """The largest value of a bucket."""
    power = F.greatest(F.floor(b / 32) - 1, F.lit(0))
    return ((b - power * 32 + 1) * F.pow(F.lit(2), power) - 1).cast("long")


def ratio(rule: str, of) -> Column:
    top, bottom, factor, _, _ = RULES[rule]
    return F.floor(of(top) * factor / F.greatest(of(bottom), F.lit(1))).cast("long")


def group_thresholds(figures: DataFrame, groups: list[str], *, prior: int = 200) -> DataFrame:
    """A row for each group: the groups, then a threshold by rule (column ``max_<rule>``, null where no text sets one).

    figures: the group columns, from wide to narrow, and the FIGURES. Sketches cover every row.
    """
    measured = [F.struct(F.lit(r).alias("rule"), F.when((F.lit(among == "all")) | (F.col(top) > 0), bucket(ratio(r, F.col))).alias("bucket")) for r, (top, _, _, among, _) in RULES.items()]
    rows = figures.select(*groups, F.explode(F.array(*measured)).alias("x")).where("x.bucket is not null")
    own = rows.groupBy(*groups, "x.rule", "x.bucket").agg((F.count("*") * UNIT).alias("n")).select(*groups, "rule", "bucket", "n")
    own = stage(own, "sketch")  # a thousand buckets or so for each group and rule at most
    pooled = None
    for depth in range(len(groups) + 1):
        by = groups[:depth]
        level = own.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))
        if pooled is not None:
            wider = groups[: depth - 1]
            whole = pooled.groupBy(*wider, "rule").agg(F.sum("n").alias("whole")) if wider else pooled.groupBy("rule").agg(F.sum("n").alias("whole"))
            share = _join_safe(pooled, whole, [*wider, "rule"]).select(*wider, "rule", "bucket", F.floor(F.col("n") / F.col("whole") * (prior * UNIT)).cast("long").alias("n"))
            held = own.select(*by).distinct()
            more = _join_safe(held, share, wider).select(*by, "rule", "bucket", "n")
            level = level.unionByName(more).groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))
        pooled = level

    held = pooled.groupBy(*groups, "rule").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("held"))
    summed = F.aggregate(
        "held",
        F.struct(F.lit(0).cast("long").alias("sum"), *[F.lit(None).cast("long").alias(f"q{q}") for q in QUARTERS]),
        lambda a, x: F.struct((a["sum"] + x["n"]).alias("sum"), *[F.coalesce(a[f"q{q}"], F.when((a["sum"] + x["n"]).cast("decimal(38,0)") * 100 >= F.col("total").cast("decimal(38,0)") * q, x["bucket"])).alias(f"q{q}") for q in QUARTERS]),
    )
    least, most = (bucket_top(F.col(f"s.q{q}")) for q in QUARTERS)
    spread = F.create_map(*[x for r, rule in RULES.items() for x in (F.lit(r), F.lit(rule[4]))])[F.col("rule")]
    limits = held.select(*groups, "rule", summed.alias("s")).select(*groups, "rule", (most + spread * (most - least)).cast("long").alias("limit"))
    return limits.groupBy(*groups).agg(*[F.max(F.when(F.col("rule") == r, F.col("limit"))).alias(f"max_{r}") for r in RULES])


def _join_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """left with right's other columns, where ``on`` is equal or null on both sides; every row meets every row where ``on`` is empty and right is a sketch of everything."""
    names = {c: f"__{c}" for c in on}
    other = right.select(*[F.col(c).alias(names[c]) for c in on], *[c for c in right.columns if c not in on])
    if not on:
        return left.join(F.broadcast(other))  # the sketch of everything: some thousand rows
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(names[c]))
    return left.join(other, match).drop(*names.values())


def _judged(df: DataFrame, thresholds: DataFrame, groups: dict[str, str], figure, broadcast_groups: int) -> tuple[DataFrame, Column, Column, list[str]]:
    """df with its group's thresholds; (joined, whether the base rules fail, whether a text is kept, the thresholds' names)."""
    names = {}
    shadow = df
    for c in [*groups, *[f"max_{r}" for r in RULES]]:
        names[c] = fresh(shadow, f"t_{c}")
        shadow = shadow.withColumn(names[c], F.lit(None))
    limits = thresholds.select(*[F.col(c).alias(n) for c, n in names.items()])
    if limits.count() <= broadcast_groups:
        limits = F.broadcast(limits)
    on = [F.col(f"`{own}`").eqNullSafe(F.col(names[g])) for g, own in groups.items()]
    joined = df.join(limits, on, "left")
    failed = base_failed(F.col(figure("n_words")), F.col(figure("n_repeat_words")))
    passes = F.lit(True)
    for r in RULES:
        passes = passes & F.coalesce(ratio(r, lambda c: F.col(figure(c))) <= F.col(names[f"max_{r}"]), F.lit(True))
    return joined, failed, ~failed & passes, [names[f"max_{r}"] for r in RULES]


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", broadcast_groups: int = 50_000) -> DataFrame:
    """id, the FIGURES, base_failed, kept and the group's thresholds, of every row of ``docs``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    figures = stage(map_texts(narrow, ["id", "lang", "source", "text"], ", ".join(f"{n} {t}" for n, t in FIGURES), lambda batch: text_figures(batch.column(3))), "figures")
    limits = stage(group_thresholds(figures, ["lang", "source"]), "thresholds")
    joined, failed, kept, names = _judged(figures, limits, {"lang": "lang", "source": "source"}, lambda c: c, broadcast_groups)
    return joined.select(F.col("id").alias(id_col), *[n for n, _ in FIGURES], failed.alias("base_failed"), kept.alias("kept"), *[F.col(n).alias(n.lstrip("_").removeprefix("t_")) for n in names])


def keep_good(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", broadcast_groups: int = 50_000) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    marked, names = append_columns(docs, text_col, FIGURES, text_figures)
    marked = stage(marked, "figures")  # read once, judged from here
    of = dict(zip([n for n, _ in FIGURES], names, strict=True))
    figures = marked.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), *[F.col(of[n]).alias(n) for n, _ in FIGURES])
    limits = stage(group_thresholds(figures, ["lang", "source"]), "thresholds")
    joined, _, kept, _ = _judged(marked, limits, {"lang": lang_col, "source": source_col}, of.__getitem__, broadcast_groups)
    return joined.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
