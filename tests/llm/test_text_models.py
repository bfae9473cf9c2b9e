import contextlib
import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import language_id, lm_score, quality_classifier, quality_rules
from gridloom.llm._ragged import word_hashes, text_bytes
from gridloom.llm._spark import holdout
from gridloom.plans.shared import SHUFFLES_GO

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_have_equal_hashes_exactly_when_equal():
    texts = ["The the\tTHE x", None, "", " \n", "é É", "a" * 5000, "end", "\x1c \x85 a"]
    data, at = text_bytes(pa.array(texts))
    hashed, by = word_hashes(data, at)
    words = [w for t in texts for w in WORD.findall(lower(t))]
    assert np.diff(by).tolist() == [len(WORD.findall(t or "")) for t in texts]
    assert len(set(zip(words, hashed.tolist(), strict=True))) == len(set(words)) == len(set(hashed.tolist()))


# quality rules


def brute_figures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines))


def brute_bucket(v):
    power = max(v.bit_length() - 6, 0)
    return power * 32 + (v >> power)


def brute_top(b):
    power = max(b // 32 - 1, 0)
    return ((b - power * 32 + 1) << power) - 1


def brute_limits(figures, prior=200, unit=1_000_000):
    """limit by (lang, source, rule)"""
    limits = {}
    for rule, (top, bottom, factor, among, spread) in quality_rules.RULES.items():
        values = [(lang, source, brute_bucket(f[top] * factor // max(f[bottom], 1))) for lang, source, f in figures if among == "all" or f[top] > 0]

        def pooled(wider, of, narrow, values=values):
            counts = Counter()
            for *group, b in values:
                if tuple(group[: len(narrow)]) == narrow:
                    counts[b] += unit
            if wider is not None:
                for b, n in wider.items():
                    counts[b] += math.floor(n / sum(wider.values()) * (prior * unit))
            return counts

        everything = pooled(None, values, ())
        for lang, source in {(lang, source) for lang, source, _ in figures}:
            counts = everything
            for narrow in ((lang,), (lang, source)):
                counts = pooled(counts, values, narrow)
            if counts:
                q, total = [], sum(counts.values())
                for p in (25, 75):
                    at = 0
                    for b in sorted(counts):
                        at += counts[b]
                        if 100 * at >= p * total:
                            q.append(brute_top(b))
                            break
                limits[lang, source, rule] = q[1] + spread * (q[1] - q[0])
    return limits


def brute_verdicts(rows):
    figures = [(lang, source, dict(zip([n for n, _ in quality_rules.FIGURES], brute_figures(text), strict=True))) for _, text, lang, source, _ in rows]
    limits = brute_limits(figures)
    out = []
    for lang, source, f in figures:
        failed = f["n_words"] < 20 or 100 * f["n_repeat_words"] > 30 * f["n_words"]
        kept = not failed
        for rule, (top, bottom, factor, _, _) in quality_rules.RULES.items():
            if (lang, source, rule) in limits:
                kept &= f[top] * factor // max(f[bottom], 1) <= limits[lang, source, rule]
        out.append((*f.values(), failed, kept))
    return out


def test_rules_equal_brute_force(odd, odd_rows):
    found = quality_rules.judge(odd).select("doc_id", *[n for n, _ in quality_rules.FIGURES], "base_failed", "kept")
    assert Counter(map(tuple, found.collect())) == Counter((r[0], *v) for r, v in zip(odd_rows, brute_verdicts(odd_rows), strict=True))


def test_thresholds_follow_their_groups(spark):
    rng = random.Random(4)
    rows = []
    for source, share in (("clean", 0.0), ("noisy", 0.3)):
        for i in range(260):
            words = [rng.choice(["alpha", "beta", "gamma"]) + str(rng.randint(0, 999)) + ("#" if rng.random() < share else "") for _ in range(60)]
            rows.append((len(rows), " ".join(words), "en", source, 0))
    rows.append((9000, " ".join("word%d$$$" % i for i in range(60)), "en", "clean", 0))
    rows.append((9001, " ".join("word%d#" % i for i in range(60)), "en", "clean", 0))
    rows.append((9002, " ".join("word%d#" % i for i in range(60)), "en", "few", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = quality_rules.judge(docs)
    names = [n for n, _ in quality_rules.FIGURES]
    assert Counter(map(tuple, found.select("doc_id", *names, "base_failed", "kept").collect())) == Counter((r[0], *v) for r, v in zip(rows, brute_verdicts(rows), strict=True))
    limits = {r["source"]: r["max_symbols"] for r in found.join(docs.select("doc_id", "source"), "doc_id").select("source", "max_symbols").distinct().collect()}
    assert 0 < limits["noisy"] and len(set(limits.values())) == 3
    kept = {r["doc_id"] for r in found.where("kept").collect()}
    assert 9000 not in kept and len(kept) > 500


def test_thresholds_differ_between_groups_of_documents(spark):
    import os

    if not os.path.exists("/root/testdata/sf0.01/documents.parquet"):
        pytest.skip("no tables")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality_rules.judge(docs).select("max_symbols", "max_dup_lines", "max_long_words").distinct()
    assert found.count() > 3


def test_rules_keep_columns_and_take_nothing(clashing, none, odd, odd_rows):
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(v[-1] for v in brute_verdicts(odd_rows))
    assert quality_rules.keep_good(none).count() == quality_rules.judge(none).count() == 0
    by_shuffle = quality_rules.judge(odd, broadcast_groups=0)
    assert Counter(map(tuple, by_shuffle.collect())) == Counter(map(tuple, quality_rules.judge(odd).collect()))


# language


def test_languages_are_told_apart_when_held_out(spark):
    rng = random.Random(5)
    banks = {lang: ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(300)] for lang, parts in {"aa": ["ba", "no", "ri"], "bb": ["sch", "un", "ge"], "cc": ["eau", "le", "oi"]}.items()}
    rows = [(i, " ".join(rng.choice(banks[lang]) for _ in range(rng.randint(4, 60))), lang) for i in range(600) for lang in [rng.choice(list(banks))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, learn=~holdout("doc_id", 4, 2))
    found = language_id.predict(docs, model, ["doc_id", "lang", holdout("doc_id", 4, 2).alias("held_out")]).where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count() > 0
    assert found.where("score < 0 or score > 1").count() == 0


def brute_languages(rows, learn, texts):
    """(language, score) of each text, by dictionaries of byte trigrams."""
    size, near = language_id.BUCKETS, language_id.NEAR

    def grams(text):
        data = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b" \t\n\x0b\x0c\r0123456789" else b for b in (text or "").encode())
        return [((a << 16 | b << 8 | c) * 2654435761 % (1 << 32)) >> 17 for a, b, c in zip(data, data[1:], data[2:], strict=False)]

    counts = {}
    for (_, text, lang), own in zip(rows, learn, strict=True):
        if own and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    names = sorted(counts)
    code = [[1 if (row >> i) & 1 else -1 for row in range(1, 1 << (len(names) - 1))] for i in range(len(names))]
    share = [{g: (c[g] + 0.5) / (sum(c.values()) + 0.5 * size) for g in range(size)} for c in (counts[n] for n in names)]
    weights, trust = [], []
    for b in range(len(code[0])):
        one, zero = ([s for s, w in zip(share, code, strict=True) if w[b] == sign] for sign in (1, -1))
        weights.append([math.log((sum(s[g] for s in one) / len(one)) / (sum(s[g] for s in zero) / len(zero))) for g in range(size)])
        trust.append(1 / (1 + math.exp(-near * min(w[b] * sum(s[g] * weights[b][g] for g in range(size)) for s, w in zip(share, code, strict=True)))))
    trust = [t * len(trust) / sum(trust) for t in trust]
    out = []
    for text in texts:
        own = grams(text)
        margin = [sum(w[g] for g in own) / len(own) if own else 0.0 for w in weights]
        loss = [sum(t * math.log1p(math.exp(-near * m * w)) for t, m, w in zip(trust, margin, word, strict=True)) for word in code]
        best = min(range(len(names)), key=loss.__getitem__)
        out.append((names[best], 1 / sum(math.exp(loss[best] - x) for x in loss)))
    return out


def test_languages_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    banks = {"aa": ["ba", "No", "ri"], "bb": ["sch", "un", "ge"], "cc": ["eau", "lé", "oi"]}
    rows = [(i, " ".join("".join(rng.choice(banks[lang]) for _ in range(rng.randint(1, 3))) + rng.choice(["", " 12", "."]) for _ in range(rng.randint(1, 12))), lang) for i in range(60) for lang in [rng.choice(list(banks))]]
    rows += [(90, None, "aa"), (91, "scheau", None), (92, "x", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(language_id, "FAN", 2)
    held = language_id.fit(docs, learn=F.col("doc_id") % 3 != 0)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, held, ["doc_id"]).collect()}
    expected = brute_languages(rows, [doc % 3 != 0 for doc, *_ in rows], [t for _, t, _ in rows])
    for (doc, text, _), (lang, score) in zip(rows, expected, strict=True):
        if text is None:
            assert found[doc] == ("und", 0.0)
        else:
            assert found[doc][1] == pytest.approx(score, rel=1e-4)
            assert found[doc][0] == lang or score < 0.51


def test_languages_of_odd_rows(odd, odd_rows, none, clashing):
    model = language_id.fit(odd)
    found = {r["doc_id"]: r for r in language_id.predict(odd, model, ["doc_id"]).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (100, 101, 102, 111))
    assert language_id.predict(odd, model, ["doc_id"]).count() == len(odd_rows)
    nothing = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing, ["doc_id"]).collect()} == {"und"}
    one = language_id.fit(odd.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language_id.predict(odd, one, ["doc_id"]).collect()} == {"und", "en"}
    kept = language_id.keep_known(clashing, model)
    assert kept.columns == clashing.columns and kept.where("doc_id = 100").count() == 0


@pytest.mark.parametrize("n", [2, 3, 7, 8, 40])
def test_codewords_differ(n):
    code = language_id.codebook(n)
    assert len({tuple(r) for r in code.tolist()}) == n
    assert all(len(set(c.tolist())) == 2 for c in code.T)


def test_counts_do_not_reach_across_texts():
    whole, at = language_id.trigrams(*text_bytes(pa.array(["abcd", "", "xy", "efg"])))
    parts = [language_id.trigrams(*text_bytes(pa.array([t])))[0] for t in ["abcd", "", "xy", "efg"]]
    assert np.diff(at).tolist() == [2, 0, 0, 1]
    assert whole.tolist() == np.concatenate(parts).tolist()


# quality classifier


def labelled(spark, n=600):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(15, 40))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" if rng.random() < 0.8 else w for w in words)))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_is_told_when_held_out(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.fit(docs, labels, learn=~holdout("id", 5, 0))
    found = quality_classifier.score(docs, model, ["doc_id", holdout("doc_id", 5, 0).alias("held_out")]).join(labels, "doc_id").where("held_out")
    assert found.where("predicted = quality").count() >= 0.95 * found.count() > 0
    assert found.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0


def test_quality_of_odd_rows(spark, odd, odd_rows, none, clashing):
    docs, labels = labelled(spark, 200)
    model = quality_classifier.fit(docs, labels.union(spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 0), (999, 1)], labels.schema)))
    assert quality_classifier.score(odd, model, ["doc_id"]).where("score between 0 and 1").count() == len(odd_rows)
    assert quality_classifier.score(none, model, ["doc_id"]).count() == 0
    assert quality_classifier.score(clashing, model, ["doc_id"]).columns == ["doc_id", "score", "predicted"]
    unlearned = quality_classifier.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(odd, unlearned, ["doc_id"]).collect()} == {0.5}


def test_descent_reaches_the_least_loss_of_a_small_problem():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(60)]
    y = np.where([(r < 12).mean() > 0.4 for r in rows], 1, -1)
    ratio = rng.normal(size=30)
    w = quality_classifier.descend(rows, y, ratio, rounds=400)

    def loss(w):
        total = 0.5 * (w**2).sum()
        for c in (1, -1):
            weight = len(y) / (2 * (y == c).sum())
            for f in (r for r, s in zip(rows, y, strict=True) if s == c):
                v = ratio[f] / np.sqrt((ratio[f] ** 2).sum())
                total += weight * max(0, 1 - c * (w[f] @ v + 0.5 * w[-1]))
        return total

    assert all(loss(w) <= loss(w + rng.normal(size=31) * s) + 1e-3 for s in (0.3, 0.05, 0.01) for _ in range(50))


# language model


def brute_lm(rows, learn):
    def tokens(text):
        return ["<start>", *WORD.findall(lower(text)), "</end>"]

    words, seen = Counter(), {1: Counter(), 2: Counter()}  # continuations by history of one and of two
    for (_, text, *_), own in zip(rows, learn, strict=True):
        if own:
            seq = tokens(text)
            words.update(seq[1:])
            for size in (1, 2):
                seen[size].update(tuple(seq[i - size : i + 1]) for i in range(size, len(seq)))
    after = {}
    for size in (1, 2):
        after[size] = Counter()
        for gram, n in seen[size].items():
            after[size][gram[:-1]] += n
    factor = {}
    for size in (1, 2):
        once, lo, hi = sum(n == 1 for n in seen[size].values()), 1e-3, 1e6
        for _ in range(100):
            a = (lo * hi) ** 0.5
            expected = sum(c * a * c**0.75 / (c - 1 + a * c**0.75) for c in after[size].values())
            lo, hi = (a, hi) if expected < once else (lo, a)
        factor[size] = a
    n, v = sum(words.values()), len(words)

    def p(history, w):
        if not history:
            return (words[w] + 1) / (n + v + 1)
        c = after[len(history)][history]
        if not c:
            return p(history[1:], w)
        m = factor[len(history)] * c**0.75
        return (seen[len(history)][(*history, w)] + m * p(history[1:], w)) / (c + m)

    out = []
    for (doc, text, *_), own in zip(rows, learn, strict=True):
        seq = tokens(text)
        scored = [p(tuple(seq[max(0, i - 2) : i]), seq[i]) for i in range(1, len(seq))]
        base = [p((), w) for w in seq[1:]]
        out.append((doc, not own, len(seq) - 1, sum(words[w] > 0 for w in seq[1:]), n, sum(map(math.log10, base)), sum(map(math.log10, scored))))
    return out


@pytest.mark.parametrize("chunk", [50, 1_000_000])
def test_scores_equal_brute_force(odd, odd_rows, chunk):
    import zlib

    learn = [doc is None or zlib.crc32(str(doc).encode()) % 7 != 2 for doc, *_ in odd_rows]
    found = lm_score.score_texts(odd, learn=~holdout("doc_id", 7, 2), chunk_tokens=chunk).collect()
    expected = brute_lm(odd_rows, learn)
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_scores_without_training_and_without_rows(odd, odd_rows, none, clashing):
    found = lm_score.score_texts(odd, learn=F.lit(False)).collect()
    assert len(found) == len(odd_rows) and all(r["base_score"] == r["score"] == 0 and r["train_tokens"] == 0 for r in found)
    assert lm_score.score_texts(none, learn=F.lit(True)).count() == 0
    assert lm_score.score_texts(clashing, learn=F.lit(True)).count() == len(odd_rows)


def shuffle_bytes(spark):
    """Bytes of shuffle files on disk, by shuffle."""
    out = Counter()
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for path in Path(top.getPath()).glob("*/shuffle_*.data"):
            with contextlib.suppress(FileNotFoundError):  # files may go meanwhile
                out[int(path.name.split("_")[1])] += path.stat().st_size
    return out


def test_exchanges_of_totals_are_freed(spark, odd):
    """Of the blocks that chunks deal out (over 100 000 bytes here) nothing stays on disk beside the totals."""
    before = set(shuffle_bytes(spark))
    found = lm_score.score_texts(odd, learn=F.lit(True))  # all but the last exchange is run here
    until = time.time() + 20
    while (left := sum(n for k, n in shuffle_bytes(spark).items() if k not in before)) > 20_000 and time.time() < until:
        time.sleep(0.2)
    assert left <= 20_000  # histograms
    assert spark.conf.get(SHUFFLES_GO, None) is None
    assert found.count() == odd.count()


def test_rounds_share_the_blocks(odd):
    """Words and pairs, then triples: neither round deals out much more than half."""
    chunks = lm_score._chunks(odd.select("doc_id", F.lit(True), "text").toDF("id", "learn", "text"), 1_000_000)
    sent = [lm_score._requests(chunks, 4, kinds).collect() for kinds in lm_score.ROUNDS]
    assert [{r["kind"] for r in rows} for rows in sent] == [{lm_score.WORD, lm_score.PAIR}, {lm_score.TRIPLE}]
    sizes = [sum(len(r["hashes"]) + len(r["counts"]) for r in rows) for rows in sent]
    assert max(sizes) < 0.6 * sum(sizes) and sum(sizes) > 100_000


def automaton(texts, factors=(2.5, 0.7)):
    texts = [np.array(t) for t in texts]
    size = np.array([len(t) for t in texts], "<u4")
    hashes = np.arange(1, 1 + max((int(t.max()) for t in texts if len(t)), default=-1) + 1, dtype="<u8") * np.uint64(7919)
    chunk = lm_score.Chunk(lm_score.to_planes(size), lm_score.to_planes(hashes), lm_score.to_planes(np.concatenate(texts).astype("<u4")), [True] * len(texts))
    counts = chunk.counts()
    return chunk, lm_score.Automaton(chunk, counts, int(counts[0][:-1].sum()), int((counts[0][:-1] > 0).sum()), factors)


def test_probabilities_after_any_history_sum_to_one():
    chunk, held = automaton([[0, 1, 2, 0, 1, 0], [0, 1, 1], [2, 2, 2, 0, 1], []])
    words = np.array([w for w in range(len(chunk.hashes)) if w != chunk.start])
    ending = set((len(chunk.hashes) + np.flatnonzero(chunk.pairs % len(chunk.hashes) == chunk.end)).tolist())
    for state in range(held.base + 1):
        if state != chunk.end and state not in ending:
            _, weight = held.step(np.full(len(words), state), words)
            unknown = 10.0 ** path_to_root(held, state) / (chunk.counts()[0][:-1].sum() + len(words) + 1)
            assert (10.0**weight).sum() + unknown == pytest.approx(1)


def path_to_root(held, state):
    total = 0.0
    while state != held.base:
        total += held.failure[state]
        state = held.fallback[state]
    return total


def test_lanes_change_nothing():
    rng = np.random.default_rng(3)
    chunk, held = automaton([rng.integers(0, 9, n).tolist() for n in (0, 1, 2, 3, 50, 51, 400)])
    whole = held.walk(chunk.word, chunk.at, 1000)
    for lane in (2, 3, 7, 50):
        assert held.walk(chunk.word, chunk.at, lane) == pytest.approx(whole, rel=1e-12)
