import random
from collections import Counter

import corpus_pipeline
from test_dedup import brute_components, brute_copies
from test_packing_chat import check_pieces
from test_text_models import brute_verdicts

from gridloom.llm import language_id, packing
from gridloom.llm._spark import holdout

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_pipeline(spark, rows):
    """The documents that reach packing; the language model, tested by itself, is the one that the stage fits."""
    rows = [r for r, v in zip(rows, brute_verdicts(rows), strict=True) if v[-1]]
    docs = spark.createDataFrame(rows, SCHEMA)
    held = language_id.fit(docs, learn=~holdout("doc_id", 4, 2))
    told = {r["text"]: r for r in language_id.predict(docs, held, ["text"]).collect()}
    rows = [r for r in rows if told[r[1]]["lang_pred"] != "und" and not told[r[1]]["ambiguous"]]
    marks = brute_copies(rows)
    stay = Counter({m[0]: n for m, n in marks.items() if m[3]})
    kept = []
    for r in rows:
        if stay[r[0]]:
            stay[r[0]] -= 1
            kept.append(r)
    least = {doc: c for doc, _, c in brute_components([r for r in kept if r[0] is not None], 5, 80)}
    return [r for r in kept if r[0] is None or least[r[0]] == r[0]]


def test_pipeline_equals_brute_force(spark, odd_rows, tmp_path):
    rng = random.Random(3)
    bank = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    rows = list(odd_rows)
    for i in range(60):
        text = [rng.choice(bank) for _ in range(rng.randint(30, 150))]
        for j in range(rng.randint(1, 4)):
            rows.append((1000 + len(rows), " ".join(text), rng.choice(["en", "de"]), f"s{i % 3}", 0))
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(bank)
    rng.shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    expected = brute_pipeline(spark, rows)
    assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter((r[0], r[1]) for r in expected)
    assert len(expected) < len(rows) - 20
    check_pieces(expected, packing.pack(docs, keep_ids=True).collect(), 4096)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r["doc_id"] for r in whole.where("start = 0").collect()) == Counter(r[0] for r in expected)


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_further_columns_with_clashing_names(spark, clashing, tmp_path):
    clashing.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == clashing.columns
    assert packing.pack(docs).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
