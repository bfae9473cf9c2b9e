import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, bank):
    return " ".join(rng.choice(bank) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties, copies, near copies, repeated rows."""
    rng = random.Random(7)
    bank = ["".join(rng.choice("abcdeéouß") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = [words(rng, rng.randint(25, 90), bank) for _ in range(30)]
    rows = [(i, t, ["en", "de", "fr"][i % 3], f"s{i % 4}", len(t)) for i, t in enumerate(prose)]
    rows += [
        (100, None, "en", "s0", None),
        (101, "", None, "s0", 0),
        (102, " \n\t ", "de", None, 4),
        (103, "One", "en", "s1", 3),
        (104, "one", "en", "s1", 3),
        (105, "two words", None, None, 9),
        (106, words(rng, 30_000, bank), "fr", "s2", 0),
        (107, "x" * 50_000, "fr", "s2", 50_000),
        (108, "<|endoftext|> <|im_end|> <s>", "en", "s2", 0),
        (109, "日本語 テスト 😀 é́", "ja", "s3", 0),
        (110, "same line here\nsame line here\nother\n\nsame line here", "en", "s3", 0),
        (111, "$$$ ### ***", "en", "s3", 0),
        (112, words(rng, 20, ["go"]), "en", "s3", 0),
    ]
    rows += [(200 + i, rows[3][1], "en", "s0", 1) for i in range(5)]  # exact copies
    rows += [(210, rows[3][1].replace(" ", "  \n"), "en", "s0", 1)]  # equal but for white space, longer
    long = words(rng, 400, bank).split()
    for i in range(6):  # near copies
        other = list(long)
        other[i * 7] = "changed"
        rows.append((220 + i, " ".join(other).upper() if i == 2 else " ".join(other), "en", "s0", 1))
    rows += [rows[5], rows[5], (None, "no id at all here", "en", "s0", 1)]  # repeated rows, no id
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns with the names that operators make."""
    from pyspark.sql import functions as F

    names = "n_tokens score kept keep_id group_size text_sha256 rep idx slot size first sha lang_pred n_words t_lang bucket rule total held ambiguous component_id".split()
    return odd.withColumns({n: F.lit("mine") for n in names})
