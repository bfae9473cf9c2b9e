import hashlib
import itertools
import random

import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import _wordbpe, piece_codec
from gridloom.llm.token_counts import count_tokens, default_vocabulary


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_vocabulary())


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


def ids_of(texts):
    merger = _wordbpe.load(default_vocabulary())
    return [ids[a:b].tolist() for _, _, ids, at in merger.encode(pa.array(texts, pa.string())) for a, b in itertools.pairwise(at.tolist())]


def ids(text):
    return ids_of([text])[0]


ODD = ["", " ", "aaa aaaa aaaaaaa", "İstanbul ΑΣΣ ΑΣ", "<|endoftext|>hi<|startoftext|> x<|endoftext", "a\x1cb\x85c d e", "don't we'LL 'S x's''s", "①²½ Ⅻ ٣٤ 12", "é ﬁ 😀👨‍👩", "ſ K Å", "\x00 \x7f a_b __", "́x"]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_librarys(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_is_cut_and_lowered_as_the_library_does(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x40000 or 0xE0000 <= c < 0xE0200 or c % 997 == 0)]
    for lo in range(0, len(points), 20_000):
        texts = [f"a{chr(c)} 1{chr(c)} :{chr(c)} {chr(c)}b {chr(c)}\u0301" for c in points[lo : lo + 20_000]]
        held = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [hex(c) for c, a, b in zip(points[lo:], ids_of(texts), held, strict=False) if a != b] == []


def test_words_are_forgotten_and_learned_anew(library, monkeypatch):
    monkeypatch.setattr(_wordbpe, "KEPT_WORDS", 5)
    for text in ("one two three four five six", "seven one <|endoftext|> né", "six 7 naïve"):
        assert ids(text) == library.encode(text, add_special_tokens=False).ids


def test_counts(odd, odd_rows, library):
    found = sorted(map(tuple, count_tokens(odd).collect()), key=str)
    expected = []
    for doc, text, *_ in odd_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 2048))
    assert found == sorted(expected, key=str)


def test_counts_of_nothing_and_beside_other_columns(none, clashing, odd_rows):
    assert count_tokens(none).count() == 0
    assert count_tokens(clashing).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(clashing).count() == len(odd_rows)


ODD_PIECES = ["", " ", "   ", "a  b", "  hi", "a\nb", "▁a", "hello ", "<s>a<0x0A>", "\x00a", "a\tb\n\n c", "\n", " " * 100, "a" * 500, "aaaab" * 50, "日本語 テスト", "😀😀é", "ﷺ▁▁ z", "ａ①ﬁ"]


@pytest.mark.parametrize("text", ODD_PIECES)
def test_pieces_equal_the_librarys(pieces, text):
    codec = piece_codec.load(piece_codec.default_model())
    assert codec.encode(text) == pieces.encode(text)
    assert codec.decode(codec.encode(text)) == pieces.decode(pieces.encode(text))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_in_pieces(pieces, text):
    codec = piece_codec.load(piece_codec.default_model())
    assert codec.encode(text) == pieces.encode(text)
    assert codec.decode(codec.encode(text)) == pieces.decode(pieces.encode(text))


def test_backtracking_equals_merging():
    codec = piece_codec.load(piece_codec.default_model())
    rng = random.Random(3)
    for _ in range(400):
        s = "".join(rng.choice("theinonrsa▁") for _ in range(rng.randint(1, 40)))
        if "▁▁" not in s:
            assert codec.backtrack(s) == codec.merge(s) == codec.merge_short(list(s))


def test_codec_on_rows(odd, odd_rows, none, clashing, pieces):
    def digests(text):
        numbers = pieces.encode(text or "")
        return len(numbers), hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest(), hashlib.sha256(pieces.decode(numbers).encode()).hexdigest()

    found = sorted(map(tuple, piece_codec.encode_decode(odd).collect()), key=str)
    assert found == sorted(((doc, *digests(text)) for doc, text, *_ in odd_rows), key=str)
    assert piece_codec.encode_decode(none).count() == 0
    assert piece_codec.encode_decode(clashing).count() == len(odd_rows)
    row = piece_codec.encode_decode(odd.where("doc_id = 105"), keep_ids=True).collect()[0]
    assert (row["ids"], row["decoded"]) == (pieces.encode("two words"), "two words")
