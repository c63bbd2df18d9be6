from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest
import sentencepiece
from data import frame, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propensa.llm import pieces
from propensa.llm.catalog import PIECES


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PIECES)


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids_of(library, text):
    return library.encode(text or "", add_bos=True, add_eos=True)


def same(model, library, texts):
    for text, ids in zip(texts, model.encode(texts), strict=True):
        want = ids_of(library, text)
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert model.decode(ids) == library.decode(want), text[:80]


ODD = ["", " ", "  ", "   a", "a    b     c      d", "▁▁ ▁", "\n\n a\tb", "a" * 23, "ab" * 17, "漢字かな 😀😀", "\0 x", "<s> </s> <0x41>",
       " " * 37 + "x" + " " * 64, "� é é́", "x" * 5000, " " * 5000, "=" * 333 + "-" * 77]


def test_odd_texts(model, library):
    same(model, library, ODD)


@pytest.mark.parametrize("letters", ["ab ", "the in er on t h e", "=- *#", "0123456789 .,", "abcdefghijklmnopqrstuvwxyzABC ", "\t\n  ▁", "дикарова ", "漢字😀é "])
def test_random_texts(model, library, letters):
    rng = random.Random(7)
    same(model, library, ["".join(rng.choices(letters, k=rng.randint(1, 150))) for _ in range(300)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_any_text(texts):
    known = pieces.model(PIECES)
    same(known, LIBRARY, texts)


def test_every_document(model, library):
    rows = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    same(model, library, [r[0] or "" for r in rows])


def test_a_long_word(model, library):
    rng = random.Random(3)
    same(model, library, ["".join(rng.choices("abcdefghij", k=100_000)), "ab" * 50_000])


def test_decoding_of_any_ids(model, library):
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000), 1, 2, 259, 260]) for _ in range(rng.randint(0, 12))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_waiting_merges(model):
    """A merge whose new pair ranks as high goes on before the next occurrence; both words are merged in one call."""
    a, b = model._char[ord("▁")], model._char[ord("t")]
    sym, place = model.merge(np.array([a] * 8 + [a, b]), np.array([True] + [False] * 7 + [True, False]))
    assert [model.pieces[i] for i in sym] == ["▁" * 8, "▁t"] and place.tolist() == [0, 8]


def test_small_memory(library):
    small = pieces.PieceModel(PIECES, words=5)
    for _ in range(3):
        same(small, library, ["one two three four five six seven", "one two", "eight nine"])
        assert len(small.known) <= 9


def test_rows_keep_their_columns(spark, library, monkeypatch):
    rows = odd_rows()
    coded = pieces.encode(frame(spark, rows, clashes=True), PIECES).withColumn("digest", F.sha2("ids", 256))
    got = pieces.decode(coded, PIECES).collect()
    want = [ids_of(library, r[1]) for r in rows]
    assert [r.doc_id for r in got] == [r[0] for r in rows] and {r.target for r in got} == {"odd"}
    assert [r.n_tokens for r in got] == [len(w) for w in want]
    assert [r.digest for r in got] == [hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest() for w in want]
    assert [r.decoded for r in got] == [library.decode(w) for w in want]


def test_clashing_columns_raise(spark):
    with pytest.raises(ValueError, match="already there"):
        pieces.encode(frame(spark, odd_rows()).withColumn("ids", F.lit(1)), PIECES)


def test_empty_table(spark):
    assert pieces.decode(pieces.encode(frame(spark, odd_rows()).where(F.lit(False)), PIECES), PIECES).count() == 0


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(bytes([0x12, 2, 0x18, 1]))  # a trainer's record of another kind of model
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.PieceModel(str(path))
