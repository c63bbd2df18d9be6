from __future__ import annotations

import zlib

import numpy as np
import pytest
from data import frame, odd_rows, prose
from tokenizers import Tokenizer

from propensa.llm import token_files
from propensa.llm.catalog import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    return plain


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


ODD = ["", " ", "\n", "a  b", "a\tb c\n\nd", " lead", "trail ", "x\r\ny z", "don't, we'll 's", "Ünïcode ß, ﬁ … 漢字. 12,3 4.",
       "<|endoftext|> a <|endoftext|>", "a b c", "\x1c a", "a .\n, b!? c:", "ªº² µm,", "é́ x", "ǅ, ŉ.", "a\0b c\0", "😀 😀, .", ". , ;"]


@pytest.mark.parametrize("text", ODD)
def test_encoder_equals_the_library(tokenizer, text):
    known = token_files.encoder(TOKENIZER)
    assert np.frombuffer(known.encode(text), known.type).tolist() == ids_of(tokenizer, text)[:-1]


def test_encoder_with_a_small_memory(tokenizer):
    known = token_files.Encoder(TOKENIZER, words=8)
    for seed in range(5):
        text = prose(seed, 200)
        assert np.frombuffer(known.encode(text), known.type).tolist() == ids_of(tokenizer, text)[:-1]
        assert len(known.later) <= 8


def test_files_hold_every_row_in_order(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 2_000)  # many segments
    rows = odd_rows()
    files = token_files.write(frame(spark, rows, clashes=True), TOKENIZER)
    got = token_files.read_back(spark, files).collect()
    want = sorted((r[0] is not None, r[0] or 0, ids_of(tokenizer, r[1])) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got) == [(a, b, len(c)) for a, b, c in want]
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(np.array(c, "<u4").tobytes()) for _, _, c in want)
    start = 0
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert len({(r.shard, r.segment) for r in got}) > 1


def test_short_documents_are_read_alone(spark, tokenizer):
    files = token_files.write(frame(spark, odd_rows()), TOKENIZER)
    assert token_files.document(spark, files, 11) == [ids_of(tokenizer, "a b c d e")]
    assert len(token_files.document(spark, files, 5)) == 2
    assert token_files.document(spark, files, 99_999) == []


def test_another_dictionary_is_refused(spark):
    rows = [(i, prose(i, 400), "en", "a", 1) for i in range(60)]
    files = token_files.write(frame(spark, rows), TOKENIZER)
    row = spark.read.parquet(files.segments).first()
    held = spark.read.parquet(files.dictionary).first()
    assert len(held.dictionary) > 1000 and held.sha256 == row.dictionary
    with pytest.raises(ValueError, match="another dictionary"):
        list(token_files.unpack(bytes(row["index"]), bytes(row.frames), b"other", row.dictionary, np.dtype("<u2")))


def test_empty_table(spark):
    files = token_files.write(frame(spark, odd_rows()).limit(0), TOKENIZER)
    assert token_files.read_back(spark, files).count() == 0
