"""Token ids as binary files with a shared dictionary and an index per document.

Every document is encoded whole, gets the end id, and is serialized as little
endian unsigned integers. A zstandard dictionary is trained once on serialized
arrays of a bounded sample; each document is then a zstandard frame of its own,
so a short document is read without its neighbours and still compresses well.

The files are Parquet, which any store that Spark writes to can hold:

* ``segments``: rows (shard, segment, first_doc, last_doc, token_start, n_docs, n_tokens,
  dictionary, index, frames). ``frames`` holds the frames one after another,
  ``index`` holds for each document id, offset, length and token count. Shards are
  ranges of ``doc_id``; ``token_start`` counts the tokens of the shard before the segment.
* ``dictionary``: one row with the dictionary, its SHA-256, the end id and the width of an id.

A reader takes the segment whose id range holds the document, looks the
document up in the index, checks the dictionary's hash, and decompresses one frame.

Defined results: a null text is an empty text and holds the end id only; rows
are ordered by id (null first, stored as ``NO_ID``), then by a hash of the text, so repeated rows keep
their place; an empty table gives files without segments; columns besides ``doc_id`` and
``text`` are not read. With too few samples to train on, frames use no
dictionary and the stored one is empty.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from propensa.llm.tables import ship
from propensa.session import scratch_path

END_ID = 2
SAMPLE_DOCS = 2_000  # bound of the rows that the dictionary is trained on
SAMPLE_CHARS = 4_000  # what a sampled row adds at most; samples only, never output
DICTIONARY_BYTES = 64 * 1024
SEGMENT_BYTES = 4 * 1024 * 1024  # frames of a segment, exceeded by one document at most
CACHED_WORDS = 500_000  # in each Python worker, some 100 MB
NO_ID = -(2**63)
LEVEL = 3
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")])
SEGMENTS = ("shard int, segment int, first_doc long, last_doc long, token_start long, n_docs long, n_tokens long, "
            "dictionary string, index binary, frames binary")
_BREAK = re.compile(r"(?<=\S) (?=\S)")


class _Odd(Exception):
    """A word with white space at an end, so that its neighbours cannot be encoded apart."""


class _Known(dict):
    """Ids of words, encoded when first asked for; starts anew when ``limit`` words are known."""

    def __init__(self, encode: Callable[[str], bytes], limit: int):
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Odd
        ids = self.encode(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids
        return ids


def _visible_bytes() -> dict[int, str]:
    """The characters that a byte-level vocabulary writes bytes as: printable ones as they are, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as bytes, by the tokenizers library.

    The byte-level rule never lets a token reach over a blank between two
    characters that are not white space, nor over a single line end between two
    such characters. So a text is encoded word by word, and words seen before
    come from a bounded memory. A text with other white space is cut at such
    blanks only. A run of Latin letters is one piece under that rule and goes to the
    library's model as it is, as does the mark that ends it; all else takes the library's whole way.
    """

    def __init__(self, path: str, words: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.visible = self.tokenizer.model, _visible_bytes()
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.type, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        self.newline = self._whole("\n")
        self.marks = {m: self._whole(m) for m in ".,;:!?"}
        self.first = _Known(lambda w: self._word("", w), words // 4)
        self.later = _Known(lambda w: self._word(" ", w), words)
        probe = "Nous étions là, word.\nOne_two (3)"
        self.by_word = True
        self.by_word = self.encode(probe) == self._whole(probe)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, blank: str, word: str) -> bytes:
        mark = self.marks.get(word[-1], b"")
        letters = word[:-1] if mark else word
        if not letters.isalpha() or max(letters) > "\u024f":
            return self._whole(blank + word)
        piece = (blank + letters).encode().decode("latin-1").translate(self.visible)
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes() + mark

    def encode(self, text: str) -> bytes:
        if not self.by_word or not text:
            return self._whole(text)
        first, later = self.first, self.later
        try:
            lines = []
            for line in text.split("\n"):
                head, *words = line.split(" ")
                lines.append(first[head] + b"".join([later[w] for w in words]))
            return self.newline.join(lines)
        except _Odd:
            head, *words = _BREAK.split(text)
            return self._whole(head) + b"".join([later.get(w) or self._whole(" " + w) for w in words])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, kept for later tasks of the same Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass(frozen=True)
class TokenFiles:
    """Places of a written set of files."""

    segments: str
    dictionary: str


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> tuple[bytes, str]:
    """Dictionary from about ``SAMPLE_DOCS`` rows at most, chosen by a hash of their id, and its SHA-256."""
    chosen = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 32)) <= (1 << 32) * SAMPLE_DOCS / (2 * max(1, docs.count()))
    sample = docs.where((F.length("text") > 0) & chosen).select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("t"))
    rows = [r.t for r in sample.orderBy("doc_id", "t").limit(SAMPLE_DOCS).collect()]
    known = Encoder(tokenizer_path)
    end = np.array([end_id], known.type).tobytes()
    samples = [known.encode(text) + end for text in rows]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    data = b""
    if len(samples) >= 16 and size >= 1024:
        try:
            data = zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
        except zstandard.ZstdError:  # samples too alike to learn from
            data = b""
    return data, hashlib.sha256(data).hexdigest()


def _segments(tokenizer_path: str, dictionary: bytes, name: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer_path)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False)
        end = np.array([end_id], known.type).tobytes()
        shard, segment, start = TaskContext.get().partitionId(), 0, 0
        index: list[tuple[int, int, int, int]] = []
        frames: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            nonlocal segment, start, index, frames, held
            table = np.array(index, INDEX)
            tokens = int(table["n_tokens"].sum())
            row = (shard, segment, index[0][0], index[-1][0], start, len(index), tokens, name, table.tobytes(), b"".join(frames))
            segment, start, index, frames, held = segment + 1, start + tokens, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()), strict=True)],
                names=[c.split()[0] for c in SEGMENTS.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                raw = known.encode(text.as_py() or "") + end
                frame = packer.compress(raw)
                doc = doc_id.as_py()
                index.append((NO_ID if doc is None else doc, held, len(frame), len(raw) // known.type.itemsize))
                frames.append(frame)
                held += len(frame)
                if held >= SEGMENT_BYTES:
                    yield closed()
        if index:
            yield closed()

    return write


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> TokenFiles:
    """Encode ``docs`` and write the files in ascending ``doc_id`` order. Shards are range partitions."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "tokens")
    files = TokenFiles(f"{folder}/segments", f"{folder}/dictionary")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    dictionary, name = train_dictionary(texts, tokenizer_path, end_id)
    width = Encoder(tokenizer_path).type.itemsize
    spark.createDataFrame([(name, bytearray(dictionary), end_id, width)], "sha256 string, dictionary binary, end_id int, id_bytes int") \
        .coalesce(1).write.parquet(files.dictionary)
    tie = F.xxhash64("text")
    ordered = texts.withColumn("_tie", tie).repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    ordered.select("doc_id", "text").mapInArrow(_segments(tokenizer_path, dictionary, name, end_id), SEGMENTS).write.parquet(files.segments)
    return files


def _dictionary(spark: SparkSession, files: TokenFiles) -> tuple[bytes, np.dtype]:
    row = spark.read.parquet(files.dictionary).first()
    data = bytes(row.dictionary)
    if hashlib.sha256(data).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary in {files.dictionary} is not the one it is named for")
    return data, np.dtype(f"<u{row.id_bytes}")


def unpack(index: bytes, frames: bytes, dictionary: bytes, name: str, kind: np.dtype) -> Iterator[tuple[int, np.ndarray]]:
    """(document id, ids) of one segment, in order; the dictionary must be the one that the segment names."""
    if hashlib.sha256(dictionary).hexdigest() != name:
        raise ValueError("the segment was written with another dictionary")
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    opener = zstandard.ZstdDecompressor(dict_data=shared)
    view = memoryview(frames)
    for entry in np.frombuffer(index, INDEX):
        start, length = int(entry["offset"]), int(entry["length"])
        ids = np.frombuffer(opener.decompress(view[start:start + length]), kind)
        if len(ids) != entry["n_tokens"]:
            raise ValueError(f"document {entry['doc_id']} does not hold the tokens its index names")
        yield int(entry["doc_id"]), ids


def read_back(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and its shard and segment."""
    ship(spark)
    dictionary, kind = _dictionary(spark, files)
    segments = spark.read.schema(SEGMENTS).parquet(files.segments)
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    offset = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = shards.select("shard", offset.cast("long").alias("offset"))  # one row per shard

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["token_start"], []
                for doc_id, ids in unpack(row["index"], row["frames"], dictionary, row["dictionary"], kind):
                    out.append((None if doc_id == NO_ID else doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                                row["shard"], row["segment"]))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*[pa.int64()] * 4, pa.int32(), pa.int32()), strict=True)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "segment"])

    per_doc = segments.select("shard", "segment", "token_start", "dictionary", "index", "frames").mapInArrow(
        digests, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, segment int")
    return per_doc.join(offsets, "shard").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "segment")


def document(spark: SparkSession, files: TokenFiles, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id: only segments whose range holds it are read, only its frames opened."""
    dictionary, kind = _dictionary(spark, files)
    segments = spark.read.schema(SEGMENTS).parquet(files.segments)
    rows = segments.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("shard", "segment")
    found = []
    for row in rows.toLocalIterator():
        index = np.frombuffer(bytes(row["index"]), INDEX)
        own = index[index["doc_id"] == doc_id]
        found += [ids.tolist() for _, ids in unpack(own.tobytes(), bytes(row.frames), dictionary, row.dictionary, kind)]
    return found
