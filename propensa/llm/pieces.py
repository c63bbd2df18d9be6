"""SentencePiece encoding and decoding by vectorised merge rounds.

A byte-pair model merges the best adjacent pair of a text, leftmost first, until no pair is a piece.
Here all new words of a batch lie one after another in flat numpy arrays of symbols. A round finds
the least pair rank of every word (segmented minimum), merges its occurrences from left to right in
one step, and compacts the arrays; a word without a pair left drops out. The rounds end when no word is left.

Two facts make this equal to the sequential merges:

* No merge reaches over two characters that stand next to each other in no piece, so a text is cut
  there. Cuts before a blank that follows a letter are made by a pattern, the others on the arrays.
* Within a round, occurrences after one whose merge makes a new pair of no greater rank wait for the
  next round, because the sequential order would take the new pair first.

Words seen before come from a memory of the Python worker, which starts anew beyond ``CACHED_WORDS``.

The model file is read here (pieces, scores, kinds and the text rules). Models that change characters
before encoding, drop extra blanks, or have user-defined or unused pieces are refused.

Defined results: a null text is an empty text and has the begin and end ids only; characters
without a piece become their bytes' pieces (or the unknown id, in models without those); repeated
rows get equal results; a text of any length is encoded whole; columns of the input besides the id and
the text are kept as they are, and new columns that clash with them raise.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from propensa.llm.tables import ship

CACHED_WORDS = 400_000  # in each Python worker, some 80 MB
CHUNK_CHARS = 500_000  # texts split into words at a time, exceeded by one text at most
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.iinfo(np.int32).max  # rank of a pair that is no piece
_WORD = re.compile(r" *[^ ]+| +")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def _each_invalid_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_invalid_byte", _each_invalid_byte)


class PieceModel:
    """Pieces and merges of a model file."""

    def __init__(self, path: str, words: int = CACHED_WORDS):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        rules = {k: v for f, spec in message if f == 3 for k, v in _fields(spec)}
        trainer = {k: v for f, spec in message if f == 2 for k, v in _fields(spec)}
        if trainer.get(3) != 2 or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24):
            raise ValueError(f"{path}: only byte-pair models that keep the characters of a text are read")
        self.prefix = bool(rules.get(3, 1))
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        for field, piece in message:
            if field == 1:
                value = dict(_fields(piece))
                self.pieces.append(value[1].decode())
                scores.append(struct.unpack("<f", value[2])[0] if 2 in value else 0.0)
                self.kinds.append(value.get(3, NORMAL))
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self._merges(scores)
        self._written = [b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else bytes([int(p[1:-1], 16)]) if k == BYTE
                         else p.replace(BLANK, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        self._opens = [p.startswith(BLANK) and k == NORMAL for p, k in zip(self.pieces, self.kinds, strict=True)]
        self._quiet = np.array([k == CONTROL for k in self.kinds])
        self.limit, self.known = words, {}

    def _merges(self, scores: list[float]) -> None:
        """Symbols, the pairs that make a piece with their rank, and the characters that may be neighbours."""
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        symbol = dict(normal)
        for char in sorted({c for p in normal for c in p} - normal.keys()):
            symbol[char] = len(self.pieces) + len(symbol) - len(normal)
        self.n_symbols = len(self.pieces) + len(symbol) - len(normal)
        rank = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        pairs = [(symbol[p[:i]] * self.n_symbols + symbol[p[i:]], rank[scores[m]], m)
                 for p, m in normal.items() for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self._pairs = np.append(table[:, 0], np.iinfo(np.int64).max)
        self._ranks = np.append(table[:, 1], NONE).astype(np.int32)
        self._made = np.append(table[:, 2], 0).astype(np.int32)
        neighbours = {(symbol[a], symbol[b]) for p in normal for a, b in zip(p, p[1:])}
        self._near = np.array(sorted(a * self.n_symbols + b for a, b in neighbours), np.int64)
        self._char = np.full(0x110000, -1, np.int32)
        for char, number in symbol.items():
            if len(char) == 1:
                self._char[ord(char)] = number
        self._chars = {number: char for char, number in symbol.items() if number >= len(self.pieces)}
        self._blank_cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in normal)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs; ``NONE`` where a pair is no piece."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.n_symbols + right)
        at = np.searchsorted(self._pairs, key)
        found = self._pairs[at] == key
        return np.where(found, self._ranks[at], NONE), self._made[at]

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words whose symbols lie in one array until no pair is left.

        ``first`` marks each word's first symbol. Gives what is left, and for each symbol the place that it began at.
        """
        sym, first, place = symbols.astype(np.int32), first.copy(), np.arange(len(symbols))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        last = np.append(first[1:], True)
        right = np.append(sym[1:], -1)
        rank, made = self._look(sym, np.where(last, -1, right))
        while len(sym):
            starts = np.flatnonzero(first)
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            open_words = least != NONE
            if not open_words.all():  # compaction: words without a pair leave the arrays
                stay = np.repeat(open_words, sizes)
                done.append((place[~stay], sym[~stay]))
                sym, first, place, rank, made = sym[stay], first[stay], place[stay], rank[stay], made[stay]
                least, sizes = least[open_words], sizes[open_words]
                if not len(sym):
                    break
            floor = np.repeat(least, sizes)
            at = np.flatnonzero(rank == floor)
            run = np.concatenate(([True], np.diff(at) != 1))  # neighbours overlap: every second one, from the left
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(run, nth, 0))) % 2 == 0]
            new = made[at]
            # Pairs that each merge makes with its neighbours as they stand when its turn comes.
            n = len(sym)
            before = sym[np.maximum(at - 1, 0)]
            joined = np.concatenate(([False], at[1:] - at[:-1] == 2))
            before[joined] = new[np.flatnonzero(joined) - 1]
            after = sym[np.minimum(at + 2, n - 1)]
            closed = (at + 2 >= n) | first[np.minimum(at + 2, n - 1)]
            sooner = np.minimum(self._look(np.where(first[at], -1, before), new)[0], self._look(new, np.where(closed, -1, after))[0]) <= floor[at]
            if sooner.any():
                word = np.cumsum(first)[at]
                passed = np.cumsum(sooner) - sooner
                opened = np.concatenate(([True], word[1:] != word[:-1]))
                keep = passed == passed[np.maximum.accumulate(np.where(opened, np.arange(len(at)), 0))]
                at, new = at[keep], new[keep]
            sym[at] = new
            left = np.ones(n, bool)
            left[at + 1] = False
            changed = np.zeros(n, bool)
            changed[at] = True
            sym, first, place, rank, made, changed = sym[left], first[left], place[left], rank[left], made[left], changed[left]
            touched = changed.copy()
            touched[:-1] |= changed[1:]
            at = np.flatnonzero(touched)
            ends = (at + 1 >= len(sym)) | first[np.minimum(at + 1, len(sym) - 1)]
            rank[at], made[at] = self._look(sym[at], np.where(ends, -1, sym[np.minimum(at + 1, len(sym) - 1)]))
        if not done:
            return sym, place
        place, sym = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return sym[order], place[order]

    def _learn(self, words: list[str]) -> None:
        """Encode words and keep their ids as bytes."""
        text = "".join(words).replace(" ", BLANK)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        begins = np.cumsum([0, *map(len, words)])[:-1]
        sym = self._char[codes]
        first = np.zeros(len(sym), bool)
        first[begins] = True
        if len(sym) > 1:  # cut where two characters are neighbours in no piece
            key = np.where((sym[:-1] < 0) | (sym[1:] < 0), -1, sym[:-1].astype(np.int64) * self.n_symbols + sym[1:])
            at = np.minimum(np.searchsorted(self._near, key), max(0, len(self._near) - 1))
            first[1:] |= (self._near[at] != key) if len(self._near) else True
        sym, place = self.merge(sym, first)
        bounds = np.append(np.searchsorted(place, begins), len(place)).tolist()
        plain = (sym >= 0) & (sym < len(self.pieces))
        odd = np.append(0, np.cumsum(~plain)).tolist()
        ids = sym.astype("<u4")
        raw = ids.tobytes()
        if len(self.known) + len(words) > self.limit:
            self.known.clear()
        for word, a, b in zip(words, bounds, bounds[1:]):
            if odd[a] == odd[b]:
                self.known[word] = raw[4 * a:4 * b]
            else:
                parts: list[int] = []
                for i in range(a, b):
                    parts += [int(ids[i])] if plain[i] else self._spelled(text[place[i]])
                self.known[word] = np.array(parts, "<u4").tobytes()

    def _spelled(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        return [self.bytes[b] for b in char.encode()] if len(self.bytes) == 256 else [self.unknown]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers, with the begin and end ids."""
        split, missing = [], set()
        for text in texts:
            text = text.replace(BLANK, " ")
            text = f" {text}" if text and self.prefix else text
            words = _WORD.findall(text) if self._blank_cuts else [text] if text else []
            split.append(words)
            missing.update(filterfalse(self.known.__contains__, words))
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
            missing = {word for words in split for word in words}
        if missing:
            self._learn(sorted(missing))
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        out = []
        for words in split:
            ids = b"".join(map(self.known.__getitem__, words))
            out.append(begin + (ids if len(self.bytes) == 256 else self._one_unknown(ids)) + end)
        return out

    def _one_unknown(self, ids: bytes) -> bytes:
        """A run of unknown characters is one unknown id in models that do not spell them."""
        values = np.frombuffer(ids, "<u4")
        again = (values[1:] == self.unknown) & (values[:-1] == self.unknown)
        return values[np.append(True, ~again)].tobytes() if again.any() else ids

    def decode(self, ids: bytes) -> str:
        """The text of ids: bytes joined to characters, blanks restored, the added first blank dropped."""
        values = np.frombuffer(ids, "<u4")
        quiet = self._quiet[values]
        first = int(np.argmin(quiet)) if len(values) and not quiet.all() else None
        # Bytes do not join to a character over a control id.
        stretches = np.split(values, np.flatnonzero(quiet[1:] != quiet[:-1]) + 1)
        raw = [b"".join(map(self._written.__getitem__, part.tolist())) for part in stretches]
        text = "".join(part.decode("utf-8", "each_invalid_byte") for part in raw)
        return text[1:] if first is not None and self.prefix and self._opens[values[first]] else text


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, kept for later tasks of the same Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _mapped(df: DataFrame, column: str, fields: list[T.StructField], chunks, work) -> DataFrame:
    """``df`` without ``column`` and with what ``work`` makes of it, some rows at a time."""
    ship(df.sparkSession)
    clash = {f.name for f in fields} & {*df.columns} - {column}
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(column)
            others = [i for i in range(batch.num_columns) if i != place]
            names = [batch.schema.names[i] for i in others] + [f.name for f in fields]
            for at, values in chunks(batch.column(place)):
                kept = [batch.column(i).slice(at, len(values)) for i in others]
                yield pa.RecordBatch.from_arrays([*kept, *work(values)], names=names)

    return df.mapInArrow(run, T.StructType([*[f for f in df.schema.fields if f.name != column], *fields]))


def _chunks(values: pa.Array, limit: int) -> Iterator[tuple[int, list]]:
    """Runs of values of about ``limit`` characters or bytes, with their place."""
    at, held, size = 0, [], 0
    for i, value in enumerate(values):
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= limit:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (binary, little-endian unsigned 32-bit integers) and ``n_tokens`` in place of its text."""
    def work(texts: list[str | None]) -> list[pa.Array]:
        ids = model(path).encode([t or "" for t in texts])
        return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return _mapped(df, text, fields, lambda values: _chunks(values, CHUNK_CHARS), work)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with the column ``decoded`` in place of its ids (binary as ``encode`` gives them; null: empty)."""
    def work(values: list[bytes | None]) -> list[pa.Array]:
        return [pa.array([model(path).decode(v or b"") for v in values], pa.string())]

    return _mapped(df, ids, [T.StructField("decoded", T.StringType())], lambda v: _chunks(v, 4 * CHUNK_CHARS), work)
