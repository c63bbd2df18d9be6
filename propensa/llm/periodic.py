"""Runs of a repeating passage, found in tiles of every scale.

A run is a maximal stretch of words with smallest period ``q`` that is at least ``max(6, 4 * q)`` words
long. Word ``i`` matches at distance ``p`` if it equals word ``i - p``; a run of period ``p`` is a stretch of at least
``3 * p`` matches in a row, and the ``p`` words before it.

* Explode: periods are taken by octaves (from ``2**k`` to twice that). An octave has a boundary every
  ``2**(k + 1)`` words, and a tile around each (or some neighbours): as many words to both sides as to reach the next
  boundaries, and one period more. Tiles overlap. Every run of the octave has a boundary well inside its
  matches, so a tile where no period of the octave matches next to the boundary is left out, and so is one
  where all that match are multiples of a smaller period.
* Solve: tiles are dealt over the cluster and solved alone. Two Z-functions give, for all periods of
  the octave at once, how far matches reach from the boundary: one of the words right of it against those
  from a period before, one of the words left of it, read backwards.
* Stitch: pieces of one run from neighbouring tiles overlap; they are shuffled by document and period and
  joined. A stretch found with several periods is one run of the smallest.

So a long document is many tiles of bounded size in each octave, and a run over the whole of it is
joined from pieces, not found by one task.

Defined results: a null text has no words; rows with the same id are rows of their own; a null id plants nothing; an empty
table gives no rows; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa.llm.tables import ship
from propensa.session import stored

LEAST_LENGTH, LEAST_TIMES = 6, 4  # of a run, in words and in periods
SPAN = 1024  # words between the first and the last boundary of a tile
CHUNK_WORDS = 200_000  # of documents exploded at a time, exceeded by one document at most
PAIRS = 2_000_000  # boundaries and periods compared at a time
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXPLODED = ("row long, doc_id long, n_words long, words string, words_sha256 string, "
            "octave int, boundary long, boundaries int, first long, tile binary")
FRAGMENTS = "row long, period long, first long, upto long"
COLLAPSED = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string, collapsed_sha256 string"


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words of a document, every tenth one (by the CRC-32 of its id) with a repeating end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    times = -(-(n - start) // period)
    return words[:start] + (words[start:start + period] * times)[:n - start]


# --- tiles --------------------------------------------------------------------------------------------------------


def margin(octave: int) -> int:
    """Matches on both sides of the best boundary of any run of the octave, at least (8 are enough to look at)."""
    return max(1, min(8, 2**octave // 2))


def reach(octave: int) -> int:
    """Words that a tile holds to the right of its boundary, and to the left besides a period."""
    return 2 ** (octave + 1) + margin(octave)


def octaves(n: int) -> range:
    """Octaves with a period that fits ``LEAST_TIMES`` times in ``n`` words."""
    return range((n // LEAST_TIMES).bit_length()) if n >= LEAST_LENGTH else range(0)


def candidates(codes: np.ndarray, octave: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries among ``places`` and periods of the octave that match on all of the margin around them, in order of place."""
    least, m = 2**octave, margin(octave)
    found = []
    step = max(1, PAIRS // least)
    for at in range(0, len(places), step):
        some = places[at:at + step]
        # The words one period before a boundary, for all periods of the octave, lie side by side.
        before = np.lib.stride_tricks.sliding_window_view(codes, least)[some - 2 * least + 1]
        where, nth = np.nonzero(before == codes[some][:, None])
        where, period = some[where], 2 * least - 1 - nth
        for aside in [*range(-1, -m - 1, -1), *range(1, m)]:
            i = where + aside
            same = (i - period >= 0) & (codes[i] == codes[np.maximum(i - period, 0)])
            where, period = where[same], period[same]
        found.append((where, period))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def matches_before(codes: np.ndarray, period: int) -> np.ndarray:
    """For each word, how many words up to it match at the distance in a row."""
    place = np.arange(len(codes))
    differs = np.ones(len(codes), bool)
    differs[period:] = codes[period:] != codes[:-period]
    return place - np.maximum.accumulate(np.where(differs, place, -1))


def explode(documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
    """Tiles (document, octave, boundary, number of boundaries, first word, words' codes) of some documents.

    The documents lie one after another, longest first, with codes of their own, so that
    one comparison serves all and a longer octave takes a shorter stretch. Boundaries of an octave are
    boundaries of all lower ones, so a period that only repeats a known smaller one is known where it stands and left out.
    Neighbouring boundaries share a tile of at most ``SPAN`` words between the first and the last.
    """
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    sizes = np.array([len(documents[i]) for i in order], np.int64)
    starts = np.cumsum(sizes) - sizes
    width = 1 + max((int(d.max()) for d in documents if len(d)), default=0)
    flat = np.concatenate([documents[i].astype(np.int64) + width * nth for nth, i in enumerate(order)]) if order else np.empty(0, np.int64)
    smaller: dict[int, list[tuple[int, np.ndarray]]] = {}
    for octave in octaves(int(sizes[0]) if len(sizes) else 0):
        least = 2**octave
        long = int(np.searchsorted(-sizes, -LEAST_TIMES * least, side="right"))
        end = int(starts[long - 1] + sizes[long - 1])
        at, period = candidates(flat[:end], octave, np.arange(2 * least, end - margin(octave) + 1, 2 * least))
        owner = np.searchsorted(starts[:long], at, side="right") - 1
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for part in np.split(np.arange(len(at)), cuts):
            if not len(part):
                continue
            nth = int(owner[part[0]])
            doc, own, periods = documents[order[nth]], at[part] - starts[nth], period[part]
            for q, matched in smaller.get(nth, ()):
                new = (periods % q != 0) | (matched[own - 1] < periods - q)
                own, periods = own[new], periods[new]
            for q in np.unique(periods[2 * LEAST_TIMES * periods <= len(doc)]).tolist():
                smaller.setdefault(nth, []).append((q, matches_before(doc, q)))
            own = np.unique(own)
            while len(own):
                near = np.concatenate(([0], np.cumsum(np.diff(own) > 4 * least)))
                share = own[(near == 0) & (own - own[0] <= SPAN)]
                own = own[len(share):]
                first = max(0, int(share[0]) - reach(octave) - 2 * least + 1)
                yield order[nth], octave, int(share[0]), 1 + int(share[-1] - share[0]) // (2 * least), first, doc[first:int(share[-1]) + reach(octave)]


def _common(s: np.ndarray, a: int, b: int) -> int:
    """Length of the common beginning of ``s[a:]`` and ``s[b:]`` (a < b)."""
    length, step = 0, 16
    while b + length < len(s):
        upto = min(step, len(s) - b - length)
        differs = s[a + length:a + length + upto] != s[b + length:b + length + upto]
        if differs.any():
            return length + int(differs.argmax())
        length, step = length + upto, step * 4
    return length


def z_function(s: np.ndarray) -> np.ndarray:
    """For each place, the length of the common beginning of ``s`` and of what follows the place.

    Only places that hold the first value are visited; inside a known match, lengths are copied in steps
    up to the first place whose match ends with the known one and may go on.
    """
    n = len(s)
    z = np.zeros(n, np.int64)
    if n == 0:
        return z
    z[0] = n
    heads = np.flatnonzero(s == s[0])
    known, at = 0, 1
    while True:
        if not known:
            nth = int(np.searchsorted(heads, at))
            if nth >= len(heads):
                return z
            at = int(heads[nth])
        length = known + _common(s, known, at + known)
        z[at] = length
        known, filled = 0, 0
        while filled < length - 1:
            upto = min(length - 1, at + filled)  # lengths known so far
            inner, limit = z[filled + 1:upto + 1], length - np.arange(filled + 1, upto + 1)
            # A length that ends with the match may go on; a longer one was cut by the same word.
            goes_on = np.flatnonzero(inner == limit) if at + length < n else ()
            stop = int(goes_on[0]) if len(goes_on) else upto - filled
            z[at + filled + 1:at + filled + 1 + stop] = np.minimum(inner[:stop], limit[:stop])
            filled += stop
            if len(goes_on):
                known = length - filled - 1
                break
        at += filled + 1


def solve(octave: int, boundary: int, count: int, first: int, tile: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of matches around a tile's boundaries: (period, first match, end), for periods of the octave.

    A stretch that ends within the tile on both sides is whole and is given only if it is long enough. A
    period whose words are a smaller one repeated is left to that one.
    """
    m, least = margin(octave), 2**octave
    places = boundary - first + 2 * least * np.arange(count)
    where, period = candidates(tile, octave, places[(places >= 2 * least) & (places + m <= len(tile))])
    early = places[places < 2 * least]  # too near to the beginning of the text for the longest periods
    for own in early.tolist():
        some = np.arange(least, own - m + 1)
        fits = np.array([(tile[own - m:own + m] == tile[own - m - p:own + m - p]).all() for p in some.tolist()], bool)
        where, period = np.append(np.full(int(fits.sum()), own), where), np.append(some[fits], period)
    found = []
    while len(where):
        own = int(where[0])
        periods = np.arange(least, min(2 * least, own + 1))
        back = int(periods[-1])
        before = np.append(z_function(tile[:own][::-1]), 0)
        left = before[periods]
        right = z_function(np.concatenate((tile[own:], [-1], tile[own - back:])))[len(tile) - own + 1 + back - periods]
        from_, upto = own - left, own + right
        seen = (left >= m) & (right >= m)
        nth = np.minimum(period - least, len(periods) - 1)
        held = (where == own) | ((period <= back) & seen[nth] & (where > from_[nth]) & (where < upto[nth]))
        where, period = where[~held], period[~held]
        whole = (from_ > periods) & (upto < len(tile))
        need = np.maximum((LEAST_TIMES - 1) * periods, LEAST_LENGTH - periods)
        good = np.flatnonzero(seen & (~whole | (left + right >= need)))
        for q in range(1, back // 2 + 1):
            if not len(good):
                break
            if before[q] >= q:
                p = periods[good]
                good = good[(p % q != 0) | (before[q] < p - q)]
        found += [(int(periods[g]), first + int(from_[g]), first + int(upto[g])) for g in good]
    return found


# --- on tables ----------------------------------------------------------------------------------------------------


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*[f.split() for f in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def _exploder(plant: bool):
    def rows_of(held: list[tuple[int, int | None, list[str]]]) -> Iterator[pa.RecordBatch]:
        codes = pd.factorize(np.array([w for _, _, words in held for w in words], dtype=object))[0]
        ends = np.cumsum([len(words) for _, _, words in held])
        documents = np.split(codes, ends[:-1])
        out, size, tiled = [], 0, set()
        for nth, octave, boundary, count, first, tile in explode(documents):
            tiled.add(nth)
            out.append((held[nth][0], None, None, None, None, octave, boundary, count, first, tile.astype("<i4").tobytes()))
            size += len(tile)
            if size >= CHUNK_WORDS:
                yield _table(EXPLODED, out)
                out, size = [], 0
        for nth, (row, doc_id, words) in enumerate(held):
            text = " ".join(words)
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((row, doc_id, len(words), text if nth in tiled else None, digest, None, None, None, None, None))
        yield _table(EXPLODED, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text")), strict=True):
                words = WORD.findall(text.as_py() or "")
                held.append((row.as_py(), doc_id.as_py(), planted(words, doc_id.as_py()) if plant else words))
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield from rows_of(held)
                    held, size = [], 0
            if held:
                yield from rows_of(held)

    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c) for c in ("row", "octave", "boundary", "boundaries", "first", "tile"))
        out = []
        for row, octave, boundary, count, first, tile in zip(*columns, strict=True):
            found = solve(octave.as_py(), boundary.as_py(), count.as_py(), first.as_py(), np.frombuffer(tile.as_py(), "<i4"))
            out += [(row.as_py(), *piece) for piece in found]
        yield _table(FRAGMENTS, out)


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs (row, start, length, period) from pieces of matches (row, period, first, upto) that overlap or meet."""
    order = Window.partitionBy("row", "period").orderBy("first", "upto")
    before = F.max("upto").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.distinct().withColumn("opens", F.when(F.col("first") <= before, 0).otherwise(1))
    numbered = opened.withColumn("nth", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "nth").agg(F.min("first").alias("first"), F.max("upto").alias("upto"))
    length = F.col("upto") - F.col("first") + F.col("period")
    runs = whole.select("row", "period", (F.col("first") - F.col("period")).alias("start"), length.alias("length"))
    long = runs.where((F.col("length") >= LEAST_LENGTH) & (F.col("length") >= LEAST_TIMES * F.col("period")))
    return long.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


@dataclass(frozen=True)
class Found:
    """``documents`` (row, doc_id, n_words, words where a tile was solved, words_sha256), a written table, and ``runs`` (row, start, length, period)."""

    documents: DataFrame
    runs: DataFrame


def find(docs: DataFrame, plant: bool = False) -> Found:
    """Runs of all documents (doc_id, text). With ``plant``, of their words with planted repetitions."""
    ship(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    exploded = stored(rows.mapInArrow(_exploder(plant), EXPLODED))  # written once, so row numbers stay
    tiles = exploded.where("octave is not null").select("row", "octave", "boundary", "boundaries", "first", "tile")
    fragments = tiles.repartition("row", "octave", "boundary").mapInArrow(_solved, FRAGMENTS)
    documents = exploded.where("octave is null").select("row", "doc_id", "n_words", "words", "words_sha256")
    return Found(documents, stitched(fragments))


def _dropped(runs: list[dict], n: int) -> np.ndarray:
    """Which words some run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for run in runs:
        step[run["start"] + run["period"]] += 1
        step[run["start"] + run["length"]] -= 1
    return np.cumsum(step[:n]) > 0


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for runs, text in zip(batch.column("runs"), batch.column("words"), strict=True):
            words = text.as_py().split(" ")
            drop = _dropped(runs.as_py(), len(words)).tolist()
            texts.append(" ".join([w for w, d in zip(words, drop, strict=True) if not d]))
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "runs")), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                                         names=["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"])


def collapse(found: Found) -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period), the text without repetitions (null where nothing
    is dropped: its words joined by one space) and its SHA-256. Only rows with a run meet their words again."""
    runs = found.runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    by_start = F.array_sort("runs", lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    tiled = found.documents.where("words is not null").join(runs.withColumn("runs", by_start), "row", "left")
    tiled = stored(tiled)
    none = F.array().cast("array<struct<start:long,length:long,period:long>>")
    plain = found.documents.where("words is null").select("doc_id", "n_words", "words_sha256").unionByName(
        tiled.where("runs is null").select("doc_id", "n_words", "words_sha256"))
    plain = plain.select("doc_id", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("words_sha256").alias("collapsed_sha256"))
    return plain.unionByName(tiled.where("runs is not null").select("doc_id", "n_words", "runs", "words").mapInArrow(_collapsed, COLLAPSED))
