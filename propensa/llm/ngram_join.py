"""Grouped prefix join of documents on the Jaccard similarity of their word shingles.

1. Shingles are ordered by how common they are (``frequency_order``), counted
   over all documents. Two sets of similarity t or more share a shingle of
   their prefixes, the first ``n - ceil(t n) + 1`` shingles in that order, and
   as prefixes hold the rarest shingles, a passage that many documents share
   hardly ever stands in one.
2. Documents with the same set are one class, and classes with the same prefix and size
   are one group. Only groups enter the index by prefix shingle.
3. Group pairs are filtered by size and by the number of prefix shingles in
   common, then expanded to their members and verified on the whole sets.

Links are wanted for the components they make, so pairs that are already
connected need no check. First each group is verified against the leading group of
the lists it stands in; that connects a large group of near copies with as many pairs
as it has members. Then every list is joined with itself for groups of
different components, without the pairs inside its largest component. No link between
components is lost, and no list is squared while its members are one component.

The frequency order is held in ``2 ** SLOT_BITS`` bytes, whatever the input; a
shingle takes the class of the most common shingle in its slot. Any such order gives the
same links; a coarser one only lets more candidates through.

Defined results: a document without words (null and empty text too) has no
shingle and no link; with fewer words than the width, all its words are one shingle;
rows of one ``doc_id`` are one document in a component; a null ``doc_id`` has a
null component; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from propensa.llm.components import components
from propensa.llm.tables import releasing, ship
from propensa.session import stored

WIDTH = 5
THRESHOLD = (4, 5)  # similarity as a fraction
SLOT_BITS = 25
LONG_WORDS = 200_000  # a longer text is hashed piece by piece
SLICE_CHARS = 1_000_000
FLUSH_KEYS = 1_000_000  # of heads counted at a time, 4 MB
SEEN_BYTES = 32 * 1024**2  # of sets kept while pairs are compared
BROADCAST_IDS = 1_000_000  # ids up to this number (8 MB) are sent to all executors
_BASE = 0xD1342543DE82EF95


_BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)  # a random number for each byte
_POWERS: dict[int, np.ndarray] = {}  # by base, grown as needed


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64."""
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = np.cumprod(np.append(np.uint64(1), np.full(n - 1, base, np.uint64)))
    return _POWERS[base]


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(words: list[list[bytes]], width: int) -> list[np.ndarray]:
    """64-bit hashes of the shingles of each word list, by spans of one running polynomial over the joined bytes."""
    counts = np.array([len(w) for w in words])
    some = counts > 0
    data = np.frombuffer(b" ".join(b" ".join(w) for w in words if w), np.uint8)
    if not len(data):
        return [np.empty(0, np.uint64) for _ in words]
    power, inverse = _powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=running[1:])
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    grams = np.where(some, np.maximum(1, counts - width + 1), 0)
    first_word = np.cumsum(counts) - counts
    nth = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
    first = np.repeat(first_word, grams) + nth
    last = np.minimum(first + width - 1, np.repeat(first_word + counts - 1, grams))
    at = starts[first]
    return np.split(mixed((running[ends[last]] - running[at]) * inverse[at]), np.cumsum(grams)[:-1])


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text; only A-Z are lower-cased."""
    pieces, owner = [], []
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        for at in range(0, max(1, len(words) - width + 1), LONG_WORDS):
            pieces.append(words[at:at + LONG_WORDS + width - 1])
            owner.append(i)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    group, held = [], 0
    for i, words in enumerate(pieces):
        group.append(i)
        held += len(words)
        if held >= LONG_WORDS or i == len(pieces) - 1:
            for j, hashes in zip(group, _hashes([pieces[j] for j in group], width), strict=True):
                found[owner[j]].append(hashes)
            group, held = [], 0
    return [np.unique(parts[0] if len(parts) == 1 else np.concatenate(parts)) for parts in found]


def text_slices(batches: Iterator[pa.RecordBatch], chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows some at a time, with the Python strings of their ``text``."""
    for batch in batches:
        column, at = batch.column("text"), 0
        while at < len(batch):
            texts, held = [], 0
            while at + len(texts) < len(batch) and held < chars:
                texts.append(column[at + len(texts)].as_py())
                held += len(texts[-1] or "")
            yield batch.slice(at, len(texts)), texts
            at += len(texts)


def _packed(values: np.ndarray) -> bytes:
    """Small unsigned numbers, byte plane after byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def frequency_order(docs: DataFrame, width: int = WIDTH) -> bytes:
    """Compressed table of ``2 ** SLOT_BITS`` bytes: log2 of the documents that hold the most common shingle of a slot.

    0 means that no shingle of the slot stands in two rows. Tasks count the 32-bit
    heads of their shingles and send sorted, packed counts by range of heads;
    each range is summed alone.
    """
    ranges = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(parts: list[np.ndarray]) -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            cuts = np.searchsorted(keys, (np.arange(1, ranges) << 32) // ranges)
            rows = [(i, _packed(np.diff(k, prepend=np.uint32(0))), _packed(c))
                    for i, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts), strict=True)) if len(k)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)],
                names=["range", "heads", "counts"])

        parts, held = [], 0
        for _, texts in text_slices(batches):
            for hashes in shingle_sets(texts, width):
                parts.append((hashes >> np.uint64(32)).astype(np.uint32))
                held += len(hashes)
            if held >= FLUSH_KEYS:
                yield flushed(parts)
                parts, held = [], 0
        if held:
            yield flushed(parts)

    def total(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.cumsum(_unpacked(x.as_py()), dtype=np.uint32) for x in table.column("heads")])
        counts = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums, slots = np.add.reduceat(counts, first), keys[first] >> np.uint32(32 - SLOT_BITS)
        slots, sums = slots[sums > 1], sums[sums > 1]
        at = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])) if len(slots) else np.empty(0, np.int64)
        most = np.log2(np.maximum.reduceat(sums, at)).astype(np.uint32) if len(at) else np.empty(0, np.uint32)
        return pa.table({"slots": pa.array([_packed(np.diff(slots[at], prepend=np.uint32(0)))], pa.binary()),
                         "classes": pa.array([_packed(most)], pa.binary())})

    heads = docs.select("text").mapInArrow(releasing(count), "range int, heads binary, counts binary")
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    for row in heads.groupBy("range").applyInArrow(total, "slots binary, classes binary").toLocalIterator():
        slots = np.cumsum(_unpacked(bytes(row.slots)), dtype=np.uint32)
        table[slots] = np.maximum(table[slots], _unpacked(bytes(row.classes)))
    return zstandard.compress(table.tobytes(), 3)


def prefix_length(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    part, whole = threshold
    return n - -(-part * n // whole) + 1


def prefixes(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n (size of the set), set1 and set2 (its fingerprint), head (fingerprint of its prefix), prefix.

    ``prefix`` leaves out shingles that stand in no other row. Written once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequency_order(docs, width))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zstandard.decompress(sent.value), np.uint8)
        for batch, texts in text_slices(batches):
            n, one, two, head, prefix = [], [], [], [], []
            for hashes in shingle_sets(texts, width):
                classes = table[hashes >> np.uint64(64 - SLOT_BITS)]
                kept = np.argsort(classes, kind="stable")[: prefix_length(len(hashes), threshold)]
                first = hashes[kept]
                n.append(len(hashes))
                one.append(int(mixed(hashes, 1).sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(mixed(hashes, 2).sum(dtype=np.uint64).astype(np.int64)))
                head.append(int(mixed(first, 3).sum(dtype=np.uint64).astype(np.int64)))
                prefix.append(first[classes[kept] > 0].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(head, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "n", "set1", "set2", "head", "prefix"])

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        releasing(describe), "doc_id long, n long, set1 long, set2 long, head long, prefix array<long>"))


def _needed(n: Column, m: Column, threshold: tuple[int, int]) -> Column:
    """Prefix shingles that similar sets of sizes n and m have in common at least.

    Common shingles outside both prefixes lie in the rest of the set whose prefix
    ends first, so they are no more than the larger rest.
    """
    part, whole = threshold
    rest = F.greatest(F.ceil(n * part / whole), F.ceil(m * part / whole)) - 1
    return F.greatest(F.lit(1), F.ceil((n + m) * part / (part + whole)) - rest)


def _enough(common: Column, n: Column, m: Column, threshold: tuple[int, int]) -> Column:
    """Whether sets of sizes n and m with so many prefix shingles in common can be similar enough."""
    part, whole = threshold
    return (common >= _needed(n, m, threshold)) & (n * whole >= m * part) & (m * whole >= n * part)


def _ids_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Those (a, b) of ``pairs`` whose whole sets are similar enough. Texts travel compressed; written once."""
    part, whole = threshold
    ids = stored(_ids_of(pairs))
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch, texts in text_slices(batches):
            data = [packer.compress(b" ".join((t or "").encode().lower().split())) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        held = 0

        def known(key: bytes) -> np.ndarray:
            nonlocal held
            tag = hashlib.blake2b(key, digest_size=16).digest()
            if tag not in seen:
                text = zstandard.decompress(key, max_output_size=1 << 31).decode()
                found = shingle_sets([text], width)[0]
                if held + found.nbytes > SEEN_BYTES:
                    seen.clear()
                    held = 0
                seen[tag] = found
                held += found.nbytes
            return seen[tag]

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                one, two = known(x.as_py()), known(y.as_py())
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(both * whole >= part * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id").mapInArrow(releasing(packed), "doc_id long, data binary")
    texts = stored(texts)
    sides = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("data").alias("x")), "a")
    sides = sides.join(texts.select(F.col("doc_id").alias("b"), F.col("data").alias("y")), "b").select("a", "b", "x", "y")
    return stored(sides.mapInArrow(releasing(compare), "a long, b long"))


def _postings(rows: DataFrame) -> DataFrame:
    """(shingle, gid, n, left) of groups, for shingles in the prefixes of two groups or more, with two leading groups.

    A leader is the group of the list, in a band of sizes, that stands in most lists: among near copies
    that is one with few changes of its own, which is similar to most others. Two
    sets of bands overlap, so sizes that one set parts meet in the other. Written once.
    """
    groups = rows.groupBy("n", "head").agg(F.min("doc_id").alias("gid"), F.first("prefix").alias("prefix"))
    entries = groups.select("gid", "n", F.size("prefix").alias("size"), F.posexplode("prefix").alias("at", "shingle"))
    # Shingles of the prefix from this one on; those that stand in no other row come first and are not in it.
    entries = entries.select("shingle", "gid", "n", (F.col("size") - F.col("at")).alias("left"))
    entries = stored(entries.withColumn("groups", F.count("*").over(Window.partitionBy("shingle"))).where("groups > 1").drop("groups"))
    entries = entries.join(entries.groupBy("gid").agg(F.count("*").alias("lists")), "gid")
    band = F.log(1.25, F.col("n"))
    for name, shift in (("first", 0.0), ("second", 0.5)):
        most = F.max(F.struct("lists", (-F.col("gid")).alias("back"), "n")).over(Window.partitionBy("shingle", "_band"))
        entries = entries.withColumn("_band", F.floor(band + shift)).withColumn(
            name, F.struct((-most["back"]).alias("gid"), most["n"].alias("n")))
    return stored(entries.select("shingle", "gid", "n", "left", "first", "second"))


def _leading_pairs(postings: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Each group with the leader that leads most of its lists, by either set of bands."""
    both = postings.select("gid", "n", F.explode(F.array("first", "second")).alias("lead")).where("lead.gid != gid")
    shared = both.groupBy("gid", "n", "lead").agg((F.count("*") / 2).alias("common"))
    # A leader of a list in both sets of bands counts once, in one set by half; the bound stays a guess that later steps mend.
    shared = shared.where(_enough(F.ceil(F.col("common")), F.col("n"), F.col("lead.n"), threshold))
    best = shared.groupBy("gid").agg(F.max(F.struct("common", F.col("lead.gid").alias("lead"))).alias("best"))
    return best.select(F.col("best.lead").alias("a"), F.col("gid").alias("b"))


def _chained(members: DataFrame) -> DataFrame:
    """Neighbours in each group of several classes."""
    before = F.lag("rep").over(Window.partitionBy("gid").orderBy("rep"))
    return members.withColumn("a", before).where("a is not null").select("a", F.col("rep").alias("b"))


def _remaining_pairs(postings: DataFrame, members: DataFrame, labels: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Member pairs of different components whose groups share enough prefix shingles, and those inside a group."""
    named = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "gid", "rep", F.coalesce("component", "rep").alias("component"))
    named = stored(named)
    # A group of several components gets a component of its own kind: it differs from all, itself included.
    groups = named.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    groups = groups.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).alias("component"))
    entries = postings.select("shingle", "gid", "n", "left").join(groups, "gid")
    sizes = entries.withColumn("_in", F.count("*").over(Window.partitionBy("shingle", "component")))
    largest = F.max(F.when(F.col("component").isNotNull(), F.struct("_in", "component"))).over(Window.partitionBy("shingle"))
    sizes = sizes.withColumn("_largest", largest).withColumn("_all", F.count("*").over(Window.partitionBy("shingle")))
    mixed_lists = sizes.where(F.col("_largest").isNull() | (F.col("_largest._in") < F.col("_all")))
    mixed_lists = stored(mixed_lists.select("shingle", "gid", "n", "left", "component", F.col("_largest.component").alias("main")))
    left = mixed_lists.where(F.col("component").isNull() | (F.col("component") != F.col("main"))).select(
        "shingle", F.col("gid").alias("g"), F.col("n").alias("gn"), F.col("left").alias("gl"), F.col("component").alias("gc"))
    right = mixed_lists.select("shingle", F.col("gid").alias("h"), F.col("n").alias("hn"), F.col("left").alias("hl"),
                               F.col("component").alias("hc"), "main")
    apart = F.col("gc").isNull() | F.col("hc").isNull() | (F.col("gc") != F.col("hc"))
    # Both outside the main component meet twice; the first order is kept.
    once = (F.col("g") < F.col("h")) | (F.col("hc") == F.col("main"))
    # The lists that a group shares with any group of some size, apart from it, bound what it shares with one of them. All its
    # mixed lists count, also those that its own component leads: there the groups apart from it are those outside that component.
    sizes = right.select("shingle", "hn").distinct()
    fits = (F.col("gn") * threshold[1] >= F.col("hn") * threshold[0]) & (F.col("hn") * threshold[1] >= F.col("gn") * threshold[0])
    outside = left.select("shingle", F.col("gn").alias("hn")).distinct()
    leading = mixed_lists.where(F.col("component") == F.col("main")).select("shingle", F.col("gid").alias("g"), F.col("n").alias("gn"))
    leading = leading.join(left.select("g").distinct(), "g", "left_semi")
    sized = left.join(sizes, "shingle").where(fits).select("g", "gn", "hn").unionByName(
        leading.join(outside, "shingle").where(fits).select("g", "gn", "hn"))
    sized = sized.groupBy("g", "gn", "hn").agg(F.count("*").alias("common"))
    sized = stored(sized.where(_enough(F.col("common"), F.col("gn"), F.col("hn"), threshold)).select("g", "hn"))
    # The first shingle that a pair has in common stands where both prefixes have as many left as it needs.
    need = _needed(F.col("gn"), F.col("hn"), threshold)
    met = left.join(sized, "g").join(right, ["shingle", "hn"]).where(F.col("g") != F.col("h")).where(
        apart & once & (F.col("gl") >= need) & (F.col("hl") >= need))
    met = stored(met.select("g", "h", "gn", "hn").distinct())
    lists = lambda name: mixed_lists.select(F.col("gid").alias(name), "shingle")
    shared = met.join(lists("g"), "g").join(lists("h"), ["h", "shingle"]).groupBy("g", "h", "gn", "hn").agg(F.count("*").alias("common"))
    shared = shared.where(_enough(F.col("common"), F.col("gn"), F.col("hn"), threshold)).select("g", "h")
    one = named.select(F.col("gid").alias("g"), F.col("rep").alias("a"), F.col("component").alias("ac"))
    two = named.select(F.col("gid").alias("h"), F.col("rep").alias("b"), F.col("component").alias("bc"))
    across = shared.join(one, "g").join(two, "h").where("ac != bc").select("a", "b")
    inside = one.join(two, (F.col("g") == F.col("h")) & (F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc"))).select("a", "b")
    return stored(across.unionByName(inside))


def similar_groups(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    ship(docs.sparkSession)
    rows = prefixes(docs, width, threshold)
    usable = rows.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("n", "head", "set1", "set2").agg(F.min("doc_id").alias("rep"))
    members = stored(classes.withColumn("gid", F.min("rep").over(Window.partitionBy("n", "head"))))
    groups = members.select("gid", "rep")
    postings = _postings(usable)
    several = members.join(members.groupBy("gid").count().where("count > 1"), "gid").select("gid", "rep")
    led = stored(_leading_pairs(postings, threshold).unionByName(_chained(several)))
    links = verified(led, docs, width, threshold)
    labels = components(links)
    rest = _remaining_pairs(postings, groups, labels, threshold)
    links = links.unionByName(verified(rest, docs, width, threshold))
    labels = components(links)
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "head", "set1", "set2", F.coalesce("component", "rep").alias("component_id"))
    named = stored(named)
    found = rows.select("doc_id", "n", "head", "set1", "set2").join(named, ["n", "head", "set1", "set2"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest id, once; rows without an id stay."""
    named = docs.where("doc_id is not null")
    ids = similar_groups(docs, width, threshold).where("component_id = doc_id").select("doc_id").distinct()
    kept = named.join(ids, "doc_id").select(*docs.columns)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    # The rows travel as one value, so that no column of theirs can clash with the number.
    kept = kept.select(F.struct(*docs.columns).alias("kept"), first.alias("nth")).where("nth = 1").select("kept.*")
    return kept.unionByName(docs.where("doc_id is null"))
