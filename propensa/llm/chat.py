"""Chat formatting at token level.

A conversation becomes turns ``[INST]role[/INST]text</s>`` after one ``<s>``.
Role and text are encoded apart from the control strings, whose reserved ids lie
beyond the vocabulary and are spliced in between, so no text can make a
control id. In the written form of a turn, control strings that occur in a
text get a backslash after their first character (and one more, if they have some already),
which is undone by taking one away; ids carry that escaped text as well, so both forms are the same.

The loss mask is a prefix sum over the ids of a batch: +1 after an assistant's role, -1 at the end of its text.

A conversation may hold a third of all rows, so the output is not one row for
each but one row per turn, in the order of (conv_id, position), with the ids,
the mask and the written form of the turn and the place where it starts in the
conversation (``id_start``, ``char_start``), and whether it is the ``last`` one. Running totals are summed by range
partition, and only conversations that reach over a partition's edge add up partitions.

Defined results: null role and text are empty strings; rows are ordered by turn
(null first), then role, then text, so repeated rows follow each other; an empty
table gives no turns; columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa.llm.tables import ship
from propensa.llm.token_files import encoder
from propensa.session import scratch_path

TURNS = "conv_id long, position long, id_start long, char_start long, ids array<int>, loss array<boolean>, formatted string, last boolean"
WRITTEN = f"part int, {TURNS}, edge boolean, id_end long, char_end long"  # places within the part, until parts are added up
WRITTEN_NAMES = [c.split()[0] for c in WRITTEN.split(", ")]
READ = "conv_id long, position long, role string, text string, loss_text string, chars long"
HELD_CHARS = 4_000_000  # of a conversation that is digested where it is read
ROLES = 1000  # whose ids are kept


@dataclass(frozen=True)
class Template:
    """Control strings; ids are reserved beyond the vocabulary in this order."""

    start: str = "<s>"
    role: str = "[INST]"
    text: str = "[/INST]"
    end: str = "</s>"
    learned: str = "assistant"  # the role whose text is under the mask

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        if any(set(c[1:]) & heads or "\\" in c for c in self.controls):
            raise ValueError("the first character of a control string may stand nowhere else in one, and no backslash may")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.start, self.role, self.text, self.end

    @cached_property
    def _plain(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in self.controls))

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in self.controls))

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        if "\\" not in text:
            return text
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:], text)


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn in range partitions, with ``position`` in the conversation from 0."""
    rows = rows.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(*order)


def _formatted(tokenizer_path: str, template: Template):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer_path)
        base = known.tokenizer.get_vocab_size()
        role_id, text_id, end = base + 1, base + 2, base + 3  # base itself opens a conversation
        space = bytes(known.type.itemsize)  # holds the place of a control id
        roles: dict[str, tuple[str, bytes]] = {}
        part = TaskContext.get().partitionId()

        def table(turns: list[list]) -> pa.RecordBatch:
            conv, position, id_start, char_start, role, text, learned, written, last, edge = zip(*turns, strict=True)
            flat = np.frombuffer(b"".join([space + r + space + t + space for r, t in zip(role, text, strict=True)]), known.type).astype(np.int32)
            in_role = np.array([len(r) for r in role]) // known.type.itemsize
            lengths = in_role + np.array([len(t) for t in text]) // known.type.itemsize + 3
            ends = np.cumsum(lengths)
            starts = ends - lengths
            flat[starts], flat[starts + 1 + in_role], flat[ends - 1] = role_id, text_id, end
            under = np.array(learned)
            step = np.zeros(len(flat), np.int8)
            step[(starts + 2 + in_role)[under]] += 1
            step[(ends - 1)[under]] -= 1
            offsets = pa.array(np.append(0, ends), pa.int32())
            id_start, char_start = np.array(id_start), np.array(char_start)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(turns), pa.int32()), pa.array(conv, pa.int64()), pa.array(position, pa.int64()),
                 pa.array(id_start, pa.int64()), pa.array(char_start, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(np.cumsum(step, dtype=np.int8) > 0)),
                 pa.array(written, pa.string()), pa.array(last, pa.bool_()), pa.array(edge, pa.bool_()),
                 pa.array(id_start + lengths, pa.int64()), pa.array(char_start + np.array([len(w) for w in written]), pa.int64())],
                names=WRITTEN_NAMES)

        # A turn is the last one of its conversation here if the next row is of another, so one is held back.
        held: list | None = None
        conversations, position, ids_before, chars_before = 0, 0, 0, 0
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if held is None or c != held[0]:
                    if held is not None:
                        held[-2:] = True, conversations == 1
                    conversations, position, ids_before, chars_before = conversations + 1, 0, 0, 0
                if held is not None:
                    out.append(held)
                if role not in roles:
                    shown = template.escape(role)
                    if len(roles) >= ROLES:
                        roles.clear()
                    roles[role] = shown, known.encode(shown)
                shown, role_ids = roles[role]
                said = template.escape(text)
                text_ids = known.encode(said)
                written = template.role + shown + template.text + said + template.end
                held = [c, position, ids_before, chars_before, role_ids, text_ids, role == template.learned, written, False, False]
                position, chars_before = position + 1, chars_before + len(written)
                ids_before += (len(role_ids) + len(text_ids)) // known.type.itemsize + 3
            if out:
                yield table(out)
        if held is not None:
            held[-2:] = True, True
            yield table([held])

    return build


def first_reserved(tokenizer_path: str) -> int:
    """The first reserved id."""
    return encoder(tokenizer_path).tokenizer.get_vocab_size()


def format_turns(rows: DataFrame, tokenizer_path: str, template: Template = Template(), folder: str | None = None) -> DataFrame:
    """Write the turns of ``rows`` (conv_id, turn, role, text) and return the written table, see ``TURNS``.

    A conversation's ``<s>`` is the first id and the first characters of its turn 0.
    """
    spark = rows.sparkSession
    ship(spark)
    path = folder or scratch_path(spark, "turns")
    turns = ordered(rows).mapInArrow(_formatted(tokenizer_path, template), WRITTEN)
    turns.write.option("compression", "zstd").parquet(path)
    turns = spark.read.schema(WRITTEN).parquet(path)
    # Only the first and the last conversation of a partition can reach over its edge: two rows a partition at most.
    ends = turns.where("last and edge").selectExpr(
        "conv_id as _conv", "part as _part", "position + 1 as n", "id_end as i", "char_end as c")
    own = Window.partitionBy("_conv").orderBy("_part")
    earlier, later = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select("_conv", "_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in "nic"],
                       (F.count("n").over(later) > 0).alias("_more")).where("_n > 0 or _more")
    joined = turns.join(F.broadcast(ends), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    first = (F.col("position") + F.coalesce("_n", F.lit(0))) == 0
    bos = F.lit(first_reserved(tokenizer_path)).cast("int")
    opening = lambda there: F.when(first, 0).otherwise(there + F.lit(1))
    return joined.select(
        "conv_id",
        (F.col("position") + F.coalesce("_n", F.lit(0))).alias("position"),
        opening(F.col("id_start") + F.coalesce("_i", F.lit(0))).alias("id_start"),
        F.when(first, 0).otherwise(F.col("char_start") + F.coalesce("_c", F.lit(0)) + len(template.start)).alias("char_start"),
        F.when(first, F.concat(F.array(bos), "ids")).otherwise(F.col("ids")).alias("ids"),
        F.when(first, F.concat(F.array(F.lit(False)), "loss")).otherwise(F.col("loss")).alias("loss"),
        F.when(first, F.concat(F.lit(template.start), "formatted")).otherwise(F.col("formatted")).alias("formatted"),
        (F.col("last") & ~F.coalesce("_more", F.lit(False))).alias("last"),
    )


_BYTES_OF: dict[str, list[bytes]] = {}  # by vocabulary file, kept for later tasks of the same Python worker


def _bytes_of(tokenizer_path: str) -> list[bytes]:
    """The bytes that each id stands for in a byte-level vocabulary."""
    if tokenizer_path not in _BYTES_OF:
        known = encoder(tokenizer_path)
        byte = {ord(shown) if isinstance(shown, str) else shown: b for b, shown in known.visible.items()}
        tokens = [known.tokenizer.id_to_token(i) or "" for i in range(known.tokenizer.get_vocab_size())]
        _BYTES_OF[tokenizer_path] = [
            bytes(byte[ord(c)] for c in t) if all(ord(c) in byte for c in t) else t.encode() for t in tokens]
    return _BYTES_OF[tokenizer_path]


def read_turns(turns: DataFrame, tokenizer_path: str, template: Template = Template()) -> DataFrame:
    """(conv_id, position, role, text, loss_text, chars, last) decoded from the ids and masks of :func:`format_turns`."""
    ship(turns.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = encoder(tokenizer_path), _bytes_of(tokenizer_path)
        base = known.tokenizer.get_vocab_size()

        def decoded(ids: np.ndarray) -> str:
            if not known.by_word:  # no byte-level vocabulary
                return template.unescape(known.tokenizer.decode(ids.tolist(), skip_special_tokens=False)) if len(ids) else ""
            return template.unescape(b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace"))

        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy()
            loss = batch.column("loss").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(batch.column("ids")).to_numpy())
            starts = np.append(0, ends[:-1])[:len(ends)]
            under = np.append(0, np.cumsum(loss))  # masked ids before a place
            role_at, text_at, end_at = (np.flatnonzero(ids == base + kind) for kind in (1, 2, 3))
            out = []
            for a, b, r, t, e in zip(starts, ends, role_at, text_at, end_at, strict=True):
                text = decoded(ids[t + 1:e])
                masked = under[b] - under[a]
                if not masked:
                    loss_text = ""
                elif masked == under[e] - under[t + 1] == e - t - 1:
                    loss_text = text  # the mask covers the text and nothing else
                else:
                    loss_text = decoded(ids[a:b][loss[a:b]])
                out.append((decoded(ids[r + 1:t]), text, loss_text))
            role, text, loss_text = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("position"), pa.array(role, pa.string()), pa.array(text, pa.string()),
                 pa.array(loss_text, pa.string()), pc.utf8_length(batch.column("formatted")).cast(pa.int64()), batch.column("last")],
                names=["conv_id", "position", "role", "text", "loss_text", "chars", "last"])

    return turns.mapInArrow(read, f"{READ}, last boolean")


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv: int | None):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, loss_text: str, chars: int) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss_chars += len(loss_text)
        self.loss.update(loss_text.encode())
        self.chars += chars

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _batch(rows: list[tuple], columns: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names = [c.split() for c in columns.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*rows, strict=True), names, strict=True)], names=[n for n, _ in names])


def conversation_digests(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The turns of :func:`read_turns` mostly come in the order in which they were written. A conversation that a task
    sees from its first turn to its last, one after the other and in ``HELD_CHARS`` characters, is digested there. The turns of all others
    are shuffled and stream, sorted, through the task of their conversation; only running hashes are held.
    """
    digested = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    either = f"{READ}, {digested}"

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, waiting, size = None, [], 0  # the conversation that is being seen, its turns and their characters
        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "position", "role", "text", "loss_text", "chars", "last"))
            for c, position, role, text, loss_text, chars, last in zip(*columns, strict=True):
                turn = (c, position, role, text, loss_text, chars, *[None] * 5)
                follows = digest is not None and c == digest.conv and position == digest.n
                if not follows:
                    out += waiting
                    digest, waiting, size = _Digest(c) if position == 0 else None, [], 0
                if digest is None:
                    out.append(turn)
                    continue
                digest.add(role, text, loss_text, chars)
                waiting.append(turn)
                size += len(text) + len(loss_text)
                if last:
                    out.append((c, *[None] * 5, *digest.row()[1:]))
                    digest, waiting, size = None, [], 0
                elif size > HELD_CHARS:
                    out += waiting
                    digest, waiting, size = None, [], 0
            if out:
                yield _batch(out, either)
        if waiting:
            yield _batch(waiting, either)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            done = []
            for c, _, role, text, loss_text, chars, *whole in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if digest is not None and (c != digest.conv or whole[0] is not None):
                    done.append(digest.row())
                    digest = None
                if whole[0] is not None:
                    done.append((c, *whole))
                    continue
                digest = digest or _Digest(c)
                digest.add(role, text, loss_text, chars)
            if done:
                yield _batch(done, f"conv_id long, {digested}")
        if digest is not None:
            yield _batch([digest.row()], f"conv_id long, {digested}")

    rows = read.mapInArrow(near, either).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return rows.mapInArrow(far, f"conv_id long, {digested}")
