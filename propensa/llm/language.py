"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a whole text in both directions, labels
every byte position with a probability for each language, and the document's
probabilities are the mean over its positions. It is trained in numpy by
backpropagation through time on a bounded, stated sample of labelled rows; all
other rows are scored on the executors in Arrow batches.

Texts are read in consecutive stretches of ``STRETCH`` bytes. Every byte of the text lies
in exactly one stretch; the state starts at zero at the ends of a stretch, so
stretches of all texts run side by side as one array and a very long text costs no more per byte.

Gates use ``x / (1 + |x|)`` as their bounded function (rescaled to 0..1 for the
update and reset gates), which costs a fraction of an exponential.

Defined results: a null text, an empty text and a text without a letter give
``und`` with score 0; ties between languages go to the first by code point;
repeated rows get equal results; with no labelled row to learn from, every text is
``und``. Only ``text`` reaches the network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa.llm.tables import releasing, ship

HIDDEN = 8
STRETCH = 128
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS = 400, 25_600  # bounds of the rows that the network learns from, of one language and of all
SAMPLE_BYTES = 512  # bytes of a sampled row that are learned from, from a seeded place in it
STEPS, BATCH, RATE = 300, 64, 0.02
WIDE = 2048  # stretches that run side by side
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Network:
    """Weights by name, with a forward pass, a backward pass and a document reader.

    For each direction: ``g`` (256, 2H) and ``x`` (256, H) bytes to update and
    reset gate and to candidate, ``u`` (H, 2H) and ``c`` (H, H) the same from the
    state, ``v`` (H, K) state to label; ``b`` (K) is the label's bias. The first axis of all but ``b`` is
    the direction.
    """

    languages: list[str]
    hidden: int = HIDDEN
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int = 7) -> Network:
        rng, h, k = np.random.default_rng(seed), self.hidden, len(self.languages)
        shapes = {"g": (2, 256, 2 * h), "x": (2, 256, h), "u": (2, h, 2 * h), "c": (2, h, h), "v": (2, h, k)}
        self.w = {n: (rng.normal(size=s) * (0.5 if n in "gx" else s[1] ** -0.5)).astype("f4") for n, s in shapes.items()}
        self.w["b"] = np.zeros(k, "f4")
        return self

    def states(self, bytes_: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States (T, N, H) after each byte of ``bytes_`` (T, N) in reading direction ``way``.

        Works in place on a few buffers; ``keep`` gets what the backward pass needs of each step.
        """
        from_byte, into, u, c, h = (*(self.w[n][way] for n in "gxuc"), self.hidden)
        steps, n = bytes_.shape
        out = np.empty((steps, n, h), "f4")
        gate, soft = np.empty((n, 2 * h), "f4"), np.empty((n, 2 * h), "f4")
        new, reset = np.empty((n, h), "f4"), np.empty((n, h), "f4")
        state = np.zeros((n, h), "f4")
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            np.matmul(state, u, out=gate)
            np.take(from_byte, bytes_[t], axis=0, out=soft, mode="clip")
            gate += soft
            np.abs(gate, out=soft)
            soft += 1
            gate /= soft
            gate *= 0.5
            gate += 0.5
            np.multiply(gate[:, h:], state, out=reset)
            np.matmul(reset, c, out=new)
            soft_new = np.take(into, bytes_[t], axis=0, mode="clip")
            new += soft_new
            np.abs(new, out=soft_new)
            soft_new += 1
            new /= soft_new
            if keep is not None:
                keep.append((t, state, soft.copy(), gate.copy(), reset.copy(), soft_new, new.copy()))
            new -= state
            new *= gate[:, :h]
            state = np.add(state, new, out=out[t])
        return out

    def labels(self, bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities (T, N, K) of every position, and the states of both directions."""
        ahead, back = self.states(bytes_, 0), self.states(bytes_, 1)
        return self._label(ahead, back), ahead, back

    def _label(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        k = len(self.languages)
        logits = ahead.reshape(-1, self.hidden) @ self.w["v"][0]
        logits += back.reshape(-1, self.hidden) @ self.w["v"][1]
        logits += self.w["b"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(*ahead.shape[:2], k)

    def gradients(self, bytes_: np.ndarray, inside: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the positions ``inside`` (T, N) a text of language ``truth`` (N), and its gradients through time."""
        kept: list[list] = [[], []]
        ahead, back = self.states(bytes_, 0, kept[0]), self.states(bytes_, 1, kept[1])
        p = self._label(ahead, back)
        total = max(1, inside.sum())
        loss = -float((np.log(np.take_along_axis(p, truth[None, :, None], 2)[:, :, 0] + 1e-9) * inside).sum() / total)
        d = p.copy()
        np.put_along_axis(d, np.broadcast_to(truth[None, :, None], (*d.shape[:2], 1)), np.take_along_axis(p, truth[None, :, None], 2) - 1, 2)
        d *= (inside / total)[:, :, None]
        grads = {n: np.zeros_like(v) for n, v in self.w.items()}
        grads["b"] = d.sum(axis=(0, 1))
        h = self.hidden
        for way, states in ((0, ahead), (1, back)):
            grads["v"][way] = states.reshape(-1, h).T @ d.reshape(-1, d.shape[2])
            into = d @ self.w["v"][way].T
            u, c = self.w["u"][way], self.w["c"][way]
            later = np.zeros_like(into[0])
            for t, state, soft, gate, reset, soft_a, new in reversed(kept[way]):
                g = later + into[t]
                z, r = gate[:, :h], gate[:, h:]
                da = g * z / (soft_a * soft_a)
                dreset = da @ c.T
                dzr = np.concatenate([g * (new - state), dreset * state], axis=1) * 0.5 / (soft * soft)
                later = g * (1 - z) + dreset * r + dzr @ u.T
                grads["u"][way] += state.T @ dzr
                grads["c"][way] += reset.T @ da
                np.add.at(grads["g"][way], bytes_[t], dzr)
                np.add.at(grads["x"][way], bytes_[t], da)
        return loss, grads

    def train(self, texts: list[bytes], truth: list[int], steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
              seed: int = 11) -> Network:
        """Adam over batches with as many texts of each language as the draw gives; seeded."""
        rng = np.random.default_rng(seed)
        by_language = [np.flatnonzero(np.array(truth) == k) for k in range(len(self.languages))]
        mean = {n: np.zeros_like(v) for n, v in self.w.items()}
        square = {n: np.zeros_like(v) for n, v in self.w.items()}
        for step in range(1, steps + 1):
            drawn = [int(rng.choice(by_language[k])) for k in rng.integers(0, len(by_language), batch)]
            starts = [int(rng.integers(0, max(1, len(texts[i]) - STRETCH + 1))) for i in drawn]
            block, inside = stretches([texts[i][s:s + STRETCH] for i, s in zip(drawn, starts, strict=True)])[:2]
            _, grads = self.gradients(block, inside, np.array([truth[i] for i in drawn]))
            now = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
            for n, g in grads.items():
                mean[n] += 0.1 * (g - mean[n])
                square[n] += 0.01 * (g * g - square[n])
                self.w[n] -= (now * mean[n] / (1 - 0.9 ** step) / (np.sqrt(square[n] / (1 - 0.99 ** step)) + 1e-6)).astype("f4")
        return self

    def read(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (documents, K) over all positions of each whole text; zeros for an empty one."""
        block, inside, owner = stretches(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, block.shape[1], WIDE):
            p = self.labels(np.ascontiguousarray(block[:, at:at + WIDE]))[0]
            p *= inside[:, at:at + WIDE, None]
            np.add.at(total, owner[at:at + WIDE], p.sum(axis=0))
        lengths = np.array([len(t) for t in texts])
        return total / np.maximum(1, lengths)[:, None]


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (STRETCH, N) of all texts, which positions are inside a text, and the text of each stretch."""
    counts = np.array([-(-len(t) // STRETCH) for t in texts], dtype=np.int64)
    block = np.frombuffer(b"".join(t.ljust(n * STRETCH, b"\0") for t, n in zip(texts, counts.tolist(), strict=True)), np.uint8)
    block = block.reshape(-1, STRETCH).T
    left = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    inside = np.arange(STRETCH)[:, None] < np.minimum(STRETCH, left[owner] - nth * STRETCH)[None, :]
    return block, inside.astype("f4"), owner


def fit(rows: DataFrame) -> Network:
    """Network learned from ``rows`` (doc_id, text, lang) that are not held out and have a language.

    Every language is learned: ``SAMPLE_PER_LANGUAGE`` rows of each at most, fewer (at least one) where there are so many
    languages that these were more than ``SAMPLE_ROWS``; those with the smallest hash of their id; ``SAMPLE_BYTES`` of each.
    """
    known = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = known.groupBy("lang").count().collect()  # a row per language
    languages = sorted(r["lang"] for r in counts)
    network = Network(languages)
    if not languages:
        return network
    # A hash threshold leaves some hundreds of rows per language before any row is ranked.
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // len(languages)))
    share = {r["lang"]: (2 * each + 60) / r["count"] for r in counts if r["count"] > 4 * each + 120}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    every = F.lit(float(1 << 30))
    cut = every
    if share:
        cuts = F.create_map(*[F.lit(v) for lang, part in share.items() for v in (lang, part * (1 << 30))])
        cut = F.coalesce(F.element_at(cuts, F.col("lang")), every)
    chars = F.length("text")
    start = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), chars - SAMPLE_BYTES + 1)) + 1
    part = F.col("text").substr(start.cast("int"), F.lit(SAMPLE_BYTES))
    picked = known.where(draw < cut).select("lang", draw.alias("d"), part.alias("t"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("d", "t"))
    sample = picked.withColumn("n", rank).where(F.col("n") <= each).orderBy("lang", "n").collect()
    texts = [r.t.encode()[:SAMPLE_BYTES] for r in sample]
    return network.start().train(texts, [languages.index(r.lang) for r in sample])


def _lettered(text: str | None) -> bytes:
    """The bytes of a text that has a letter, else none."""
    return text.encode() if text and any(map(str.isalpha, text)) else b""


def _scores(model: Network, column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN])
        for batch in batches:
            values = batch.column(column)
            at = 0
            while at < len(batch):
                texts, held = [], 0
                while at + len(texts) < len(batch) and held < 1_000_000:
                    texts.append(_lettered(values[at + len(texts)].as_py()))
                    held += len(texts[-1])
                best, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
                if model.languages:
                    p = np.round(model.read(texts), 5)  # the last digits depend on what is read together
                    some = p.sum(axis=1) > 0
                    best[some], score[some] = p[some].argmax(axis=1), np.clip(p[some].max(axis=1), 0, 1)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                                                 names=[*part.schema.names, "lang_pred", "score"])
                at += len(texts)

    return predict


def predict(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (columns of these names are replaced); other columns pass through."""
    ship(df.sparkSession)
    df = df.drop("lang_pred", "score")
    fields = [*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return df.mapInArrow(releasing(_scores(network, text)), T.StructType(fields))
