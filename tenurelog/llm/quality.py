"""Quality classifier: random-indexing word vectors, pooled, and a calibrated two-layer network.

Random indexing: every token has a sparse random index vector that its hash
determines, and its word vector is the sum of the index vectors of the tokens up
to ``REACH`` places around its occurrences in all documents, labelled or not. Word
vectors are kept for ``2**BUCKET_BITS`` hash buckets of tokens, a fixed size; they are
whole numbers until they get unit length, so the order of the sums does not matter. A
document is the mean of the word vectors of all its tokens, the mean of those of its
distinct tokens, and its length. A network with one hidden layer gives the odds, and
one temperature, fitted on texts that the network has not seen, turns them into
probabilities.

Tokens are words of letters and digits in lower case, runs of other visible
characters, and marks that stand for words in capitals, for numbers and for a
token that repeats the one before it.

The network is fitted on at most ``SAMPLE`` labelled documents per label, those with
the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import partial
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .interpolated_lm import pack, unpack
from .nets import Adam, sigmoid
from .workspace import ID, TEXT, kept_schema, restored, sample_of_each, texts

SAMPLE = 2000
BUCKET_BITS = 15
SIZE, ONES, REACH = 64, 6, 2
PART_BYTES = 1 << 20
SUM_BLOCK = 1 << 17  # numbers of the table that travel together
STRETCH = 1 << 15  # tokens whose vectors are laid out at once
HIDDEN, EPOCHS, BATCH, RATE = 24, 60, 64, 0.01

U64 = np.uint64
CAPITALS, NUMBER, AGAIN = U64(0x51), U64(0x52), U64(0x53)  # marks for kinds of words
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = tk.VISIBLE & ~tk.WORD


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each token, in the order of the text."""
    starts, ends, text = tk.spans(data, offsets, tk.WORD)
    hashed = tk.span_hashes(tk.LOWER[data], starts, ends)
    size = ends - starts
    for member, mark in ((_UPPER, CAPITALS), (_DIGIT, NUMBER)):
        inside = np.concatenate([[0], np.cumsum(member[data])])
        whole = (inside[ends] - inside[starts] == size) & (size > 1)
        hashed[whole] = mark
    sign_starts, sign_ends, sign_text = tk.spans(data, offsets, _SIGN)
    signs = tk.span_hashes(data, sign_starts, sign_ends)
    order = np.argsort(np.concatenate([starts, sign_starts]), kind="stable")
    token, text = np.concatenate([hashed, signs])[order], np.concatenate([text, sign_text])[order]
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (text[1:] == text[:-1])
    return np.where(again, AGAIN, token), text


def _bucket(token: np.ndarray) -> np.ndarray:
    return (tk.mix(token + U64(11)) >> U64(64 - BUCKET_BITS)).astype(np.int64)


Part = tuple[np.ndarray, np.ndarray, int]  # token, text number, number of texts


def token_parts(texts_: list[str]) -> Iterator[Part]:
    """The tokens of a list of texts, a few MB at a time, so that what is made of them stays small."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts_, pa.string())], [TEXT])
    for part in tk.slices([batch], TEXT, PART_BYTES):
        yield (*tokens_of(*tk.bytes_of(part.column(0))), part.num_rows)


def add_neighbours(total: np.ndarray, token: np.ndarray, text: np.ndarray) -> None:
    """Add the index vectors around each token to the sums of its bucket; ``total`` has all buckets end to end."""
    for first in range(0, len(token), STRETCH):
        here, home = token[first : first + STRETCH + REACH], text[first : first + STRETCH + REACH]
        row, pairs = _bucket(here) * SIZE, []
        for step in range(1, REACH + 1):
            left = np.flatnonzero(home[step:] == home[:-step])
            left = left[left < STRETCH]  # later ones belong to the next stretch
            pairs += [(row[left + step], left), (row[left], left + step)]
        for one in range(ONES):
            draw = tk.mix(here ^ U64(0x9E3779B97F4A7C15 * (one + 1) & 0xFFFFFFFFFFFFFFFF))
            place, sign = (draw >> U64(8)).astype(np.int64) % SIZE, 1 - 2 * (draw & U64(1)).astype(np.int64)
            for word, near in pairs:
                np.add.at(total, word + place[near], sign[near])


@tk.freed
def _sums_of_partition(fan_in: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE << BUCKET_BITS, np.int64)
    for batch in tk.slices(batches, TEXT, PART_BYTES):
        add_neighbours(total, *tokens_of(*tk.bytes_of(batch.column(TEXT))))
    group = TaskContext.get().partitionId() // fan_in
    for block in range(0, len(total), SUM_BLOCK):
        part = total[block : block + SUM_BLOCK]
        if part.any():
            columns = [pa.array([block // SUM_BLOCK]), pa.array([group]), pa.array([_packed(part)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "part", "sums"])


def _packed(sums: np.ndarray) -> bytes:
    return pack((sums << 1) ^ (sums >> 63))  # the sign as the last bit, so that high bytes are 0


def _unpacked(packed: bytes) -> np.ndarray:
    folded = unpack(packed, SUM_BLOCK, np.int64)
    return (folded >> 1) ^ -(folded & 1)


def _sum_blocks(key: tuple, table: pa.Table) -> pa.Table:
    total = np.zeros(SUM_BLOCK, np.int64)
    for packed in table.column("sums"):
        total += _unpacked(packed.as_py())
    columns = {"block": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([0], pa.int64())}
    return pa.table({**columns, "sums": pa.array([_packed(total)], pa.binary())})


def word_vectors(base: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets from all texts of a corpus.

    Partial sums are added in two steps of the square root of the number of
    partitions; the result has a fixed size.
    """
    schema = "block bigint, part bigint, sums binary"
    fan_in = ceil(sqrt(base.rdd.getNumPartitions() or 1))
    sums = base.select(TEXT).mapInArrow(partial(_sums_of_partition, fan_in), schema)
    for keys in (("block", "part"), ("block",)):
        sums = sums.groupBy(*keys).applyInArrow(_sum_blocks, schema)
    table = np.zeros((1 << BUCKET_BITS, SIZE), np.float32)
    rows = SUM_BLOCK // SIZE
    for row in sums.select("block", "sums").collect():  # a constant number of constant size
        block = _unpacked(bytes(row[1])).reshape(-1, SIZE).astype(float)  # one at a time: the driver's memory is small
        table[row[0] * rows : (row[0] + 1) * rows] = block / np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)
    return table


def pooled(vectors: np.ndarray, token: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    """The features of each text."""
    row = _bucket(token)
    out = np.zeros((count, 2 * SIZE + 1), np.float32)
    pair = np.unique(text * len(vectors) + row)
    for at, (rows, home) in enumerate(((row, text), (pair % len(vectors), pair // len(vectors)))):
        number = np.bincount(home, minlength=count)
        sums = np.zeros((count, SIZE))
        for first in range(0, len(rows), STRETCH):
            near, own = rows[first : first + STRETCH], home[first : first + STRETCH]
            begin = np.flatnonzero(np.diff(own, prepend=-1))
            sums[own[begin]] += np.add.reduceat(vectors[near], begin, axis=0)
        out[:, at * SIZE : (at + 1) * SIZE] = sums / np.maximum(number, 1)[:, None]
    out[:, -1] = np.log1p(np.bincount(text, minlength=count)) / 8
    return out


class QualityNet:
    """Vectors, two layers and a temperature."""

    def __init__(self, vectors: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = 2 * SIZE + 1
        self.vectors, self.temperature = vectors, 1.0
        self.mean, self.spread = np.zeros(n, np.float32), np.ones(n, np.float32)
        self.w = {
            "in": (rng.standard_normal((n, HIDDEN)) / np.sqrt(n)).astype(np.float32),
            "in_b": np.zeros(HIDDEN, np.float32),
            "out": (rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32),
            "out_b": np.zeros(1, np.float32),
        }

    def odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.spread @ self.w["in"] + self.w["in_b"])
        return hidden @ self.w["out"] + self.w["out_b"][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.odds(x).astype(float) / self.temperature)

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        held = order[: len(x) // 5] if len(x) >= 20 else order
        rest = order[len(x) // 5 :] if len(x) >= 20 else order
        self.mean, self.spread = x[rest].mean(axis=0), x[rest].std(axis=0) + 1e-3
        adam, steps = Adam(self.w, RATE), 0
        total = EPOCHS * -(-len(rest) // BATCH)
        for _ in range(EPOCHS):
            shuffled = rng.permutation(rest)
            for first in range(0, len(shuffled), BATCH):
                pick = shuffled[first : first + BATCH]
                adam.rate, steps = RATE * (1 - 0.95 * steps / total), steps + 1
                adam.update(self._gradients((x[pick] - self.mean) / self.spread, y[pick]))
        self.temperature = self._calibrate(self.odds(x[held]).astype(float), y[held])

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        hidden = np.tanh(x @ self.w["in"] + self.w["in_b"])
        wrong = ((sigmoid(hidden @ self.w["out"] + self.w["out_b"][0]) - y) / len(y)).astype(np.float32)
        back = np.outer(wrong, self.w["out"]) * (1 - hidden * hidden)
        return {
            "in": x.T @ back + 1e-3 * self.w["in"],
            "in_b": back.sum(axis=0),
            "out": hidden.T @ wrong + 1e-3 * self.w["out"],
            "out_b": np.array([wrong.sum()], np.float32),
        }

    @staticmethod
    def _calibrate(odds: np.ndarray, y: np.ndarray) -> float:
        """The temperature with the smallest loss on held-out texts."""

        def loss(t: float) -> float:
            p = np.clip(sigmoid(odds / t), 1e-6, 1 - 1e-6)
            return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

        return min(np.geomspace(0.25, 8, 141), key=loss)


def train(vectors: np.ndarray, sample: list[tuple[str, int]]) -> QualityNet:
    """A network from word vectors and (text, label) pairs; without both labels it says their share everywhere."""
    texts_ = [t for t, _ in sample]
    net = QualityNet(vectors)
    y = np.array([q for _, q in sample], float)
    if len(set(y.tolist())) == 2:
        net.fit(np.concatenate([pooled(net.vectors, *part) for part in token_parts(texts_)]), y)
    else:
        for name in ("out", "in"):
            net.w[name][:] = 0
        net.w["out_b"][0] = 0.0 if not len(y) else (2.0 if y[0] else -2.0)
    return net


@tk.freed
def _score(net_of, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    net: QualityNet = net_of.value
    for batch in tk.slices(batches, TEXT):
        token, text = tokens_of(*tk.bytes_of(batch.column(TEXT)))
        # rounded, as the last bits depend on what else is in the batch
        p = np.round(net.probability(pooled(net.vectors, token, text, batch.num_rows)), 6)
        passed = [n for n in batch.schema.names if n != TEXT]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in passed], pa.array(p)], [*passed, "score"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> QualityNet:
    """A classifier from ``labels`` (id and 0 or 1) and the texts of ``docs``; NULLs are left out.

    The word vectors are those of all ``docs``; of the labelled ones at most ``sample`` per label train the network.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("_label_id"), F.col(f"`{label_col}`").cast("int").alias("_label"))
    known = known.where("_label_id IS NOT NULL AND _label IN (0, 1)")
    chosen = sample_of_each(known, "_label", "_label_id", sample)
    # At most 2 * sample rows, so they go to the documents and not the other way round.
    base = texts(docs, id_col, text_col).where(f"{TEXT} IS NOT NULL")
    found = base.join(F.broadcast(chosen), F.col(ID) == F.col("_label_id")).groupBy("_label_id", "_label").agg(F.min(TEXT).alias(TEXT))
    vectors = word_vectors(base)
    tk.release()
    net = train(vectors, sorted((r[0], r[1]) for r in found.select(TEXT, "_label").collect()))
    tk.release()  # the driver tokenised the sample; later stages need its memory
    return net


def score_quality(docs: DataFrame, net: QualityNet, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, or the columns ``keep``, and ``score``, the probability of label 1.

    A NULL text counts as empty; an empty text has a score like any other. Only
    the text decides. Repeated rows come out alike; columns that are not kept are
    ignored; an empty table gives an empty result.
    """
    base = texts(docs, id_col, text_col, keep)
    net_of = docs.sparkSession.sparkContext.broadcast(net)
    return restored(base.mapInArrow(partial(_score, net_of), f"{kept_schema(base)}, score double"), id_col, keep)
