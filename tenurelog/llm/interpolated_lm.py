"""Scores of texts under a bigram model by deleted interpolation.

``P(w | v) = l2 c(vw) / c(v) + l1 c(w) / N + l0 / (V + 1)``; the three weights
depend on the bucket ``1 + floor(log2 c(v))`` of the context (0 if it is unseen, then l2
is 0) and are learned by expectation-maximisation on held-out counts: those of all
training documents, each with the document itself deleted from all counts. The context
of a first word is a mark that is counted once per training document.

How the counts meet the texts. Documents are packed into blocks of a few MB, which
are written once. Every block sends each of its distinct words and word pairs once,
with their counts in its training documents, to the shard that owns them by hash;
the shard adds up what all blocks sent and answers each block with the totals, in
the order of its question. A message is a sorted list of hashes as differences,
compressed. So the shuffle carries each distinct n-gram of a block once, whatever
its frequency, and no word, however common, makes a task large; with very many
shards a message shrinks to single n-grams, which is an ordinary shuffle by n-gram.
No part of the model is collected or broadcast except the weights.

Words are known by 64 bits, pairs by 52.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .workspace import ID, TEXT, Workspace, ship, small_batches

BLOCK = 6 << 20
SHARD_BYTES = 16 << 20  # text per shard
PAIR_BITS = 52
BUCKETS = 48
GRID = 4  # steps per octave in the held-out counts
ZERO = 255  # a probability of 0 in them
ROUNDS = 100

U64 = np.uint64
START, END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)  # marks, not hashes of words


# -- packing ---------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in tk.slices(batches, TEXT, BLOCK // 8):
        held.append(batch)
        size += batch.column(TEXT).nbytes
        if size >= BLOCK:
            yield _packed(part, held)
            part, held, size = part + 1, [], 0
    if held:
        yield _packed(part, held)


def _packed(part: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for batch in batches:
            out.write_batch(batch)
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["part", "block"])


def _open(block: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(block).read_all().combine_chunks().to_batches()[0]


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed planes of bytes."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U64(0)))


def unpack_sorted(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(packed, n, U64), dtype=U64)


# -- n-grams ---------------------------------------------------------------


class Grams:
    """The tokens of the texts of a block: each text's words and one end."""

    def __init__(self, column: pa.Array):
        data, offsets = tk.bytes_of(column)
        data = tk.LOWER[data]
        starts, ends, text = tk.spans(data, offsets, tk.VISIBLE)
        count = len(column)
        number = np.diff(tk.first_of_each(text, count)) + 1
        self.last = np.cumsum(number) - 1
        self.first = self.last - number + 1
        self.text = np.repeat(np.arange(count), number)
        self.token = np.full(len(self.text), END, U64)
        self.token[np.arange(len(starts)) + text] = tk.span_hashes(data, starts, ends)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.first] = START
        self.pair = tk.mix(before * U64(0x9E3779B97F4A7C15) + self.token * U64(0xC2B2AE3D27D4EB4F)) >> U64(64 - PAIR_BITS)
        self.words, self.word = np.unique(self.token, return_inverse=True)
        self.pairs, self.pair = np.unique(self.pair, return_inverse=True)

    def context(self, by_token: np.ndarray, ends: float) -> np.ndarray:
        """The same counts for the token before; the mark of a start is counted like an end."""
        out = np.empty_like(by_token)
        out[1:] = by_token[:-1]
        out[self.first] = ends
        return out


def _shard(keys: np.ndarray, bits: int, shards: int) -> np.ndarray:
    return ((keys >> U64(bits - 24)) * U64(shards)) >> U64(24)


ASK = "shard bigint, part bigint, n_words int, words binary, word_counts binary, n_pairs int, pairs binary, pair_counts binary"
ANSWER = "part bigint, shard bigint, n_words int, word_counts binary, n_pairs int, pair_counts binary, tokens bigint, distinct bigint"


def _arrow(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _ask(shards: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, block in _rows(batches):
        batch = _open(block)
        grams = Grams(batch.column(TEXT))
        train = batch.column("train").to_numpy(zero_copy_only=False)[grams.text].astype(float)
        found = []
        for keys, which, bits in ((grams.words, grams.word, 64), (grams.pairs, grams.pair, PAIR_BITS)):
            counts = np.bincount(which, train, minlength=len(keys)).astype(np.uint32)
            found.append((keys, counts, np.searchsorted(_shard(keys, bits, shards), np.arange(shards + 1))))
        (words, word_n, w), (pairs, pair_n, p) = found
        rows = []
        for s in np.flatnonzero((np.diff(w) > 0) | (np.diff(p) > 0)).tolist():
            a, b, c, d = (int(x) for x in (w[s], w[s + 1], p[s], p[s + 1]))
            rows.append((s, part, b - a, pack_sorted(words[a:b]), pack(word_n[a:b]), d - c, pack_sorted(pairs[c:d]), pack(pair_n[c:d])))
        yield _arrow(ASK, rows)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("part")[i].as_py(), batch.column("block")[i].as_py()


def _answer(table: pa.Table) -> pa.Table:
    """The totals of one shard, for each block in the order it asked."""
    rows = table.to_pylist()
    replies, stats = [], (0, 0)
    for key, count in (("words", "word_counts"), ("pairs", "pair_counts")):
        sizes = [r[f"n_{key}"] for r in rows]
        keys = np.concatenate([unpack_sorted(r[key], n) for r, n in zip(rows, sizes)])
        counts = np.concatenate([unpack(r[count], n, np.uint32) for r, n in zip(rows, sizes)])
        distinct, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts, minlength=len(distinct))
        if key == "words":
            stats = (int(total.sum()), int((total > 0).sum()))
        given = total[which].astype(np.uint64)
        cut = np.cumsum([0, *sizes])
        replies.append([pack(given[a:b]) for a, b in zip(cut[:-1], cut[1:])])
    shard = rows[0]["shard"]
    out = [(r["part"], shard, r["n_words"], w, r["n_pairs"], p, 0, 0) for r, w, p in zip(rows, *replies)]
    out.append((-1, shard, 0, b"", 0, b"", *stats))
    return pa.Table.from_batches([_arrow(ANSWER, out)])


def _counts(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The totals of a block's words and pairs."""
    rows = sorted(answers.select(["shard", "n_words", "word_counts", "n_pairs", "pair_counts"]).to_pylist(), key=lambda r: r["shard"])
    words = [unpack(r["word_counts"], r["n_words"], U64) for r in rows]
    pairs = [unpack(r["pair_counts"], r["n_pairs"], U64) for r in rows]
    return np.concatenate(words).astype(float), np.concatenate(pairs).astype(float)


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))).astype(int), 0).clip(0, BUCKETS - 1)


# -- weights ---------------------------------------------------------------


def _held_out(tokens: int, ends: int, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Held-out counts of (bucket, pair probability, word probability), each document deleted from the totals."""
    batch = _open(blocks.column("block")[0].as_py())
    grams = Grams(batch.column(TEXT))
    word_n, pair_n = _counts(answers)
    train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)

    def own(which: np.ndarray, distinct: int) -> np.ndarray:
        """How often each token's n-gram stands in its own text."""
        _, at, n = np.unique(grams.text * distinct + which, return_inverse=True, return_counts=True)
        return n[at]

    own_word = own(grams.word, len(grams.words))
    word = word_n[grams.word] - own_word
    pair = pair_n[grams.pair] - own(grams.pair, len(grams.pairs))
    context = grams.context(word, ends - 1)
    length = np.diff(np.append(grams.first, len(grams.text)))[grams.text]
    rest = np.maximum(tokens - length, 1)
    use = train[grams.text]
    cell = (bucket_of(context) << 16) | (_step(pair, context) << 8) | _step(word, rest)
    found, n = np.unique(cell[use], return_counts=True)
    return pa.table({"cell": pa.array(found.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


def _step(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The probability on a logarithmic grid; ZERO for 0."""
    share = np.divide(count, total, out=np.zeros(len(count)), where=total > 0)
    seen = share > 0
    out = np.full(len(count), ZERO)
    out[seen] = np.rint(-GRID * np.log2(share[seen])).clip(0, ZERO - 1).astype(int)
    return out


def learn_weights(cells: dict[int, int], distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """(bucket, [l2, l1, l0]) by expectation-maximisation; an unused bucket takes after the one below."""
    weights = np.zeros((BUCKETS, 3))
    key, n = np.array(list(cells), np.int64), np.array(list(cells.values()), float)
    value = np.where(np.arange(256) == ZERO, 0.0, 2.0 ** (-np.arange(256) / GRID))
    before = np.array([0.0, 0.9, 0.1])
    for bucket in range(BUCKETS):
        mine = (key >> 16) == bucket if len(key) else np.zeros(0, bool)
        if mine.any():
            p = np.stack([value[(key[mine] >> 8) & 255], value[key[mine] & 255], np.full(mine.sum(), 1 / (distinct + 1))], axis=1)
            w = np.array([0.0, 0.5, 0.5]) if bucket == 0 else np.full(3, 1 / 3)
            for _ in range(rounds):
                share = p * w
                share *= (n[mine] / np.maximum(share.sum(axis=1), 1e-300))[:, None]
                w = share.sum(axis=0) / n[mine].sum()
            w = np.maximum(w, [0 if bucket == 0 else 1e-6, 1e-6, 1e-6])
            before = w / w.sum()
        elif bucket == 1:
            before = np.array([0.4, 0.5, 0.1])
        weights[bucket] = before
    return weights


# -- scores ----------------------------------------------------------------

SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def _score(tokens: int, distinct: int, ends: int, weights: np.ndarray, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    batch = _open(blocks.column("block")[0].as_py())
    grams = Grams(batch.column(TEXT))
    word_n, pair_n = _counts(answers)
    word, pair = word_n[grams.word], pair_n[grams.pair]
    context = grams.context(word, ends)
    base = np.log10((word + 0.1) / (tokens + 0.1 * (distinct + 1)))
    w = weights[bucket_of(context)]
    p = w[:, 0] * np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
    p += w[:, 1] * word / max(tokens, 1) + w[:, 2] / (distinct + 1)
    rows = batch.num_rows

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.bincount(grams.text, x, minlength=rows)

    return pa.table(
        {
            ID: batch.column(ID),
            "n_tokens": pa.array(np.bincount(grams.text, minlength=rows).astype(np.int64)),
            "n_known": pa.array(per_text(word > 0).astype(np.int64)),
            "base_score": pa.array(per_text(base)),
            "score": pa.array(per_text(np.log10(p))),
        }
    )


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``train`` says which documents are learned from (NULL: not). Tokens are the
    words, A-Z in lower case, that blanks and the control characters 9 to 13
    separate, and one end per text. ``n_known`` counts tokens seen in training and
    ``train_tokens`` all training tokens. ``base_score`` is the sum of
    ``log10((c + 0.1) / (N + 0.1 (V + 1)))``, ``score`` the sum of ``log10 P``.

    A NULL text counts as empty; an empty text has one token. Without training
    documents every probability is uniform. Repeated rows are counted and returned
    each; NULL ids are kept; other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    work = Workspace(spark, "lm")
    base = docs.select(
        F.col(f"`{id_col}`").alias(ID), F.col(f"`{text_col}`").cast("string").alias(TEXT), F.coalesce(train, F.lit(False)).alias("train")
    )
    kind = base.schema[ID].dataType.simpleString()
    size, ends = base.agg(F.sum(F.octet_length(TEXT)), F.count_if("train")).first()
    shards = min(1 << 20, 1 + (size or 0) // SHARD_BYTES)
    blocks = work.write(base.mapInArrow(_blocks, "part bigint, block binary"), "blocks")
    asked = blocks.mapInArrow(partial(_ask, int(shards)), ASK)
    answers = work.write(asked.groupBy("shard").applyInArrow(_answer, ANSWER), "answers")
    tokens, distinct = answers.where("part = -1").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct, ends = int(tokens or 0), int(distinct or 0), int(ends or 0)
    answers = answers.where("part >= 0")

    cells = blocks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(partial(_held_out, tokens, ends), "cell bigint, n bigint")
    # At most BUCKETS * 256 * 256 cells, however large the corpus.
    weights = learn_weights({r[0]: r[1] for r in cells.groupBy("cell").agg(F.sum("n")).collect()}, distinct)

    scored = blocks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        partial(_score, tokens, distinct, ends, weights), f"{ID} {kind}, {SCORES}"
    )
    return scored.select(F.col(ID).alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
