"""Byte-level BPE with content-defined chunk reuse.

A rolling hash over the last few bytes cuts every text into chunks, of ``MASK + 1``
bytes on average. The cuts depend on the content alone, so a passage gives the same
chunks in every document, and each distinct chunk is encoded once and looked up
after that.

Encoding chunks one by one is not the same as encoding the text: BPE may merge
across a join. The pre-tokenizer splits a text for certain before a single blank
between two visible ASCII characters; such a place is called firm. At each join a
window is encoded anew, from the last firm place before the join to the first one
behind it, and on both sides one stretch farther, to the next firm place. In these
stretches its ids must be exactly those of the chunk alone. If they are, the window's
ids take the place of the chunks' own between the two; if not, the window grows by
one firm place on each side, until they agree or the text is encoded whole. Chunks
with too few firm places are joined before they are encoded. Every text is then
decoded and compared with the original as well.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .bpe_words import ByteBpe, firm_places, require_byte_level
from .workspace import ID, TEXT, texts

ROLL = 4  # bytes the rolling hash looks at
MASK = 511  # a cut at one in MASK + 1 positions on average
CACHE_BYTES = 32 << 20  # of chunks and their ids that a worker remembers; beyond that it starts over

_loaded: dict[str, Encoder] = {}

Coded = tuple[np.ndarray, list[int]]  # ids, and where each ends


class Encoder(ByteBpe):
    """With the chunks encoded so far."""

    def __init__(self, definition: str):
        super().__init__(definition)
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[bytes, Coded] = {}
        self.held = 0

    def code(self, piece: bytes) -> Coded:
        ids = np.array(self.encode_plain(piece.decode()), np.int64)
        return ids.astype(np.uint32), np.cumsum(self.byte_at[ids + 1] - self.byte_at[ids]).tolist()

    def chunk(self, piece: bytes) -> Coded:
        """Each distinct chunk is encoded once."""
        found = self.chunks.get(piece)
        if found is None:
            found = self.code(piece)
            self.held += len(piece) + 16 * len(found[1])
            if self.held > CACHE_BYTES:
                self.forget()
            self.chunks[piece] = found
        return found


def chunk_cuts(data: np.ndarray, offsets: np.ndarray, mask: int | None = None) -> np.ndarray:
    """Where chunks begin: at each text, and at a character where the hash of the bytes before says so."""
    rolled = np.zeros(len(data) + 1, np.uint64)
    for back in range(ROLL):
        step = data.astype(np.uint64) * np.uint64(pow(0x100000001B3, back + 1, 1 << 64))
        rolled[back + 1 :] += step[: len(data) - back]
    cut = (tk.mix(rolled) & np.uint64(MASK if mask is None else mask)) == 0
    cut[:-1] &= (data & 0xC0) != 0x80
    for back in range(ROLL):  # a hash that reaches into the text before does not count
        cut[np.minimum(offsets + back, len(data))] = False
    cut[offsets] = True
    cut[len(data)] = False
    return np.flatnonzero(cut)


def joined_chunks(cuts: list[int], firm: list[int], end: int) -> list[int]:
    """The cuts of one text that leave at least two firm places inside each chunk."""
    kept = [cuts[0]]
    for cut in cuts[1:]:
        if bisect_left(firm, cut) - bisect_right(firm, kept[-1]) >= 2:
            kept.append(cut)
    if len(kept) > 1 and bisect_left(firm, end) - bisect_right(firm, kept[-1]) < 2:
        kept.pop()
    return kept


def _between(coded: Coded, start: int, low: int, high: int) -> np.ndarray | None:
    """The ids of a piece that begins at ``start`` from ``low`` to ``high``; None if one lies across."""
    ids, ends = coded
    first = 0 if low == start else bisect_left(ends, low - start) + 1
    last = 0 if high == start else bisect_left(ends, high - start) + 1
    for place, n in ((low, first), (high, last)):
        if place != start and (n > len(ends) or ends[n - 1] != place - start):
            return None
    return ids[first:last]


def encode_text(enc: Encoder, text: bytes, cuts: list[int], firm: list[int]) -> list[np.ndarray]:
    """The ids of one text in parts; ``cuts`` and ``firm`` are places in it, beginning with 0."""
    starts = joined_chunks(cuts, firm, len(text))
    if len(starts) == 1:
        return [enc.chunk(text)[0]]
    ends = [*starts[1:], len(text)]
    coded = [enc.chunk(text[a:b]) for a, b in zip(starts, ends)]
    out, done = [], 0  # ids so far, and where they end
    for k in range(len(starts) - 1):
        left, right = (firm[bisect_right(firm, a) : bisect_left(firm, b)] for a, b in zip(starts[k : k + 2], ends[k : k + 2]))
        for grown in range(min(len(left), len(right)) - 1):
            low2, low, high, high2 = left[-2 - grown], left[-1 - grown], right[grown], right[grown + 1]
            if low < done:
                return [enc.code(text)[0]]
            window = enc.code(text[low2:high2])
            before, after = _between(window, low2, low2, low), _between(window, low2, high, high2)
            own_before, own_after = _between(coded[k], starts[k], low2, low), _between(coded[k + 1], starts[k + 1], high, high2)
            agreed = all(x is not None for x in (before, after, own_before, own_after)) and (
                np.array_equal(before, own_before) and np.array_equal(after, own_after)
            )
            kept = _between(coded[k], starts[k], done, low) if agreed else None
            inner = _between(window, low2, low, high) if agreed else None
            if kept is not None and inner is not None:
                out += [kept, inner]
                done = high
                break
        else:
            return [enc.code(text)[0]]
    rest = _between(coded[-1], starts[-1], done, len(text))
    return [*out, rest] if rest is not None else [enc.code(text)[0]]


def _encoder(definition) -> Encoder:
    text = definition.value
    if text not in _loaded:
        _loaded.clear()
        _loaded[text] = Encoder(text)
    return _loaded[text]


def encode_bytes(enc: Encoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, and where each text's ids begin."""
    blob, cuts, firm = data.tobytes(), chunk_cuts(data, offsets), np.flatnonzero(firm_places(data, offsets))
    at_cut, at_firm = np.searchsorted(cuts, offsets), np.searchsorted(firm, offsets)
    parts: list[np.ndarray] = []
    n = np.zeros(len(offsets), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b > a:
            own = encode_text(
                enc, blob[a:b], (cuts[at_cut[i] : at_cut[i + 1]] - a).tolist(), (firm[at_firm[i] : at_firm[i + 1]] - a).tolist()
            )
            n[i + 1] = sum(map(len, own))
            parts += own
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return ids, np.cumsum(n)


def _run(definition, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = _encoder(definition)
    for batch in tk.slices(batches, TEXT):
        data, offsets = tk.bytes_of(batch.column(TEXT))
        ids, at = encode_bytes(enc, data, offsets)
        back = enc.decode(ids)
        if not np.array_equal(back, data):
            ids, at, back, offsets = _whole(enc, data, offsets)
        out_ids = pa.Array.from_buffers(
            pa.binary(), batch.num_rows, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4").tobytes())]
        )
        out_text = pa.Array.from_buffers(
            pa.string(), batch.num_rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(back.tobytes())]
        )
        yield pa.RecordBatch.from_arrays([batch.column(ID), pa.array(np.diff(at)), out_ids, out_text], [ID, "n_tokens", "ids", "decoded"])


def _whole(enc: Encoder, data: np.ndarray, offsets: np.ndarray):
    """The library's own way, for texts whose ids do not stand for their bytes."""
    blob = data.tobytes()
    text = [blob[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    coded = [e.ids for e in enc.library.encode_batch(text, add_special_tokens=False)]
    at = np.cumsum([0, *map(len, coded)])
    back = [enc.library.decode(ids, skip_special_tokens=False).encode() for ids in coded]
    flat = np.array([i for ids in coded for i in ids], np.uint32)
    return flat, at, np.frombuffer(b"".join(back), np.uint8), np.cumsum([0, *map(len, back)])


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_tokens``, ``ids`` and ``decoded``.

    ``vocabulary`` is the path of a byte-level BPE in the JSON form of the
    tokenizers library, read on the driver; a definition of another kind, or with
    another pre-tokenizer, raises ValueError before any work. ``ids`` is binary: unsigned 32-bit
    little-endian integers, as the library gives them for the whole text
    without added special tokens; ``decoded`` is their text. A NULL text counts
    as empty; an empty text has no ids. Rows are independent of one another, so
    repeated rows and other columns change nothing, and an empty table gives an
    empty result.
    """
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    require_byte_level(text)
    definition = docs.sparkSession.sparkContext.broadcast(text)
    base = texts(docs, id_col, text_col)
    kind = base.schema[ID].dataType.simpleString()
    return base.mapInArrow(
        partial(_run, definition), f"{ID} {kind}, n_tokens bigint, ids binary, decoded string"
    ).withColumnRenamed(ID, id_col)
