"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of ``window`` words of an item, or the whole item if it is
shorter. Every window is a set of shingles. A text can only contain the window
whole if it contains each of its shingles, so one shingle is a necessary prefix
of that set; the rarest in the documents makes the fewest candidates. The join
runs on that shingle alone. Length and positional bounds then place the window
in the text (it must begin and end inside it), and the words themselves are
compared, so the result is exact.

Documents are scanned twice, once to count the shingles of the windows and once
to join; neither scan shuffles a text. The windows go to the tasks in blocks of
at most ``block_bytes`` of item text, whose number follows the items: that is
the bound of what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .workspace import ID, TEXT, Workspace, kept_schema, restored, texts

SHINGLE = 3
WINDOW = 10
BLOCK_BYTES = 8 << 20
MAP = 1 << 16


class Windows:
    """The windows of a block of items, ready to be joined.

    ``word_at[w]`` is where window w begins in ``word`` (hashes) and ``raw``
    (the words themselves).
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        column = pa.array([text for _, text in items], pa.string())
        data, starts, ends, text, self.word = tk.words(*tk.bytes_of(column))
        blob = data.tobytes()
        self.raw = [blob[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        bounds = tk.first_of_each(text, len(items))
        at, length, item = [], [], []
        for i, (name, _) in enumerate(items):
            n = int(bounds[i + 1] - bounds[i])
            for first in range(max(1, n - window + 1) if n else 0):
                at.append(int(bounds[i]) + first)
                length.append(min(n, window))
                item.append(number[name])
        self.word_at, self.length = np.array(at, np.int64), np.array(length, np.int64)
        self.item = np.array(item, np.int64)
        # every shingle of every window: hash, window, offset within the window
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(1, SHINGLE + 1):
            chosen = np.flatnonzero(np.minimum(self.length, SHINGLE) == k)
            if len(chosen):
                hashed, _ = tk.shingles(self.word, np.zeros(len(self.word), np.int64), k)
                per = self.length[chosen] - k + 1
                window_of = np.repeat(chosen, per)
                offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
                found.append((hashed[self.word_at[window_of] + offset], window_of, offset))
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.hash, self.of, self.offset = (np.concatenate(x) for x in zip(*(found or [empty])))
        self.sizes = sorted(set(np.minimum(self.length, SHINGLE).tolist()))

    def prefixes(self, counts: dict[int, int]) -> None:
        """Keep the rarest shingle of each window only, sorted by hash."""
        rarity = np.array([counts.get(int(h), 0) for h in self.hash.view(np.int64)], np.int64)
        order = np.lexsort((self.offset, self.hash, rarity, self.of))
        first = np.ones(len(order), bool)
        first[1:] = self.of[order][1:] != self.of[order][:-1]
        keep = order[first]
        keep = keep[np.argsort(self.hash[keep], kind="stable")]
        self.hash, self.of, self.offset = self.hash[keep], self.of[keep], self.offset[keep]


def _member(hashed: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of the hashes that occur in the sorted ``wanted``."""
    seen = np.zeros(MAP, bool)
    seen[wanted & np.uint64(MAP - 1)] = True
    maybe = np.flatnonzero(seen[hashed & np.uint64(MAP - 1)])
    at = np.searchsorted(wanted, hashed[maybe])
    return maybe[wanted[np.minimum(at, len(wanted) - 1)] == hashed[maybe]]


@tk.freed
def _count(wanted_of, sizes: list[int], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of this partition hold each wanted shingle."""
    wanted = wanted_of.value
    total = np.zeros(len(wanted), np.int64)
    for batch in tk.slices(batches, TEXT):
        *_, text, word = tk.words(*tk.bytes_of(batch.column(0)))
        for k in sizes:
            hashed, whole = tk.shingles(word, text, k)
            at = _member(hashed, wanted)
            at = at[whole[at]]
            pair = np.unique(np.searchsorted(wanted, hashed[at]) * batch.num_rows + text[at])
            total += np.bincount(pair // batch.num_rows, minlength=len(wanted))
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(wanted[hit].view(np.int64)), pa.array(total[hit])], ["shingle", "n"])


def _place(win: Windows, data, starts, ends, text, word, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every occurrence of a window."""
    bounds = tk.first_of_each(text, rows)
    begins, chosen = [], []
    for k in win.sizes:
        hashed, whole = tk.shingles(word, text, k)
        at = _member(hashed, win.hash)
        at = at[whole[at]]
        low = np.searchsorted(win.hash, hashed[at], "left")
        many = np.searchsorted(win.hash, hashed[at], "right") - low
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window, begin = win.of[entry], np.repeat(at, many) - win.offset[entry]
        end = begin + win.length[window]
        home = text[np.repeat(at, many)]
        fits = (begin >= bounds[home]) & (end <= bounds[home + 1]) & (np.minimum(win.length[window], SHINGLE) == k)
        begin, window = begin[fits], window[fits]
        for j in range(int(win.length[window].max()) if len(window) else 0):
            within = j < win.length[window]
            inner = np.where(within, j, 0)
            same = word[begin + inner] == win.word[win.word_at[window] + inner]
            begin, window = begin[same], window[same]
        begins.append(begin)
        chosen.append(window)
    begin, window = np.concatenate([np.zeros(0, np.int64), *begins]), np.concatenate([np.zeros(0, np.int64), *chosen])
    blob = data.tobytes()
    exact = np.fromiter(
        (
            all(blob[starts[b + j] : ends[b + j]] == win.raw[win.word_at[w] + j] for j in range(win.length[w]))
            for b, w in zip(begin.tolist(), window.tolist())
        ),
        bool,
        len(begin),
    )
    return begin[exact], window[exact]


SPAN = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


@tk.freed
def _join(block, keep_text: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    win: Windows = block.value
    for batch in tk.slices(batches, TEXT):
        rows = batch.num_rows
        data, starts, ends, text, word = tk.words(*tk.bytes_of(batch.column(TEXT)))
        begin, window = _place(win, data, starts, ends, text, word, rows)
        home = text[begin]
        bounds = tk.first_of_each(text, rows)
        hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
        order = np.argsort(home, kind="stable")
        for chunk in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(order) else []:
            row, base = int(home[chunk[0]]), int(bounds[home[chunk[0]]])
            spans = [(s["first"], s["end"]) for s in hits[row]]
            spans += [(int(begin[c]) - base, int(begin[c] + win.length[window[c]]) - base) for c in chunk]
            hits[row] = merged(spans)
            items[row] = sorted({*items[row], *(win.names[win.item[window[c]]] for c in chunk)})
        passed = [n for n in batch.schema.names if n not in (TEXT, "hits", "items")]
        out = [*[batch.column(n) for n in passed], pa.array(np.diff(bounds)), pa.array(hits, SPAN), pa.array(items, pa.list_(pa.string()))]
        names = [*passed, "n_words", "hits", "items"]
        if keep_text:
            out, names = [*out, batch.column(TEXT)], [*names, TEXT]
        yield pa.RecordBatch.from_arrays(out, names)


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    """Overlapping or touching spans as one, in order."""
    out: list[dict] = []
    for first, end in sorted(spans):
        if out and first <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"first": first, "end": end})
    return out


def find_benchmark_windows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: its id, or the columns ``keep``, ``n_words``, ``hits`` and ``items``.

    ``hits`` are the spans ``[first, end)`` of document words inside any
    occurrence of a window, merged and in order; ``items`` the ids, as strings
    and sorted, of the items with occurring windows.

    A NULL or empty text has no words and no hits. Items without id or without
    words are left out; an id that occurs twice stands for all of its texts.
    Repeated documents each get their own row. Empty tables give an empty
    result, or documents without hits. Columns that are not kept are ignored.
    """
    spark = docs.sparkSession
    size = F.octet_length("_item_text")
    bench = items.select(
        F.col(f"`{item_col}`").cast("string").alias("_item"), F.col(f"`{item_text_col}`").cast("string").alias("_item_text")
    ).where("_item IS NOT NULL AND _item_text IS NOT NULL")
    total = bench.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    in_block = F.pmod(F.xxhash64("_item", "_item_text"), F.lit(blocks))

    base = texts(docs, id_col, text_col, keep)
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    state = base.select("*", none.alias("hits"), F.array().cast("array<string>").alias("items"))
    work = Workspace(spark, "decontaminate")
    schema = f"{kept_schema(base)}, n_words bigint, hits array<struct<first:bigint,end:bigint>>, items array<string>"
    for number in range(blocks):
        rows = bench.where(in_block == number).distinct().collect()  # about block_bytes of text
        win = Windows(sorted((r[0], r[1]) for r in rows), window)
        counts = {}
        if len(win.hash):
            wanted = spark.sparkContext.broadcast(np.unique(win.hash))
            counted = base.select(TEXT).mapInArrow(partial(_count, wanted, win.sizes), "shingle bigint, n bigint")
            counts = {r[0]: r[1] for r in counted.groupBy("shingle").agg(F.sum("n")).collect()}
        win.prefixes(counts)
        last = number == blocks - 1
        search = partial(_join, spark.sparkContext.broadcast(win), not last)
        state = state.mapInArrow(search, schema if last else f"{schema}, {TEXT} string")
        if not last:
            state = work.write(state, "block").drop("n_words")
    tk.release()  # the driver tokenised the items
    return restored(state, id_col, keep)
