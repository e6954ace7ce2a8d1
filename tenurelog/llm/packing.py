"""Packing of token sequences by bin completion, planned on the histogram of lengths.

Lengths are whole numbers up to the capacity, so however many pieces there are,
the packing problem is a table of at most ``capacity`` counts. The plan is made
on that table: a list of fillings (how many pieces of which length share a
sequence), each with the number of sequences filled so. Its size depends on the
capacity alone. Pieces are then placed by their rank among all pieces of their
length, which comes from counts per partition; no piece is moved for it.

The plan is searched by branch and bound. A node takes the largest piece left and
enumerates the sets of pieces that may share its sequence, least waste first.
Sets to which another piece could be added, and sets that pack into another
set's pieces, are dominated and left out. A filling is used as often as the counts
permit, then less often. A branch whose waste would need as many sequences as the
best plan known is cut. The search begins with the plan of best-fit decreasing,
keeps each better one, and ends when it meets the lower bound, when all branches
are done, or after ``NODES`` nodes; what it returns is then the best plan found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as tk
from .bpe_words import encoder_of, require_byte_level
from .workspace import TEXT, Workspace, kept_schema, restored, ship, small_batches, texts

CAPACITY = 1024
NODES = 3_000
WIDEST = 64  # undominated fillings that one node remembers to compare the next ones with

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


# -- bounds and first plan -------------------------------------------------


def lower_bound(counts: Mapping[int, int], capacity: int) -> int:
    """Sequences that any packing needs: pieces over half the capacity, and what cannot lie beside them."""
    n = np.zeros(capacity + 1, object)
    for length, count in counts.items():
        n[length] += count
    size = n * np.arange(capacity + 1)
    best = -(-int(size.sum()) // capacity)
    half = capacity // 2
    for small in range(half + 1):
        alone, wide = sum(n[capacity - small + 1 :]), n[half + 1 : capacity - small + 1]
        beside = sum(wide) * capacity - sum(size[half + 1 : capacity - small + 1])
        over = sum(size[max(small, 1) : half + 1]) - beside
        best = max(best, int(alone + sum(wide) + max(0, -(-over // capacity))))
    return best


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on counts: each length goes to the fullest sequences that take it."""
    classes: list[list] = []  # room, filling, how many sequences
    for length in sorted(counts, reverse=True):
        left = counts[length]
        classes.sort(key=lambda c: c[0])
        split: list[list] = []
        for item in classes:
            room, filling, times = item
            if room < length or not left:
                continue
            k = room // length
            full = min(times, left // k)
            rest = left - full * k
            if full < times and 0 < rest < k:
                split.append([room - rest * length, filling + [(length, rest)], 1])
                item[2] -= 1
                left -= rest
            if full:
                split.append([room - k * length, filling + [(length, k)], full])
                item[2] -= full
                left -= full * k
        classes += split
        k = capacity // length
        if left >= k:
            classes.append([capacity - k * length, [(length, k)], left // k])
        if left % k:
            classes.append([capacity - left % k * length, [(length, left % k)], 1])
        classes = [c for c in classes if c[2]]
    return [(tuple(filling), times) for _, filling, times in classes]


# -- bin completion --------------------------------------------------------


def _packs_into(items: Filling, bins: Filling) -> bool:
    """Whether the pieces of one filling fit into those of another, each used as a bin."""
    pieces = [length for length, k in items for _ in range(k)]
    rooms = [length for length, k in bins for _ in range(k)]
    if len(pieces) > 12 or sum(pieces) > sum(rooms):
        return False

    def place(i: int, rooms: list[int]) -> bool:
        if i == len(pieces):
            return True
        for j, room in enumerate(rooms):
            if room >= pieces[i] and room not in rooms[:j] and place(i + 1, [*rooms[:j], room - pieces[i], *rooms[j + 1 :]]):
                return True
        return False

    return place(0, rooms)


def fillings(counts: dict[int, int], room: int, most_waste: int) -> Iterator[tuple[int, Filling]]:
    """Undominated sets of pieces of at most ``room`` together, with their waste, least waste first."""
    lengths = sorted(length for length, c in counts.items() if c and length <= room)
    if counts.get(room):
        yield 0, ((room, 1),)  # any other set packs into this piece
        return
    mask = (1 << (room + 1)) - 1
    reach = [1]  # sums that the first i lengths can make, as bits
    for length in lengths:
        bits, left, step = reach[-1], min(counts[length], room // length), 1
        while left:
            take = min(step, left)
            bits |= bits << (length * take) & mask
            left, step = left - take, step * 2
        reach.append(bits)

    def exactly(i: int, total: int) -> Iterator[Filling]:
        """Sets of the first ``i`` lengths with this sum, the longest pieces first."""
        if not total:
            yield ()
            return
        while i and not lengths[i - 1] <= total:
            i -= 1
        for j in range(i, 0, -1):
            if not reach[j] >> total & 1:
                return
            length = lengths[j - 1]
            for k in range(min(counts[length], total // length), 0, -1):
                if reach[j - 1] >> (total - k * length) & 1:
                    for rest in exactly(j - 1, total - k * length):
                        yield ((length, k), *rest)

    seen: list[Filling] = []
    for waste in range(min(room, most_waste) + 1):
        for found in exactly(len(lengths), room - waste):
            used = dict(found)
            if any(length <= waste and counts[length] > used.get(length, 0) for length in lengths):
                continue  # another piece fits in
            if any(_packs_into(found, other) for other in seen):
                continue
            if len(seen) < WIDEST:
                seen.append(found)
            yield waste, found


def plan_packing(counts: Mapping[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how often to use each, for as few sequences as the search finds.

    ``counts`` says how many pieces there are of each length from 1 to ``capacity``.
    """
    left = {length: int(c) for length, c in counts.items() if c}
    if any(not 1 <= length <= capacity for length in left):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    best = best_fit(left, capacity)
    fewest, bound = sum(t for _, t in best), lower_bound(left, capacity)
    total = sum(length * c for length, c in left.items())

    path: list[tuple[Filling, int, int, tuple]] = []  # filling, times, waste of one, its place in the order
    waste = used = 0

    def children(after: tuple | None) -> Iterator[tuple[Filling, int, int, tuple]]:
        """Fillings around the largest piece, and how often; only those behind ``after`` if its largest piece is the same."""
        largest = max(length for length, c in left.items() if c)
        left[largest] -= 1
        found = fillings(dict(left), capacity - largest, (fewest - 1) * capacity - total - waste)
        left[largest] += 1
        for lost, rest in found:
            place = (-largest, lost, tuple((-length, -k) for length, k in rest))
            if after is not None and place <= after:
                continue
            if rest and rest[0][0] == largest:
                filling = ((largest, rest[0][1] + 1), *rest[1:])
            else:
                filling = ((largest, 1), *rest)
            times = min(left[length] // k for length, k in filling)
            forced = lost == 0 and len(rest) == 1 and rest[0][1] == 1
            for t in range(times, times - 1 if forced else 0, -1):
                yield filling, t, lost, place

    stack = [children(None)] if left and fewest > bound else []
    while stack and nodes > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                filling, t, lost, _ = path.pop()
                for length, k in filling:
                    left[length] += k * t
                waste, used = waste - t * lost, used - t
            continue
        nodes -= 1
        filling, t, lost, place = step
        # What is wasted takes room like pieces do.
        if -(-(total + waste + t * lost) // capacity) >= fewest:
            continue
        for length, k in filling:
            left[length] -= k * t
        path.append(step)
        waste, used = waste + t * lost, used + t
        if any(left.values()):
            stack.append(children(place))
            continue
        if used < fewest:
            fewest, best = used, [(f, n) for f, n, *_ in path]
            if fewest == bound:
                break
        path.pop()
        for length, k in filling:
            left[length] += k * t
        waste, used = waste - t * lost, used - t
    return best


# -- placing ---------------------------------------------------------------


@dataclass(frozen=True)
class Places:
    """For each length, by rank: the sequence and the offset. One row per filling and length of the plan."""

    key: np.ndarray  # length << 44 | first rank, rising
    each: np.ndarray  # pieces of this length per sequence
    sequence: np.ndarray  # the first sequence
    offset: np.ndarray  # where the first piece lies

    @classmethod
    def of(cls, plan: list[tuple[Filling, int]]) -> Places:
        rank: dict[int, int] = {}
        rows, sequence = [], 0
        for filling, times in plan:
            offset = 0
            for length, k in filling:
                rows.append((length << 44 | rank.get(length, 0), k, sequence, offset))
                rank[length] = rank.get(length, 0) + k * times
                offset += k * length
            sequence += times
        rows.sort()
        return cls(*(np.array(c, np.int64) for c in zip(*rows))) if rows else cls(*(np.zeros(0, np.int64),) * 4)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length << 44 | rank
        at = np.searchsorted(self.key, key, "right") - 1
        inside = key - self.key[at]
        return self.sequence[at] + inside // self.each[at], self.offset[at] + inside % self.each[at] * length


def _count(length_col: str, capacity: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their partition and their place among the rows of their length in it."""
    seen = np.zeros(capacity + 1, np.int64)
    part = TaskContext.get().partitionId()
    for batch in batches:
        length = batch.column(length_col).to_numpy(zero_copy_only=False)
        if batch.num_rows and not (length.min() >= 1 and length.max() <= capacity):
            raise ValueError(f"lengths must lie between 1 and {capacity}")
        length = length.astype(np.int64)
        order = np.argsort(length, kind="stable")
        ranked = length[order]
        begins = np.flatnonzero(np.diff(ranked, prepend=-1))
        inside = np.arange(len(ranked)) - np.repeat(begins, np.diff(np.append(begins, len(ranked))))
        place = np.empty(len(ranked), np.int64)
        place[order] = inside + seen[ranked]
        seen += np.bincount(length, minlength=capacity + 1)
        columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_part", "_place"])


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """All columns of ``pieces`` with the ``sequence_id`` and the ``offset`` of each piece.

    Sequences are numbered from 0, and the pieces of one lie in it without gaps from
    offset 0. Lengths are 1 to ``capacity``; another one, or NULL, fails the job. Equal
    pieces are separate pieces. An empty table gives an empty result. Columns may have any
    names but ``sequence_id`` and ``offset``.
    """
    spark = pieces.sparkSession
    ship(spark)
    small_batches(spark)
    work = Workspace(spark, "packing")
    inner = [f"_c{i}" for i in range(len(pieces.columns))]
    base = pieces.toDF(*inner)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema)
    length = inner[pieces.columns.index(length_col)]
    placed = work.write(base.mapInArrow(partial(_count, length, capacity), f"{schema}, _part int, _place bigint"), "placed")

    sizes = placed.groupBy("_part", length).agg(F.count(F.lit(1)).alias("n"))
    sizes = work.write(sizes, "sizes")  # at most ``capacity`` rows per partition
    counts = {r[0]: r[1] for r in sizes.groupBy(length).agg(F.sum("n")).collect()}  # at most ``capacity`` numbers
    places = spark.sparkContext.broadcast(Places.of(plan_packing(counts, capacity, nodes)))

    earlier = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", length, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))

    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.value.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    find = F.pandas_udf(look_up, "sequence_id long, offset long")
    found = placed.join(starts, ["_part", length]).withColumn("_found", find(F.col(length), F.col("_before") + F.col("_place")))
    return found.select(*[F.col(i).alias(c) for i, c in zip(inner, pieces.columns)], "_found.sequence_id", "_found.offset")


# -- pieces ----------------------------------------------------------------


def cut(size: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of each piece; the first piece of a document takes what is left over."""
    n = -(-size // capacity)
    document = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(n) - n, n)
    after = (n[document] - piece) * capacity  # room from here to the end
    start = np.maximum(size[document] - after, 0)
    return document, piece, start, size[document] - after + capacity - start


def _pieces(definition, end_id: int, capacity: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(definition)
    for batch in tk.slices(batches, TEXT):
        ids, at = encoder.encode(*tk.bytes_of(batch.column(TEXT)))
        ids = np.insert(ids, at[1:], end_id)
        size = np.diff(at) + 1
        document, piece, start, length = cut(size, capacity)
        of = pa.array(document)
        ends = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(document), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4").tobytes())])
        own = [c for c in batch.schema.names if c != TEXT]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(of) for c in own], pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), binary],
            [*own, "piece", "start", "length", "ids"],
        )


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ids of each document and ``end_id``, cut to pieces: id, ``piece`` from 0, ``start``, ``length`` and ``ids``.

    ``vocabulary`` is the path of a byte-level BPE in the JSON form of the tokenizers
    library; ids are those that it gives without added special tokens. A document
    of more than ``capacity`` ids is cut into pieces of ``capacity``, of which the
    first may be shorter. ``ids`` is binary: unsigned 32-bit little-endian integers.
    A NULL text counts as empty, which still has its end. Rows are independent of
    one another, so repeated rows and NULL ids are kept and other columns ignored; an
    empty table gives an empty result.
    """
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    require_byte_level(text)
    definition = docs.sparkSession.sparkContext.broadcast(text)
    base = texts(docs, id_col, text_col)
    schema = f"{kept_schema(base)}, piece int, start bigint, length bigint, ids binary"
    return restored(base.mapInArrow(partial(_pieces, definition, end_id, capacity), schema), id_col, ())
