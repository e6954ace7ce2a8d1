"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles of five words are weighted by ``tf * idf``. Both parts are damped:
   tf counts as ``1 + log2(tf)``, idf as ``1 + DAMP * ln(N / df) / ln(N)``. With a
   steeper idf the shingles that a large group of copies shares would weigh so
   little that the group falls apart. Document frequencies are summed over all
   documents in ``2**DF_BITS`` hash buckets (a collision can only raise a df, and
   a df of everything moves a weight by ``DAMP`` at most). Weights lie on a
   geometric grid of ``2**(1/GRID)``.
2. Each text gets ``BANDS * ROWS`` samples. Two texts agree in a sample with the
   probability of their weighted Jaccard similarity. Texts that agree in all
   samples of a band share a bucket: at 0.8 a pair meets with probability 0.9998.
3. Pairs are verified by the weighted Jaccard similarity of their whole texts.

Equal texts are one node, known by a 128-bit digest. Within a bucket pairs are
never all written out. In each of ``ROUNDS`` rounds every bucket whose nodes still
belong to several classes compares ``LEADERS`` nodes, of its largest classes, with
the nodes outside their classes; what is similar joins them. A group of near copies
collapses in these rounds, each linear in the bucket.

What shares a bucket and is still apart then is mostly not similar: many edits of
one text, too far from one another. Such nodes get ``LONG_BANDS`` further bands of
``LONG_ROWS`` samples each. A pair at 0.8 meets in one of these with probability
0.99, at 0.9 with 1 - 1e-9, while texts farther apart meet far more rarely, so that
similar ones stand out. Rounds with ``LONG_LEADERS`` leaders run over these buckets.

The rounds only make classes grow early; no pair depends on them. What shares a
bucket and is apart behind them is joined exactly, by prefixes. A text's shingles
are taken rarest first. Two similar texts share one of those that make up the first
``1 - t`` of the heavier text's weight and the first ``1 - 2t / (1 + t)`` of the
lighter one's (t: the threshold): the shingles behind would not be enough. So all
pairs of different classes that share such a shingle are found, by class first and
then by node, if the weight from it on would be enough in both texts, as it must be
from the first shingle on that the two share. Every pair that shares a bucket
is compared, ruled out by this bound, or in one class already. ``exact=True``
leaves the rounds of long bands out. The number of pairs is quadratic only where
texts of different classes share their rare shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .components import components
from .workspace import ID, TEXT, Workspace, digest, texts

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
DF_BITS = 20
DF_BLOCK = 1 << 16
DAMP = 0.25
GRID = 16
LEVELS = 128
DRAWS = 1 << 16
ROUNDS = 2
LEADERS, LONG_LEADERS = 3, 8
LONG_BANDS, LONG_ROWS = 64, 12
LONG = LONG_BANDS * LONG_ROWS
SLACK = 1e-6  # of the threshold: sums of the same weights in another order differ in the last bits
PLANES = 4  # bits per sample in a sketch

U64 = np.uint64
PAIR = ["a", "b", "root_a", "root_b"]
PREFIX = "node binary, root binary, shingle bigint, left double, short boolean, weight double"
_SHIFT = U64(20)  # a shingle is known by 44 bits within its text


def shingle_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, 44-bit shingle and count, sorted, of the distinct shingles of each text.

    A text of fewer words than a shingle has one shingle of all its words.
    """
    data, offsets = tk.bytes_of(column)
    *_, text, word = tk.words(data, offsets)
    hashed, whole = tk.shingles(word, text, SHINGLE)
    hashed, home = hashed[whole], text[: len(whole)][whole]
    bounds = tk.first_of_each(text, len(column))
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < SHINGLE))
    if len(short):
        power = U64(0x9E3779B97F4A7C15)
        place = np.arange(len(word)) - bounds[text]
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(tk.mix(word + place.astype(U64) * power))])
        hashed = np.concatenate([hashed, tk.mix(sums[bounds[short + 1]] - sums[bounds[short]])])
        home = np.concatenate([home, short])
    both = np.sort((home.astype(U64) << U64(44)) | (hashed >> _SHIFT))
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(both)))
    return (both[at] >> U64(44)).astype(np.int64), both[at] & U64((1 << 44) - 1), count


def _bucket(shingle: np.ndarray) -> np.ndarray:
    return (tk.mix(shingle) >> U64(64 - DF_BITS)).astype(np.int64)


# -- document frequencies --------------------------------------------------


@tk.freed
def _df_of_partition(fan_in: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << DF_BITS, np.int64)
    for batch in tk.slices(batches, TEXT):
        _, shingle, _ = shingle_counts(batch.column(0))
        total += np.bincount(_bucket(shingle), minlength=1 << DF_BITS)
    group = TaskContext.get().partitionId() // fan_in
    yield from _blocks(total, group)


def _blocks(total: np.ndarray, group: int) -> Iterator[pa.RecordBatch]:
    for block in range(0, len(total), DF_BLOCK):
        part = total[block : block + DF_BLOCK]
        if part.any():
            packed = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block // DF_BLOCK]), pa.array([group]), pa.array([packed], pa.binary())], ["block", "part", "counts"]
            )


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 8 * DF_BLOCK, codec="zstd", asbytes=True), np.int64)


def _sum_blocks(key: tuple, table: pa.Table) -> pa.Table:
    total = np.zeros(DF_BLOCK, np.int64)
    for packed in table.column("counts"):
        total += _unpack(packed.as_py())
    packed = pa.compress(total.tobytes(), codec="zstd", asbytes=True)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([0], pa.int64()), "counts": pa.array([packed], pa.binary())})


def document_frequencies(base: DataFrame) -> np.ndarray:
    """In how many documents each bucket of shingles occurs.

    Partial sums are added in two steps of the square root of the number of
    partitions; the result has a fixed size of ``2**DF_BITS`` numbers.
    """
    schema = "block bigint, part bigint, counts binary"
    fan_in = ceil(sqrt(base.rdd.getNumPartitions() or 1))
    partial_sums = base.select(TEXT).mapInArrow(partial(_df_of_partition, fan_in), schema)
    sums = partial_sums.groupBy("block", "part").applyInArrow(_sum_blocks, schema)
    sums = sums.groupBy("block").applyInArrow(_sum_blocks, schema)
    df = np.zeros(1 << DF_BITS, np.int64)
    for row in sums.select("block", "counts").collect():  # a constant number of constant size
        df[row[0] * DF_BLOCK : (row[0] + 1) * DF_BLOCK] = _unpack(bytes(row[1]))
    return df


def to_levels(df: np.ndarray, documents: int) -> np.ndarray:
    n = max(documents, 2)
    idf = 1 + DAMP * np.log(n / np.clip(df, 1, n)) / log(n)
    return np.rint(GRID * np.log2(idf)).astype(np.uint8)


def levels(shingle: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weight of each shingle: ``2 ** (level / GRID)``."""
    tf = np.rint(GRID * np.log2(1 + np.log2(count)))
    return np.minimum(tf.astype(np.int64) + idf[_bucket(shingle)], LEVELS - 1)


WEIGHT = 2.0 ** (np.arange(LEVELS) / GRID)


# -- consistent weighted sampling ------------------------------------------


class Sampler:
    """Improved consistent weighted sampling.

    For a weight S, draws r, c ~ Gamma(2, 1) and b ~ U(0, 1):
    ``t = floor(ln S / r + b)``, ``ln a = ln c - r (t - b + 1)``; the shingle with
    the smallest a is the sample, together with t. The draws come from a table
    that a hash of shingle and sample number indexes, so ln a is a table value
    per weight level. Its ordered bits and those of the hash give one integer,
    and the smallest of them names both the shingle and t.
    """

    def __init__(self) -> None:
        draw = np.random.default_rng(20_240_101)
        self.r = -np.log(draw.random(DRAWS) * draw.random(DRAWS) + 1e-300)
        self.log_c = np.log(-np.log(draw.random(DRAWS) * draw.random(DRAWS) + 1e-300))
        self.b = draw.random(DRAWS)
        self.table = np.zeros((LEVELS, DRAWS), U64)
        self.filled = np.zeros(LEVELS, bool)
        self.odd = tk.mix(np.arange(1, SAMPLES + LONG + 1, dtype=U64)) | U64(1)

    def _fill(self, level: int) -> None:
        t = np.floor(log(2) * level / GRID / self.r + self.b)
        bits = (self.log_c - self.r * (t - self.b + 1)).astype(np.float32).view(np.uint32)
        negative = (bits >> 31).astype(bool)
        self.table[level] = np.where(negative, ~bits, bits | np.uint32(1 << 31)).astype(U64) << U64(32)
        self.filled[level] = True

    def samples(self, shingle: np.ndarray, level: np.ndarray, first: np.ndarray, numbers: range = range(SAMPLES)) -> np.ndarray:
        """One row of samples per text; ``first`` is where each text's shingles begin."""
        for x in np.unique(level):
            if not self.filled[x]:
                self._fill(int(x))
        base, row = tk.mix(shingle), level.astype(U64) << U64(16)
        flat = self.table.reshape(-1)
        out = np.empty((len(first), len(numbers)), U64)
        for i, number in enumerate(numbers):
            spread = base * self.odd[number]
            key = flat[(spread >> U64(48)) | row]
            key |= (spread >> U64(16)) & U64(0xFFFFFFFF)
            out[:, i] = np.minimum.reduceat(key, first)
        return out


_sampler: list[Sampler] = []
tk.on_release(_sampler.clear)


def _sampling() -> Sampler:
    """One table of draws per worker."""
    if not _sampler:
        _sampler.append(Sampler())
    return _sampler[0]


def _band_keys(got: np.ndarray, bands: int, rows: int, salt: int = 0) -> np.ndarray:
    """The bucket of each band of samples."""
    weights = np.array([pow(0x9E3779B97F4A7C15, 2 * j + 1, 1 << 64) for j in range(rows)], U64)
    band = (got.reshape(-1, bands, rows) * weights).sum(axis=2, dtype=U64)
    return tk.mix(band + np.arange(salt, salt + bands, dtype=U64) * U64(0xD1B54A32D192ED03))


@tk.freed
def _sign(idf_of, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    idf = idf_of.value
    place = np.arange(SAMPLES, dtype=U64)
    for batch in tk.slices(batches, TEXT):
        text, shingle, count = shingle_counts(batch.column(TEXT))
        rows, first = np.unique(text, return_index=True)
        if len(rows):
            got = _sampling().samples(shingle, levels(shingle, count, idf), first)
        else:
            got = np.zeros((0, SAMPLES), U64)
        keys = _band_keys(got, BANDS, ROWS)
        spread = tk.mix(got)
        planes = [(((spread >> U64(p)) & U64(1)) << place).sum(axis=1, dtype=U64) for p in range(PLANES)]
        has = np.bincount(rows, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), _lists(has, keys), _lists(has, np.stack(planes, axis=1))], ["node", "bands", "sketch"]
        )


def _lists(has: np.ndarray, values: np.ndarray) -> pa.Array:
    """Each row of ``values`` as a list; an empty list where ``has`` is 0."""
    at = np.concatenate([[0], np.cumsum(has * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.reshape(-1).view(np.int64)))


# -- verification ----------------------------------------------------------


def similarity(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    keys, weights, sums = [], [], []
    for column in (left, right):
        text, shingle, count = shingle_counts(column)
        weight = WEIGHT[levels(shingle, count, idf)]
        keys.append((text.astype(U64) << U64(44)) | shingle)
        weights.append(weight)
        sums.append(np.bincount(text, weight, minlength=len(column)))
    at = np.searchsorted(keys[1], keys[0])
    at[at == len(keys[1])] = 0
    same = keys[1][at] == keys[0] if len(keys[1]) else np.zeros(len(keys[0]), bool)
    shared = np.bincount(
        (keys[0][same] >> U64(44)).astype(np.int64), np.minimum(weights[0][same], weights[1][at[same]]), minlength=len(left)
    )
    union = sums[0] + sums[1] - shared
    return np.divide(shared, union, out=np.zeros(len(left)), where=union > 0)


@tk.freed
def _verify(idf_of, threshold: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The roots of the pairs that are similar."""
    idf = idf_of.value
    for batch in tk.slices(batches, "text_b"):
        like = similarity(batch.column("text_a"), batch.column("text_b"), idf)
        # A hair below: sums of the same weights in another order differ in the last bits.
        hit = pa.array(np.flatnonzero(like >= threshold - 1e-9))
        yield pa.RecordBatch.from_arrays([batch.column("root_a").take(hit), batch.column("root_b").take(hit)], ["a", "b"])


def _possible(threshold: float, samples: int, planes: int):
    """Whether two sketches, ``planes`` bits of each sample, leave the threshold possible.

    Samples that differ change each of their bits with odds 1/2. The distance may
    exceed what the threshold expects by 4.5 standard deviations.
    """
    differ = samples * (1 - threshold)
    spread = differ * planes / 4 + (planes / 2) ** 2 * differ * threshold
    most = int(differ * planes / 2 + 4.5 * sqrt(spread))
    words = samples * planes // 64
    distance = " + ".join(f"bit_count(sketch_a[{p}] ^ sketch_b[{p}])" for p in range(words))
    return F.expr(f"{distance} <= {most}")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    exact: bool = False,
) -> DataFrame:
    """One row per document: its id, ``node`` (digest of the text), ``class_id`` and ``keeper``.

    ``class_id`` is the smallest id among the documents of the class; ``keeper``
    marks the text that stands for the class, that of this id. All pairs that share a
    bucket are settled; ``exact`` does so without the rounds of long bands.

    Equal texts are always in one class. A NULL text is a class of its own
    (``node`` is NULL). Texts without words are only alike if equal. NULL ids
    take part and count as largest. Repeated rows each get a row. Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near")
    base = texts(docs, id_col, text_col)
    named = base.withColumn("node", digest())
    placed = work.write(named.select(ID, "node"), "placed")

    idf_of = spark.sparkContext.broadcast(to_levels(document_frequencies(base), placed.count()))  # 2**DF_BITS bytes
    tk.release()  # the driver needs the frequencies no more
    signed = named.where("node IS NOT NULL").select("node", TEXT).mapInArrow(
        partial(_sign, idf_of), "node binary, bands array<bigint>, sketch array<bigint>"
    )
    nodes = work.write(signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    ids = work.write(placed.where("node IS NOT NULL").groupBy("node").agg(F.min(ID).alias("first")), "ids")
    root = _link(work, named, nodes, ids, idf_of, threshold, exact)
    work.keep_only(placed, ids, root)

    rooted = ids.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("head")
    head = rooted.groupBy("root").agg(best).select("root", F.col("head.first").alias("class_id"), F.col("head.node").alias("keep"))
    classes = rooted.join(head, "root").select("node", "class_id", (F.col("node") == F.col("keep")).alias("keeper"))
    alone = F.col("node").isNull()
    return placed.join(classes, "node", "left").select(
        F.col(ID).alias(id_col),
        "node",
        F.when(alone, F.col(ID)).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("keeper")).alias("keeper"),
    )


class _Links:
    """Pairs tried and the classes that follow from the links found; ``root`` has the nodes that are not their own root."""

    def __init__(self, work: Workspace, nodes: DataFrame, text_of: DataFrame, idf_of, threshold: float):
        self.work, self.nodes, self.text_of, self.idf_of, self.threshold = work, nodes, text_of, idf_of, threshold
        self.tried = work.spark.createDataFrame([], "a binary, b binary")
        self.root = work.spark.createDataFrame([], "node binary, root binary")

    def _both(self, pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for name in ("b", "a"):
            pairs = pairs.join(table.select(F.col("node").alias(name), F.col(column).alias(f"{column}_{name}")), name)
        return pairs

    def compare(self, pairs: DataFrame, sketched: bool = True) -> None:
        """Verify the pairs and join the classes of similar ones; ``sketched`` leaves out those tried before or ruled out by sketches.

        Pairs ``(a, b, root_a, root_b)`` bring their roots along, which differ, in either order, so that links need not look for them.
        """
        if sketched:
            pairs = pairs.distinct().join(self.tried, ["a", "b"], "left_anti")
        pairs, found = self.work.write_counted(pairs, "pairs")
        if not found:
            return
        if sketched:
            self.tried = self.tried.union(pairs.select("a", "b"))
            able = self._both(pairs, self.nodes, "sketch").where(_possible(self.threshold, SAMPLES, PLANES))
            pairs = able.select(*PAIR)
        whole = self._both(pairs, self.text_of, "text").select("root_a", "root_b", "text_a", "text_b")
        # Only the classes that the new links join are gone through, not all links again.
        new = whole.mapInArrow(partial(_verify, self.idf_of, self.threshold), "a binary, b binary")
        classes, found = self.work.write_counted(new.distinct(), "classes")
        if not found:
            return
        moved = components(classes, self.work).where("node != root")
        # What moves was a root before, so it has no row yet.
        again = self.root.join(moved.select(F.col("node").alias("was"), F.col("root").alias("now")), F.col("root") == F.col("was"), "left")
        again = again.select("node", F.coalesce("now", "root").alias("root"))
        before, self.root = self.root, self.work.write(again.unionByName(moved), "roots")
        self.work.drop(before)

    def settle(self, member: DataFrame, leaders: int) -> None:
        """Rounds of leaders over the buckets of ``member``."""
        for turn in range(ROUNDS):
            self.compare(_leaders(_rooted(member, self.root), turn, leaders))


def _shared(member: DataFrame) -> DataFrame:
    """The rows of buckets with more than one node, and the bucket's smallest node."""
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1")
    return member.join(shared.select("bucket", "leader"), "bucket")


def _link(work: Workspace, named: DataFrame, nodes: DataFrame, ids: DataFrame, idf_of, threshold: float, exact: bool) -> DataFrame:
    """(node, root) of the nodes that are linked to others and are not the root themselves."""
    member = work.write(_shared(nodes.select("node", F.explode("bands").alias("bucket"))), "member")

    # One document per text that shares a bucket, found by node and id: the many
    # documents with one text differ in the id and so do not meet in one task.
    one = member.select("node").distinct().join(ids, "node").select(F.col("node").alias("_one"), "first")
    chosen = named.join(one, (F.col("node") == F.col("_one")) & F.col(ID).eqNullSafe(F.col("first")))
    text_of = work.write(chosen.groupBy("node").agg(F.first(TEXT).alias("text")), "texts")
    links = _Links(work, nodes, text_of, idf_of, threshold)

    # First every node tries the leader that it meets in most buckets.
    meets = member.where("node != leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
    pick = meets.groupBy("node").agg(F.max_by("leader", F.struct("n", "leader")).alias("a")).withColumnRenamed("node", "b")
    links.compare(pick.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b")))
    links.settle(member, LEADERS)

    if not exact:
        unsettled = work.write(_open_buckets(member, links.root), "unsettled")
        loose = text_of.join(unsettled.select("node").distinct(), "node", "left_semi")
        longer = loose.mapInArrow(partial(_sign_long, idf_of), "node binary, bands array<bigint>")
        links.settle(work.write(_shared(longer.select("node", F.explode("bands").alias("bucket"))), "long"), LONG_LEADERS)

    apart = work.write(_open_buckets(member, links.root).select("node", "root").distinct(), "apart")
    loose = work.write(text_of.join(apart, "node"), "loose")
    df_of = work.spark.sparkContext.broadcast(document_frequencies(loose.select(F.col("text").alias(TEXT))))  # 2**DF_BITS numbers
    tk.release()
    rare = loose.mapInArrow(partial(_prefixes, idf_of, df_of, threshold), PREFIX)
    links.compare(_remaining(work.write(rare, "rare"), threshold), sketched=False)
    return links.root


def _rooted(member: DataFrame, root: DataFrame) -> DataFrame:
    """(bucket, node, root) of all members."""
    return member.select("bucket", "node").join(root, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))


def _open_buckets(member: DataFrame, root: DataFrame) -> DataFrame:
    """(bucket, node, root) of the buckets whose nodes belong to several classes."""
    placed = _rooted(member, root)
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return placed.join(mixed.select("bucket"), "bucket", "left_semi")


def _leaders(placed: DataFrame, turn: int, leaders: int) -> DataFrame:
    """Nodes of the largest classes of each bucket with every node outside that class; none of a bucket of one class."""
    order = F.xxhash64(F.lit(turn), "node")
    size = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.min_by("node", order).alias("a"))
    # Classes of one size take turns.
    best = [F.max_by(F.struct("root", "a"), F.struct("n", F.xxhash64(F.lit(turn * leaders + j), "root"))) for j in range(leaders)]
    lead = size.groupBy("bucket").agg(F.array_distinct(F.array(*best)).alias("leads"), F.count(F.lit(1)).alias("classes"))
    lead = lead.where("classes > 1").select("bucket", "leads")
    out = placed.join(lead, "bucket").select("node", "root", F.explode("leads").alias("lead")).where("root != lead.root")
    return out.select(*_in_order("lead.a", "node", "a", "b"), *_in_order("lead.root", "root", "root_a", "root_b"))


def _in_order(one: str, other: str, low: str, high: str) -> tuple[Column, Column]:
    return F.least(one, other).alias(low), F.greatest(one, other).alias(high)


@tk.freed
def _sign_long(idf_of, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The long bands of each text."""
    for batch in tk.slices(batches, "text"):
        text, shingle, count = shingle_counts(batch.column("text"))
        rows, first = np.unique(text, return_index=True)
        keys = np.zeros((len(rows), LONG_BANDS), U64)
        if len(rows):
            level = levels(shingle, count, idf_of.value)
            keys = _band_keys(_sampling().samples(shingle, level, first, range(SAMPLES, SAMPLES + LONG)), LONG_BANDS, LONG_ROWS, BANDS)
        has = np.bincount(rows, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(has, keys)], ["node", "bands"])


@tk.freed
def _prefixes(idf_of, df_of, threshold: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each text that make up its prefix, but for those that no other text has.

    ``left`` is the weight of the text from this shingle on; ``short`` marks the part
    that is enough for the lighter text of a pair.
    """
    least = threshold - SLACK
    for batch in tk.slices(batches, "text"):
        text, shingle, count = shingle_counts(batch.column("text"))
        share = WEIGHT[levels(shingle, count, idf_of.value)]
        df = df_of.value[_bucket(shingle)]
        order = np.lexsort((shingle, df, text))  # any order that is the same for all texts is right
        text, shingle, share, df = text[order], shingle[order], share[order], df[order]
        weight = np.bincount(text, share, minlength=batch.num_rows)
        sums = np.concatenate([[0.0], np.cumsum(share)])
        first = tk.first_of_each(text, batch.num_rows)
        left = (weight + sums[first[:-1]])[text] - sums[:-1]  # the weight from this shingle on
        at = np.flatnonzero((left >= least * weight[text]) & (df > 1))
        own = pa.array(text[at])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node").take(own),
                batch.column("root").take(own),
                pa.array(shingle[at].view(np.int64)),
                pa.array(left[at]),
                pa.array(left[at] >= (2 * least / (1 + least) - SLACK) * weight[text[at]]),
                pa.array(weight[text[at]]),
            ],
            ["node", "root", "shingle", "left", "short", "weight"],
        )


def _remaining(rare: DataFrame, threshold: float) -> DataFrame:
    """The pairs of different classes that share a shingle of their prefixes and may be similar.

    Classes that share a shingle are found first: the members of one class never meet.
    """
    mixed = rare.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("short").alias("any"))
    live = rare.join(mixed.where("low != high AND any").select("shingle"), "shingle", "left_semi")
    enough = (threshold - SLACK) / (1 + threshold - SLACK)
    may = F.least("left_a", "left_b") >= enough * (F.col("weight_a") + F.col("weight_b"))
    classes = live.groupBy("shingle", "root").agg(F.max("left").alias("left"), F.min("weight").alias("weight"))
    left, right = (classes.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("root", "left", "weight")]) for side in "ab")
    pairs = left.join(right, "shingle").where((F.col("root_a") < F.col("root_b")) & may).select("shingle", "root_a", "root_b")
    for side in "ab":
        names = {"node": side, "root": f"root_{side}", "left": f"left_{side}", "weight": f"weight_{side}"}
        pairs = pairs.join(live.select("shingle", *[F.col(c).alias(n) for c, n in names.items()]), ["shingle", f"root_{side}"])
    return pairs.where(may).select(*_in_order("a", "b", "a", "b"), "root_a", "root_b").distinct()
