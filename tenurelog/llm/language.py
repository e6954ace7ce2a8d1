"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows: each run of visible bytes with the blank before and
behind it; a run of more than ``WIDTH`` bytes is cut into several. In every
window one recurrent network reads forwards and one backwards, and each position
gets a probability per language from both states. A document's probability is
the mean over all positions of all its windows, that is of the whole text.

The state begins anew in each window, so equal windows have equal results. A
worker computes each distinct window once and remembers the sums.

The network is trained in numpy by backpropagation through time on windows of at
most ``SAMPLE`` labelled documents per language, those with the smallest hash of
their id, and at most ``WINDOWS`` windows per language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .nets import Adam, sigmoid, softmax
from .workspace import ID, TEXT, sample_of_each, texts

SAMPLE = 400
WINDOWS = 20_000
WIDTH = 20
HIDDEN, EMBED = 16, 16
STEPS, BATCH, RATE = 500, 384, 0.01
CACHE = 2_000_000  # distinct windows a worker remembers; beyond that it starts over
UNKNOWN = "und"


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the windows, without the blanks around them."""
    starts, ends, text = tk.spans(data, offsets, tk.VISIBLE)
    pieces = (ends - starts + WIDTH - 1) // WIDTH
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(starts)), pieces)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = starts[which] + number * WIDTH
        starts, ends, text = first, np.minimum(first + WIDTH, ends[which]), text[which]
    return starts, ends, text


def window_bytes(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Windows of one size as rows of bytes, with a blank on both sides."""
    out = np.full((len(starts), size + 2), 32, np.uint8)
    out[:, 1:-1] = data[starts[:, None] + np.arange(size)]
    return out


class ByteGru:
    """Two gated recurrent networks, one per direction, and a layer that labels each position."""

    def __init__(self, languages: list[str], seed: int = 7):
        self.languages = languages
        rng = np.random.default_rng(seed)

        def new(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {"embed": new(256, EMBED) * 4, "out": new(2 * HIDDEN, len(languages)), "out_b": np.zeros(len(languages), np.float32)}
        for d in "fb":
            self.w |= {f"in_{d}": new(EMBED, 3 * HIDDEN), f"in_b_{d}": np.zeros(3 * HIDDEN, np.float32)}
            self.w |= {f"gate_{d}": new(HIDDEN, 2 * HIDDEN), f"cand_{d}": new(HIDDEN, HIDDEN)}

    # One step: z, r = sigmoid(x + h U); c = tanh(x + (r h) V); h = (1 - z) h + z c

    def _read(self, rows: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States after each position, in the order of the text."""
        w = self.w
        given = w["embed"] @ w[f"in_{d}"] + w[f"in_b_{d}"]
        h = np.zeros((len(rows), HIDDEN), np.float32)
        states = np.empty((rows.shape[1], len(rows), HIDDEN), np.float32)
        for t in range(rows.shape[1]) if d == "f" else reversed(range(rows.shape[1])):
            x = given[rows[:, t]]
            zr = sigmoid(x[:, : 2 * HIDDEN] + h @ w[f"gate_{d}"])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ w[f"cand_{d}"])
            if keep is not None:
                keep.append((t, h, z, r, c))
            h = h + z * (c - h)
            states[t] = h
        return states

    def label(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities (position, row, language)."""
        both = np.concatenate([self._read(rows, "f", None), self._read(rows, "b", None)], axis=2)
        return softmax(both @ self.w["out"] + self.w["out_b"])

    def gradients(self, rows: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradients, by backpropagation through time."""
        w, steps = self.w, {"f": [], "b": []}
        both = np.concatenate([self._read(rows, "f", steps["f"]), self._read(rows, "b", steps["b"])], axis=2)
        p = softmax(both @ w["out"] + w["out_b"])
        size, n = rows.shape[1], len(rows)
        loss = -float(np.log(p[:, np.arange(n), truth] + 1e-9).mean())
        p[:, np.arange(n), truth] -= 1
        p /= size * n
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["out"] = np.einsum("tnh,tnl->hl", both, p)
        grads["out_b"] = p.sum(axis=(0, 1))
        back = p @ w["out"].T
        for d, part in (("f", back[:, :, :HIDDEN]), ("b", back[:, :, HIDDEN:])):
            dh = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, c in reversed(steps[d]):
                dh = dh + part[t]
                dc = dh * z * (1 - c * c)
                drh = dc @ w[f"cand_{d}"].T
                dzr = np.concatenate([dh * (c - h) * z * (1 - z), drh * h * r * (1 - r)], axis=1)
                grads[f"cand_{d}"] += (r * h).T @ dc
                grads[f"gate_{d}"] += h.T @ dzr
                dx = np.concatenate([dzr, dc], axis=1)
                x = w["embed"][rows[:, t]]
                grads[f"in_{d}"] += x.T @ dx
                grads[f"in_b_{d}"] += dx.sum(axis=0)
                np.add.at(grads["embed"], rows[:, t], dx @ w[f"in_{d}"].T)
                dh = dh * (1 - z) + drh * r + dzr @ w[f"gate_{d}"].T
        return loss, grads


def train(sample: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> ByteGru | None:
    """A network from (text, language) pairs; None if there are none."""
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for number, lang in enumerate(languages):
        data, offsets = tk.bytes_of(pa.array([t for t, x in sample if x == lang], pa.string()))
        starts, ends, _ = cut_windows(data, offsets)
        chosen = rng.permutation(len(starts))[:WINDOWS]
        starts, ends = starts[chosen], ends[chosen]
        for size in np.unique(ends - starts):
            rows = window_bytes(data, starts[ends - starts == size], int(size))
            by_size.setdefault(int(size), []).append((rows, np.full(len(rows), number)))
    pools = {}
    for size, parts in by_size.items():
        # the same number of windows of each language, by drawing the smaller ones again
        most = max(len(r) for r, _ in parts)
        rows = [(r[rng.integers(0, len(r), most)] if len(r) < most else r, np.full(most, t[0])) for r, t in parts]
        pools[size] = (np.concatenate([r for r, _ in rows]), np.concatenate([t for _, t in rows]))
    net = ByteGru(languages, seed)
    adam = Adam(net.w, RATE)
    sizes = sorted(pools)
    weight = np.array([len(pools[s][0]) * (s + 2) for s in sizes], float)
    weight /= weight.sum() if len(sizes) else 1
    for step in range(steps if sizes else 0):
        rows, truth = pools[int(rng.choice(sizes, p=weight))]
        pick = rng.integers(0, len(rows), BATCH)
        adam.rate = RATE * (1 - 0.9 * step / steps)
        adam.update(net.gradients(rows[pick], truth[pick])[1])
    return net


class Reader:
    """A trained network in one worker, with the windows it has read."""

    def __init__(self, net: ByteGru):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.sums = np.zeros((0, len(self.net.languages)), np.float32)

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text; zeros for a text without windows."""
        count, width = len(offsets) - 1, len(self.net.languages)
        starts, ends, text = cut_windows(data, offsets)
        if not len(starts):
            return np.zeros((count, width))
        if len(self.key) > CACHE:
            self.forget()
        size = ends - starts
        distinct, first, which = np.unique(tk.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.key, distinct)
        inside = slot < len(self.key)
        known = np.zeros(len(distinct), bool)
        known[inside] = self.key[slot[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            sums = np.empty((len(new), width), np.float32)
            begin, long = starts[first[new]], size[first[new]]
            for n in np.unique(long):
                at = np.flatnonzero(long == n)
                for part in np.array_split(at, 1 + len(at) // 2048):
                    sums[part] = self.net.label(window_bytes(data, begin[part], int(n))).sum(axis=0)
            self.key = np.insert(self.key, slot[new], distinct[new])
            self.sums = np.insert(self.sums, slot[new], sums, axis=0)
        sums = self.sums[np.searchsorted(self.key, distinct)]
        total = np.stack([np.bincount(text, sums[which, k], minlength=count) for k in range(width)], axis=1)
        positions = np.bincount(text, size + 2, minlength=count)
        return total / np.maximum(positions, 1)[:, None]


_readers: dict[str, Reader] = {}


def _predict(name: str, net_of, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if name not in _readers:
        _readers.clear()
        _readers[name] = Reader(net_of.value)
    reader = _readers[name]
    for batch in tk.slices(batches, TEXT):
        p = reader.probabilities(*tk.bytes_of(batch.column(TEXT)))
        letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
        best = p.argmax(axis=1)
        known = letters & (p.max(axis=1) > 0)
        said = [reader.net.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
        score = np.where(known, np.round(np.clip(p.max(axis=1), 0, 1), 6), 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(ID), pa.array(said), pa.array(score)], [ID, "lang_pred", "score"])


def identify_language(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score``.

    ``labelled`` has the same columns and a language; rows with a NULL text or
    language are left out of the training. ``lang_pred`` is a language seen there,
    or ``und`` with score 0 if the text is NULL or has no letter, or nothing could
    be learned. ``score`` is the pooled probability of ``lang_pred``. Only the text
    decides. Repeated rows come out alike; other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    known = labelled.select(
        F.col(f"`{id_col}`").alias(ID), F.col(f"`{text_col}`").cast("string").alias(TEXT), F.col(f"`{lang_col}`").cast("string").alias("_lang")
    )
    known = known.where(f"_lang IS NOT NULL AND {TEXT} IS NOT NULL")
    chosen = sample_of_each(known, "_lang", ID, sample)
    rows = sorted((r[0], r[1]) for r in chosen.select(TEXT, "_lang").collect())  # ``sample`` per language
    net = train(rows)
    base = texts(docs, id_col, text_col)
    kind = base.schema[ID].dataType.simpleString()
    if net is None:
        return base.select(F.col(ID).alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    with_letters = base.withColumn("letters", F.coalesce(F.col(TEXT).rlike(r"\p{L}"), F.lit(False)))
    predict = partial(_predict, uuid.uuid4().hex, spark.sparkContext.broadcast(net))
    out = with_letters.mapInArrow(predict, f"{ID} {kind}, lang_pred string, score double")
    return out.withColumnRenamed(ID, id_col)
