"""Removal of repeated lines and sentences across documents, by the digest of each.

A unit is a sentence of a line: a stretch up to and with the next ``.``, ``!``, ``?``
or one of ``。！？``; a line without any of them is one unit. So a passage is found
where it fills lines, and also where it stands inside one. Units are compared after
normalising: letters A-Z to lower case, runs of white space to one blank, none at
the ends.

* A unit of at least ``min_words`` words goes if it occurred before, in the order of
  document id and place.
* A shorter one may repeat by chance. It goes if it occurred before together with
  the unit behind it, or the one before it, in its line: the digest is that of both.
  So runs of short units go whole, and one that stands alone stays.
* A line all of whose units go, goes whole.

Every unit that goes is left standing somewhere before: the earliest occurrence of
its digest holds it, or gave way to a still earlier one.

Units are found and hashed in whole Arrow batches, without a loop over units, and their
digests written once. Only digests and places are shuffled. The earliest occurrence per digest is a minimum with
partial minima before the shuffle, so a line that stands in a third of all
documents is one row per task there. The occurrences that go are found by a join
with the digests that occur more than once, in which adaptive execution splits a
frequent digest; then their places meet the documents once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .workspace import ID, TEXT, Workspace, kept_schema, texts

MIN_WORDS = 8
# Fixed value: what ends a sentence.
SENTENCE = r"[^.!?。！？]+[.!?。！？]*|[.!?。！？]+"
_SENTENCE = re.compile(SENTENCE)
# The same marks as bytes; white space inside a line is what is neither visible nor a line feed.
ASCII_MARKS = np.zeros(256, bool)
ASCII_MARKS[[ord(c) for c in ".!?"]] = True
WIDE_MARKS = [int.from_bytes(c.encode()) for c in "。！？"]
WIDE_LEAD = np.zeros(256, bool)
WIDE_LEAD[[c >> 16 for c in WIDE_MARKS]] = True

U64 = np.uint64
HALVES = (U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F))

SPANS = "array<struct<start:int,end:int>>"


def _marks(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a mark that ends a sentence."""
    marks = ASCII_MARKS[data]
    lead = np.flatnonzero(WIDE_LEAD[data[:-2]])
    lead = lead[np.isin(data[lead].astype(np.int64) << 16 | data[lead + 1].astype(np.int64) << 8 | data[lead + 2], WIDE_MARKS)]
    for byte in range(3):
        marks[lead + byte] = True
    return marks


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each unit begins, also one of blanks alone; its text, its line there, and its number in the line."""
    ends, feed = _marks(data), data == 10
    begins = np.ones(len(data), bool)
    begins[1:] = feed[:-1] | (ends[:-1] & ~ends[1:])
    begins[offsets[offsets < len(data)]] = True
    begins &= ~feed
    at = np.flatnonzero(begins)
    text = np.searchsorted(offsets, at, "right") - 1
    feeds = np.flatnonzero(feed)
    row = np.searchsorted(feeds, at)  # lines over all texts, but for the ends of texts
    fresh = np.ones(len(at), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    number = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return at, text, row - np.searchsorted(feeds, offsets[:-1])[text], number


def _digests_of(column: pa.Array, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and both halves of the digest of each unit, and of each pair with a short one."""
    data, offsets = tk.bytes_of(column)
    at, text, line, number = _units(data, offsets)
    starts, ends, unit = tk.spans(data, np.append(at, len(data)), tk.VISIBLE)
    first = np.searchsorted(unit, np.arange(len(at) + 1))
    size = np.diff(first)
    place = (np.arange(len(unit)) - first[unit]).astype(U64)
    data, whole = tk.LOWER[data], []
    for half, backward in zip(HALVES, (False, True)):
        word = tk.mix(tk.span_hashes(data, starts, ends, backward) + place * half)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(word, dtype=U64)])
        whole.append(tk.mix(sums[first[1:]] - sums[first[:-1]] + size.astype(U64)))
    own = np.flatnonzero(size >= min_words)
    low, next_, joined = size < min_words, slice(1, None), np.zeros(len(at), bool)
    joined[:-1] = (size[:-1] > 0) & (size[next_] > 0) & (low[:-1] | low[next_]) & (text[:-1] == text[next_]) & (line[:-1] == line[next_])
    pair = np.flatnonzero(joined)
    which = np.where(low[pair], np.where(low[pair + 1], 3, 1), 2)
    both = np.concatenate([own, pair])
    spot = (line[both] << 32) + (number[both] << 2) + np.concatenate([np.zeros(len(own), np.int64), which])
    # The second of a pair goes through one more step, so that the order counts.
    d1, d2 = (np.concatenate([w[own], tk.mix(w[pair] + tk.mix(w[pair + 1] + half))]) for w, half in zip(whole, HALVES))
    return text[both], spot, d1, d2


@tk.freed
def _digests(min_words: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tk.slices(batches, TEXT):
        text, at, d1, d2 = _digests_of(batch.column(TEXT), min_words)
        own = pa.array(text)
        columns = [batch.column(ID).take(own), batch.column("twin").take(own), *map(pa.array, (at, d1.view(np.int64), d2.view(np.int64)))]
        yield pa.RecordBatch.from_arrays(columns, [ID, "twin", "at", "d1", "d2"])


def unit_digests(base: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, twin, at, d1, d2) of the units of each text, and of pairs with a short unit.

    ``at`` is the place: the line in the upper half, then the unit in it, and in the last
    two bits what goes when the digest occurred before: 0 the unit by itself, of
    a pair 1 the unit, 2 the next one, 3 both. ``d1`` and ``d2`` are the digest.
    """
    schema = f"{kept_schema(base)}, twin bigint, at bigint, d1 bigint, d2 bigint"
    return base.select(ID, "twin", TEXT).mapInArrow(partial(_digests, min_words), schema)


def without(text: str, gone: set[int]) -> tuple[str, list[dict]]:
    """The text without the units at these places (line << 30 | number in it), and the removed spans in order."""
    kept, spans, at = [], [], 0
    hit = {place >> 30 for place in gone}
    for number, line in enumerate(text.split("\n")):
        if number not in hit:
            kept.append(line)
            at += len(line) + 1
            continue
        parts = _SENTENCE.findall(line)
        out = [number << 30 | s in gone for s in range(len(parts))]
        if all(o or not part.strip(" \t\x0b\f\r") for o, part in zip(out, parts)):
            spans.append({"start": at, "end": at + len(line)})
        else:
            start = at
            for o, part in zip(out, parts):
                if o:
                    spans.append({"start": start, "end": start + len(part)})
                start += len(part)
            kept.append("".join(part for o, part in zip(out, parts) if not o))
        at += len(line) + 1
    return "\n".join(kept), spans


def _places(at: Iterable[int]) -> set[int]:
    """The units that go for the digests at these places: the unit itself, or the next one, or both."""
    out = set()
    for unit, which in ((a >> 2, a & 3) for a in at):
        out |= {unit} if which < 2 else {unit + 1} if which == 2 else {unit, unit + 1}
    return out


def _cut(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
    done = [(None, None) if t is None else without(t, _places(g.tolist())) for t, g in zip(text, gone)]
    return pd.DataFrame({"text": [t for t, _ in done], "removed": [r for _, r in done]}, dtype=object)


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: all columns of ``docs``, the text without its repeated units, and more.

    ``_n_lines``, ``_n_removed`` and ``_removed``: the removed units as spans
    ``[start, end)`` in characters of the original text, in order, without the
    line end; of a removed line only its own span. Kept lines are joined by line
    feeds.

    A NULL text stays NULL and has no lines; an empty text has one empty line.
    Within one document a later repeat goes too. NULL ids count as smallest.
    Rows equal in id and text are one document given twice and come out alike.
    Other columns are returned as they are, whatever their names; an empty table
    gives an empty result.
    """
    # id and a hash of the text name a document, so that rows with one id and different texts stay apart
    work = Workspace(docs.sparkSession, "lines")
    base = texts(docs, id_col, text_col).withColumn("twin", F.xxhash64(TEXT))
    units = work.write(unit_digests(base, min_words), "units")
    place = F.struct(ID, "twin", "at")
    first = units.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = units.join(first.drop("n"), ["d1", "d2"]).where(place != F.col("first"))
    gone = again.groupBy(F.col("twin").alias("_gone_twin"), F.col(ID).alias("_gone_id")).agg(F.collect_set("at").alias("_gone"))
    # The other columns travel as one struct, so none of their names can clash, and the text once.
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    whole = docs.select(F.struct(*others).alias("_row"), F.col(f"`{id_col}`").alias(ID), F.col(f"`{text_col}`").cast("string").alias(TEXT))
    same = (F.xxhash64(TEXT) == F.col("_gone_twin")) & F.col(ID).eqNullSafe(F.col("_gone_id"))
    hit, text = F.col("_gone").isNotNull(), F.col(TEXT)
    cut = F.pandas_udf(_cut, f"text string, removed {SPANS}")
    joined = whole.join(gone, same, "left").withColumn("_cut", cut(F.when(hit, text), F.col("_gone")))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *[F.when(hit, F.col("_cut.text")).otherwise(text).alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(lines).alias("_n_lines"),
        F.when(hit, F.size("_cut.removed")).otherwise(0).alias("_n_removed"),
        F.when(hit, F.col("_cut.removed")).otherwise(F.array().cast(SPANS)).alias("_removed"),
    )
