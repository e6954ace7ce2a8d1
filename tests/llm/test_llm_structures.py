"""Packing, the Merkle manifest and whitening against plain versions."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD_TEXTS
from pyspark.sql import functions as F

from tenurelog.llm import queries
from tenurelog.llm.bpe_words import WordEncoder, require_byte_level
from tenurelog.llm.merkle import fold_proof, leaf_digest, merkle_proofs, proof_text
from tenurelog.llm.packing import best_fit, cut, lower_bound, pack, plan_packing, token_pieces
from tenurelog.llm.whitening import fit_whitening, refined_eigh, whiten

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# -- packing ---------------------------------------------------------------


def fewest_bins(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                place(i + 1, [*bins[:j], bins[j] + items[i], *bins[j + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def bins_of(plan, counts, capacity):
    used = Counter()
    for filling, times in plan:
        assert times > 0 and sum(length * k for length, k in filling) <= capacity
        for length, k in filling:
            used[length] += k * times
    assert used == Counter({length: c for length, c in counts.items() if c})
    return sum(times for _, times in plan)


def test_plans_of_small_tables_are_optimal():
    draw, better = random.Random(11), 0
    for _ in range(400):
        capacity = draw.choice([10, 20, 50, 100])
        items = [draw.randint(1, draw.choice([capacity, capacity // 2])) for _ in range(draw.randint(0, 10))]
        counts = Counter(items)
        want = fewest_bins(items, capacity)
        assert bins_of(plan_packing(counts, capacity), counts, capacity) == want
        assert lower_bound(counts, capacity) <= want
        better += bins_of(best_fit(counts, capacity), counts, capacity) > want
    assert better, "best fit alone must not solve them all"


def test_plan_size_does_not_follow_the_counts():
    draw = random.Random(3)
    small = Counter(min(1024, int(draw.lognormvariate(6, 0.8)) or 1) for _ in range(3000))
    huge = {length: c * 1_000_003 for length, c in small.items()}
    plan = plan_packing(huge, 1024, 300)
    used, bound = bins_of(plan, huge, 1024), lower_bound(huge, 1024)
    assert len(plan) < 5000 and bound <= used <= bound * 1.02
    with pytest.raises(ValueError):
        plan_packing({0: 1}, 1024)
    with pytest.raises(ValueError):
        plan_packing({1025: 1}, 1024)


def test_only_long_documents_are_cut_and_the_first_piece_is_short():
    document, piece, start, length = cut(np.array([1, 4, 5, 8, 11]), 4)
    got = [tuple(map(int, r)) for r in zip(document, piece, start, length)]
    assert got == [(0, 0, 0, 1), (1, 0, 0, 4), (2, 0, 0, 1), (2, 1, 1, 4), (3, 0, 0, 4), (3, 1, 4, 4), (4, 0, 0, 3), (4, 1, 3, 4), (4, 2, 7, 4)]


def library_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


SPECIAL = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y  z", "it's 'll  don't\n\n q", "a\u0085b   c d", " \t x", "é ü 中文 字 a b"]


def test_word_encoder_equals_the_library(docs):
    with open(VOCABULARY, encoding="utf-8") as f:
        definition = f.read()
    texts = [r[0] for r in docs.select("text").collect()] + [t for _, t in ODD_TEXTS] + SPECIAL
    encoder = WordEncoder(definition)
    for _ in range(2):  # the second time from the pieces remembered
        column = pa.array(texts, pa.string())
        from tenurelog.llm import tokens as tk

        ids, at = encoder.encode(*tk.bytes_of(column))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library_ids(t) for t in texts]
        if encoder.fast is not None:
            encoder.fast = None  # the second time by the library itself
            encoder.forget()


def test_unknown_definitions_are_refused():
    with open(VOCABULARY, encoding="utf-8") as f:
        definition = f.read()
    with pytest.raises(ValueError):
        require_byte_level(definition.replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false'))


def check_packed(rows, texts, capacity):
    """Pieces are those of the documents, and sequences have neither gaps nor overlaps."""
    ids = {key: library_ids(t) + [2] for key, t in texts}
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, own in ids.items():
        found = sorted(pieces[key], key=lambda r: r["piece"])
        assert [r["start"] for r in found] == [sum(r["length"] for r in found[:i]) for i in range(len(found))]
        assert sum(r["length"] for r in found) == len(own)
        assert len(found) == max(1, -(-len(own) // capacity)) and all(r["length"] == capacity for r in found[1:])
        for r in found:
            part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    return len(sequences)


def test_packed_documents_of_the_table(spark, sf_dir, docs):
    rows = queries.op11_bin_completion(spark, sf_dir).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    used = check_packed(rows, texts, 1024)
    bound = lower_bound(Counter(r["length"] for r in rows), 1024)
    assert used <= bound * 1.01 + 1


def test_packing_of_odd_texts_and_repeated_rows(odd, empty):
    pieces = token_pieces(odd, VOCABULARY, 2, 64).withColumn("ids_crc32", F.crc32("ids"))
    texts = [(i, t) for i, t in ODD_TEXTS]
    rows = pack(pieces.drop("ids").withColumn("_part", F.lit("clash")), capacity=64).collect()
    if len({i for i, _ in texts if i is not None}) == len(texts):
        check_packed(rows, texts, 64)
    assert len(rows) == pieces.count()
    twice = pack(pieces.union(pieces), capacity=64)
    assert twice.count() == 2 * len(rows)
    assert twice.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0
    assert pack(token_pieces(empty, VOCABULARY, 2)).collect() == []
    with pytest.raises(Exception, match="lengths must lie between"):
        pack(pieces.withColumn("length", F.lit(0).cast("long"))).collect()


# -- Merkle manifest -------------------------------------------------------


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fan=3):
    """Levels of a tree, from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + fan]) for i in range(0, len(last), fan)])
    return levels


def siblings(levels, rank, fan=3):
    out = []
    for level in levels[:-1]:
        first = rank // fan * fan
        run = level[first : first + fan]
        out += run[: rank - first] + run[rank - first + 1 :]
        rank //= fan
    return out


def plain_leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_proofs(rows):
    """(leaf, subroot, root, siblings) of rows (group, order, values), sorted by group and order, None first."""

    def key(value):
        return (value is not None, value.encode() if isinstance(value, str) else value)

    rows = sorted(((g, o, plain_leaf(*v)) for g, o, v in rows), key=lambda r: (key(r[0]), key(r[1]), r[2]))
    trees = [(g, plain_tree([r[2] for r in part])) for g, part in ((g, list(p)) for g, p in groupby(rows, key=lambda r: r[0]))]
    over = plain_tree([levels[-1][0] for _, levels in trees])
    out = []
    for s, (g, levels) in enumerate(trees):
        for rank, leaf in enumerate(levels[0]):
            out.append((leaf, levels[-1][0], over[-1][0], "".join(siblings(levels, rank) + siblings(over, s))))
    return out


@pytest.mark.parametrize("height", [1, 2, 6])
def test_proofs_against_a_plain_tree(spark, height):
    draw = random.Random(height)
    rows = [(g, draw.choice([None, *range(40)]), draw.choice([None, "", "x\ny", "é" * 50])) for g in (None, "", "b", "é", "Z") for _ in range(draw.choice([1, 2, 3, 10, 130]))]
    rows += [("one", 7, "alone")] + [("same", 1, "t")] * 31
    frame = spark.createDataFrame([(*r, "c") for r in rows], "src string, id long, body string, _group string")
    got = merkle_proofs(frame.repartition(5), ["id", "src", "body"], "src", "id", keep=["id", "_group"], height=height)
    assert got.columns == ["id", "_group", "leaf", "subroot", "root", "proof"]
    got = got.select("leaf", "subroot", "root", proof_text("proof").alias("p"), fold_proof("leaf", "proof").alias("f")).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(plain_proofs([(s, i, (i, s, b)) for s, i, b in rows]))
    assert all(r["f"] == r["root"] for r in got)


def test_proofs_of_odd_rows_and_of_none(odd, empty):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [(r["source"], r["doc_id"], tuple(r[c] for c in columns)) for r in odd.collect()]
    twice = merkle_proofs(odd.union(odd), columns, "source", "doc_id", keep=["doc_id"])
    got = twice.select("leaf", "subroot", "root", proof_text("proof")).collect()
    assert sorted(map(tuple, got)) == sorted(plain_proofs(rows * 2))
    assert merkle_proofs(empty, columns, "source", "doc_id", keep=["doc_id"]).collect() == []
    alone = merkle_proofs(odd.limit(1), columns, "source", "doc_id").first()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof"] == []


def test_leaf_digest_counts_bytes(spark):
    frame = spark.createDataFrame([(None, "", "é", -5)], "a string, b string, c string, d long")
    got = frame.select(leaf_digest(*map(F.col, "abcd"))).first()[0]
    assert got == h("-0:2:é2:-5")


def test_only_tampered_texts_fail(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in queries.op12_merkle_manifest(spark, sf_dir).collect()}
    for r in docs.collect():
        touched = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (r["text"] or "")
        assert got[r["doc_id"]]["verified"] is not touched


# -- whitening -------------------------------------------------------------


def symmetric(values, seed=1):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(n) - q.T @ q) / 2
    a = (q * np.sort(np.array(values, np.longdouble))[::-1]) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 60),
        np.r_[np.linspace(1, 2, 30), 3 + 1e-9 * np.arange(8), 5 + 1e-12 * np.arange(3)],
        np.r_[np.ones(12), np.linspace(2, 3, 20), 1e-9 * np.arange(9)],
        np.geomspace(1, 1e-13, 40),
        np.array([1.0, 1 + 1e-8, 1 + 2e-8, 1 + 1.5e-8, 7]),
        np.zeros(4),
        np.array([3.0]),
    ],
)
def test_eigenvectors_are_exact_also_in_clusters(values):
    a = symmetric(values)
    got, x = refined_eigh(a)
    scale = max(1e-300, float(np.abs(a).max()))
    assert float(np.abs(x.T @ x - np.eye(len(a))).max()) < 1e-16
    assert float(np.abs(a @ x - x * got).max()) < 1e-17 * scale * len(a)
    assert float(np.abs(got - np.sort(np.array(values))[::-1]).max()) < 1e-16 * max(scale, 1)
    if np.min(np.diff(np.sort(values)), initial=1) > 1e-10:  # float32 alone, or double, could not tell these
        plain = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
        assert float(np.abs(a @ plain.astype(np.longdouble) - plain * got).max()) > 1e-9 * scale or len(a) == 1


def plain_whitening(vectors, k=16):
    x = np.floor(np.array(vectors, float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    kept = min(k, int((e > np.trace(v) * len(s) * 2.3e-16).sum()))
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, (x - s / n) @ u[:, :kept] / np.sqrt(e[:kept]), e[:kept] / np.trace(v)


def compare(rows, vectors, ids, n_expected=None):
    n, deviation, whitened, explained = plain_whitening(vectors)
    k = whitened.shape[1]
    got = sorted((r["vec_id"], r["component"], r["deviation"], r["whitened"], r["explained"]) for r in rows)
    assert [g[:2] for g in got] == sorted((i, c) for i in ids for c in range(1, k + 1))
    at = {i: j for j, i in enumerate(ids)}
    found = np.zeros_like(whitened)
    for i, c, dev, w, share in got:
        assert int(dev) == deviation[at[i]]
        assert share == pytest.approx(explained[c - 1], rel=1e-9)
        found[at[i], c - 1] = w
    sign = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found - whitened * sign).max() < 1e-7
    return n


def test_whitening_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    sound = [r for r in rows if r["embedding"] and all(v is not None and np.isfinite(v) for v in r["embedding"])]
    got = queries.op13_refined_whitening(spark, sf_dir).collect()
    n = compare(got, [r["embedding"] for r in sound], [r["vec_id"] for r in sound])
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_of_odd_vectors(spark):
    draw = np.random.default_rng(4)
    good = [[float(v) for v in draw.normal(size=5)] for _ in range(40)]
    good += [good[0]] * 30 + [[float(v) + 1e-5 for v in good[1]]]  # repeats, and one that rounds like another
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0] * 4, [nan] + [0.0] * 4, [0.0, inf, 0.0, 0.0, 0.0], [None] * 5, [0.0, 1.0, None, 0.0, 0.0]]
    rows = [(i, v, "c") for i, v in enumerate(good)] + [(1000 + i, v, "c") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, _x string").repartition(7)
    model = fit_whitening(frame)
    got = whiten(frame, model).collect()
    n = compare(got, good, list(range(len(good))))
    assert model.n == n < len(good) and model.identity_error < 1e-12
    assert whiten(frame.limit(0), model).collect() == []


def test_whitening_without_enough_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, None)], "vec_id long, embedding array<float>")
    same = fit_whitening(frame)
    assert same.n == 1 and len(same.values) == 0 and whiten(frame, same).collect() == []
    assert fit_whitening(frame.limit(0)) is None and whiten(frame, None).collect() == []
    line = spark.createDataFrame([(None, [0.0, 0.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    model = fit_whitening(line)
    got = whiten(line, model).collect()
    assert [r["component"] for r in got] == [1, 1, 1] and {round(abs(r["whitened"]), 9) for r in got} == {1.0}
    assert all(r["explained"] == pytest.approx(1) for r in got)


def test_deviation_is_exact_beyond_64_bits(spark):
    frame = spark.createDataFrame([(i, [float(i) * 1e7, 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    model = fit_whitening(frame)
    got = {r["vec_id"]: int(r["deviation"]) for r in whiten(frame, model).collect() if r["component"] == 1}
    x = [int(i * 1e7 * 64) + 1_000_000 for i in range(50)]
    assert got == {i: (50 * x[i] - sum(x)) ** 2 for i in range(50)}
    assert max(got.values()) > 1 << 63
