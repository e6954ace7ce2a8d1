"""URLs, near duplicates, classifiers, shards, fingerprints and the pipeline."""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD_TEXTS, benchmark_hits, fold, near_classes, rows_of, without_repeats
from pyspark.sql import functions as F

from tenurelog.llm import imatch, language, quality, queries
from tenurelog.llm import tokens as tk
from tenurelog.llm import weighted_minhash as wm
from tenurelog.llm.byte_shards import byte_shards
from tenurelog.llm.components import components
from tenurelog.llm.decontaminate import find_benchmark_windows
from tenurelog.llm.url_reputation import judge_urls, suffix_and_domain
from tenurelog.llm.workspace import Workspace

# -- near duplicates -------------------------------------------------------


def test_near_duplicates_of_the_table(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(docs).collect()}
    assert got == near_classes(texts)


def test_large_group_of_near_copies(spark):
    """Copies of one text with a changed word each, all different, and a passage that others share."""
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.integers(0, 150)] = f"z{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base[:50] + [f"q{x}" for x in rng.integers(0, 10**9, 100)])) for i in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(300)} == {0}
    assert all(got[1000 + i] == 1000 + i for i in range(100))


def weighted_classes(rows):
    """Smallest id of the component of each id, by weighted similarity over all pairs, and the similar pairs."""
    found = [(i, t) for i, t in rows if t]
    column = pa.array([t for _, t in found])
    text, shingle, _ = wm.shingle_counts(column)
    df = np.bincount(wm._bucket(shingle), minlength=1 << wm.DF_BITS)
    idf = wm.to_levels(df, len(rows))
    pairs, parent = [], {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(found) - 1):
        left = pa.array([found[i][1]] * (len(found) - i - 1))
        like = wm.similarity(left, column[i + 1 :], idf)
        for j in np.flatnonzero((like >= wm.THRESHOLD - 1e-9) | np.array([found[i][1] == t for _, t in found[i + 1 :]])):
            a, b = found[i][0], found[i + 1 + j][0]
            pairs.append((a, b))
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}, pairs


def test_near_duplicates_equal_all_pairs_of_the_weighted_similarity(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, pairs = weighted_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(docs).collect()}
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
    assert all(want[i] == want[c] for i, c in got.items()), "nothing is joined that is not similar"


def test_edits_that_are_not_similar_do_not_hide_similar_ones(spark, monkeypatch):
    """Many texts share half of their shingles with one another and their buckets; a few pairs among them are similar."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(200):
        own = base[:96] + [f"z{x}" for x in rng.integers(0, 10**9, 24)]
        rows.append((i, " ".join(own)))
        if i % 20 == 0:
            rows.append((1000 + i, " ".join([*own[:-2], "other", "end"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want, pairs = weighted_classes(rows)
    assert len(pairs) >= 10
    widest = []
    compare = wm._Links.compare
    monkeypatch.setattr(wm._Links, "compare", lambda self, p, sketched=True: (widest.append(p.count()), compare(self, p, sketched))[1])
    got = {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(frame).collect()}
    assert got == want
    assert max(widest) < 210 * 16 * wm.LONG_LEADERS, "pairs must stay linear in the number of texts"
    assert {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(frame, exact=True).collect()} == want


def test_similar_texts_that_no_leader_meets_are_joined(spark, monkeypatch):
    """What the rounds of leaders leave over is found by prefixes: here all of it but each node's first try."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(150):
        own = base[:96] + [f"z{x}" for x in rng.integers(0, 10**9, 24)]
        rows.append((i, " ".join(own)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join([*own[:-2], "other", "end"])))
            rows.append((2000 + i, " ".join([*own, *own[100:]])))
    want, _ = weighted_classes(rows)
    assert len(set(want.values())) < len(rows) - 25
    monkeypatch.setattr(wm, "ROUNDS", 0)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in wm.near_duplicates(frame).collect()} == want


def test_near_duplicate_edges(odd, empty):
    got = sorted(((r["doc_id"], r["class_id"], r["keeper"]) for r in wm.near_duplicates(odd).collect()), key=repr)
    same = {9008, 9009, None}
    assert got == sorted(((i, 9008 if i in same else i, True) for i, _ in ODD_TEXTS), key=repr)
    assert wm.near_duplicates(empty).count() == 0


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(5)
    idf = np.full(1 << wm.DF_BITS, 3, np.uint8)
    a = " ".join(f"w{i}" for i in rng.integers(0, 50, 400))
    b = " ".join(a.split()[:300] + [f"v{i}" for i in rng.integers(0, 50, 100)])
    column = pa.array([a, b])
    text, shingle, count = wm.shingle_counts(column)
    first = np.unique(text, return_index=True)[1]
    got = wm.Sampler().samples(shingle, wm.levels(shingle, count, idf), first)
    truth = wm.similarity(pa.array([a]), pa.array([b]), idf)[0]
    assert 0.4 < truth < 0.8
    assert (got[0] == got[1]).mean() == pytest.approx(truth, abs=0.2)
    assert wm.similarity(pa.array([a, "", "x y"]), pa.array([a, "", "y x"]), idf).tolist() == [1.0, 0.0, 0.0]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, Workspace(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_components_know_their_end_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).count() == 0


def test_rows_are_counted_while_they_are_written(spark):
    """Without a job of their own; a table that Spark finds empty has none."""
    work = Workspace(spark, "test")
    table, n = work.write_counted(spark.range(1000).where("id % 3 = 0"), "rows")
    assert n == table.count() == 334
    none = spark.createDataFrame([], "id long")
    for empty in (none, none.join(spark.range(9), "id"), spark.range(9).where("id < 0").distinct()):
        table, n = work.write_counted(empty, "none")
        assert n == table.count() == 0


def test_near_duplicates_take_few_jobs(spark, docs):
    """Each job's plans, stages and threads cost the driver memory, whatever the size of the table."""
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "near duplicates")
    wm.near_duplicates(docs)
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("few-jobs")) <= 110


def test_pairs_bring_their_roots(spark, docs, monkeypatch):
    """Links need no join with the classes, and the pairs of a round are never of one class."""
    seen, compare = [], wm._Links.compare

    def checked(self, pairs, sketched=True):
        root = {bytes(r["node"]): bytes(r["root"]) for r in self.root.collect()}
        for r in pairs.collect():
            a, b = bytes(r["a"]), bytes(r["b"])
            assert a < b and {bytes(r["root_a"]), bytes(r["root_b"])} == {root.get(a, a), root.get(b, b)}
            assert r["root_a"] != r["root_b"]
            seen.append((a, b))
        compare(self, pairs, sketched)

    monkeypatch.setattr(wm._Links, "compare", checked)
    wm.near_duplicates(docs)
    assert seen


def test_the_driver_gives_memory_back_behind_frequencies(spark, docs, monkeypatch):
    calls, frequencies, release = [], wm.document_frequencies, tk.release
    monkeypatch.setattr(wm, "document_frequencies", lambda base: (calls.append("df"), frequencies(base))[1])
    monkeypatch.setattr(tk, "release", lambda: (calls.append("release"), release())[1])
    wm.near_duplicates(docs)
    assert calls == ["df", "release"] * 2


def test_the_driver_keeps_no_tables_of_powers(spark, docs, sf_dir):
    """What tokenising a sample leaves in the driver would stay for all later stages."""
    quality.fit_quality(docs, queries.table(spark, sf_dir, "labels"))
    assert len(tk._powers[0]) == 1
    find_benchmark_windows(docs, queries.table(spark, sf_dir, "benchmark"))
    assert len(tk._powers[0]) == 1


# -- URLs ------------------------------------------------------------------


def test_registered_domains(spark):
    names = [
        ("a.example.org", "org", "example.org"),
        ("x.shop.com.mx", "com.mx", "shop.com.mx"),
        ("a.b.go.kr", "go.kr", "b.go.kr"),
        ("www.firm.co.uk", "co.uk", "firm.co.uk"),
        ("me.github.io", "github.io", "me.github.io"),
        ("co.uk", "co.uk", "co.uk"),
        ("com.example.info", "info", "example.info"),
        ("de", "de", "de"),
        ("co", "co", "co"),
        ("10.0.0.12", "12", "0.12"),
        ("", "", ""),
    ]
    frame = spark.createDataFrame(names, "name string, suffix string, domain string")
    suffix, domain = suffix_and_domain(F.col("name"))
    got = frame.select("name", suffix.alias("s"), domain.alias("d"), "suffix", "domain").collect()
    assert [(r["s"], r["d"]) for r in got] == [(r["suffix"], r["domain"]) for r in got]


def test_url_parts_and_rules(spark):
    urls = [
        (1, "https://A.B.ORG/x?q#f"),
        (2, "http://org"),
        (3, "x://example.org/es/1"),
        (4, "x://sub.example.org/en/14.html"),
        (5, "x://notexample.org/es/"),
        (6, "x://a.com/fr/1"),
        (7, "x://a.com/de/1"),
        (8, "x://a.com?y/z"),
        (9, None),
        (10, "no scheme/de/"),
        (11, "x://org/"),
        (12, "a://b://c/d"),
        (13, ""),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"host": F.lit(1), "name": F.lit(2)})
    labelled = spark.createDataFrame([], "url string, good int")
    got = rows_of(judge_urls(pages, labelled, queries.RULES), "page_id")
    show = {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()}
    assert show == {
        1: ("a.b.org", "/x", "org/", "allow"),
        2: ("org", "", None, "allow"),
        3: ("example.org", "/es/1", "example.org/es/", "block"),
        4: ("sub.example.org", "/en/14.html", "example.org/en/1", "block"),
        5: ("notexample.org", "/es/", "org/", "allow"),
        6: ("a.com", "/fr/1", "com/fr/", "allow"),
        7: ("a.com", "/de/1", "com/de/", "block"),
        8: ("a.com", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("org", "/", "org/", "allow"),
        12: ("b:", "//c/d", None, "allow"),
        13: ("", "", None, "allow"),
    }


def test_reputation_shrinks_and_blocks(spark):
    good = [(f"x://h{i}.fine.net/{j}", 1) for i in range(30) for j in range(20)]
    bad = [(f"x://spam{i}.farm.info/{j}", 0) for i in range(30) for j in range(20)]
    few = [("x://one.mixed.net/1", 0), (None, 1), ("x://one.mixed.net/2", None)]
    labelled = spark.createDataFrame(good + bad + few, "url string, good int")
    asked = ["x://h1.fine.net/9", "x://spam1.farm.info/z", "x://new.farm.info/", "x://new.fine.net/", "x://one.mixed.net/"]
    pages = spark.createDataFrame(list(enumerate(asked)), "page_id long, url string")
    got = rows_of(judge_urls(pages, labelled, ()), "page_id")
    assert [got[i]["verdict"] for i in range(5)] == ["allow", "block", "block", "allow", "allow"]
    # an unlabelled host has the mean of its domain, not that of all pages
    assert got[2]["n_labelled"] == 0 and got[2]["posterior_mean"] < 0.1 < 0.9 < got[3]["posterior_mean"]
    assert got[4]["posterior_mean"] > 0.1  # one bad page does not condemn a host
    assert judge_urls(pages.limit(0), labelled, ()).count() == 0


# -- classifiers -----------------------------------------------------------


def test_gradients_match_differences():
    net = language.ByteGru(["a", "b"], seed=1)
    for k in net.w:
        net.w[k] = net.w[k].astype(float)
    rows = np.array([[32, 97, 98, 32], [32, 99, 97, 32]], np.uint8)
    truth = np.array([0, 1])
    loss, grads = net.gradients(rows, truth)
    rng = np.random.default_rng(0)
    for name in net.w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in net.w[name].shape)
            if name == "embed":
                at = (97, at[1])
            kept = net.w[name][at]
            net.w[name][at] = kept + 1e-3
            up = net.gradients(rows, truth)[0]
            net.w[name][at] = kept - 1e-3
            down = net.gradients(rows, truth)[0]
            net.w[name][at] = kept
            assert (up - down) / 2e-3 == pytest.approx(grads[name][at], abs=2e-4)


def test_language_on_held_out(spark, sf_dir, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in queries.op3_byte_gru(spark, sf_dir).collect()]
    assert len(got) == len(truth)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and len(r["lang_pred"]) == 2]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_language_edges(docs, odd, empty):
    got = language.identify_language(odd, docs, sample=20).collect()
    none = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert none == {9001, 9002, 9003, 9004} and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert language.identify_language(empty, docs, sample=5).count() == 0
    assert {r["lang_pred"] for r in language.identify_language(odd, empty).collect()} == {"und"}


def test_language_reads_the_whole_text(docs):
    net = language.train([("abc abd abe", "x"), ("nop noq nor", "y")], steps=30)
    reader = language.Reader(net)
    from tenurelog.llm import tokens as tk

    one, two = (reader.probabilities(*tk.bytes_of(pa.array([t])))[0] for t in ("abc " * 5000, "abc " * 2500 + "nop " * 2500))
    assert one[0] > two[0]
    again = reader.probabilities(*tk.bytes_of(pa.array(["abc " * 5000])))[0]
    assert again == pytest.approx(one)


def test_quality_on_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables hold some 70 labels to learn from
    if not os.path.isdir(sf_dir):
        pytest.skip("needs the tables of this size")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries.op4_random_indexing(spark, sf_dir).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9


def test_quality_edges(spark, docs, odd, empty):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (0, 1)], "doc_id long, quality int")
    net = quality.fit_quality(docs, labels)
    got = quality.score_quality(odd, net).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[9001] == by[9002] and by[9008] == by[9009]
    assert quality.score_quality(empty, net).count() == 0
    blank = quality.fit_quality(docs, labels.limit(0))
    assert all(r["score"] == 0.5 for r in quality.score_quality(odd, blank).collect())


def test_word_vectors_of_all_texts(spark):
    """Words of unlabelled texts have vectors too, the same however the rows are dealt out."""
    rows = [(0, "good plain words"), (1, "bad plain words")] + [(10 + i, f"rare{i} plain unseen{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    nets = [quality.fit_quality(docs.repartition(n), labels) for n in (1, 9)]
    assert np.array_equal(nets[0].vectors, nets[1].vectors)
    token, text = quality.tokens_of(*tk.bytes_of(pa.array([t for _, t in rows])))
    assert np.linalg.norm(nets[0].vectors[quality._bucket(token)], axis=1).min() > 0.99
    near = np.zeros(quality.SIZE << quality.BUCKET_BITS, np.int64)
    quality.add_neighbours(near, token, text)
    want = near.reshape(-1, quality.SIZE)
    assert nets[0].vectors == pytest.approx(want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9), abs=1e-6)
    # one text longer than a stretch: a word's sum has every neighbour within reach
    token = np.random.default_rng(1).integers(0, 1 << 62, quality.STRETCH + 9).astype(np.uint64)
    total = np.zeros_like(near)
    quality.add_neighbours(total, token, np.zeros(len(token), np.int64))
    signs = sum((1 - 2 * (tk.mix(token ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) & np.uint64(1)).astype(int)) for k in range(quality.ONES))
    ends = np.array([2, 3, *[4] * (len(token) - 4), 3, 2])
    assert total.sum() == (signs * ends).sum()


def test_temperature_improves_calibration():
    rng = np.random.default_rng(2)
    odds = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-odds))).astype(float)
    assert quality.QualityNet._calibrate(3 * odds, y) == pytest.approx(3, rel=0.2)


# -- shards ----------------------------------------------------------------


def check_shards(rows, texts, shards=8):
    rows = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    order = sorted(((-1 if r["doc_id"] is None else r["doc_id"]) for r in rows))
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in rows] == order  # contiguous in the order of ids
    sums = [0] * shards
    for shard in range(shards):
        own = [r for r in rows if r["shard"] == shard]
        assert [r["slot"] for r in own] == list(range(len(own)))
        sums[shard] = sum(r["size"] for r in own)
    largest = max(r["size"] for r in rows)
    assert max(sums) - min(sums) <= 2 * largest
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts
    )


def test_shards_of_the_table(spark, sf_dir, docs):
    check_shards(queries.op8_byte_shards(spark, sf_dir).collect(), [r["text"] for r in docs.collect()])


def test_shard_edges(odd, empty):
    check_shards(byte_shards(odd).collect(), [t for _, t in ODD_TEXTS])
    assert byte_shards(empty).count() == 0
    assert [r["shard"] for r in byte_shards(odd, shards=1).collect()] == [0] * len(ODD_TEXTS)


# -- fingerprints ----------------------------------------------------------


def edited_texts(rows):
    """Of (id, text) in order: each text with its last half taken from the next."""
    out = []
    for i, (_, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        out.append(text[: len(text) - half] + after[:half])
    return out


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 20_000])
def test_edited_texts_and_likeness(docs, bucket_bytes):
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    got = imatch.edited_fingerprints(docs, bucket_bytes=bucket_bytes).orderBy("doc_id").collect()
    assert [r["edited"] for r in got] == edited_texts(rows)
    for i, r in enumerate(got):
        a, b, c = (x.split("-") for x in (r["fingerprint"], r["edited_fingerprint"], got[(i + 1) % len(got)]["fingerprint"]))
        assert r["near_edited"] == pytest.approx(np.mean([x == y for x, y in zip(a, b)]))
        assert r["near_next"] == pytest.approx(np.mean([x == y for x, y in zip(a, c)]))
    assert np.mean([r["near_edited"] for r in got]) > np.mean([r["near_next"] for r in got])


def test_fingerprints_follow_lexicon_terms(spark):
    """Order, case, punctuation, repeats and rare words do not matter."""
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(common, 30))) for i in range(400)]
    twin = rows[7][1].split()
    rows.append((900, ", ".join(reversed(twin)).upper() + " veryrareword " + twin[0]))
    got = rows_of(imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), least=0.02, most=0.5))
    assert got[900]["fingerprint"].split("-")[0] == got[7]["fingerprint"].split("-")[0]
    assert len({r["fingerprint"] for r in got.values()}) == 400


def test_fingerprint_edges(odd, empty):
    got = imatch.edited_fingerprints(odd).collect()
    assert len(got) == len(ODD_TEXTS)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (9008, 9009, None)}) == 1
    assert {r["n_chars"] for r in got if r["doc_id"] in (9001, 9002)} == {0}
    assert imatch.edited_fingerprints(empty).count() == 0
    one = imatch.edited_fingerprints(odd.where("doc_id = 9005")).first()
    assert (one["edited"], one["near_next"]) == ("ono"[:2] + "o", 1.0)


# -- the pipeline ----------------------------------------------------------


def test_pipeline_stages_take_effect(spark, sf_dir, tmp_path):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_dedup", "line_dedup", "decontaminate", "encode"]
    seen = []
    for number, (name, stage) in enumerate(pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(out := os.path.join(tmp_path, str(number)))
        docs = spark.read.parquet(out)
        seen.append({r["doc_id"]: r for r in docs.collect()})
        if name != "encode":
            assert docs.columns == before.columns
    first, near, lines, clean, coded = seen
    scores = {r["doc_id"]: r["predicted"] for r in queries.op4_random_indexing(spark, sf_dir).collect()}
    assert set(first) == {i for i, p in scores.items() if p}
    classes = near_classes({i: r["text"] for i, r in first.items()})
    assert set(near) == set(classes.values())
    want = without_repeats(near[i]["text"] for i in sorted(near))
    assert {i: r["text"] for i, r in lines.items()} == {i: t for i, (t, _) in zip(sorted(near), want)}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())
    assert set(clean) == {i for i, r in lines.items() if not benchmark_hits(r["text"], bench)[2]}
    assert {i: r["decoded_sha256"] for i, r in coded.items()} == {
        i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in clean.items()
    }


def test_pipeline_edges(spark, odd, empty, sf_dir):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        rows = stage(spark, odd, sf_dir).collect()
        if name == "near_dedup":
            same = [r for r in rows if r["doc_id"] in (9008, 9009, None)]
            assert [r["doc_id"] for r in same] == [9008]
            assert len(rows) == len(ODD_TEXTS) - 3
        elif name != "quality" and name != "decontaminate":
            assert len(rows) == len(ODD_TEXTS)
