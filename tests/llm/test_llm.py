"""Operators of the corpus part against brute force, libraries and exact round trips."""

import base64
import collections
import itertools
import random
import struct
import zlib
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gaugeworks.llm import (
    bm25_packing,
    bpe_bitmap,
    cross_polytope,
    language_id,
    license_zstd,
    line_dedup,
    queries,
    quality_forest,
    simhash_tiles,
    suffix_columns,
    token_files,
)
from gaugeworks.llm.components import connected_components
from gaugeworks.llm.shared import shared_folder

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "x", "é" * 150, "z" * 3000, "a b  c\t\td \xa0 e", "<|endoftext|> it's 12'34", "a<|endoftext|> b  <|endoftext|>c <|endoftext|><|endoftext|>\n<|endoftext|>.d e", "日本 語　テ\n" * 20, "ab" * 500]


@pytest.fixture(scope="module")
def documents(spark):
    """The smallest table, odd texts, a repeated row, a shared and two null ids, and columns with clashing names."""
    rows = [(9000 + i, text) for i, text in enumerate(ODD)] + [(None, "no id here"), (None, None), (9001, "same id"), (9004, "x")]
    odd = queries_schema(spark, rows)
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    names = ["fp", "digest", "start", "spans", "key", "unit", "verdict", "language", "score", "cut", "shard", "kept_fp", "a", "b"]
    return table.union(odd).withColumns({c: F.lit(None).cast("string") for c in names}).cache()


def queries_schema(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def empty(documents):
    return documents.where("false")


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(queries.BYTE_BPE)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_token_files(spark, documents, library):
    path = shared_folder(spark, "t")
    token_files.write_token_files(documents, path, queries.BYTE_BPE, 2)
    rows = token_files.read_token_files(spark, path).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    given = pairs(documents)
    wanted = sorted((d or -1, len(i := library(t)) + 1, crc([*i, 2])) for d, t in given)
    assert sorted((r.doc_id or -1, r.n_tokens, r.crc) for r in rows) == wanted
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows][:-1]]).tolist()
    assert [r.doc_id or -1 for r in rows] == sorted(d or -1 for d, _ in given)
    token_files.write_token_files(empty(documents), f"{path}-none", queries.BYTE_BPE, 2)
    assert token_files.read_token_files(spark, f"{path}-none").count() == 0


def test_variable_length_code():
    numbers = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1, 7, 1], "u4")
    control, data = token_files.pack(numbers)
    assert len(control) == 3 and token_files.unpack(control, data, np.array([9])).tolist() == numbers.tolist()


def test_packing_encodes_small_batches(spark, monkeypatch):
    """A batch is held several times over in an executor, so its documents are bounded."""
    most = bm25_packing.BATCH_ROWS

    def ids(text, path, end_id):
        @F.arrow_udf("binary")
        def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                assert len(batch) <= most
                yield pa.array([b"\1\0"] * len(batch), pa.binary())

        return found(text)

    monkeypatch.setattr(bm25_packing, "library_ids", ids)
    rows = spark.range(0, 2 * most + 5, 1, 1).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert bm25_packing.pack_documents(rows, queries.BYTE_BPE, 0).count() == 2 * most + 5
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_packing(documents, library):
    rows = bm25_packing.pack_documents(documents, queries.BYTE_BPE, 0).collect()
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at & (at - 1) == 0 and at <= 1024
    for d, t in set(pairs(documents)):
        ids = [*library(t), 0]
        copies = collections.Counter((r.start, r.length) for r in by[d, len(ids)])
        assert sum(length * n for (_, length), n in copies.items()) % len(ids) == 0
        if len(copies) == sum(copies.values()) and sum(r.length for r in by[d, len(ids)]) == len(ids):
            assert all(crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for r in by[d, len(ids)])
    assert bm25_packing.pack_documents(empty(documents), queries.BYTE_BPE, 0).count() == 0


def test_bm25_neighbours():
    texts = [np.array(t, "u4") for t in ([1, 2, 3, 9], [4, 5, 6, 9], [1, 2, 3, 8], [7, 9, 9, 9])]
    scores = bm25_packing.Bm25Index(texts, np.ones(10), 4.0).scores(0)
    assert np.argsort(-scores)[:2].tolist() == [0, 2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bitmap_bpe(spark, documents, name):
    path = public_tokenizers.path(name)
    memo = bpe_bitmap.rank_memo(path, public_tokenizers.PATTERN)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    wanted = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(1)
    texts = ODD + ["".join(pick.choices("ab the,'s.é\n", k=pick.randint(1, 60))) for _ in range(2000)] + ["".join(pick.choices("etaoin", k=20000))]
    for text, ids in zip(texts, memo.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == wanted.encode_ordinary(text or "")
        assert memo.learn.decode(ids) == (text or "").encode()
    rows = documents.select("text", bpe_bitmap.encode_ids(F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    rows = rows.withColumn("back", bpe_bitmap.decode_ids(F.col("ids"), path, public_tokenizers.PATTERN)).collect()
    assert all(bytes(r.back).decode() == (r.text or "") and r.ids == wanted.encode_ordinary(r.text or "") for r in rows)


def test_line_dedup_against_sql(spark):
    found = queries.op3_line_dedup(spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    wanted = duck.execute(queries.ORACLE["op3_line_dedup"]).fetchall()
    assert sorted(map(tuple, found.select("doc_id", "n_removed", "removed_chars", "kept_md5").collect())) == sorted(wanted)


def test_line_units():
    text = "One two three four five six. Seven. Eight nine\nten eleven twelve thirteen.  Last\xa0one"
    found = list(line_dedup.units(text))
    assert [(n, w, text[a:b]) for n, w, a, b, _ in found] == [(0, 6, text[:29]), (1, 8, text[29:])]
    assert [u[:4] for u in line_dedup.units("a b. \n\n c\n", 1)] == [(0, 2, 0, 8), (1, 1, 8, 10)]
    assert not list(line_dedup.units(None)) and not list(line_dedup.units(" \n. "[:2]))


def test_line_dedup_cases(spark, documents):
    first, second = "One two three four five six seven eight. ", "Nine ten eleven twelve thirteen fourteen fifteen sixteen.\n"
    stock = "Only eight words are in this stock line.\n"
    rows = [
        (2, "These are my very own words. " + first + second + "Tail"),
        (1, first + second.upper() + stock),
        (None, first.replace(" ", "\t ") + second),
        (3, stock + "other text that is long enough here."),
        (4, first + second + first + second),
        (2, "These are my very own words. " + first + second + "Tail"),
        (5, None),
        (6, ""),
    ]
    table = queries_schema(spark, rows)
    found = line_dedup.remove_repeats(table, spans_as="gone").collect()
    by = {(r.doc_id, r.text): [rows_text(rows, r.doc_id)[s["start"] : s["end"]] for s in r.gone] for r in found}
    assert by == {
        (2, "These are my very own words. Tail"): [first, second],
        (1, first + second.upper() + stock): [],
        (None, ""): [first.replace(" ", "\t "), second],
        (3, stock + "other text that is long enough here."): [],
        (4, ""): [first, second, first, second],
        (5, None): [],
        (6, ""): [],
    }
    assert len(found) == len(rows)
    assert line_dedup.remove_repeats(documents).columns == documents.columns
    assert line_dedup.remove_repeats(empty(documents)).count() == 0


def rows_text(rows, doc_id):
    return next(t for d, t in rows if d == doc_id) or ""


def test_repeated_strings_in_collections():
    pick = random.Random(3)
    for length in (1, 2, 3, 20):
        for _ in range(30):
            texts = [bytes(pick.choices(b"ab\0c"[: pick.randint(1, 4)], k=pick.randint(0, 60))) for _ in range(pick.randint(1, 10))]
            times = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
            wanted = [[times[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]
            assert [f.tolist() for f in suffix_columns.repeated_in_collection(texts, length)] == wanted


def test_columns_left_of_the_anchor_only(monkeypatch):
    """The same strings as by brute force, and no column is inserted for what stands right of the spots."""
    pick, written = random.Random(6), []
    write = suffix_columns._File.write
    monkeypatch.setattr(suffix_columns._File, "write", lambda self, values: (written.append(len(values)), write(self, values)))
    for alphabet in (b"ab", b"a\0c"):
        for length in (13, 16, 20):
            texts = [bytes(pick.choices(alphabet, k=pick.randint(0, 60), weights=[9] + [1] * (len(alphabet) - 1))) for _ in range(30)] * 2
            spots = [pick.randint(0, min(12, len(t))) for t in texts]
            places = [[(t[i : i + length], s - i) for i in range(min(s, len(t) - length) + 1)] for t, s in zip(texts, spots, strict=True)]
            times = collections.Counter(p for some in places for p in some)
            wanted = [[i for i, p in enumerate(some) if times[p] > 1] for some in places]
            written.clear()
            assert [np.flatnonzero(f).tolist() for f in suffix_columns.repeated_in_collection(texts, length, spots)] == wanted
            assert max(written) == len(texts) + sum(spots)


@pytest.mark.parametrize("variants", [2000, 2])
def test_repeated_strings(documents, monkeypatch, variants):
    monkeypatch.setattr(suffix_columns, "MOST_VARIANTS", variants)
    rows = suffix_columns.remove_repeated_strings(documents, 200, "kept_bytes", "gone").collect()
    texts = [(r.text or "").encode() for r in rows]
    times = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for r, text in zip(rows, texts, strict=True):
        edges = np.zeros(len(text) + 1, int)
        for i in range(len(text) - 199):
            if times[text[i : i + 200]] > 1:
                edges[i] += 1
                edges[i + 200] -= 1
        gone = np.cumsum(edges)[: len(text)] > 0
        assert bytes(r.kept_bytes) == np.frombuffer(text, "u1")[~gone].tobytes()
        assert [tuple(s) for s in r.gone] == suffix_columns._runs(gone)
    assert suffix_columns.remove_repeated_strings(empty(documents), 200, "k", "s").count() == 0


def test_equal_rows_remove_each_other(spark):
    text = " ".join(str(i * i) for i in range(90))
    rows = spark.createDataFrame([(1, text), (1, text), (2, "short"), (3, text[:250] + "x" * 10 + text[260:])], "doc_id int, text string")
    done = suffix_columns.remove_repeated_strings(rows).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in done) == [(1, 0), (1, 0), (2, 5), (3, len(text) - 250)]


def test_no_string_is_lost_before_sorting():
    pick = random.Random(5)
    for _ in range(40):
        middle = bytes(pick.choices(b"ab", k=80))
        spots = [pick.randint(0, 120) for _ in range(30)]
        segments = [bytes(pick.choices(b"ab", k=s, weights=[30, 1])) + middle + bytes(pick.choices(b"ab", k=pick.randint(120 - s, 120), weights=[30, 1])) for s in spots]
        times = collections.Counter((t[i : i + 200], s - i) for t, s in zip(segments, spots) for i in range(min(s, len(t) - 200) + 1))
        wanted = [any(times[t[i : i + 200], s - i] > 1 for i in range(min(s, len(t) - 200) + 1)) for t, s in zip(segments, spots)]
        assert (suffix_columns.may_share(segments, spots, 80, 200) >= wanted).all()


def test_simhash_components(documents):
    rows = simhash_tiles.near_duplicates(documents).collect()
    prints = np.array([r.fp for r in rows], "i8").view("u8")
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 4
    label = np.arange(len(rows))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    for group in set(label.tolist()):
        members = [r for r, g in zip(rows, label.tolist(), strict=True) if g == group]
        assert {r.component_id for r in members} == {min((r.doc_id for r in members if r.doc_id is not None), default=None)}
    kept = simhash_tiles.keep_one(documents)
    assert kept.columns == documents.columns and kept.count() == len(set(label.tolist()))
    assert simhash_tiles.keep_one(empty(documents)).count() == 0


def test_simhash_bits():
    import xxhash

    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in (b"a b c d", b"b c d e")]
    found = simhash_tiles.simhash("A b C d E")
    assert found == sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) > 1)
    assert simhash_tiles.simhash(" \n") == 0 and simhash_tiles.simhash("One") == xxhash.xxh64_intdigest(b"one", seed=42)


def stages(spark, group, action):
    """How many stages the jobs of `action` have."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    tracker = context.statusTracker()
    return sum(len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup(group))


def test_components_take_few_stages(spark):
    """Trees of pointers, a path up and down, and a node of many smaller ones."""
    edges = [(i, i // 2) for i in range(2, 200)] + [(1000 + i, 1000 + (i * 37) % 101) for i in range(1, 101)]
    path = [3000, 2000, 3001, 2001, 3002, 2002, 3003, 2003]
    edges += [*itertools.pairwise(path), *[(5000, 4000 + i) for i in range(300)], (7, 7)]
    table = spark.createDataFrame(edges, "u bigint, v bigint")
    found = {}
    assert stages(spark, "components", lambda: found.update({r.node: r.root for r in connected_components(table).collect()})) < 75
    graph = {}
    for u, v in edges:
        a, b = graph.setdefault(u, {u}), graph.setdefault(v, {v})
        if a is not b:
            a |= b
            graph |= dict.fromkeys(a, a)
    assert found == {node: min(group) for node, group in graph.items()}


def test_components(spark):
    pick = random.Random(4)
    edges = [(pick.randint(0, 60), pick.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    linked = {n for u, v in edges if u != v for n in (u, v)}
    assert found == {n: label[n] for n in linked}


def test_nearest(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], "f8")
    extra = [(None, [1.0] * 64), (9001, None), (9002, [0.0] * 64), (9003, [float("nan")] * 64), (9004, [None] * 64)]
    both = table.select("vec_id", "embedding").union(spark.createDataFrame(extra, "vec_id bigint, embedding array<float>")).withColumn("bucket", F.lit(1))
    found = collections.defaultdict(dict)
    for r in cross_polytope.search(both, F.col("vec_id") % 20 == 0).collect():
        found[r.query_id][r.vec_id] = (r.rank, r.score)
    asked = np.flatnonzero(ids % 20 == 0)
    hits = 0
    for q in asked.tolist():
        scores = x @ x[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]].tolist()
        got = found[ids[q]]
        assert len(got) == 20 and all(abs(s - x[np.flatnonzero(ids == v)[0]] @ x[q]) < 1e-9 for v, (_, s) in got.items())
        order = sorted(got, key=lambda v: got[v][0])
        assert order == sorted(order, key=lambda v: (-got[v][1], v))
        hits += len(set(best) & set(got))
    assert hits >= 0.9 * 20 * len(asked)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [3.0]), (2, [0.5, 9.0]), (20, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in cross_polytope.search(few, F.col("vec_id") == 0, tables=4, probes=8).orderBy("rank").collect()] == [(0, 1), (0, 20), (0, 2)]
    assert cross_polytope.search(few.where("false"), F.lit(True)).count() == 0


def nearest_recall(spark, x):
    """(recall, rows) of 40 queries among the rows of x."""
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(set)
    for r in cross_polytope.search(rows, F.col("vec_id") < 40).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(40):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-scores)[:20].tolist()))
    return hits / 800, sum(map(len, got.values()))


@pytest.mark.parametrize("case", ["one long", "lognormal", "wide"])
def test_nearest_of_other_shapes(spark, case):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 768 if case == "wide" else 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if case == "one long":
        x[500] *= 100
    if case == "lognormal":
        x *= np.exp(rng.normal(size=(1000, 1)))
    recall, rows = nearest_recall(spark, x)
    assert rows == 800 and recall >= 0.9


def test_hadamard_turn_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 7))
    turned = cross_polytope.Rotations(7, 1).turn(x, 0)
    assert np.allclose((turned**2).sum(axis=1), (x**2).sum(axis=1) * 8**3)


def test_rule_statistics():
    words = [random.Random(i).choice("abcdef") * random.Random(i + 99).randint(1, 3) for i in range(80)]
    words += words[:20]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    again = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in again for j in range(i, i + 8)}
    assert quality_forest.repeated_words([w.encode() for w in words]) == len(covered)
    assert quality_forest.statistics("a# é\n \na# é\n|x")[:5] == (5, 8, 3, 1, 0)
    assert quality_forest.statistics(None)[:5] == (0, 0, 0, 0, 0)


def test_quality(spark, documents):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = quality_forest.judge(table, quality_forest.fit(table, labels), "v").join(labels, "doc_id")
    rates = {r.quality: r.rate for r in found.where("not v.base_failed").groupBy("quality").agg(F.avg(F.col("v.kept").cast("int")).alias("rate")).collect()}
    assert rates[1] > 0.98 and rates[0] < 0.6
    kept = quality_forest.keep_good(documents, labels.where("false"))
    assert kept.columns == documents.columns and 0 < kept.count() <= documents.count()
    assert quality_forest.keep_good(empty(documents), labels).count() == 0


def test_language(spark, documents):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(table.where(~held))
    found = table.where(held).select("lang", language_id.predict(F.col("text"), model).alias("p"))
    assert found.agg(F.avg((F.col("lang") == F.col("p.lang_pred")).cast("int"))).first()[0] > 0.98
    assert (model.weights == 0).mean() > 0.5
    assert [model.predict(t)[0] for t in (None, "", "12 !", "\n")] == ["und"] * 4
    tagged = documents.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    assert language_id.keep_identified(tagged).columns == tagged.columns
    assert language_id.keep_identified(empty(tagged)).count() == 0


def test_temperature_fits_overconfident_scores():
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.25), np.array([6.0, 0.0])) for _ in range(4000)]
    assert abs(6 / language_id.temperature(rows) - np.log(3)) < 0.15


def test_licenses(spark, documents):
    mit = license_zstd.TEMPLATES["mit-license"]
    first, second = mit.split("The above copyright")
    texts = {
        1: "intro\nReleased under the MIT License.\nmore",
        2: "Licensed under the Apache License,\nVersion 2.0.",
        3: "licensed under the apache license, version 1.1.",
        4: "Permission is hereby granted to sit down. No license.",
        5: mit.replace("charge", "any charge"),
        6: "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.",
        7: None,
        8: f"{first}\n\nThe above copyright{second}",
        9: "word " * 50000 + "// All rights\n// reserved.",
        10: "All rights reserved. " * 3000,
    }
    found = license_zstd.scan_licenses(queries_schema(spark, list(texts.items()))).collect()
    assert {(r.doc_id, r.license) for r in found} == {
        (1, "mit-notice"), (2, "apache-2.0-notice"), (5, "mit-license"), (6, "gpl-3.0-notice"), (6, "cc-by-nc-4.0-notice"), (8, "mit-license"),
        (9, "all-rights-reserved"), (10, "all-rights-reserved"),
    }
    assert [(r.missing, r.extra) for r in found if r.doc_id in (5, 8)] == [(0, 1), (0, 0)]
    assert sorted(r.start for r in found if r.doc_id == 10) == list(range(0, 63000, 21))
    assert next(texts[1][r.start : r.end] for r in found if r.doc_id == 1) == "Released under the MIT License"
    assert license_zstd.scan_licenses(empty(documents)).count() == 0 and license_zstd.scan_licenses(documents).columns[0] == "doc_id"


def test_licenses_at_every_place():
    """Each template at each word position of a long line, cut into small blocks too, is found where it was put."""
    scanner = license_zstd.Scanner(license_zstd.TEMPLATES)
    host = "the committee agreed that any such matter under the public law of the land may be granted or refused by the person in charge " * 20
    host = host.split()
    for name, template in license_zstd.TEMPLATES.items():
        for at in range(0, len(host), 7):
            before = " ".join(host[:at])
            (one,) = scanner.scan(f"{before} {template} {' '.join(host[at:])}")
            assert one["license"] == name and one["start"] == len(before) + 1 and (one["missing"], one["extra"]) == (0, 0)
            assert license_zstd.words(f"{before} {template}"[one["start"] : one["end"]] + ".") == scanner.words[name]


def test_license_differences_are_least():
    """Altered templates against plain dynamic programming over every stretch of the text."""
    rng = random.Random(5)
    scanner = license_zstd.Scanner(license_zstd.TEMPLATES)
    for name in ("isc", "gpl-header", "mpl-2.0-header"):
        template, allowed = scanner.words[name], scanner.allowed[name]
        for edits in range(0, 14):
            text = list(template)
            for _ in range(edits):
                i = rng.randrange(len(text))
                text[i : i + 1] = rng.choice([[], [text[i], "other"], [text[i], rng.choice(template)]])
            text = ["far", "off"] + text + ["after", "that"]
            best = min(_indels(text[a:], template) for a in range(len(text)))
            found = scanner.confirm(text, name)
            assert bool(found) == (best <= allowed), (name, edits)
            if found:
                assert found[0][2] + found[0][3] == best


def _indels(text, template):
    """Least number of words left out or put in between `template` and any beginning of `text`; digits are never left out."""
    row = list(range(len(template) + 1))
    for i, word in enumerate(template):
        row[i + 1] = row[i] + (10**6 if any(c.isdigit() for c in word) else 1)
    row[0], best = 0, row[-1]
    for n, word in enumerate(text, start=1):
        new = [n]
        for i, wanted in enumerate(template):
            skip = 10**6 if any(c.isdigit() for c in wanted) else 1
            new.append(min(new[i] + skip, row[i + 1] + 1, row[i] if word == wanted else 10**6))
        row, best = new, min(best, new[-1])
    return best


def test_nearest_with_repeated_ids(spark):
    """One id repeated as often as or more often than a query has places takes one of them; no query goes short."""
    rng = np.random.default_rng(1)
    for times in (19, 20, 30):
        values = rng.normal(size=(38, 8)) * 0.02 + 1
        ids = list(range(1, 39))
        rows = [(i, v.tolist()) for i, v in zip(ids, values)] + [(5, (values[4] * 1.5).tolist())] * times
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        best = {}
        for i, v in rows:
            best.setdefault(i, []).append(np.array(v))
        found = collections.defaultdict(list)
        for r in cross_polytope.search(frame, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
            found[r.query_id].append(r.vec_id)
        (query,) = found
        scores = {i: max(float(values[query - 1] @ v) for v in vs) for i, vs in best.items() if i != query}
        assert found[query] == sorted(scores, key=lambda i: (-scores[i], i))[:20]


def test_near_duplicates_keep_one_row_a_component(spark):
    """Rows that share a doc_id in two components, and rows without one."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in ("red", "blue", "green"))
    rows = [(7, a), (8, a), (7, b), (9, b), (None, c), (None, c), (None, a)]
    kept = simhash_tiles.keep_one(queries_schema(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(7, a), (7, b), (0, c)])


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert sorted(docs.columns) == sorted(columns), name
    assert 0.5 * before < docs.count() < before
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
