"""Orchard codes, SuperMinHash copies and the prefix trie against brute force, with odd rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import orchard_codes, prefix_trie, super_minhash
from gaugeworks.llm.shared import spread_join

SF = "/root/testdata/sf0.001"
CLASHING = ["node", "id", "pos", "bucket", "bands", "salt", "comp", "digest", "part", "at", "mark", "row", "top", "shard", "key", "n"]


def clashing(frame):
    return frame.withColumns({c: F.lit(1) for c in CLASHING if c not in frame.columns})


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_spread_join(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    lookup = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    found = spread_join(rows, lookup, "k", "id", "left").collect()
    assert len(found) == 1000 and all(r.v == {0: "a", 1: "b"}.get(r.k) for r in found)


# Orchard codes


def codes_by_brute_force(rows, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1])
    cuts = [width * i // 8 for i in range(9)]
    parts = [lambda v, a=a, b=b: v[a:b] for a, b in zip(cuts, cuts[1:])]
    books = [[list(cut(v)) for _, v, _ in kept[:entries]] for cut in parts]

    def nearest(x, book):
        return min((sum((a - c) ** 2 for a, c in zip(x, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p, cut in enumerate(parts):
            groups = collections.defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(cut(v), books[p])[1]].append(cut(v))
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if groups[i] else e for i, e in enumerate(books[p])]
    found, by_label = [], collections.Counter()
    for i, v, label in kept:
        near = [nearest(cut(v), books[p]) for p, cut in enumerate(parts)]
        found.append((i, label, [e for _, e in near], sum(d for d, _ in near)))
        by_label[label] += found[-1][3]
    long = lambda n: n if n < 2**63 else None
    return [(i, label, code, long(error), long(by_label[label])) for i, label, code, error in found], books


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_codes(spark, scale):
    rng = random.Random(5)
    rows = [(i, [scale * round(rng.gauss(0, 1), 3) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(120)]
    rows += [(3, rows[3][1], 1), (3, rows[4][1], 1), (None, rows[5][1], 2), (200, None, 1), (201, [], 1), (202, [1.0] * 15, 1)]
    rows += [(203, [None] + [1.0] * 15, 1), (204, [float("nan")] * 16, 1), (205, [float("inf")] * 16, 1), (206, [0.0] * 16, None)]
    table = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    found, books = orchard_codes.compress(table)
    wanted, wanted_books = codes_by_brute_force(rows)
    assert books.entries == wanted_books
    assert ordered(map(tuple, found.collect())) == ordered(wanted)


def test_codes_of_huge_few_and_no_vectors(spark):
    rows = [(1, [1e30] * 9, 1), (2, [-1e30] + [0.5] * 8, 1), (3, [0.0] * 9, 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found, books = orchard_codes.compress(table)
    assert ordered(map(tuple, found.collect())) == ordered(codes_by_brute_force(rows)[0])
    none, books = orchard_codes.compress(table.where("false"))
    assert none.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()


def test_orchard_search_spares_distances():
    rng = np.random.default_rng(0)
    entries = rng.integers(-1000, 1000, (64, 2))
    vectors = rng.integers(-1000, 1000, (500, 2))
    nearest, distance, taken = orchard_codes.orchard(vectors, entries)
    every = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
    assert nearest.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()
    assert taken < 0.7 * every.size


# SuperMinHash


def ranks_one_by_one(values, size):
    """The signature of a set, a whole permutation for each element."""
    found = [2**64 - 1] * size
    for value in values:
        places = list(range(size))
        for step in range(size):
            drawn = int(super_minhash._mixed(np.array([(value + (step + 1) * 0x9E3779B97F4A7C15) % 2**64], "u8"))[0])
            other = step + ((drawn >> 32) * (size - step) >> 32)
            places[step], places[other] = places[other], places[step]
            found[places[step]] = min(found[places[step]], step << 32 | drawn & 0xFFFFFFFF)
    return found


def test_signatures():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype="u8") for n in (1, 2, 0, 40, 300)]
    found = super_minhash.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), 32)
    assert found.tolist() == [ranks_one_by_one(s.tolist(), 32) for s in sets]


def test_estimates_vary_less_than_plain_minhash():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(200):
        shared, a, b = np.split(rng.integers(0, 2**63, 60, dtype="u8"), [40, 50])
        x, y = super_minhash.signatures(np.concatenate([shared, a, shared, b]), np.array([50, 50]))
        errors.append((x == y).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.02 and np.var(errors) < 0.8 * (40 / 60) * (20 / 60) / 128


def copies_by_brute_force(rows, size, percent):
    sets = [super_minhash.shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("size", [4, 5])
def test_copies(spark, size, monkeypatch):
    rng = random.Random(size)
    word = lambda: "".join(rng.choices("abcdef", k=3))
    rows = []
    for base in range(12):
        words = [word() for _ in range(rng.choice([8, 60, 250]))]
        for copy in range(rng.choice([1, 3, 25])):
            changed = list(words)
            for _ in range(rng.randrange(5)):
                changed[rng.randrange(len(words))] = word()
            rows.append((100 * base + copy, " ".join(changed).title() if copy % 2 else "\n".join(changed)))
    long = [word() for _ in range(30000)]
    rows += [(5000, " ".join(long)), (5001, " ".join([*long, "end"])), (5002, None), (5003, ""), (5004, " \t\n"), (5005, "A"), (5006, "a"), (5007, "a\xa0b c")]
    rows += [(100, rows[0][1]), (None, rows[0][1]), (None, "no id and no copy of it"), (None, None), rows[3], rows[3], (5008, "x y z w v " * 40), (5009, "x y z w v " * 41)]
    table = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = super_minhash.near_duplicates(table, size)
    assert ordered(map(tuple, found.collect())) == ordered(copies_by_brute_force(rows, size, 80))
    assert super_minhash.near_duplicates(table.where("false")).count() == 0


def test_links_that_no_leader_sees(spark, monkeypatch):
    """A chain of copies, each linked with the next alone, in tiles smaller than the buckets."""
    monkeypatch.setattr(super_minhash, "TILE", 4)
    monkeypatch.setattr(super_minhash, "FAMILY_TILE", 500)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[18 * i : 18 * i + 200])) for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = super_minhash.near_duplicates(table, 4)
    assert ordered(map(tuple, found.collect())) == ordered(copies_by_brute_force(rows, 4, 80))


# Prefix trie


def trie_by_brute_force(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    turns = {c: [pair for _, pair in sorted(ts)] for c, ts in turns.items()}
    nodes = collections.defaultdict(list)
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))
        whole = tuple(turns.get(base, [])[:h] + own[h:])
        for depth in range(len(whole) + 1):
            nodes[whole[:depth]].append((c, depth == len(whole)))
    children = collections.Counter(s[:-1] for s in nodes if s)
    leaves, tokens = collections.Counter(), collections.Counter()
    for s, members in nodes.items():
        for depth in range(len(s) + 1):
            leaves[s[:depth]] += children[s] == 0
            tokens[s[:depth]] += (len(members) - 1) * len(s[-1][1].encode().split()) if s else 0
    least = {s: min(c for c, _ in members) for s, members in nodes.items()}
    sha = lambda members: hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in members if end)).encode()).hexdigest()
    return [(least[s], len(s), least[s[:-1]] if s else None, len(m), children[s], leaves[s], tokens[s], sha(m)) for s, m in nodes.items()]


def odd_conversations():
    rng = random.Random(9)
    rows = []
    for conv in [*range(-30, 90), 4100, 8200, 8210]:
        kind = rng.randrange(4)
        for turn in range(rng.randrange(1, 7)):
            text = f"turn {turn} of {kind if turn < 4 else conv}"
            rows.append((conv, None if turn == 0 else turn, rng.choice(["user", None]) if turn == 5 else "user", rng.choice(["", None]) if turn == 3 else text))
    rows = [r for r in rows if r[0] != 60]  # conversations 61 to 79 have no base
    rows += [(7, 2, "tie", "b"), (7, 2, "tie", "a"), (7, 2, "tie", "a"), (None, 1, "user", "nowhere"), (8, None, "user", "second null")]
    return rows + [(40, 100 + i, "user", f"long {i} \xa0 word") for i in range(300)] + [(400, i, "u", "x" * 20000) for i in range(2)]


@pytest.mark.parametrize("limit", [1 << 16, 50, 1])
def test_trie(spark, limit, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 3)
    rows = odd_conversations() if limit > 1 else odd_conversations()[:200]
    table = clashing(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    found = prefix_trie.conversation_trie(table, limit=limit)
    assert ordered(map(tuple, found.collect())) == ordered(trie_by_brute_force(rows))


def test_trie_of_no_turns(spark):
    table = spark.createDataFrame([(None, 1, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.conversation_trie(table).count() == 0


def test_node_table():
    digests = np.random.default_rng(3).integers(0, 2**63, (10000, 2), dtype="u8")
    table = prefix_trie.NodeTable(digests)
    assert np.sort(table.slots(digests)).tolist() == list(range(10000))
    assert (table.slots(digests + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.concatenate([digests, digests[:1]]))
