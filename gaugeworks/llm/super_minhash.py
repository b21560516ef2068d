"""SuperMinHash near-duplicates (operator 12).

Every shingle draws a random permutation of the places of a signature, one place a step; a place keeps its
least (step, draw). Steps run for all shingles of many documents at once, and a document stops at the first
step after which no place of its signature is empty, since later steps only bring greater ranks. Ranks of one
shingle are correlated, no two alike, which lowers the variance of the estimate against plain MinHash.

Documents of equal sets are one node. Nodes that share a band meet in a bucket:

1. every node is compared on its full set with one leader that it meets most often; links form components;
2. in buckets that still hold several components, nodes of different ones are compared by sizes and signatures;
   a bucket reports a spanning forest of the pairs that these do not rule out, and forests form families;
3. in a family, nodes of different components are compared on full sets, and a spanning forest of the linked
   components joins them.

Buckets and families are compared in pairs of tiles, and only forests leave a task, so no group of copies
brings forth all its pairs. A component that fills tiles of its own is not compared within itself.

With 32 bands of 4 places a pair of similarity 0.8 meets in no bucket with probability 5e-8, and an estimate
under LEAST_ESTIMATE has 1e-8; both fall fast above 0.8. No bucket is capped or sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.components import connected_components
from gaugeworks.llm.shared import SALTS, row_key, saved, spread_join

#: Words of a shingle and the least similarity of a link in per cent; bands and places of a band.
SHINGLE, PERCENT, BANDS, PLACES = 5, 80, 32, 4
#: Estimates below rule a pair out (5.6 deviations under 0.8); nodes of a bucket's tile; shingles of a family's tile.
LEAST_ESTIMATE, TILE, FAMILY_TILE = 0.6, 512, 1 << 18
#: Shingles handled at once.
CHUNK = 1 << 18
_EMPTY = np.uint64(2**64 - 1)


def shingles(text: str | None, size: int = SHINGLE) -> set[bytes]:
    """Distinct shingles of lower-cased (A-Z) words; the whole sequence, if shorter; none without words."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def hashes(found: set[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of a set of shingles."""
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, found), "u8", len(found)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(values: np.ndarray, counts: np.ndarray, size: int = BANDS * PLACES) -> np.ndarray:
    """SuperMinHash of several sets, laid one after the other in `values`: a row of `size` ranks each.

    A rank is the step in the upper half and a 32-bit draw in the lower. A set without elements has a row of
    the greatest number.
    """
    found = np.full(len(counts) * size, _EMPTY, "u8")
    owner = np.repeat(np.arange(len(counts)), counts)
    swapped: list[np.ndarray] = []
    for step in range(size):
        drawn = _mixed(values + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = np.uint64(step) + ((drawn >> np.uint64(32)) * np.uint64(size - step) >> np.uint64(32))
        swapped.append(place)
        for earlier in range(step - 1, -1, -1):  # what stands there after the swaps before
            place = np.where(place == swapped[earlier], np.uint64(earlier), place)
        np.minimum.at(found, owner * size + place.astype("i8"), np.uint64(step << 32) | (drawn & np.uint64(0xFFFFFFFF)))
        unfilled = (found.reshape(-1, size) == _EMPTY).any(axis=1)[owner]
        if not unfilled.all():
            values, owner, swapped = values[unfilled], owner[unfilled], [s[unfilled] for s in swapped]
        if not len(values):
            break
    return found.reshape(-1, size)


def band_hashes(ranks: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One number for each band of each signature; bands of different numbers do not meet."""
    parts = ranks.reshape(len(ranks), bands, -1)
    found = np.broadcast_to(np.arange(1, bands + 1, dtype="u8"), (len(ranks), bands))
    for i in range(parts.shape[2]):
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, i])
    return found.view("i8")


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[np.ndarray], list[int]]]:
    """Runs of rows (without their last column, the text), their sorted hashes and their set sizes."""
    rows, found, counts, held = [], [], [], 0
    for batch in batches:
        for *row, text in zip(*batch.columns, strict=True):
            distinct = shingles(text.as_py(), size)
            rows.append([v.as_py() for v in row])
            counts.append(len(distinct))
            found.append(hashes(distinct))
            held += len(distinct) + 64
            if held >= CHUNK:
                yield rows, found, counts
                rows, found, counts, held = [], [], [], 0
    if rows:
        yield rows, found, counts


def signed(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, n, digest, signature, bands) of each row: set size, digest of the set, 16 bits a place."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets, counts in _sets(batches, shingle):
            ranks = signatures(np.concatenate(sets), np.array([len(s) for s in sets]))
            bands = pa.array(band_hashes(ranks).reshape(-1))
            columns = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([hashlib.md5(s.tobytes(), usedforsecurity=False).digest() for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in _mixed(ranks).astype("u2")], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) * BANDS + 1, BANDS, dtype="i4")), bands),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "digest", "signature", "bands"])

    schema = "doc_id bigint, key bigint, n bigint, digest binary, signature binary, bands array<bigint>"
    return _texts(documents).mapInArrow(found, schema)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text")


def stars(nodes: DataFrame) -> DataFrame:
    """(node, leader): for each node but the first of its buckets, the leader that it meets most often.

    A bucket's nodes are dealt to SALTS heaps with a leader each; the leaders meet in the bucket once more.
    """
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt")
    members = nodes.select(F.explode("bands").alias("bucket"), "node", salt)
    first = lambda *keys: F.first("node").over(Window.partitionBy(*keys).orderBy("node"))
    heaps = members.withColumn("leader", first("bucket", "salt"))
    tops = heaps.where("node = leader").select("bucket", "node").withColumn("leader", first("bucket"))
    met = heaps.select("node", "leader").union(tops.select("node", "leader")).where("node != leader")
    counts = met.groupBy("node", "leader").count()
    return counts.groupBy("node").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("leader"))


def open_nodes(nodes: DataFrame) -> DataFrame:
    """The rows of `nodes` (node, comp, bands) that share a bucket with a node of another component."""
    buckets = nodes.select(F.explode("bands").alias("bucket"), "node", "comp")
    several = buckets.groupBy("bucket").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most").select("bucket")
    return nodes.join(spread_join(buckets, several, "bucket", "node").select("node").distinct(), "node")


def tile_pairs(members: DataFrame, group: str, weight: Column, most: int, lists: list[str]) -> DataFrame:
    """Pairs of tiles that between them hold all pairs of rows of one `group` and different components (comp).

    A tile holds a weight of about `most`; `lists` are the columns kept, as arrays, once for either tile.
    Components heavier than that have tiles of their own, which are not paired with each other.
    """
    sizes = members.groupBy(group, "comp").agg(F.sum(weight).alias("size"))
    light = F.col("size") < most
    small = F.sum(F.when(light, F.col("size")).otherwise(0)).alias("small")
    groups = sizes.groupBy(group).agg(F.count("*").alias("comps"), small).where("comps > 1").select(group, "small")
    labels = sizes.join(groups, group).select(
        F.struct(group, "comp").alias("place"),
        F.when(light, F.lit(-1)).otherwise(F.col("comp")).alias("label"),
        F.ceil(F.when(light, F.col("small")).otherwise(F.col("size")) / most).alias("tiles"),
    )
    placed = spread_join(members.withColumn("place", F.struct(group, "comp")), labels, "place", "node")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).alias("tile")
    row = F.collect_list(F.struct(*lists)).alias("rows")
    tiles = placed.groupBy(group, "label", tile).agg(row).select(group, "label", "tile", *[F.col(f"rows.{c}").alias(c) for c in lists])
    tiles = saved(tiles, "tiles")
    others = tiles.toDF(group, *[f"other_{c}" for c in tiles.columns[1:]])
    before = F.struct("label", "tile") <= F.struct("other_label", "other_tile")
    pairs = tiles.join(others, group).where(before & ((F.col("label") != F.col("other_label")) | (F.col("label") == -1)))
    return pairs.select(*lists, *[f"other_{c}" for c in lists])


def forest(near: Iterator[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the pairs (index into nodes a, indexes into nodes b) connect, as pairs of a node and the least one of its group."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    tree = np.arange(len(nodes))
    for i, others in near:
        groups = np.unique(np.append(tree[right[others]], tree[left[i]]))
        if len(groups) > 1:
            tree[np.isin(tree, groups)] = groups[0]
    hung = np.flatnonzero(tree != np.arange(len(nodes)))
    return nodes[hung], nodes[tree[hung]]


def _forests(pairs: DataFrame, near: Callable, tied: int = 0) -> DataFrame:
    """(u, v): the forests of pairs of tiles, whose near nodes `near` gives from the columns of either tile.

    A forest ties what stands in the column of number `tied`: nodes, or their components.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.num_columns // 2
            for row in range(batch.num_rows):
                a, b = ([c[row].values for c in columns] for columns in (batch.columns[:half], batch.columns[half:]))
                u, v = forest(near(a, b), a[tied].to_numpy(), b[tied].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.mapInArrow(found, "u bigint, v bigint")


def weak_pairs(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v): forests of nodes (node, comp, n, signature, bands) of different components that share a bucket and may link."""
    least = LEAST_ESTIMATE * percent / PERCENT * BANDS * PLACES

    def near(a: list[pa.Array], b: list[pa.Array]) -> Iterator[tuple[int, np.ndarray]]:
        (comps, sizes), (others, other_sizes) = ([x.to_numpy() for x in t[1:3]] for t in (a, b))
        ranks, other_ranks = (np.frombuffer(b"".join(t[3].to_pylist()), "u2").reshape(len(t[3]), -1) for t in (a, b))
        for i in range(len(comps)):
            lesser, greater = np.minimum(sizes[i], other_sizes), np.maximum(sizes[i], other_sizes)
            kept = np.flatnonzero((comps[i] != others) & (100 * lesser >= percent * greater))
            yield i, kept[(ranks[i] == other_ranks[kept]).sum(axis=1) >= least]

    members = nodes.select(F.explode("bands").alias("bucket"), "node", "comp", "n", "signature")
    return _forests(tile_pairs(members, "bucket", F.lit(1), TILE, ["node", "comp", "n", "signature"]), near).distinct()


def family_links(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v): forests of the components that links join, of nodes (family, node, comp, n, members) of one family and different components."""

    def near(a: list[pa.Array], b: list[pa.Array]) -> Iterator[tuple[int, np.ndarray]]:
        (comps, sizes), (others, other_sizes) = ([x.to_numpy() for x in t[1:3]] for t in (a, b))
        sets = [np.frombuffer(x, "u8") for x in b[3].to_pylist()]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        shingles = np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        for i, own in enumerate(np.frombuffer(x, "u8") for x in a[3].to_pylist()):
            low, high = np.searchsorted(shingles, own), np.searchsorted(shingles, own, side="right")
            runs = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
            shared = np.bincount(owner[at], minlength=len(sets))
            yield i, np.flatnonzero((comps[i] != others) & (100 * shared >= percent * (sizes[i] + other_sizes - shared)))

    return _forests(tile_pairs(nodes, "family", F.col("n"), FAMILY_TILE, ["node", "comp", "n", "members"]), near, tied=1).distinct()


def sets_of(nodes: DataFrame, documents: DataFrame, shingle: int) -> DataFrame:
    """(node, members) of `nodes` (node, first): sorted hashes, made anew from the text of one of a node's documents."""
    name = lambda id_, key: F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("")), key)
    ids = nodes.select("node", name(F.col("first.doc_id"), F.col("first.key")).alias("row"))
    texts = _texts(documents).select(name(F.col("doc_id"), F.col("key")).alias("row"), "text")
    texts = texts.join(ids, "row").dropDuplicates(["row"]).select("node", "text")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets, _ in _sets(batches, shingle):
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "members"])

    return texts.mapInArrow(found, "node bigint, members binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of nodes whose full sets (node, members) link."""
    left = pairs.select("u", "v").join(sets.toDF("u", "left"), "u")
    both = spread_join(left, sets.toDF("v", "right"), "v", "u")
    return both.where(linked(F.col("left"), F.col("right"), percent)).select("u", "v")


def linked(left: Column, right: Column, percent: int) -> Column:
    """Whether two sets, given as their sorted hashes, share `percent` per cent of their union or more."""

    @F.arrow_udf("boolean")
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_linked(*(np.frombuffer(x.as_buffer(), "u8") for x in pair), percent) for pair in zip(*batch, strict=True)], pa.bool_())

    return found(left, right)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `documents` (doc_id, text; others are not read).

    Null texts and texts without a word have an empty set, which links with nothing: their component is
    their own doc_id. Equal sets are always one component, so repeated rows and rows that share a doc_id each
    give a row; the smallest doc_id of a component names it and is kept. A null doc_id is no smallest id: a
    component of such rows alone has null, and its rows are kept.
    """
    rows = saved(signed(documents, shingle), "signatures")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    same = [F.first(c).alias(c) for c in ("n", "signature", "bands")]
    nodes = rows.where("n > 0").groupBy("digest").agg(F.min(place).alias("first"), *same)
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    met = saved(stars(nodes), "stars")
    touched = nodes.join(met.select("node").union(met.select("leader")).distinct(), "node")
    sets = saved(sets_of(touched, documents, shingle), "sets")
    first = saved(confirmed(met.toDF("u", "v"), sets, percent), "links")
    roots = connected_components(first)
    left = saved(open_nodes(touched.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))), "open")
    families = connected_components(weak_pairs(left, percent)).toDF("node", "family")
    within = families.join(left.select("node", "comp", "n"), "node").join(sets, "node")
    second = saved(family_links(within, percent), "links")
    joined = connected_components(second).toDF("comp", "joined")
    comps = nodes.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("comp"))
    rooted = comps.join(joined, "comp", "left").select("digest", "first", F.coalesce("joined", "comp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    components = spread_join(rooted, least, "root", "digest").select("digest", F.col("least.doc_id").alias("component_id"))
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    full = spread_join(rows.where("n > 0").select("doc_id", "key", "n", "digest"), components, "digest", "key")
    found = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(empty)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
