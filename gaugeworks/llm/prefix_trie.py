"""Prefix trie of conversations in minimal-perfect-hash node tables (operator 13).

Prefixes are known by digests that add up over turns, so a long conversation is dealt in blocks. Distinct
digests are the nodes; all rows of one digest must agree in parent and last turn, which by induction rules
out collisions. Subtrees of at most LIMIT rows are dealt to shards whole. A shard gives each of its digests a
slot by a minimal perfect hash, checked against the digest kept in the slot, scatters counts into flat arrays
and adds them up through the array of parent slots, deepest first. What lies above those subtrees is a
smaller trie of its own, with the sums of the subtrees below it, and is treated likewise until all is done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import saved, spread_join

#: Rows of a subtree that a shard takes whole; turns of a block of digests; ids of a piece of an end list, as a power of two.
LIMIT, BLOCK, PIECE_BITS = 1 << 16, 4096, 12
WORD = r"[^\x20\x09-\x0D]+"


class NodeTable:
    """A minimal perfect hash of different 128-bit digests (rows of two numbers): each gets a slot under their count.

    Digests alone in their place of a level's bitmap get the next slots there; the others go to the next level.
    """

    def __init__(self, digests: np.ndarray, spread: float = 1.7) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.digests = np.empty_like(digests)
        left, taken = digests, 0
        while len(left):
            size = int(spread * len(left)) + 1
            places = self._places(left, len(self.levels), size)
            alone = np.bincount(places, minlength=size) == 1
            ranks = taken + np.cumsum(alone) - 1
            self.levels.append((alone, ranks))
            settled = alone[places]
            self.digests[ranks[places[settled]]] = left[settled]
            left, taken = left[~settled], taken + int(settled.sum())
            if len(self.levels) > 200:
                raise ValueError("a digest was given twice")

    @staticmethod
    def _places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        x = digests[:, 0] ^ (digests[:, 1] * np.uint64(2 * level + 0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * level)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype("i8")

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those not in the table; a slot counts only if it holds that digest."""
        found = np.full(len(digests), -1)
        left = np.arange(len(digests))
        for level, (alone, ranks) in enumerate(self.levels):
            places = self._places(digests[left], level, len(alone))
            met = alone[places]
            slots = ranks[places[met]]
            true = (self.digests[slots] == digests[left[met]]).all(axis=1)
            found[left[met][true]] = slots[true]
            left = left[~met]
        return found


def accumulate(parents: np.ndarray, depths: np.ndarray, children: np.ndarray, leaves: np.ndarray, tokens: np.ndarray) -> None:
    """Adds, in slots ordered by depth from the deepest, each node's sums to its parent's (parent slot -1: none here).

    Given are the children, leaves and tokens that come from outside; own tokens included.
    """
    inside = parents >= 0
    np.add.at(children, parents[inside], 1)
    leaves += children == 0
    order = np.argsort(-depths, kind="stable")
    order = order[inside[order]]
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1):
        np.add.at(leaves, parents[level], leaves[level])
        np.add.at(tokens, parents[level], tokens[level])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): places from 1 in the order of turn (null first), role and digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie"),
    )
    keys = ["conv_id", "turn", "role", "digest", "tie"]  # Spark puts nulls first
    parts = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = saved(parts.select("conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    runs = parts.groupBy("part", "conv_id").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")  # a row for each part
    placed = parts.join(runs.withColumn("before", before).drop("n"), ["part", "conv_id"])
    return placed.select("conv_id", (F.col("at") - F.col("start") + F.col("before") + 1).alias("pos"), "digest", "words")


def rebuilt(rows: DataFrame, every: int, heads: Column) -> DataFrame:
    """(c, len, pos, digest, words) of each conversation with its head exchanged, and a row at place 0 for each.

    The first `heads` (a column over conv_id, at most 3) turns come from conversation conv_id - conv_id % every.
    """
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("turns"))
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = convs.select("conv_id", "turns", base.alias("base"), heads.cast("long").alias("h"))
    convs = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("there")), "base", "left")
    head = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.select(F.col("conv_id").alias("c"), "base", "h", head.alias("head"), (head + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("len"))
    convs = saved(convs, "conversations")
    given = rows.where(f"pos <= 3 AND conv_id % {int(every)} = 0").withColumnRenamed("conv_id", "base")
    first = convs.where("head > 0").join(given, "base").where("pos <= head").select("c", "len", "pos", "digest", "words")
    own = spread_join(rows.withColumnRenamed("conv_id", "c"), convs.select("c", "h", "head", "len"), "c", "pos").where("pos > h")
    own = own.select("c", "len", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "digest", "words")
    root = convs.select("c", "len", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words"))
    return root.union(first).union(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """`rows` (c, len, pos, digest, words) with the digests of the prefix that ends there (id) and of its parent."""
    halves = [F.when(F.col("pos") == 0, 0).otherwise(F.xxhash64(F.lit(seed), "pos", "digest")) for seed in (1, 2)]
    own = [half for h in halves for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    rows = saved(rows.select("*", *[e.alias(f"e{i}") for i, e in enumerate(own)], F.floor(F.col("pos") / BLOCK).alias("block")), "rebuilt")
    within = Window.partitionBy("c", "block").orderBy("pos")
    totals = rows.groupBy("c", F.col("block") + 1).agg(*[F.sum(f"e{i}").alias(f"s{i}") for i in range(4)]).toDF("c", "block", "s0", "s1", "s2", "s3")
    before = Window.partitionBy("c").orderBy("block")
    carry = totals.join(rows.where(f"block > 0 AND pos % {BLOCK} = 0").select("c", "block"), ["c", "block"])
    carry = carry.select("c", "block", *[F.sum(f"s{i}").over(before).alias(f"s{i}") for i in range(4)])
    sums = rows.select("c", "len", "pos", "block", "digest", "words", *[f"e{i}" for i in range(4)], *[F.sum(f"e{i}").over(within).alias(f"w{i}") for i in range(4)])
    sums = sums.join(carry, ["c", "block"], "left")
    lanes = [F.col(f"w{i}") + F.coalesce(f"s{i}", F.lit(0)) for i in range(4)]
    named = lambda at, sums: F.unhex(F.md5(F.concat_ws(":", at, *sums)))
    parent = F.when(F.col("pos") > 0, named(F.col("pos") - 1, [lane - F.col(f"e{i}") for i, lane in enumerate(lanes)]))
    return sums.select("c", "len", "pos", "digest", "words", named(F.col("pos"), lanes).alias("id"), parent.alias("parent"))


def ends(full: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, c): SHA-256 of the sorted numbers c joined by commas, streamed in pieces of 2 ** PIECE_BITS."""
    piece = F.shiftright("c", PIECE_BITS).alias("piece")
    pieces = full.groupBy("id", piece).agg(F.array_join(F.sort_array(F.collect_list("c")), ",").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            ids, shas = [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if id_ == current:
                    state.update(b"," + text.as_py().encode())
                    continue
                if current is not None:
                    ids.append(current)
                    shas.append(state.hexdigest())
                current, state = id_, hashlib.sha256(text.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(shas, pa.string())], ["id", "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    return pieces.repartition("id").sortWithinPartitions("id", "piece").select("id", "text").mapInArrow(hashed, "id binary, ends_sha256 string")


def levels(rows: DataFrame, limit: int) -> list[DataFrame]:
    """Tables (id, top) of nodes and the top node of their subtree, deepest subtrees first; each node stands in one.

    `rows` (c, len, pos, id) are different conversations. A subtree holds at most `limit` rows of those that are
    left, so there are as many levels as the longest conversation has runs of `limit` turns, and one or two more.
    """
    found, part = [], saved(rows, "level")
    while True:
        size = F.sum(F.col("len") - F.col("pos") + 1)
        heavy = saved(part.groupBy("id").agg(size.alias("below")).where(F.col("below") > limit).select("id"), "heavy")
        if heavy.isEmpty():
            root = F.unhex(F.md5(F.lit("0:0:0:0:0")))  # as `prefixes` names place 0
            return [*found, part.select("id").distinct().withColumn("top", root)]
        cuts = spread_join(part, heavy, "id", "c").groupBy("c").agg((F.max("pos") + 1).alias("cut"), F.max_by("id", "pos").alias("last"))
        dealt = saved(spread_join(part, saved(cuts, "cuts"), "c", "pos"), "dealt")
        tops = dealt.where("pos = cut").select("c", F.col("id").alias("top"))
        light = spread_join(dealt.where("pos >= cut").select("c", "pos", "id"), tops, "c", "pos")
        found.append(saved(light.groupBy("id").agg(F.first("top").alias("top")), "light"))
        keep = cuts.groupBy("last").agg(F.min("c").alias("c")).select("c")
        above = spread_join(dealt.where("pos < cut"), keep, "c", "pos")
        part = saved(above.select("c", (F.col("cut") - 1).alias("len"), "pos", "id"), "level")


NODE = "id binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean"


def _shard(group: pa.Table) -> pa.Table:
    """All nodes of a shard with their sums."""
    column = {name: group.column(name).to_numpy() for name in ("conv_id", "depth", "n_convs", "words", "children", "leaves", "tokens")}
    pairs = lambda name: np.frombuffer(b"".join(x or bytes(16) for x in group.column(name).to_pylist()), "u8").reshape(-1, 2)
    own, above = pairs("id"), pairs("parent")
    table = NodeTable(own)
    slots = table.slots(own)
    if not np.array_equal(np.sort(slots), np.arange(len(own))):
        raise ValueError("two digests share a slot")
    flat = {name: np.empty_like(values) for name, values in column.items()}
    parents = np.empty(len(own), "i8")
    for name, values in column.items():
        flat[name][slots] = values
    parents[slots] = np.where(column["depth"] > 0, table.slots(above), -1)
    tokens = flat["tokens"] + (flat["n_convs"] - 1) * flat["words"]
    accumulate(parents, flat["depth"], flat["children"], flat["leaves"], tokens)
    inside = parents[slots] >= 0
    parent_conv = pa.array(flat["conv_id"][np.maximum(parents[slots], 0)], mask=~inside)
    values = [group.column("id"), group.column("parent"), column["conv_id"], column["depth"], parent_conv, column["n_convs"]]
    values += [flat["children"][slots], flat["leaves"][slots], tokens[slots], ~inside]
    names = ["id", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "top"]
    return pa.table(dict(zip(names, values, strict=True)))


def build(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of conversations given as (c, len, pos, digest, words) with a row at place 0 each.

    One row for each different prefix: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    rows = saved(prefixes(rows), "prefixes")
    full = rows.where("pos = len").select("id", "c")
    alike = full.groupBy("id").agg(F.min("c").alias("c"), F.count("*").alias("copies")).select("c", "copies")
    different = saved(spread_join(rows, alike, "c", "pos"), "different")
    one = lambda c: F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).otherwise(F.raise_error(F.lit(f"{c}: two prefixes share a digest")))
    nodes = different.groupBy("id").agg(
        one("parent").alias("parent"), one("digest").alias("digest"), one("pos").alias("depth"), F.min("c").alias("conv_id"),
        F.sum("copies").alias("n_convs"), F.min("words").alias("words"),
    )
    nodes = saved(nodes, "nodes")
    done: list[DataFrame] = []
    for level in levels(different.select("c", "len", "pos", "id"), limit):
        tops = [d.where("top AND depth > 0").select("parent", "n_leaves", "saved_tokens") for d in done]
        here = nodes.drop("digest").join(level, "id")
        sums = [F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("tokens")]
        if tops:
            here = here.join(reduce(DataFrame.union, tops).groupBy(F.col("parent").alias("id")).agg(*sums), "id", "left")
            here = here.fillna(0, ["children", "leaves", "tokens"])
        else:
            here = here.withColumns(dict.fromkeys(("children", "leaves", "tokens"), F.lit(0).cast("long")))
        here = saved(here, "here")
        shards = max(1, -(-here.count() // limit))
        shard = F.pmod(F.xxhash64("top"), F.lit(shards))
        dealt = here.withColumn("shard", shard).drop("top").groupBy("shard")
        done.append(saved(dealt.applyInArrow(_shard, NODE), "summed"))
    summed = reduce(DataFrame.union, done)
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    hung = spread_join(summed.where("top AND depth > 0").select("id", "parent"), above, "parent", "id").select("id", "above")
    found = summed.join(hung, "id", "left").join(ends(full), "id", "left")
    return found.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, every: int = 20, heads: Column | None = None, limit: int = LIMIT) -> DataFrame:
    """The trie of `conversations` (conv_id, turn, role, text) rebuilt with shared heads; other columns are not read.

    `heads` defaults to crc32 of the decimal conv_id modulo 4. Rows without a conv_id take no part; null role or
    text is empty; turns alike in conv_id and turn follow each other by role and digest, and repeated rows are
    turns of their own. Without any row there is no node, not even the root.
    """
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4 if heads is None else heads
    return build(rebuilt(saved(turns(conversations), "placed"), every, heads), limit)
