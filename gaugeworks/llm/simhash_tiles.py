"""SimHash near-duplicates by tiled exact comparison (operator 5).

Different fingerprints are laid in tiles by the population counts of their halves. Tiles whose counts differ
beyond the radius cannot hold a link and are never paired; within a pair, counts of the first quarter narrow
the rows to compare. What is left is compared exactly with exclusive-or and bit counts. A pair of tiles
reports a spanning forest of its links, so a group of near copies does not grow with the square of its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.components import connected_components
from gaugeworks.llm.shared import fresh, saved

#: Words of a shingle, seed of the hash, most differing bits of a link, fingerprints of a tile.
SHINGLE, SEED, RADIUS, TILE = 4, 42, 4, 4096


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of lower-cased (A-Z) words in shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    found = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), "<u8")
    counts = np.zeros(64, "i8")
    for i in range(0, len(found), 1 << 16):
        part = found[i : i + (1 << 16)]
        counts += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * counts > len(found), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a text column as a bigint with the same 64 bits."""

    @F.arrow_udf("bigint")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([simhash(row.as_py(), shingle) for row in batch], "u8").view("i8"))

    return found(text)


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one), as pairs of fingerprints."""
    nodes = a if same else np.concatenate([a, b])
    group = np.arange(len(nodes))
    quarter_a, quarter_b = (np.bitwise_count(t & np.uint64(0xFFFF)).astype("i8") for t in (a, b))
    order = np.argsort(quarter_b, kind="stable")
    sorted_b, counts = b[order], quarter_b[order]
    shift = 0 if same else len(a)
    left, right = [], []
    for count in np.unique(quarter_a).tolist():
        rows = np.flatnonzero(quarter_a == count)
        low, high = np.searchsorted(counts, [count - radius, count + radius + 1])
        for i in range(0, len(rows), 256):
            part = rows[i : i + 256]
            near = np.bitwise_count(a[part, None] ^ sorted_b[None, low:high]) <= radius
            for row in np.flatnonzero(near.sum(axis=1) > (1 if same else 0)).tolist():
                u = int(part[row])
                others = order[low:high][near[row]] + shift
                _, first = np.unique(group[others], return_index=True)
                for v in others[first].tolist():
                    if group[u] != group[v]:
                        left.append(u)
                        right.append(v)
                        group[group == group[v]] = group[u]
    return nodes[np.array(left, "i8")], nodes[np.array(right, "i8")]


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): links that connect whatever is connected by at most `radius` differing bits, in `fp` (bigint).

    At most 1,089 pairs of half counts exist; a pair with many fingerprints is dealt to several tiles.
    """
    halves = [F.bit_count(F.shiftrightunsigned("fp", 32)).alias("p"), F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)).alias("q")]
    cells = saved(fingerprints.select("fp").distinct().select("fp", *halves), "fingerprints")
    sizes = cells.groupBy("p", "q").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    number = F.pmod(F.xxhash64("fp"), F.col("tiles"))
    tiles = saved(
        cells.join(F.broadcast(sizes), ["p", "q"]).groupBy("p", "q", number.alias("tile")).agg(F.collect_list("fp").alias("fps")), "tiles"
    )
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1) if i + abs(j) <= radius and (i, j) >= (0, 0)]
    offset = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    others = tiles.select(offset.alias("o"), "*").select(
        (F.col("p") + F.col("o.i")).alias("p"), (F.col("q") + F.col("o.j")).alias("q"), F.col("tile").alias("other"), F.col("fps").alias("near"),
        (F.struct("o.i", "o.j") == F.struct(F.lit(0), F.lit(0))).alias("own"),
    )
    pairs = tiles.join(others, ["p", "q"]).where(~F.col("own") | (F.col("tile") <= F.col("other")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                a, b = (x.values.to_numpy().view("u8") for x in (a, b))
                u, v = _forest(a, b, same, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view("i8")), pa.array(v.view("i8"))], ["u", "v"])

    return pairs.select("fps", "near", F.col("own") & (F.col("tile") == F.col("other"))).mapInArrow(compared, "u bigint, v bigint")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for each row: its fingerprint and the smallest doc_id it is linked with.

    Fingerprints link at `radius` or fewer differing bits; components are those of the links. Null texts and
    texts without a word have fingerprint zero, linked like any other. Repeated rows and rows that share a
    doc_id each give a row. A null doc_id is no smallest id: a component of such rows alone has null.
    """
    return _rooted(documents, shingle, radius).select("doc_id", "fp", "component_id")


def _rooted(documents: DataFrame, shingle: int, radius: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row; the root of a component is its smallest fingerprint."""
    rows = saved(documents.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(least, radius)).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(components, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, columns unchanged: that of its smallest doc_id, or one of those without a doc_id if all are.

    Components are those of the links, not of doc_ids: rows that share a doc_id but are no near copies stay
    beside each other. Of rows equal in doc_id and fingerprint one stays.
    """
    taken = documents.columns
    fp, key = fresh(taken, "kept_fp"), fresh(taken, "kept_key")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp")).alias("least")
    identity = lambda doc_id, fp: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), fp)
    chosen = _rooted(documents, shingle, radius).groupBy("root").agg(least)
    kept = chosen.select(identity(F.col("least.doc_id"), F.col("least.fp")).alias(key))
    rows = documents.withColumn(fp, fingerprint(F.col("text"), shingle))
    rows = rows.withColumn(key, identity(F.col("doc_id").cast("long"), F.col(fp)))
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).drop(fp, key)
