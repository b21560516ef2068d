"""Approximate nearest neighbours by cross-polytope hashing (operator 6).

Three rounds of random signs and a fast Hadamard transform turn each unit vector pseudo-randomly; its bucket
in a table is the signed axis nearest to it. A query probes, in every table, the axes that it is nearest to,
and all vectors found there are ranked by their exact inner product on the original vectors.

For largest inner products of vectors of unequal length, data vectors are dealt to ranges of length. In each
range one coordinate is added that makes its vectors equally long and is zero in queries; nearest by angle is
then largest by inner product. Queries probe every range.

How much the buckets find depends on the vectors, so it is measured: some queries are also answered exactly,
block by block, and where too little was found all queries are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import saved

#: Tables, axes probed in each, vectors of a block. Recall at these figures is in the README.
TABLES, PROBES, BLOCK = 12, 20, 8192
#: Ranges of length at most, greatest ratio of lengths in one (the last takes all shorter vectors).
RANGES, RATIO = 8, 1.5
#: Queries that measure recall, and the recall below which all queries are answered exactly.
MEASURED, LEAST_RECALL = 256, 0.95
FOUND = "query_id bigint, vec_id bigint, score double"


class Rotations:
    """Pseudo-rotations of `tables` tables for vectors of `width` coordinates."""

    def __init__(self, width: int, tables: int = TABLES, seed: int = 3) -> None:
        self.size = 1 << max(1, (width - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, 3, self.size))

    def turn(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """The vectors, zeros added up to a power of two, after three rounds of signs and Hadamard transform."""
        turned = np.zeros((len(vectors), self.size))
        turned[:, : vectors.shape[1]] = vectors
        for signs in self.signs[table]:
            turned *= signs
            half = 1
            while half < self.size:
                pairs = turned.reshape(len(vectors), -1, 2, half)
                turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(vectors), -1)
                half *= 2
        return turned

    def axes(self, vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The nearest signed axes of each vector, nearest first: i for +i, size + i for -i."""
        turned = self.turn(vectors, table)
        signed = np.concatenate([turned, -turned], axis=1)
        probes = min(probes, signed.shape[1])
        best = np.argpartition(-signed, probes - 1, axis=1)[:, :probes]
        return np.take_along_axis(best, np.argsort(-np.take_along_axis(signed, best, axis=1), axis=1, kind="stable"), axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def search(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """The k nearest found for each query: query_id, rank, vec_id, score.

    Queries are the rows of `vectors` (vec_id, embedding) for which `is_query` holds; candidates are all rows
    but the query's own. Rows whose vec_id is null or whose vector is null, zero or holds null or non-finite
    components take no part. Vectors may differ in length; the shorter of two counts as continued by zeros.
    Rows that share a vec_id are one candidate, with the greatest score. Ties go to the smaller vec_id. An
    empty table gives no rows. Buckets are read block by block, however many vectors they hold. Where the
    buckets hold less than LEAST_RECALL of what MEASURED queries should find, the result is exact; otherwise it
    is for queries that found fewer than k, or than all candidates.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.coalesce(fine, F.lit(False)).alias("fine"))
    rows = rows.where("fine")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    known = rows.agg(F.max(F.size("v")).alias("width"), F.max(norm).alias("norm"), F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.count_distinct("vec_id").alias("ids")).first()
    if not known.asks:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = known.width
    shorter = F.floor(F.log(F.lit(known.norm) / norm) / F.lit(float(np.log(RATIO))))
    ranged = F.greatest(F.lit(0), F.least(F.lit(RANGES - 1), shorter)).cast("int").alias("ranged")
    longest = {r.ranged: r.norm for r in rows.groupBy(ranged).agg(F.max(norm).alias("norm")).collect()}  # RANGES at most
    rows = rows.select("vec_id", "asks", ranged, F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))).alias("v"))
    rotations = Rotations(width + 1, tables)
    lengths = np.array([longest.get(i, 0.0) for i in range(RANGES)])

    def placed(count: int, as_query: bool):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    values = _matrix(part.column(1), width)
                    norms = np.linalg.norm(values, axis=1)
                    if as_query:
                        own, room = None, np.zeros(len(values))
                    else:
                        own = part.column(2).to_numpy()
                        room = np.sqrt(np.maximum(0, lengths[own] ** 2 - norms**2))
                    full = np.column_stack([values, room])
                    full /= np.linalg.norm(full, axis=1, keepdims=True)
                    for table, probed in itertools.product(range(tables), longest if as_query else [None]):
                        axes = rotations.axes(full, table, count)
                        which = np.repeat(np.arange(len(values)), axes.shape[1])
                        ranges = own[which] if probed is None else probed
                        bucket = (ranges * tables + table) * 2 * rotations.size + axes.ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(bucket, pa.int32()), part.column(0).take(pa.array(which)), part.column(1).take(pa.array(which))], ["bucket", "vec_id", "v"]
                        )

        return place

    schema = "bucket int, vec_id bigint, v array<double>"
    index = saved(rows.select("vec_id", "v", "ranged").mapInArrow(placed(1, False), schema), "index")
    sizes = index.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # ranges x tables x axes at most
    dealt = index.join(F.broadcast(sizes), "bucket").selectExpr("bucket", "vec_id", "v", "int(pmod(xxhash64(vec_id), blocks)) AS block")
    asking = rows.where("asks").select("vec_id", "v").mapInArrow(placed(probes, True), schema)
    asked = asking.join(F.broadcast(sizes.toDF("bucket", "spread")), "bucket").selectExpr("bucket", "vec_id", "v", "explode(sequence(0, spread - 1)) AS block")

    def nearest(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(queries) and len(candidates):
            ids = candidates.column("vec_id").to_numpy()
            values = _matrix(candidates.column("v").combine_chunks(), width)
            ask_ids, asks = queries.column("vec_id").to_numpy(), _matrix(queries.column("v").combine_chunks(), width)
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            firsts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))  # rows of one id are one candidate
            ids = ids[firsts]
            for at in range(0, len(asks), 256):
                scores = np.maximum.reduceat(asks[at : at + 256] @ values.T, firsts, axis=1)
                scores[ask_ids[at : at + 256, None] == ids[None]] = -np.inf
                most = min(k, len(ids))
                least = -np.partition(-scores, most - 1, axis=1)[:, most - 1 : most]
                row, column = np.nonzero((scores >= least) & (scores > -np.inf))
                tied = scores[row, column] == least[row, 0]
                above = np.bincount(row[~tied], minlength=len(scores))
                place = np.cumsum(tied) - np.append(0, np.cumsum(np.bincount(row[tied], minlength=len(scores))))[row]
                keep = ~tied | (place <= most - above[row])  # ties in order of ids
                found[0].append(ask_ids[at : at + 256][row[keep]])
                found[1].append(ids[column[keep]])
                found[2].append(scores[row[keep], column[keep]])
        return pa.table([pa.array(np.concatenate(f) if f else [], t) for f, t in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    pairs = asked.groupBy("bucket", "block").cogroup(dealt.groupBy("bucket", "block")).applyInArrow(nearest, FOUND)
    found = saved(_top(_greatest(pairs), k), "nearest")

    def exact(asks: DataFrame, n: int) -> DataFrame:
        """The k nearest of `n` queries among all rows, every block of the one with every block of the other."""
        ask_blocks, blocks = -(-n // BLOCK), -(-known.n // BLOCK)
        every = lambda number, name: F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(name)
        dealt_to = lambda number, name: F.pmod(F.xxhash64("vec_id", "v"), F.lit(number)).cast("int").alias(name)
        left = asks.select("vec_id", "v", dealt_to(ask_blocks, "ask_block"), every(blocks, "block"))
        right = rows.select("vec_id", "v", dealt_to(blocks, "block"), every(ask_blocks, "ask_block"))
        met = left.groupBy("ask_block", "block").cogroup(right.groupBy("ask_block", "block")).applyInArrow(nearest, FOUND)
        return _top(_greatest(met), k)

    asks = rows.where("asks").select("vec_id", "v")
    # Whole ids: all rows of a query's id count.
    chosen = asks.select("vec_id").distinct().orderBy(F.xxhash64("vec_id")).limit(MEASURED)
    measured = saved(asks.join(F.broadcast(chosen), "vec_id"), "measured")
    wanted = exact(measured, measured.count())
    met = wanted.join(found.select("query_id", "vec_id", F.lit(1).alias("met")), ["query_id", "vec_id"], "left")
    recall = met.agg(F.count("met") / F.count("*")).first()[0]
    if recall is not None and recall < LEAST_RECALL:
        return exact(asks, known.asks)
    due = min(k, known.ids - 1)
    enough = saved(found.groupBy("query_id").count().where(F.col("count") >= due).select("query_id"), "enough")
    short = saved(asks.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    n_short = short.count()
    return found.join(enough, "query_id", "left_semi").select(found.columns).union(exact(short, n_short)) if n_short else found


def _greatest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def _top(best: DataFrame, k: int) -> DataFrame:
    """Each query's k best: largest score, then smallest vec_id; at most k rows of a bucket come in."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
