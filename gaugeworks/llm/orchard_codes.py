"""Product codes of vectors with Orchard's search for the nearest codebook entry (operator 11).

A codebook's entries each keep a list of the others, nearest first. The search of a part starts at an entry,
walks that entry's list, marks what it visits, and moves to the list of any entry that is nearer. Past an
entry that lies beyond twice the current distance no nearer one can follow, so it stops there. All parts of a
batch search at once. Components are integers throughout, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh, saved, spread_join

#: Components are multiplied by SCALE and floored; parts of a vector, entries of a codebook, rounds of learning.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Integers up to here are searched as 64-bit numbers, greater ones as exact Python integers; vectors handled at once.
SAFE, ROWS = 1 << 24, 4096


@dataclass
class Codebooks:
    """Entries of each part (lists of integers), the same number for all parts."""

    entries: list[list[list[int]]]

    def sha256(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for entry in part for x in entry).encode()).hexdigest()


def integers(vector: list[float]) -> list[int]:
    """floor(SCALE * x) of each finite component, exactly."""
    return [math.floor(SCALE * x) if abs(x) < 2**53 else SCALE * int(x) for x in vector]


def _exact(values: list[list[int]]) -> np.ndarray:
    """A matrix of 64-bit numbers where all squares and sums fit, otherwise of Python integers."""
    greatest = max((abs(x) for row in values for x in row), default=0)
    return np.array(values, "i8" if greatest < SAFE else object).reshape(len(values), len(values[0]) if values else 0)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def orchard(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each vector's nearest entry, ties to the lower index, and how many distances it took."""
    if object in (vectors.dtype, entries.dtype):
        vectors, entries = vectors.astype(object), entries.astype(object)
    among = _squares(entries[:, None], entries[None]) if len(entries) else np.zeros((0, 0))
    lists = np.argsort(among, axis=1, kind="stable")
    nearest = np.zeros(len(vectors), "i8")
    distance = _squares(vectors, entries[nearest])
    at = np.zeros(len(vectors), "i8")
    visited = np.zeros((len(vectors), len(entries)), bool)
    visited[:, 0] = True
    active, taken = np.arange(len(vectors)), len(vectors)
    while len(active):
        here = nearest[active]
        other = lists[here, at[active]]
        go = among[here, other] <= 4 * distance[active]  # twice the distance, squared; beyond it the search ends
        active, other = active[go.astype(bool)], other[go.astype(bool)]
        at[active] += 1
        new = ~visited[active, other]
        rows, candidates = active[new], other[new]
        visited[rows, candidates] = True
        taken += len(rows)
        found = _squares(vectors[rows], entries[candidates])
        better = ((found < distance[rows]) | ((found == distance[rows]) & (candidates < nearest[rows]))).astype(bool)
        rows = rows[better]
        nearest[rows], distance[rows], at[rows] = candidates[better], found[better], 0
        active = active[at[active] < len(entries)]
    return nearest, distance, taken


def bounds(width: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end; parts differ by at most one component."""
    return [width * i // parts for i in range(parts + 1)]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Matrices of the components of rows given by the columns of `COMPONENTS`."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            small, large = batch.slice(start, ROWS).columns
            if large.null_count == len(large):
                yield small.flatten().to_numpy(zero_copy_only=False).reshape(len(small), -1)
            else:
                yield _exact([[int(x) for x in v or w] for v, w in zip(small.to_pylist(), large.to_pylist(), strict=True)])


#: Columns of a vector's integers: 64-bit numbers where all are below SAFE, otherwise decimal strings; one of them is null.
COMPONENTS = ["components", "large"]


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, components, large) of the rows that take part.

    Null and empty vectors and those with null or non-finite components are dropped.
    """
    fine = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = vectors.where(fine).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    small = F.forall("embedding", lambda x: F.abs(x) < SAFE // SCALE)

    @F.arrow_udf("array<string>")
    def spelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([v and [str(x) for x in integers(v)] for v in batch.to_pylist()], pa.list_(pa.string()))

    components = F.when(small, F.transform("embedding", lambda x: F.floor(SCALE * x).cast("bigint")))
    return rows.select("vec_id", "label", components.alias("components"), spelled(F.when(~small, F.col("embedding"))).alias("large"))


def initial(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The codebooks made of the first vectors by vec_id (nulls last, then by components)."""
    numbers = F.coalesce(*[F.col(c).cast("array<double>") for c in COMPONENTS])
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), numbers, *COMPONENTS).limit(entries).collect()  # `entries` rows
    first = [[int(x) for x in r["components"] or r["large"]] for r in first]
    width = bounds(len(first[0]) if first else 0, parts)
    return Codebooks([[v[a:b] for v in first if len(v) == width[-1]] for a, b in zip(width, width[1:])])


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: the floored means of the parts nearest to each entry; unused ones stay."""
    matrices = [_exact(part) for part in books.entries]
    cuts = np.cumsum([0, *[m.shape[1] for m in matrices]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(m.shape, object) for m in matrices]
        counts = [np.zeros(len(m), "i8") for m in matrices]
        for values in _batches(batches):
            for part, matrix in enumerate(matrices):
                piece = values[:, cuts[part] : cuts[part + 1]]
                nearest, _, _ = orchard(piece, matrix)
                for entry in np.unique(nearest).tolist():
                    chosen = piece[nearest == entry]
                    totals[part][entry] += chosen.sum(axis=0).astype(object)
                    counts[part][entry] += len(chosen)
        found = [(p, e, int(counts[p][e]), [str(x) for x in totals[p][e]]) for p in range(len(matrices)) for e in np.flatnonzero(counts[p]).tolist()]
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "n", "sums"])

    each = rows.select(*COMPONENTS).mapInArrow(sums, "part int, entry int, n bigint, sums array<string>")
    each = each.select("part", "entry", "n", F.posexplode("sums").alias("at", "total"))
    totals = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    books = Codebooks([[list(entry) for entry in part] for part in books.entries])
    for r in totals.collect():  # a row for each component of the codebooks
        books.entries[r["part"]][r["entry"]][r["at"]] = int(r["total"]) // r["n"]
    return books


def learn(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after `rounds` rounds over all rows of `kept`."""
    books = initial(rows, parts, entries)
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def codes(components: Column, large: Column, books: Codebooks) -> Column:
    """A struct of the code of a vector (list of indexes) and its error, the sum of squared distances, as a decimal string."""
    matrices = [_exact(part) for part in books.entries]
    cuts = np.cumsum([0, *[m.shape[1] for m in matrices]])
    kind = pa.struct([("code", pa.list_(pa.int32())), ("error", pa.string())])

    @F.arrow_udf("struct<code:array<int>,error:string>")
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            results = []
            for values in _batches(iter([pa.RecordBatch.from_arrays(list(batch), COMPONENTS)])):
                each = [orchard(values[:, a:b], m) for m, a, b in zip(matrices, cuts, cuts[1:], strict=False)]
                indexes = np.stack([e[0] for e in each], axis=1).tolist()
                errors = [sum(map(int, ds)) for ds in zip(*[e[1] for e in each], strict=True)]
                results += [{"code": i, "error": str(e)} for i, e in zip(indexes, errors, strict=True)]
            yield pa.array(results, kind)

    return found(components, large)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) of each vector that takes part, and the codebooks.

    `vectors` has vec_id, embedding and label; other columns are not read. Besides what `kept` drops, vectors of
    another length than that of the smallest vec_id take no part. Fewer vectors than `entries` make smaller codebooks; rows that
    share a vec_id, and rows without one, each give a row. label_error sums the error over equal labels, nulls
    together. Errors that no long holds are null. An empty table gives no row.
    """
    rows = saved(kept(vectors), "components")
    books = initial(rows, parts, entries)
    width = sum(len(part[0]) for part in books.entries if part)
    rows = rows.where(F.size(F.coalesce("components", F.expr("transform(large, x -> 0L)"))) == width)
    books = learn(rows, parts, entries, rounds)
    coded = rows.withColumn("coded", codes(F.col("components"), F.col("large"), books))
    exact = F.col("coded.error").cast("decimal(38,0)")
    mark = F.struct(F.col("label").isNull().alias("none"), F.col("label").alias("value"))
    coded = saved(coded.select("vec_id", "label", F.to_json(mark).alias("mark"), "coded.code", exact.alias("error")), "codes")
    totals = coded.groupBy("mark").agg(F.sum("error").alias("label_error"))
    by = fresh(coded.columns, "by")
    result = spread_join(coded.withColumn(by, F.xxhash64("vec_id", "code")), totals, "mark", by)
    whole = lambda name: F.expr(f"try_cast({name} AS bigint)").alias(name)
    return result.select("vec_id", "label", "code", whole("error"), whole("label_error")), books
