"""Packing by lexical retrieval (operator 7): a sharded BM25 index finds what follows in a seed's window.

Whole windows of a document are sequences of their own. What is left of each document is dealt evenly to
shards of a bounded number of documents; a shard holds a BM25 index of its remainders, with document
frequencies and mean length of the whole corpus. A seed's best-scoring unused neighbours fill its window;
the last is cut where the window ends and its rest seeds the next one. So all windows of a shard are full
but the last, which is split into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.library_tokens import id_type, library_ids, library_memo
from gaugeworks.llm.pieces import gather
from gaugeworks.llm.shared import saved

#: Documents that are encoded at once: texts and ids of a batch are held several times over, in the JVM and in the worker.
BATCH_ROWS = 1000
#: Documents of a shard; terms of a seed's query, those of most weight in it; BM25's constants.
SHARD_DOCUMENTS, QUERY_TERMS, K1, B = 2048, 32, 1.2, 0.75
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int, window: int = 1024) -> DataFrame:
    """One row per piece: where it lies in its document (start, length) and in its sequence (offset).

    Null text counts as empty, so each row has `end_id` at least. Repeated rows and rows that share a doc_id
    are packed as documents of their own; a null doc_id stays null. An empty table gives no pieces. Other
    columns are ignored. `window` must be a power of two.
    """
    kind, size = id_type(tokenizer), library_memo(tokenizer).learn.size

    @F.arrow_udf("doc_tokens bigint, whole array<bigint>, rest binary")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            tokens, whole, rest = [], [], []
            for row in batch:
                ids = np.frombuffer(row.as_buffer(), kind)
                n = len(ids) // window
                raw = ids[: n * window].astype("<u4").tobytes()
                tokens.append(len(ids))
                whole.append([zlib.crc32(raw[i : i + 4 * window]) for i in range(0, len(raw), 4 * window)])
                rest.append(ids[n * window :].tobytes())
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array(whole, pa.list_(pa.int64())), pa.array(rest, pa.binary())], ["doc_tokens", "whole", "rest"]
            )

    ids = library_ids(F.col("text"), tokenizer, end_id)
    cuts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), cut(ids).alias("cut")).select("doc_id", "cut.*")
    cuts = saved(cuts, "packing", batch_rows=BATCH_ROWS)
    frequencies = np.zeros(size, "i8")
    for row in _document_frequencies(cuts, kind).collect():  # as many rows as the vocabulary at most
        frequencies[row.id] = row.n
    known = cuts.agg(F.count("*").alias("n"), F.avg(F.length("rest")).alias("mean")).first()
    idf = np.log(1 + (known.n - frequencies + 0.5) / (frequencies + 0.5))
    mean = (known.mean or 0) / np.dtype(kind).itemsize or 1.0
    shards = max(1, -(-known.n // SHARD_DOCUMENTS))

    def packed(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        return _pack_shard(key[0].as_py(), table, kind, idf, mean, window)

    numbered = cuts.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return numbered.groupBy("shard").applyInArrow(packed, SCHEMA)


def _document_frequencies(cuts: DataFrame, kind: str) -> DataFrame:
    """In how many remainders each id occurs: (id, n)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, "i8")
        for batch in batches:
            for row in batch.column(0):
                different = np.unique(np.frombuffer(row.as_buffer(), kind))
                if len(different) and different[-1] >= len(total):
                    total = np.append(total, np.zeros(int(different[-1]) + 1 - len(total), "i8"))
                total[different] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["id", "n"])

    return cuts.select("rest").mapInArrow(counted, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


class Bm25Index:
    """Postings of token ids over the remainders of one shard."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        self.n = len(texts)
        lengths = np.array([len(t) for t in texts], "i8")
        joined = np.concatenate([*texts, np.zeros(0, "u4")]).astype("i8")
        keys, counts = np.unique(joined * self.n + np.repeat(np.arange(self.n), lengths), return_counts=True)
        terms, self.docs = keys // max(1, self.n), keys % max(1, self.n)
        saturated = counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[self.docs] / mean))
        self.weights = idf[terms] * saturated
        self.bounds = np.searchsorted(terms, np.arange(len(idf) + 1))
        by_doc = np.lexsort((terms, -self.weights, self.docs))
        self.terms = terms[by_doc]
        self.doc_bounds = np.searchsorted(self.docs[by_doc], np.arange(self.n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the heaviest terms of the seed."""
        terms = self.terms[self.doc_bounds[seed] : self.doc_bounds[seed + 1]][:QUERY_TERMS]
        begins, lengths = self.bounds[terms], self.bounds[terms + 1] - self.bounds[terms]
        return np.bincount(gather(self.docs, begins, lengths), gather(self.weights, begins, lengths), minlength=self.n)


def _pack_shard(shard: int, table: pa.Table, kind: str, idf: np.ndarray, mean: float, window: int) -> pa.Table:
    rests = [np.frombuffer(b, kind).astype("<u4") for b in table.column("rest").to_pylist()]
    ids, tokens = table.column("doc_id").to_pylist(), table.column("doc_tokens").to_pylist()
    whole = table.column("whole").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, tokens[i], rests[i].tobytes()))
    pieces: list[tuple] = []
    sequence = shard << 32
    for i in order:
        for w, crc in enumerate(whole[i]):
            pieces.append((ids[i], w * window, window, crc, tokens[i], sequence, 0))
            sequence += 1
    left = [i for i in order if len(rests[i])]
    rests = [rests[i] for i in left]
    begin = [len(whole[i]) * window for i in left]
    for filled in _windows(rests, Bm25Index(rests, idf, mean), window):
        for part in _powers(filled, window):
            offset = 0
            for j, a, b in part:
                i = left[j]
                pieces.append((ids[i], begin[j] + a, b - a, zlib.crc32(rests[j][a:b].tobytes()), tokens[i], sequence, offset))
                offset += b - a
            sequence += 1
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    columns = zip(*pieces, strict=True) if pieces else [[]] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _windows(texts: list[np.ndarray], index: Bm25Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as (text, from, to); each but the last is full."""
    unused = np.ones(len(texts), dtype=bool)
    seed, at, following = -1, 0, 0
    while True:
        if seed < 0:
            while following < len(texts) and not unused[following]:
                following += 1
            if following == len(texts):
                return
            seed, at = following, 0
            unused[seed] = False
        filled = [(seed, at, len(texts[seed]))]
        room = window - (len(texts[seed]) - at)
        subject, seed = seed, -1
        if room > 0:
            scores = np.where(unused, index.scores(subject), -1.0)
            ranked = np.argsort(-scores, kind="stable")
            for j in ranked.tolist():
                if not unused[j]:
                    break
                unused[j] = False
                taken = min(room, len(texts[j]))
                filled.append((j, 0, taken))
                room -= taken
                if taken < len(texts[j]):
                    seed, at = j, taken
                if room == 0:
                    break
        yield filled


def _powers(filled: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """A full window as it is; a shorter one cut into runs whose lengths are powers of two, longest first."""
    total = sum(b - a for _, a, b in filled)
    sizes = [window] if total == window else [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    rest = list(reversed(filled))
    for size in sizes:
        part = []
        while size:
            j, a, b = rest.pop()
            taken = min(size, b - a)
            part.append((j, a, a + taken))
            size -= taken
            if a + taken < b:
                rest.append((j, a + taken, b))
        yield part
