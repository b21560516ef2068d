"""Token files: frequency-ranked ids in a byte-aligned variable-length code (operator 2).

An id is stored as its rank by frequency in the whole corpus, in one to four bytes. Two bits per id tell
how many; four of them make a control byte, and control bytes stand apart from data bytes. Decoding looks
control bytes up in a table of lengths and takes all data bytes of a block with numpy at once.

Folder layout: `ranks` (rank, id) and `blocks/part=NNNNN` with rows of about 256 kilobytes of documents in
ascending doc_id; the parts follow each other in doc_id too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.library_tokens import id_type, library_ids, library_memo
from gaugeworks.llm.pieces import gather
from gaugeworks.llm.shared import saved

#: Data bytes of a block, and documents of a part.
BLOCK_BYTES, PART_DOCUMENTS = 1 << 18, 20_000

#: Lengths of the four ids of each control byte, and the bits that a length keeps.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype="u4")


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers; the last control byte is filled with zero bits."""
    ranks = ranks.astype("<u4")
    code = (ranks > 0xFF).astype("u1") + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view("u1").reshape(-1, 4)[np.arange(4) <= code[:, None]]
    code = np.append(code, np.zeros(-len(code) % 4, "u1")).reshape(-1, 4).astype("u1")
    return (code << np.array([0, 2, 4, 6], "u1")).sum(axis=1, dtype="u1").tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The numbers of several runs packed one after another; counts holds how many each run has."""
    lengths = LENGTHS[np.frombuffer(control, "u1")].ravel()
    groups = (counts + 3) // 4 * 4
    lengths = gather(lengths, np.cumsum(groups) - groups, counts)
    begins = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", "u1")
    values = padded[begins].astype("u4")
    for i in (1, 2, 3):
        values |= padded[begins + i].astype("u4") << np.uint32(8 * i)
    return values & MASKS[lengths]


def count_ids(ids: Column, kind: str, size: int, frame: DataFrame) -> DataFrame:
    """How often each id occurs in a binary column: (id, n), at most `size` rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library_memo.cache_clear()  # the texts are encoded by now; a worker's memory goes to the next steps
        total = np.zeros(size, "i8")
        for batch in batches:
            for row in batch.column(0):
                total += np.bincount(np.frombuffer(row.as_buffer(), kind), minlength=size) if len(row.as_buffer()) > size else 0
            small = [row.as_buffer() for row in batch.column(0) if len(row.as_buffer()) <= size]
            if small:
                total += np.bincount(np.frombuffer(b"".join(small), kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["id", "n"])

    partial = frame.select(ids.alias("ids")).mapInArrow(counted, "id int, n bigint")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encodes `text` of all documents, each with `end_id` after it, into token files at `path`.

    Null text counts as empty. Rows are ordered by doc_id, null first; rows that share one, by their ids.
    Repeated rows are all kept. An empty table gives files without blocks. Other columns are ignored.
    """
    spark, kind, size = documents.sparkSession, id_type(tokenizer), library_memo(tokenizer).learn.size
    raw = saved(documents.select(F.col("doc_id").cast("long").alias("doc_id"), library_ids(F.col("text"), tokenizer, end_id).alias("ids")), "token-ids")
    counts = count_ids(F.col("ids"), kind, size, raw).orderBy(F.desc("n"), "id").collect()  # as many rows as the vocabulary at most
    order = [row.id for row in counts]
    spark.createDataFrame(list(enumerate(order)), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.zeros(size, "u4")
    ranks[order] = np.arange(len(order))

    @F.arrow_udf("n int, control binary, data binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [ranks[np.frombuffer(row.as_buffer(), kind)] for row in batch]
            both = [pack(row) for row in rows]
            yield pa.StructArray.from_arrays(
                [pa.array([len(r) for r in rows], pa.int32()), pa.array([c for c, _ in both], pa.binary()), pa.array([d for _, d in both], pa.binary())],
                ["n", "control", "data"],
            )

    parts = max(1, -(-raw.count() // PART_DOCUMENTS))
    cuts = raw.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts).alias("cuts")).first().cuts or []
    cuts = sorted(set(cuts)) if parts > 1 else []
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    ordered = (
        raw.select("doc_id", packed("ids").alias("coded"), F.coalesce(F.when(F.col("doc_id").isNotNull(), part), F.lit(0)).alias("part"))
        .select("part", "doc_id", "coded.n", "coded.control", "coded.data")
        .repartition(len(cuts) + 1, "part")
        .sortWithinPartitions("part", "doc_id", "n", "control", "data")
    )
    schema = "part int, block int, first bigint, doc_ids array<bigint>, counts array<int>, control binary, data binary"
    ordered.mapInArrow(_blocks, schema).write.option("compression", "none").partitionBy("part").parquet(f"{path}/blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered documents to rows of a block each; `first` is the number of ids before it in the part."""
    part, block, first = None, 0, 0
    ids: list[int | None] = []
    counts: list[int] = []
    control, data = bytearray(), bytearray()

    def row() -> pa.RecordBatch:
        values = [[part], [block], [first], [list(ids)], [list(counts)], [bytes(control)], [bytes(data)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        names = ["part", "block", "first", "doc_ids", "counts", "control", "data"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        columns = [batch.column(i) for i in range(5)]
        for p, d, n, c, b in zip(*[x.to_pylist() for x in columns], strict=True):
            if ids and (p != part or len(data) >= BLOCK_BYTES):
                yield row()
                block, first = block + 1, first + sum(counts)
                ids.clear(), counts.clear(), control.clear(), data.clear()
            if p != part:
                part, block, first = p, 0, 0
            ids.append(d)
            counts.append(n)
            control += c
            data += b
    if ids:
        yield row()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit bytes)."""
    schema = "block int, first bigint, doc_ids array<bigint>, counts array<int>, control binary, data binary, part int"
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    order = [row.id for row in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]  # the vocabulary at most
    ids = np.array(order, "<u4")
    tokens = F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = blocks.select("part", tokens.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.select("part", before.alias("before"))  # a row for each part

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, doc_ids, counts, control, data in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                counts = np.array(counts, "i8")
                values = ids[unpack(control, data, counts)]
                ends = np.cumsum(counts)
                raw, cuts = values.tobytes(), (4 * np.append(0, ends)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.join(parts, "part").select((F.col("first") + F.col("before")).alias("first"), "doc_ids", "counts", "control", "data")
    return placed.mapInArrow(decoded, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
