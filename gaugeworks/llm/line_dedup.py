"""Substring de-duplication by hashing lines and the sentences in them (operator 3).

A text is cut after line ends and after sentence ends with white space; a piece of fewer than LEAST_WORDS
words stays with the piece after it, so where a unit begins depends on no more than the words before it and
repeated passages fall into the same units wherever they stand. Equal units after normalising form a group;
the earliest ranked occurrence is kept. Later ones go where adjacent ones hold LEAST_RUN words in all: a
single short stock line is no passage. Spans of removed units refer to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh, row_key, saved

#: Words of a piece that ends a unit, and words of adjacent repeated units that go.
LEAST_WORDS, LEAST_RUN = 6, 16
#: Digests joined in the map tasks, at most; those that hold the most occurrences.
HOT = 10_000
_END = re.compile(r"[.!?][\t-\r ]+|\n")


def units(text: str | None, least_words: int = LEAST_WORDS) -> Iterator[tuple[int, int, int, int, int]]:
    """(number, words, start, end, digest) of each unit with a word; offsets are code points, the digest has 128 bits.

    Units cover the text, with the white space at their ends. Normalised: A-Z in lower case, runs of ASCII white
    space to one space, none at either end.
    """
    text = text or ""
    number, start, words, at = 0, 0, [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        piece = text[at:end].encode().lower().split()
        words += piece
        at = end
        if len(piece) >= least_words or (end == len(text) and words):
            yield number, len(words), start, end, xxhash.xxh3_128_intdigest(b" ".join(words))
            number, start, words = number + 1, end, []


def occurrences(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, key, unit, words, start, end, h1, h2) of all units of all texts."""
    names = ["doc_id", "key", "unit", "words", "start", "end", "h1", "h2"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                each = [list(units(t.as_py(), least_words)) for t in part.column(2)]
                counts = [len(e) for e in each]
                rows = pa.array(np.repeat(np.arange(len(each)), counts))
                flat = [u for e in each for u in e]
                places = [pa.array([u[i] for u in flat], pa.int32()) for i in range(4)]
                halves = [pa.array(np.array([u[4] >> shift & 0xFFFFFFFFFFFFFFFF for u in flat], "u8").view("i8")) for shift in (64, 0)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), *places, *halves], names)

    texts = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("key"), "text")
    return texts.mapInArrow(found, "doc_id bigint, key bigint, unit int, words int, start int, end int, h1 bigint, h2 bigint")


def later(found: DataFrame) -> DataFrame:
    """The occurrences of `occurrences` that are not the first of their digest, by doc_id (null last), key and unit.

    The digests with the most occurrences, at most HOT of them, are joined in the map tasks; no other digest
    holds more than a HOT-th of the repeated occurrences.
    """
    digest = ["h1", "h2"]
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "unit")
    repeated = saved(found.groupBy(*digest).count().where("count > 1"), "repeated")
    total = repeated.agg(F.sum("count")).first()[0] or 0
    hot = repeated.where(F.col("count") > max(1000, total // HOT)).select(*digest)
    cold = repeated.where(F.col("count") <= max(1000, total // HOT)).select(*digest)
    often = saved(found.join(F.broadcast(hot), digest), "often")
    first = often.groupBy(*digest).agg(F.min(place).alias("first"))
    often = often.join(F.broadcast(first), digest).where(place != F.col("first")).select(*found.columns)
    rank = F.rank().over(Window.partitionBy(*digest).orderBy(place))
    return found.join(cold.hint("merge"), digest).withColumn("rank", rank).where("rank > 1").select(*found.columns).union(often)


def removals(documents: DataFrame, least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN) -> DataFrame:
    """(doc_id, key, spans): for each document that loses units, their numbers and offsets in order.

    Rows equal in doc_id and text are one occurrence: neither loses a unit to the other, and both lose the same ones.
    """
    gone = later(saved(occurrences(documents, least_words), "units")).select("doc_id", "key", "unit", "words", "start", "end").distinct()
    own = Window.partitionBy("doc_id", "key")
    gone = gone.withColumn("run", F.col("unit") - F.row_number().over(own.orderBy("unit")))
    gone = gone.withColumn("held", F.sum("words").over(Window.partitionBy("doc_id", "key", "run"))).where(F.col("held") >= least_run)
    return gone.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("unit", "start", "end"))).alias("spans"))


def remove_repeats(documents: DataFrame, least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN, spans_as: str | None = None) -> DataFrame:
    """`documents` with repeated units taken out of `text`, the white space after them included; other columns unchanged.

    With `spans_as`, a further column of that name holds the removed units (unit, start, end) with offsets in
    the original text, empty where nothing went. Null texts stay null. Rows are never removed: a text whose
    units all go becomes empty. Rows equal in doc_id and text are treated alike; see `later` for ties.
    """
    taken = [*documents.columns, spans_as or ""]
    id_, key, spans = fresh(taken, "removed_id"), fresh(taken, "removed_key"), fresh(taken, "removed_spans")
    lost = removals(documents, least_words, least_run).toDF(id_, key, spans)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (row_key(F.col("text")) == F.col(key))
    rows = documents.join(lost, same, "left")
    text = without_spans(F.col("text"), F.col(spans))
    result = [text.alias("text") if c == "text" else F.col(c) for c in documents.columns]
    if spans_as:
        result.append(F.coalesce(F.col(spans), F.array().cast("array<struct<unit:int,start:int,end:int>>")).alias(spans_as))
    return rows.select(*result)


def without_spans(text: Column, spans: Column) -> Column:
    """Texts without the characters of the given spans (start, end; in order); null spans leave a text as it is."""

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in batches:
            yield pa.array([_without(t.as_py(), g.as_py()) for t, g in zip(texts, gone, strict=True)], pa.string())

    return cut(text, spans)


def _without(text: str | None, spans: list[dict] | None) -> str | None:
    if not spans:
        return text
    starts = [0, *(s["end"] for s in spans)]
    ends = [*(s["start"] for s in spans), len(text)]
    return "".join(text[a:b] for a, b in zip(starts, ends, strict=True))
