"""Removal of repeated byte strings by column-wise suffix sorting of document collections (operator 4).

A byte goes if a string of `length` bytes that covers it also starts anywhere else. Equal strings hold the
same anchor: the leftmost of their 80-byte substrings whose hash is least. So strings are dealt to tasks by
anchor, as segments: the text around all neighbouring strings that share an anchor. Anchors that occur once
are dropped before any text moves, and equal segments are kept once with their number of occurrences.

The segments of a task are one collection. Its Burrows-Wheeler transform and longest common prefixes are
built by inserting one symbol per segment each round, from the anchor leftwards, into two files that are
read and written in sequence; what follows the anchors is sorted once and stands for the ends of the texts.
Neighbouring suffixes with `length` bytes in common are repeats.

An anchor with more different segments than a task should hold (copies of one passage in different
surroundings) is dealt anew by longer anchors, at last by whole strings. Each table written on the way is
deleted after its last reader; the found ranges stay, since the result is computed from them.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.pieces import chunks
from gaugeworks.llm.shared import discard, fresh, saved

#: Bytes of a repeated string; anchor lengths, each for what is too much for the one before.
LENGTH, ANCHORS = 200, (80, 160, 192, 200)
#: Most different segments of an anchor in one collection; segments dealt to a collection, of which `may_share` leaves few.
MOST_VARIANTS, COLLECTION = 2000, 4000
#: Width of the steps in which the place of an anchor in a string is told apart.
STEP = 20

_ODD, _HIGH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFF00000000)
_powers = {1: np.ones(1, "u8"), -1: np.ones(1, "u8")}


def _power(sign: int, n: int) -> np.ndarray:
    """The first n powers of an odd number, or of its inverse, modulo 2^64."""
    if len(_powers[sign]) < n:
        base = int(_ODD) if sign > 0 else pow(int(_ODD), -1, 1 << 64)
        steps = np.full(2 * n, base, "u8")
        steps[0] = 1
        _powers[sign] = np.multiply.accumulate(steps)
    return _powers[sign][:n]


def anchors(data: np.ndarray, offsets: np.ndarray, anchor: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, hash, place of the anchor) of the runs of strings that share an anchor, in texts one after another."""
    n, window = len(data), length - anchor + 1
    if n < length:
        return np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u8"), np.zeros(0, "i4")
    sums = np.zeros(n + 1, "u8")
    np.cumsum((data.astype("u8") + np.uint64(1)) * _power(-1, n), out=sums[1:])
    mixed = (sums[anchor:] - sums[: n - anchor + 1]) * _power(1, n - anchor + 1)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    least, span = (mixed & _HIGH) | np.arange(len(mixed), dtype="u8"), 1  # upper half of the hash, then the place
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[step:], least[:-step])
        span += step
    where = (least & ~_HIGH).astype("i4")
    begin = np.arange(len(where))
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(where)]
    whole = begin + length <= ends
    opens = whole.copy()
    opens[1:] &= (where[1:] != where[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(opens)
    closes = whole.copy()
    closes[:-1] &= (where[1:] != where[:-1]) | ~whole[1:] | opens[1:]
    return starts, np.flatnonzero(closes) - starts + 1, mixed[where[starts]], where[starts]


def may_share(segments: list[bytes], spots: list[int], anchor: int, length: int) -> np.ndarray:
    """Which segments can have a string of `length` bytes in common with another one; no others need sorting.

    Equal strings hold their anchor at one place, `left` bytes after their start. For each step of `left` values
    the bytes that all such strings hold around the anchor (`spots`) must agree.
    """
    spare = length - anchor
    groups: dict[tuple[int, bytes], list[int]] = {}
    for i, (segment, at) in enumerate(zip(segments, spots, strict=True)):
        for left in range(0, min(spare, at) + 1, STEP):
            end = at + anchor + max(0, spare - left - STEP + 1)
            if end <= len(segment):
                groups.setdefault((left, segment[at - left : end]), []).append(i)
    shared = np.zeros(len(segments), bool)
    for group in groups.values():
        if len(group) > 1:
            shared[group] = True
    return shared


class _File:
    """Bytes that are written and read in sequence; kept in memory, since a collection is of bounded size."""

    def __init__(self) -> None:
        self.file = os.fdopen(os.memfd_create("column"), "w+b")

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, "u1")

    def write(self, values: np.ndarray) -> None:
        self.file.seek(0)
        values.tofile(self.file)
        self.file.truncate()
        self.file.flush()

    def close(self) -> None:
        self.file.close()


def _sorted_ends(ends: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bytes that each has in common with the one before, `length` at most) of the texts' ends."""
    order = np.array(sorted(range(len(ends)), key=ends.__getitem__), "i8")
    sizes = np.minimum([len(e) for e in ends], length)
    symbols = np.zeros((len(ends), int(sizes.max(initial=0)) + 1), "u1")
    for row, end in zip(symbols, ends, strict=True):
        row[: min(len(end), length)] = np.frombuffer(end[:length], "u1")
    symbols, sizes = symbols[order], sizes[order]
    common = np.zeros(len(ends), "u1")
    unlike = symbols[1:] != symbols[:-1]
    agree = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length)
    common[1:] = np.minimum(agree, np.minimum(sizes[1:], sizes[:-1]))
    return order, common


def repeated_in_collection(texts: list[bytes], length: int = LENGTH, spots: list[int] | None = None) -> list[np.ndarray]:
    """For each text, which of its strings of `length` (at most 255) bytes start elsewhere in the collection too.

    With `spots`, a place in each text, strings that start after it are not looked at, and those that reach past it
    are equal only if they start equally far before it, as strings that hold an anchor there do. Columns are then
    inserted from the spots to the left; what follows them is sorted whole.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts], "i8")
    spots = sizes if spots is None else np.array(spots, "i8")
    longest = int(spots.max(initial=0))
    symbols = np.zeros((longest + 1, n), "u1")  # row j: j-th from the spot, 0 past the beginning
    for i, (text, spot) in enumerate(zip(texts, spots.tolist(), strict=True)):
        symbols[:spot, i] = np.frombuffer(text, "u1")[:spot][::-1] + 1
    order, ends = _sorted_ends([t[s:] for t, s in zip(texts, spots.tolist(), strict=True)], length)
    first = np.empty(n, "i8")  # where the end of each text stands
    first[order] = np.arange(n)
    transform, common = _File(), _File()
    transform.write(symbols[0, order])
    common.write(ends)
    at, active = first, np.arange(n)  # where the newest suffix of each text stands
    for j in range(1, longest + 1):
        before, lcp = transform.read(), common.read()
        more = symbols[j - 1, active] > 0
        at, active = at[more], active[more]
        order = np.argsort(before, kind="stable")
        rank = np.empty(len(before), "i4")
        rank[order] = np.arange(len(before), dtype="i4")
        ended = int(np.count_nonzero(before == 0))
        new = n + rank[at] - ended
        old = np.ones(len(before) + len(at), bool)
        old[new] = False
        merged = np.empty(len(old), "u1")
        merged[old], merged[new] = before, symbols[j, active]
        prefixes = np.zeros(len(old), "u1")
        prefixes[old] = lcp
        touched = np.unique(np.concatenate([rank[at], rank[at] + 1]))
        touched = touched[touched < len(before)]
        prefixes[n + touched - ended] = 0
        paired = touched[touched > ended]
        paired = paired[before[order[paired]] == before[order[paired - 1]]]
        if len(paired):
            begins, stops = order[paired - 1] + 1, order[paired] + 1
            sequence = np.argsort(begins)
            ranges = np.stack([begins[sequence], stops[sequence]], axis=1).ravel()
            least = np.minimum.reduceat(np.append(lcp, 0), ranges)[::2]
            prefixes[n + paired[sequence] - ended] = np.minimum(least, length - 1) + 1
        transform.write(merged)
        common.write(prefixes)
        at = new
    before, lcp = transform.read(), np.append(common.read(), 0)
    transform.close(), common.close()
    rank = np.empty(len(before), "i8")
    rank[np.argsort(before, kind="stable")] = np.arange(len(before))
    following = n + rank - np.count_nonzero(before == 0)
    starts = np.append(0, np.cumsum(np.maximum(0, sizes - length + 1)))
    found = np.zeros(starts[-1], bool)
    at, active = first, np.arange(n)
    for j in range(longest + 1):
        if j:
            more = spots[active] >= j
            at, active = following[at[more]], active[more]
        hit = active[(lcp[at] >= length) | (lcp[at + 1] >= length)]
        found[starts[hit] + spots[hit] - j] = True
    return [found[low:high] for low, high in zip(starts[:-1].tolist(), starts[1:].tolist())]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype("i1"), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), schema.types, strict=True)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, most)):
        yield _columns(some, schema)


def _noted(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """(bounds of the rows, the members one after another) of a list of structs without nulls in them; a null list is empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return [0, *np.cumsum(sizes).tolist()], [c.to_numpy(zero_copy_only=False) for c in column.flatten().flatten()]


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(a, b, data, members of what is noted, other columns) of rows; of rows with one key that follow each other the first, since they are equal."""
    last = None
    for batch in batches:
        bounds, members = _noted(batch.column(3))
        others = [c.to_pylist() for c in batch.columns[4:]]
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if key != last:
                noted = [m[bounds[i] : bounds[i + 1]].tolist() for m in members]
                yield *key, batch.column(2)[i].as_py(), noted, *[c[i] for c in others]
            last = key


def _saved(frame: DataFrame, name: str) -> DataFrame:
    return saved(frame, name, tidy=True)


def _strings(texts: DataFrame, length: int, level: int = 0) -> DataFrame:
    """(a, b, ranges): strings low to high - 1 of text (a, b) start elsewhere too; texts: a, b, data, equal where a and b are.

    Only keys and digests of segments are counted; bytes travel for one segment of each of the kinds to be sorted.
    """
    anchor = ANCHORS[level] * length // LENGTH

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, column = batch.column(0), batch.column(1), batch.column(2).cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", "u1")
            for first, last in chunks(ends):
                offsets = ends[first : last + 1] - ends[first]
                starts, counts, keys, spots = anchors(data[ends[first] : ends[last]], offsets, anchor, length)
                text = np.searchsorted(offsets, starts, side="right") - 1
                which = pa.array(first + text)
                numbers = [starts - offsets[text], counts, spots - starts]
                columns = [a.take(which), b.take(which), *[pa.array(x.astype("i4")) for x in numbers], pa.array(keys.view("i8"))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "at", "n", "spot", "anchor"])

    every = _saved(texts.select("a", "b", "data").mapInArrow(found, "a bigint, b bigint, at int, n int, spot int, anchor bigint"), "anchors")
    again = every.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor")
    runs = F.collect_set(F.struct("at", "n", "spot", "anchor")).alias("runs")
    places = every.join(again, "anchor", "left_semi").groupBy("a", "b").agg(runs, F.count("*").alias("rows"))
    places = _saved(places.select("a", "b", "runs", F.expr("rows div size(runs)").alias("copies")), "places")
    discard(every)

    kinds = pa.schema([(c, pa.int64()) for c in ("a", "b", "s1", "s2", "times", "anchor")] + [("at", pa.list_(pa.int32())), ("n", pa.int32()), ("spot", pa.int32())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, data, runs, copies in _texts_with(batches):
                same: dict[bytes, tuple] = {}
                for at, n, spot, key in zip(*runs, strict=True):
                    digest = xxhash.xxh3_128_digest(data[at : at + n + length - 1])
                    same.setdefault(digest, (key, [], n, spot))[1].append(at)
                for digest, rest in same.items():
                    yield a, b, *struct.unpack("<qq", digest), len(rest[1]) * copies, *rest

        return _batches(rows(), kinds)

    schema = "a bigint, b bigint, s1 bigint, s2 bigint, times bigint, anchor bigint, at array<int>, n int, spot int"
    segments = _saved(texts.join(places, ["a", "b"]).select("a", "b", "data", "runs", "copies").mapInArrow(digests, schema), "segments")
    discard(places)
    home = F.min(F.struct("a", "b", F.col("at")[0].alias("at"))).alias("home")
    same = [F.first(c).alias(c) for c in ("anchor", "n", "spot")]
    different = _saved(segments.groupBy("s1", "s2").agg(F.sum("times").alias("times"), home, *same), "different")
    variants = different.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1")
    fields = ["s1", "s2", "times", "anchor", "variants", "n", "spot"]
    wanted = different.join(variants, "anchor").groupBy(F.col("home.a").alias("a"), F.col("home.b").alias("b"))
    wanted = wanted.agg(F.collect_list(F.struct(F.col("home.at").alias("at"), *fields)).alias("wanted"))

    wide = [("s1", pa.int64()), ("s2", pa.int64()), ("times", pa.int64()), ("anchor", pa.int64()), ("variants", pa.int64())]
    cut_kinds = pa.schema([*wide, ("n", pa.int32()), ("spot", pa.int32()), ("data", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*w[1:], data[w[0] : w[0] + w[6] + length - 1]) for _, _, data, noted in _texts_with(batches) for w in zip(*noted, strict=True))
        return _batches(rows, cut_kinds)

    schema = "s1 bigint, s2 bigint, times bigint, anchor bigint, variants bigint, n int, spot int, data binary"
    mixed = _saved(texts.join(wanted, ["a", "b"]).select("a", "b", "data", "wanted").mapInArrow(cut, schema), "mixed")
    copies = _saved(different.where("times > 1").select("s1", "s2", F.lit(0).alias("low"), F.col("n").alias("high")), "copies")
    discard(different)
    collected = mixed.where(F.col("variants") <= MOST_VARIANTS) if level < len(ANCHORS) - 1 else mixed
    bins = max(1, -(-collected.count() // COLLECTION))

    def sort(table: pa.Table) -> pa.Table:
        shared = may_share(table.column("data").to_pylist(), table.column("spot").to_pylist(), anchor, length)
        table = table.filter(pa.array(shared))
        flags = repeated_in_collection(table.column("data").to_pylist(), length, table.column("spot").to_pylist())
        rows = [
            (s1, s2, low, high)
            for s1, s2, times, flag in zip(*[table.column(c).to_pylist() for c in ("s1", "s2", "times")], flags, strict=True)
            if times == 1
            for low, high in _runs(flag)
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["s1", "s2", "low", "high"])

    place = F.pmod(F.xxhash64("anchor"), F.lit(bins)).alias("bin")
    dealt = collected.select(place, "s1", "s2", "times", "spot", "data").repartition(bins, "bin")
    marks = copies.union(dealt.groupBy("bin").applyInArrow(sort, "s1 bigint, s2 bigint, low int, high int"))
    spent = [mixed, copies]
    if level < len(ANCHORS) - 1:
        crowded = mixed.where(F.col("variants") > MOST_VARIANTS)
        if not crowded.isEmpty():
            deeper = _strings(crowded.select(F.col("s1").alias("a"), F.col("s2").alias("b"), "data"), length, level + 1)
            marks = marks.union(deeper.select("a", "b", F.inline("ranges")))
            spent.append(deeper)
    marks = _saved(marks, "marks")
    discard(*spent)
    placed = segments.select("a", "b", "s1", "s2", "at").join(marks, ["s1", "s2"]).select("a", "b", F.explode("at").alias("at"), "low", "high")
    placed = placed.groupBy("a", "b").agg(F.collect_set(F.struct((F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high"))).alias("ranges"))
    placed = _saved(placed, "ranges")
    discard(segments, marks)
    return placed


def remove_repeated_strings(documents: DataFrame, length: int = LENGTH, kept_as: str = "kept", spans_as: str = "spans") -> DataFrame:
    """`documents` with the bytes that stay (binary `kept_as`) and the removed spans (`spans_as`: start, end in bytes).

    A byte of the UTF-8 text goes if a string of `length` bytes (at most 200) within its text that covers it
    also starts anywhere else in any row's text, itself included; spans are maximal. All is judged on the
    input, so no copy stays. Null texts count as empty. Every row is a text of its own, also where rows share a
    doc_id, have none, or are equal in all: equal rows of 200 bytes and more remove each other. Other columns
    are unchanged; `kept_as` and `spans_as` must not be among them.
    """
    taken = [*documents.columns, kept_as, spans_as]
    a, b = fresh(taken, "text_a"), fresh([*taken, "text_a"], "text_b")
    left = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull())]
    texts = documents.where(F.octet_length("text") >= length).select(left[0].alias("a"), left[1].alias("b"), F.col("text").cast("binary").alias("data"))
    found = _strings(texts, length).toDF(a, b, spans_as)
    rows = documents.withColumn("text", F.col("text")).join(found, (left[0] == F.col(a)) & (left[1] == F.col(b)), "left")

    @F.arrow_udf("kept binary, spans array<struct<start:int,end:int>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            texts, (bounds, (lows, highs)) = texts.cast(pa.binary()), _noted(ranges)
            out, starts, ends, sizes = [], [], [], [0]
            for i, text in enumerate(texts):
                data, low, high = text.as_py() or b"", lows[bounds[i] : bounds[i + 1]], highs[bounds[i] : bounds[i + 1]] + (length - 1)
                if len(low):
                    order = np.argsort(low)
                    low, high = low[order], np.maximum.accumulate(high[order])
                    opens = np.append(True, low[1:] > high[:-1])
                    low, high = low[opens].tolist(), high[np.append(opens[1:], True)].tolist()
                    starts += low
                    ends += high
                    data = b"".join([data[a:b] for a, b in zip([0, *high], [*low, len(data)], strict=True)])
                out.append(data)
                sizes.append(len(starts))
            spans = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
            yield pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans)], ["kept", "spans"])

    done = rows.withColumn(spans_as, cut(F.col("text"), F.col(spans_as)))
    return done.select(*documents.columns, F.col(spans_as)["kept"].alias(kept_as), F.col(spans_as)["spans"].alias(spans_as))
