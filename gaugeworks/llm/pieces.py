"""Whole columns of text cut into pieces with numpy, each different piece handled once per worker.

A piece is a run of white space with the run of other characters after it, cut once more between a letter
and a full stop or comma. The pattern that splits text before byte-pair merges never joins a character to
white space that follows it, nor a letter to such a mark, so a piece gives the same ids wherever it stands,
and a text's ids are those of its pieces in order.

Pieces are recognised by a 64-bit multilinear hash of their bytes and their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once (one longer text is handled alone), and the pieces a worker remembers.
CHUNK_BYTES, KEPT = 2_000_000, 2_000_000

#: White space of Unicode, as UTF-8; the first group is single bytes.
SPACE_BYTES = b"\t\n\x0b\x0c\r "
SPACE_SEQUENCES = [
    c.encode() for c in map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_STOPS, _LETTERS = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_STOPS[list(b".,")] = True
_LETTERS[list(range(65, 91)) + list(range(97, 123))] = True
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[s[0] for s in SPACE_SEQUENCES]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and where each text begins (one more entry than texts); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype="<i8")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, dtype="u1") if data is not None else np.zeros(0, "u1")
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most CHUNK_BYTES bytes, or one text."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    space = _IS_SPACE[data]
    leads = np.flatnonzero(_LEADS[data])
    for sequence in SPACE_SEQUENCES if len(leads) else ():
        at = leads[leads + len(sequence) <= len(data)]
        for i, byte in enumerate(sequence):
            at = at[data[at + i] == byte]
        for i in range(len(sequence)):
            space[at + i] = True
    return space


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin; a text that is not empty begins one."""
    space = white_space(data)
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[1:] |= _STOPS[data[1:]] & _LETTERS[data[:-1]]
    opens[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(opens)


_weights = np.zeros(0, dtype="u8")


def hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece's bytes and length."""
    global _weights
    lengths = np.diff(np.append(starts, len(data)))
    longest = int(lengths.max(initial=0))
    if longest >= len(_weights):
        _weights = np.random.default_rng(7).integers(1, 2**64 - 1, size=max(4096, 2 * longest), dtype="u8") | np.uint64(1)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    terms = _weights[place]
    terms *= data
    mixed = np.add.reduceat(terms, starts) if len(starts) else np.zeros(0, "u8")
    mixed ^= lengths.astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[begins : begins + lengths], one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(begins - (ends - lengths), lengths) + np.arange(total)]


class PieceMemo:
    """Ids of texts through `learn`, which gets new pieces as bytes and returns (ids of all, number in each)."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kept: int = KEPT) -> None:
        self.learn, self.kept = learn, kept
        self.keys = np.zeros(0, "u8")
        self.begins = np.zeros(0, "i8")
        self.counts = np.zeros(0, "i8")
        self.ids = np.zeros(0, "u4")

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of the column."""
        data, offsets = text_bytes(column)
        for first, last in chunks(offsets):
            low = offsets[first]
            yield from self._encode(data[low : offsets[last]], offsets[first : last + 1] - low)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        starts = piece_starts(data, offsets)
        keys, where, which = np.unique(hashes(data, starts), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, keys)
        slot[slot == len(self.keys)] = 0
        known = self.keys[slot] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        begins, counts, ids = np.zeros(len(keys), "i8"), np.zeros(len(keys), "i8"), self.ids
        begins[known], counts[known] = self.begins[slot[known]], self.counts[slot[known]]
        if len(new):
            ends = np.append(starts[1:], len(data))
            raw = data.tobytes()
            learned, sizes = self.learn([raw[s:e] for s, e in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            counts[new], begins[new] = sizes, len(ids) + np.cumsum(sizes) - sizes
            ids = np.concatenate([ids, learned.astype("u4")])
            if len(self.keys) < self.kept:
                self.ids = ids
                place = np.searchsorted(self.keys, keys[new])
                self.keys = np.insert(self.keys, place, keys[new])
                self.begins = np.insert(self.begins, place, begins[new])
                self.counts = np.insert(self.counts, place, counts[new])
        flat = gather(ids, begins[which], counts[which])
        upto = np.append(0, np.cumsum(counts[which]))[np.searchsorted(starts, offsets)]
        for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
            yield flat[a:b]
