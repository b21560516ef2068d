"""Byte-level byte-pair encoding and decoding with a hierarchical-bitmap rank queue (operator 8).

The queue has a bucket of linked-list positions per merge rank; three levels of 64-bit words say which
buckets hold any, so the lowest rank is found by three find-first-set steps. One queue serves all new
pre-tokens of a batch: positions of different pre-tokens never touch, so taking the lowest rank of all
takes the lowest rank of each. A bucket is emptied at once with numpy; entries whose pair has changed
meanwhile are stale and skipped. Work per merge does not depend on a pre-token's length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.llm.pieces import PieceMemo, gather

NONE = np.int64(-1)


class RankQueue:
    """Buckets of positions by rank, with find-first-set over three levels of 64-bit words."""

    def __init__(self, ranks: int) -> None:
        self.low = [0] * (ranks // 64 + 1)
        self.middle = [0] * (len(self.low) // 64 + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        if rank in self.buckets:
            self.buckets[rank].append(positions)
            return
        self.buckets[rank] = [positions]
        word, block = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.middle[block] |= 1 << (word & 63)
        self.top |= 1 << block

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Positions with their ranks; -1 stands for a pair that does not merge."""
        keep = ranks >= 0
        ranks, positions = ranks[keep], positions[keep]
        if len(ranks) == 0:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts), strict=True):
            self.push(rank, part)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has positions, and those in ascending order."""
        if not self.top:
            return None
        block = (self.top & -self.top).bit_length() - 1
        bits = self.middle[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        self.low[word] &= bits - 1
        if not self.low[word]:
            self.middle[block] &= self.middle[block] - 1
            if not self.middle[block]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


class RankEncoder:
    """Ids by a rank file (token bytes and rank per line); `pattern` splits text into pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype="i8")
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype="i8")
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype="i8")
        self.size = size

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        split = [[m.encode() for m in self.pattern.findall(piece.decode())] for piece in pieces]
        different = list(dict.fromkeys(token for parts in split for token in parts))
        ids, sizes = self.merge(different)
        begins = np.cumsum(sizes) - sizes
        place = {token: i for i, token in enumerate(different)}
        which = np.fromiter((place[t] for parts in split for t in parts), dtype="i8")
        of_piece = np.repeat(np.arange(len(pieces)), [len(parts) for parts in split])
        totals = np.bincount(of_piece, weights=sizes[which], minlength=len(pieces)).astype("i8") if len(which) else np.zeros(len(pieces), "i8")
        return gather(ids, begins[which], sizes[which]), totals

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, and how many each has."""
        lengths = np.array([len(w) for w in words], dtype="i8")
        data = np.frombuffer(b"".join(words), dtype="u1")
        n = len(data)
        if n == 0:
            return np.zeros(0, "u4"), np.zeros(len(words), "i8")
        word = np.repeat(np.arange(len(words)), lengths)
        token = np.append(self.single[data], NONE)  # the entry at n stands for "nothing there"
        following, before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(lengths[lengths > 0])
        following[ends - 1] = n
        before[ends[:-1]] = n
        before[0] = n
        alive = np.ones(n + 1, dtype=bool)
        whole = [self.ranks.get(w, -1) for w in words]
        done = np.array(whole)[word] >= 0  # a pre-token in the vocabulary is one id
        queue = RankQueue(self.size)
        here = np.flatnonzero((following[:n] < n) & ~done)
        queue.push_all(self._rank(token[here], token[following[here]]), here)
        while (taken := queue.pop()) is not None:
            rank, at = taken
            at = at[alive[at]]
            at = at[following[at] < n]
            at = at[self._rank(token[at], token[following[at]]) == rank]  # else stale
            if len(at) == 0:
                continue
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            if not first.all():
                at = self._without_overlap(at, first, following)
                first = np.append(True, word[at[1:]] != word[at[:-1]])
                if not first.all():
                    wait = ~first & ~self._independent(rank, at, first, token, following, before, n)
                    if wait.any():
                        late = np.isin(word[at], word[at[wait]]) & ~first
                        queue.push(rank, at[late])
                        at = at[~late]
            gone = following[at]
            beyond = following[gone]
            token[at] = rank
            following[at] = beyond
            before[beyond[beyond < n]] = at[beyond < n]
            alive[gone] = False
            left = before[at]
            left_at = np.unique(left[left < n])
            queue.push_all(self._rank(token[left_at], token[following[left_at]]), left_at)
            right_at = at[beyond < n]
            queue.push_all(self._rank(token[right_at], token[following[right_at]]), right_at)
        ids = np.where(done, -2, token[:n])
        starts = np.cumsum(lengths) - lengths
        whole = np.array(whole)
        single = np.flatnonzero((whole >= 0) & (lengths > 0))
        keep = alive[:n] & ~done
        keep[starts[single]] = True
        ids[starts[single]] = whole[single]
        return ids[keep].astype("u4"), np.bincount(word[keep], minlength=len(words))

    @staticmethod
    def _without_overlap(at: np.ndarray, first: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Of runs of pairs that share a symbol, every second, from the left."""
        touches = np.append(False, (following[at[:-1]] == at[1:]) & ~first[1:])
        begin = np.maximum.accumulate(np.where(~touches, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - begin) % 2 == 0]

    def _independent(self, rank, at, first, token, following, before, n) -> np.ndarray:
        """Whether the pairs that stand next to a merge, before those further right are merged, all rank higher.

        Then one pair after another, lowest rank and leftmost first, gives the same as all at once.
        """
        beyond = following[following[at]]
        right = self._rank(np.full(len(at), rank), token[np.minimum(beyond, n)])
        left = before[at]
        merged_left = np.append(False, (following[following[at[:-1]]] == at[1:]) & ~first[1:])
        left_token = np.where(merged_left, rank, token[left])
        lower = self._rank(left_token, np.full(len(at), rank))
        ok = ((right < 0) | (right > rank)) & ((lower < 0) | (lower > rank))
        # a word with any pair that fails merges one pair at a time
        group = np.cumsum(first) - 1
        bad = np.zeros(group[-1] + 1, dtype=bool)
        bad[group[~ok]] = True
        return ~bad[group]

    @functools.cached_property
    def decimals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _table([b"%d," % i for i in range(self.size)])

    @functools.cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _table(self.tokens)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        flat, begins, lengths = self.spelled
        return gather(flat, begins[ids], lengths[ids]).tobytes()

    def listed(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        flat, begins, lengths = self.decimals
        return gather(flat, begins[ids], lengths[ids]).tobytes()[:-1]


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(e) for e in entries], dtype="i8")
    return np.frombuffer(b"".join(entries), dtype="u1"), np.cumsum(lengths) - lengths, lengths


@functools.cache
def rank_memo(path: str, pattern: str) -> PieceMemo:
    """One per worker process, vocabulary and pattern."""
    return PieceMemo(RankEncoder(path, pattern))


def encode_ids(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text column as array<int>; null text gives an empty array."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = rank_memo(path, pattern)
        for batch in batches:
            found = list(memo.encode(batch))
            yield pa.ListArray.from_arrays(np.append(0, np.cumsum([len(f) for f in found])).astype("i4"), np.concatenate([*found, np.zeros(0, "u4")]).astype("i4"))

    return ids(text)


def decode_ids(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an array<int> column of ids stands for; null ids give null, ids outside the vocabulary fail."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = rank_memo(path, pattern)
        for batch in batches:
            yield pa.array([None if row is None else memo.learn.decode(np.array(row, dtype="i8")) for row in batch.to_pylist()], type=pa.binary())

    return decoded(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Encodes each text, decodes its ids, and returns n_tokens, ids_sha256 and decoded_sha256.

    Null and empty texts have no ids. Ids and bytes are those of `encode_ids` and `decode_ids`; they are
    digested where they are made, since they are larger than the text.
    """

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = rank_memo(path, pattern)
        for batch in batches:
            rows = [
                (len(ids), hashlib.sha256(memo.learn.listed(ids)).hexdigest(), hashlib.sha256(memo.learn.decode(ids)).hexdigest())
                for ids in memo.encode(batch)
            ]
            counts, listed, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digests(text)
