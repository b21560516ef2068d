"""Token ids from the tokenizers library; pieces of text seen before on a worker are not sent to it again."""

from __future__ import annotations

import functools
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.llm.pieces import SPACE_BYTES, PieceMemo, gather

#: Pieces that go to the library in one string, strings in one call, and the pieces a worker remembers.
GROUP, AT_ONCE, KEPT = 500, 20, 1_000_000


class LibraryEncoder:
    """Encodes pieces with the vocabulary file `path` of a byte-level tokenizer, as the library does by default.

    A text is cut at added tokens first there; none holds white space, so each lies in one piece.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size()
        self.opens = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)])

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A space and characters after it: joined to long strings, since only the first token of each begins
        with a space. Other pieces go one by one."""
        plain = np.array(
            [len(p) > 1 and p[0] == 32 and p[1] < 0x80 and p[1] not in SPACE_BYTES and not any(a in p for a in self.added) for p in pieces]
        )
        joined = np.flatnonzero(plain)
        groups = [joined[i : i + GROUP] for i in range(0, len(joined), GROUP)]
        alone = np.flatnonzero(~plain)
        texts = [b"".join([pieces[i] for i in g]).decode() for g in groups] + [pieces[i].decode() for i in alone]
        collecting = gc.isenabled()
        gc.disable()  # the library makes lists of millions of numbers, and no cycles
        found = []
        for i in range(0, len(texts), AT_ONCE):  # the library's results are many times larger than the ids
            encoded = self.library.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)
            found += [np.array(e.ids, dtype="u4") for e in encoded]
        if collecting:
            gc.enable()
        sizes = np.zeros(len(pieces), "i8")
        for group, ids in zip(groups, found):
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) != len(group):
                raise ValueError("the vocabulary does not keep a leading space in a piece's first token")
            sizes[group] = np.diff(np.append(begins, len(ids)))
        sizes[alone] = [len(ids) for ids in found[len(groups) :]]
        flat = np.concatenate([*found, np.zeros(0, "u4")])
        order = np.concatenate([joined, alone])
        begins = np.zeros(len(pieces), "i8")
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(flat, begins, sizes), sizes


@functools.cache
def library_memo(path: str) -> PieceMemo:
    """One per worker process and vocabulary."""
    return PieceMemo(LibraryEncoder(path), KEPT)


def library_ids(text: Column, path: str, end_id: int) -> Column:
    """Ids of a text column with `end_id` after each text, as bytes: unsigned little-endian, two bytes each
    where the vocabulary has at most 65,536 entries, four otherwise. Null text counts as empty."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = library_memo(path)
        kind = id_type(path)
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in batches:
            yield pa.array([found.astype(kind).tobytes() + end for found in memo.encode(batch)], type=pa.large_binary()).cast(pa.binary())
            pa.default_memory_pool().release_unused()

    return ids(text)


def id_type(path: str) -> str:
    """The numpy type of stored ids."""
    return "<u2" if library_memo(path).learn.size <= 1 << 16 else "<u4"
