"""Packing of tokenized documents into sequences of bounded length: bounded-space online best fit.

Each task packs the documents of its own partition in the order in which they come, so nothing is shuffled
and a task that runs anew after a loss gives the same rows. Open sequences are kept by their free space; a
bitset marks the spaces that occur, so that the tightest fit is one shift and one lowest-bit search. Where
a further sequence would exceed the fixed number of open ones, the fullest is closed first. Pieces pass
through a look-ahead of bounded size and leave it by falling length, which best fit packs more tightly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vigil.llm.memory import begin, release
from vigil.llm.pieces import in_groups
from vigil.llm.vocabularies import library_encoder

#: Sequences of one task are numbered from its partition number shifted by so many bits.
_TASK_BITS = 36

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "sequence_id bigint, offset bigint")


class OpenSequences:
    """Places lengths into sequences of `capacity`, holding at most `most_open` unfinished ones."""

    def __init__(self, capacity: int, most_open: int, first_id: int = 0):
        self.capacity = capacity
        self.most_open = most_open
        self.next_id = first_id
        self.spaces = 0  # bit f is set where a sequence with f free places is open
        self.by_space: dict[int, list[int]] = {}
        self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset for `length` tokens, 1 to capacity."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            if self.open == self.most_open:
                fullest = (self.spaces & -self.spaces).bit_length() - 1
                if fullest >= left:  # what was just filled is the fullest
                    return sequence, self.capacity - free
                self._take(fullest)
            self.by_space.setdefault(left, []).append(sequence)
            self.spaces |= 1 << left
            self.open += 1
        return sequence, self.capacity - free

    def _take(self, free: int) -> int:
        held = self.by_space[free]
        sequence = held.pop()
        if not held:
            self.spaces &= ~(1 << free)
        self.open -= 1
        return sequence


def cut_lengths(tokens: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; of a longer one only the first is shorter than `capacity`."""
    first = tokens % capacity
    return ([first] if first else []) + [capacity] * (tokens // capacity)


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, most_open: int = 4096, look_ahead: int = 20_000,
    keep: int = 1_500_000,
) -> DataFrame:
    """One row per piece of each row of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids by the tokenizers library and then `end_id`; a null or empty text is the end id
    alone. Documents of up to `capacity` tokens are never cut; longer ones are cut into pieces of `capacity`
    of which the first may be shorter. sequence_id is unique over all tasks; the pieces of a sequence lie
    side by side from offset 0. ids_crc32 covers the piece's ids as little-endian unsigned 32-bit integers.
    A null doc_id and repeated rows are packed like any other row; other columns are not read. Each worker
    remembers the ids of about `keep` pieces, at about 140 bytes each.
    """
    end, owner = end_id.to_bytes(4, "little"), f"{keep} packed pieces"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        encoder = library_encoder(path, owner, keep)
        sequences = OpenSequences(capacity, most_open, TaskContext.get().partitionId() << _TASK_BITS)
        waiting: list[tuple] = []

        def placed() -> pa.RecordBatch:
            waiting.sort(key=lambda piece: -piece[3])
            rows = [(*piece, *sequences.place(piece[3])) for piece in waiting]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, group in in_groups(batch.column(1)):
                for doc_id, ids in zip(doc_ids[first:], encoder.texts(group)):
                    ids += end
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        waiting.append((doc_id, piece, start, length, crc))
                        start += length
                        if len(waiting) == look_ahead:
                            yield placed()
            release()
        if waiting:
            yield placed()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_TYPES = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]
