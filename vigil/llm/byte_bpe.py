"""Byte-level BPE: encoding by a segment tree over byte positions, and decoding.

The tree of a piece holds at each byte position the rank of the pair that begins there, and in its inner
nodes the least (rank, position) below, so that its root names the leftmost pair of least rank. A merge
changes three leaves: the merged pair's own, that of the live neighbour before it, and that of the part it
swallowed; each is carried up to the root in a logarithmic number of steps. Pieces of similar length are
merged side by side in numpy arrays, one merge of every unfinished piece in each step.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from vigil.llm.pieces import PieceEncoder, in_groups
from vigil.llm.vocabularies import load_ranks

_NONE = np.iinfo(np.int64).max


class SegmentTreeBpe:
    """Merges of byte sequences by ranks. `cells` bounds the tree nodes held at once, for short pieces."""

    def __init__(self, ranks: dict[bytes, int], cells: int = 1 << 20):
        self.ranks = ranks
        self.cells = cells
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """rank * width + position of each pair, or _NONE where it is no token; an id of -1 is a border."""
        key = left << 32 | right
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = (self.pairs[i] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[i] * width + at, _NONE)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int64)
            elif piece:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, places in by_width.items():
            step = max(1, self.cells // width)
            for k in range(0, len(places), step):
                part = places[k : k + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        place = np.arange(width)
        ids = np.full((n, width + 1), -1, np.int64)  # the last column is the border
        ids[:, :width] = np.where(place < sizes[:, None], self.byte_ids[data], -1)
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        after[np.arange(n), sizes - 1] = width
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), _NONE, np.int64)
        tree[:, width:] = self._leaf(ids[:, :width], ids[:, 1:], place, width)
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2

        row = np.flatnonzero(tree[:, 1] != _NONE)
        while row.size:
            rank, at = np.divmod(tree[row, 1], width)
            gone = after[row, at]
            then = after[row, gone]
            ids[row, at] = rank
            ids[row, gone] = -1
            after[row, at] = then
            before[row, then] = at
            ahead = before[row, at]
            tree[row, width + gone] = _NONE
            tree[row, width + at] = self._leaf(rank, ids[row, then], at, width)
            # Where nothing stands before, the leaf of the swallowed part is written once more.
            first = ahead < 0
            leaf = np.where(first, gone, ahead)
            tree[row, width + leaf] = self._leaf(np.where(first, -1, ids[row, ahead]), rank, leaf, width)
            self._carry_up(tree, row, (width + at, width + gone, width + leaf))
            row = row[tree[row, 1] != _NONE]
        return [line[line >= 0] for line in ids]

    @staticmethod
    def _carry_up(tree: np.ndarray, row: np.ndarray, leaves: tuple[np.ndarray, ...]) -> None:
        """New minima from the changed leaves to the root; all leaves of a tree are equally deep."""
        nodes = [leaf >> 1 for leaf in leaves]
        while nodes[0][0]:
            for node in nodes:
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            nodes = [node >> 1 for node in nodes]


@functools.lru_cache(maxsize=4)
def _coder(path: str, pattern: str) -> tuple[PieceEncoder, list[bytes | None]]:
    ranks = load_ranks(path)
    bpe = SegmentTreeBpe(ranks)
    find = regex.compile(pattern).findall
    words: dict[str, bytes] = {}

    def encode(pieces: list[str]) -> list[bytes]:
        found = [find(p) for p in pieces]
        if len(words) > 500_000:
            words.clear()
        new = list(set().union(*found).difference(words))
        ids = bpe.encode([w.encode("utf-8") for w in new])
        words.update((w, i.astype("<u4").tobytes()) for w, i in zip(new, ids))
        return [b"".join([words[w] for w in f]) for f in found]

    tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return PieceEncoder(encode), tokens


def encode_texts(texts: list[str], path: str, pattern: str = public_tokenizers.PATTERN) -> list[bytes]:
    """Ids of each text, as little-endian unsigned 32-bit integers."""
    return _coder(path, pattern)[0].texts(texts)


def decode_ids(ids: bytes, path: str, pattern: str = public_tokenizers.PATTERN) -> bytes:
    tokens = _coder(path, pattern)[1]
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_documents(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, keep_ids: bool = True
) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (binary, little-endian unsigned 32-bit), n_tokens,
    ids_sha256, decoded_sha256 of the bytes that the ids decode to.

    Each match of `pattern` is merged by itself; special tokens are ordinary text. A null text counts as
    empty: no ids. A null doc_id and repeated rows are kept as they are; other columns are not read.
    Without `keep_ids` the ids stay in the task.
    """
    columns = ["doc_id bigint"] + ["ids binary"] * keep_ids + [
        "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in in_groups(batch.column(1)):
                ids = encode_texts(group, path, pattern)
                out = {"doc_id": batch.column(0).slice(first, len(group))}
                if keep_ids:
                    out["ids"] = pa.array(ids, pa.binary())
                out["n_tokens"] = pa.array([len(i) // 4 for i in ids], pa.int64())
                out["ids_sha256"] = pa.array([hashlib.sha256(i).hexdigest() for i in ids])
                out["decoded_sha256"] = pa.array(
                    [hashlib.sha256(decode_ids(i, path, pattern)).hexdigest() for i in ids])
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ", ".join(columns))
