"""Token ids in a binary format of patched frame-of-reference blocks, written in document order and read back.

A frame holds the ids of some whole documents, cut into blocks of equal size. A block stores its least id,
and what exceeds that in as many bits as a percentile of its values needs; the values that need more stand
with their positions in the block's exception list. An index in the frame gives the start of every block,
so that a document is read without unpacking the others.

Layout of a frame, little-endian: magic (4 bytes), block size, number of ids, number of documents (u32
each); documents: ids (i64 each), presence of the id (u8 each), numbers of tokens (u32 each); blocks: byte
offset in the body (u32), least id (u32), exceptions (u16), width (u8), each as an array; then the body: per
block the packed bits, the positions of its exceptions (u16 each) and their values (u32 each).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.memory import begin
from vigil.llm.pieces import in_groups
from vigil.llm.vocabularies import library_encoder
from vigil.session import materialize, new_folder

MAGIC = b"PFR1"
BLOCK = 256
_HEAD = np.dtype([("magic", "S4"), ("block", "<u4"), ("ids", "<u4"), ("docs", "<u4")])


def _bits(values: np.ndarray) -> np.ndarray:
    """How many bits each value needs; exact below 2**32."""
    return np.frexp(values.astype(np.float64))[1]


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The bytes of each row of values of `width` bits, least bits first; a row holds a multiple of 8 values."""
    if width > 16:
        bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1
        return np.packbits(bits.astype(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")
    # 8 values are `width` bytes: four of them in each half of 128 bits, then moved together.
    eight = values.reshape(-1, 8)
    halves = np.zeros((len(eight), 2), "<u8")
    for i in range(4):
        halves[:, 0] |= eight[:, i].astype(np.uint64) << np.uint64(i * width)
        halves[:, 1] |= eight[:, 4 + i].astype(np.uint64) << np.uint64(i * width)
    if width < 16:
        half = np.uint64(4 * width)
        halves[:, 0] |= halves[:, 1] << half
        halves[:, 1] >>= np.uint64(64) - half
    return halves.view(np.uint8).reshape(-1, 16)[:, :width].reshape(len(values), -1)


def unpack_bits(data: np.ndarray, width: int) -> np.ndarray:
    """The values that `pack_bits` made rows of bytes of."""
    if width > 16:
        bits = np.unpackbits(data, axis=1, bitorder="little").reshape(len(data), -1, width)
        return bits @ (np.uint32(1) << np.arange(width, dtype=np.uint32))
    eight = np.zeros((data.size // width, 16), np.uint8)
    eight[:, :width] = data.reshape(-1, width)
    halves = eight.view("<u8")
    low, high = halves[:, 0], halves[:, 1]
    if width < 16:
        half = np.uint64(4 * width)
        high = (low >> half) | (high << (np.uint64(64) - half))
    mask = np.uint64(2**width - 1)
    values = np.empty((len(eight), 8), np.uint32)
    for i in range(4):
        values[:, i] = (low >> np.uint64(i * width)) & mask
        values[:, 4 + i] = (high >> np.uint64(i * width)) & mask
    return values.reshape(len(data), -1)


def pack_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = 0.9) -> list[bytes]:
    """The block arrays (offsets, least, exceptions, widths) and the body of some ids."""
    n = -(-len(ids) // block)
    padded = np.full(n * block, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    table = padded.reshape(n, block)
    least = table.min(axis=1) if n else np.empty(0, np.uint32)
    over = table - least[:, None]
    place = min(block - 1, int(np.ceil(percentile * block)) - 1)
    # A greater value never needs fewer bits, so that the percentile of the values gives that of their bits.
    widths = _bits(np.partition(over, place, axis=1)[:, place]) if n else np.empty(0, np.int64)
    outlier = over > (np.uint64(1) << widths.astype(np.uint64))[:, None] - np.uint64(1)
    exceptions = outlier.sum(axis=1)
    packed = widths * block // 8
    sizes = packed + 6 * exceptions
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    body = np.zeros(offsets[-1], np.uint8)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        low = over[at] & np.uint32(2**width - 1)
        data = pack_bits(low, width)
        body[offsets[at][:, None] + np.arange(data.shape[1])] = data
    row, column = np.nonzero(outlier)
    if len(row):
        nth = np.arange(len(row)) - np.concatenate([[0], np.cumsum(exceptions)])[row]
        position = offsets[row] + packed[row] + 2 * nth
        value = offsets[row] + packed[row] + 2 * exceptions[row] + 4 * nth
        body[position[:, None] + np.arange(2)] = column.astype("<u2").view(np.uint8).reshape(-1, 2)
        body[value[:, None] + np.arange(4)] = over[row, column].astype("<u4").view(np.uint8).reshape(-1, 4)
    return [offsets[:-1].astype("<u4").tobytes(), least.astype("<u4").tobytes(),
            exceptions.astype("<u2").tobytes(), widths.astype(np.uint8).tobytes(), body.tobytes()]


def write_frame(doc_ids: list[int | None], ids: list[bytes], block: int = BLOCK, percentile: float = 0.9) -> bytes:
    """A frame of whole documents; ids are little-endian unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    head = np.array([(MAGIC, block, len(flat), len(doc_ids))], _HEAD).tobytes()
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    present = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    counts = np.array([len(i) // 4 for i in ids], "<u4").tobytes()
    return b"".join([head, docs, present, counts, *pack_blocks(flat, block, percentile)])


class Frame:
    """Reads a frame: its documents, and the ids of any run of positions through the block index."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, _HEAD, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a frame of token blocks")
        self.block, self.size, docs = int(head["block"]), int(head["ids"]), int(head["docs"])
        at = _HEAD.itemsize

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        values, present = take("<i8", docs), take("u1", docs)
        self.doc_ids = [v if p else None for v, p in zip(values.tolist(), present.tolist())]
        self.counts = take("<u4", docs).astype(np.int64)
        n = -(-self.size // self.block)
        self.offsets, self.least = take("<u4", n).astype(np.int64), take("<u4", n)
        self.exceptions, self.widths = take("<u2", n).astype(np.int64), take("u1", n).astype(np.int64)
        self.body = np.frombuffer(data, np.uint8, offset=at)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids at positions start to stop; only the blocks that hold them are unpacked."""
        stop = self.size if stop is None else min(stop, self.size)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        out = np.zeros((last - first, self.block), np.uint32)
        widths, offsets = self.widths[first:last], self.offsets[first:last]
        packed = widths * self.block // 8
        for width in np.unique(widths[widths > 0]).tolist():
            at = np.flatnonzero(widths == width)
            data = self.body[offsets[at][:, None] + np.arange(width * self.block // 8)]
            out[at] = unpack_bits(data, width)
        number = self.exceptions[first:last]
        row = np.repeat(np.arange(last - first), number)
        if len(row):
            nth = np.arange(len(row)) - np.concatenate([[0], np.cumsum(number)])[row]
            position = offsets[row] + packed[row] + 2 * nth
            value = offsets[row] + packed[row] + 2 * number[row] + 4 * nth
            column = self.body[position[:, None] + np.arange(2)].copy().view("<u2")[:, 0]
            out[row, column] = self.body[value[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        flat = (out + self.least[first:last, None]).ravel()
        return flat[start - first * self.block : stop - first * self.block]

    def document(self, n: int) -> np.ndarray:
        """The ids of the n-th document of this frame."""
        start = int(self.counts[:n].sum())
        return self.ids(start, start + int(self.counts[n]))


FRAMES = "part int, frame int, start_in_part bigint, n_docs bigint, n_tokens bigint, data binary"


def write_token_frames(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, frame_ids: int = 250_000, percentile: float = 0.9
) -> None:
    """Encodes `docs` (doc_id, text) with the tokenizers library, appends `end_id` to each document and
    writes the frames to `folder` in ascending doc_id order, nulls first, rows of equal doc_id by their text.

    The range partitions are numbered in this order, and each frame has its own number and start within its
    partition. A frame closes when it holds `frame_ids` ids; a longer document fills one by itself. A null
    text counts as empty. Other columns are not read.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pieces")
        encoder = library_encoder(path)
        part, frame, start = TaskContext.get().partitionId(), 0, 0
        held_docs: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            data = write_frame(held_docs, held, percentile=percentile)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "frame": pa.array([frame], pa.int32()),
                "start_in_part": [start], "n_docs": [len(held)], "n_tokens": [size],
                "data": pa.array([data], pa.binary())})

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, group in in_groups(batch.column(1)):
                for doc_id, ids in zip(doc_ids[first:], encoder.texts(group)):
                    held_docs.append(doc_id)
                    held.append(ids + end)
                    size += len(held[-1]) // 4
                    if size >= frame_ids:
                        yield close()
                        frame, start = frame + 1, start + size
                        held_docs, held, size = [], [], 0
        if held:
            yield close()

    (docs.select(F.col("doc_id").cast("bigint"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, FRAMES)
     .write.option("compression", "none").parquet(folder))


def read_token_frames(spark, folder: str) -> DataFrame:
    """The documents of a folder of frames: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 over its ids as little-endian unsigned 32-bit integers.

    The starts of the partitions are running sums over one number per partition, not over frames. They are
    written first, so that Spark knows how few they are and moves no frame to meet them."""
    frames = spark.read.schema(FRAMES).parquet(folder)
    parts = frames.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")), "part-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                frame = Frame(data.as_py())
                ids = memoryview(frame.ids().astype("<u4").tobytes())
                ends = np.cumsum(frame.counts)
                bounds = zip((ends - frame.counts).tolist(), ends.tolist())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(frame.doc_ids, pa.int64()),
                    "start": pa.array(first + ends - frame.counts),
                    "n_tokens": pa.array(frame.counts),
                    "ids_crc32": pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in bounds], pa.int64())})

    return (frames.join(starts, "part")
            .select((F.col("start_in_part") + F.col("part_start")).alias("first"), "data")
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def token_file_digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Writes `docs` as token frames into the shared folder and gives what is read back from them."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-frames")
    write_token_frames(docs, path, folder, end_id)
    return read_token_frames(spark, folder)
