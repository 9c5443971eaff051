import hashlib
import random
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vigil.llm import byte_bpe, packing, token_blocks
from vigil.llm.pieces import cut
from vigil.llm.vocabularies import library_encoder, load_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(RANKS),
                             special_tokens={})


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


ODD = st.lists(st.sampled_from([" ", " ", "\n", "\t", "a", "b'", "'s", "1", ".", "!,", "é", " ", "\x1c",
                               "\x00", "ß", "\x85", "日", "the", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_pieces_are_encoded_as_whole_texts(reference_ids, texts):
    ours = byte_bpe.encode_texts(texts, RANKS)
    assert ours == [as_bytes(reference_ids[0](t)) for t in texts]
    assert library_encoder(JSON).texts(texts) == [as_bytes(reference_ids[1](t)) for t in texts]
    assert ["".join(cut(t)) for t in texts] == texts


@pytest.fixture(scope="module")
def reference_ids(reference, library):
    return reference.encode_ordinary, library


def naive(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def test_segment_tree_merges_like_a_plain_search():
    draw = random.Random(3)
    ranks = {bytes([b]): b for b in range(256)}
    for rank in range(256, 330):
        token = b"".join(draw.choice(list(ranks)[97:123] + list(ranks)[256:]) for _ in range(2))
        ranks.setdefault(token, rank)
    pieces = [bytes(draw.choice(b"abcdefgh") for _ in range(draw.randint(1, 70))) for _ in range(300)] + [b"", b"a" * 999]
    merged = byte_bpe.SegmentTreeBpe(ranks, cells=256).encode(pieces)
    assert [m.tolist() for m in merged] == [[ranks[p]] if p in ranks else naive(p, ranks) for p in pieces]


def test_encode_documents(spark, reference):
    got = byte_bpe.encode_documents(cases.frame(spark), RANKS).collect()
    assert len(got) == len(cases.rows())
    for row, (doc_id, text) in zip(got, cases.pairs()):
        ids = as_bytes(reference.encode_ordinary(text))
        assert (row.doc_id, bytes(row.ids), row.n_tokens) == (doc_id, ids, len(ids) // 4)
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode_documents(cases.empty(spark), RANKS).count() == 0


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 15, 16, 17, 32])
def test_bits_are_packed_least_first(width):
    draw = np.random.default_rng(width)
    values = draw.integers(0, 2**width, (5, 64), dtype=np.uint64).astype(np.uint32)
    bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1
    packed = token_blocks.pack_bits(values, width)
    assert (packed == np.packbits(bits.astype(np.uint8).reshape(5, -1), axis=1, bitorder="little")).all()
    assert (token_blocks.unpack_bits(packed, width) == values).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50257) | st.integers(0, 2**32 - 1), max_size=1500), st.sampled_from([0.5, 0.9, 1.0]))
def test_frames_give_back_any_ids(ids, percentile):
    a, b = ids[: len(ids) // 3], ids[len(ids) // 3 :]
    frame = token_blocks.Frame(token_blocks.write_frame([7, None, -3], [as_bytes(a), b"", as_bytes(b)],
                                                        percentile=percentile))
    assert frame.doc_ids == [7, None, -3]
    assert frame.ids().tolist() == ids
    assert [frame.document(i).tolist() for i in range(3)] == [a, [], b]
    assert frame.ids(len(ids) // 2, len(ids) // 2 + 9).tolist() == ids[len(ids) // 2 : len(ids) // 2 + 9]


def test_exceptions_keep_blocks_small():
    ids = np.arange(256, dtype=np.uint32) % 16
    ids[40] = 50_000
    assert len(token_blocks.pack_blocks(ids)[-1]) == 256 * 4 // 8 + 6


def test_token_files(spark, library):
    docs = cases.frame(spark)
    got = token_blocks.token_file_digests(docs.repartition(5), JSON).collect()
    expected, start = [], 0
    for doc_id, text in sorted(cases.pairs(), key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        ids = as_bytes([*library(text), 2])
        expected.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    assert token_blocks.token_file_digests(cases.empty(spark), JSON).count() == 0


def test_special_strings_are_taken_as_the_library_does(spark, library):
    texts = ["see <|endoftext|> end", "a", "<|endoftext|>", "b <|endoftext|>\n<|endoftext|>c", "<|endoftext", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digests = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_blocks.token_file_digests(docs, JSON).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = as_bytes([*library(text), 2])
        assert digests[i] == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert 50256 in library(texts[0])
    packed = {r.doc_id: r.ids_crc32 for r in packing.pack_documents(docs, JSON).collect()}
    assert packed == {i: d[2] for i, d in digests.items()}


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = packing.OpenSequences(10, most_open=2)
    assert [bins.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert bins.place(3) == (1, 7)  # 3 free fit better than 4
    assert bins.place(8) == (2, 0)
    assert bins.place(5) == (3, 0)  # a third open one: the fullest, with 2 free, is closed
    assert bins.place(2) == (0, 6)
    assert bins.open <= 2


def check_packing(rows, texts, library, capacity):
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    left = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = []
    for doc_id, text in texts:
        ids, start = [*library(text), 2], 0
        for piece, n in enumerate(packing.cut_lengths(len(ids), capacity)):
            expected.append((str(doc_id), piece, start, n, zlib.crc32(as_bytes(ids[start : start + n]))))
            start += n
        assert start == len(ids)
    assert left == sorted(expected)
    return len(sequences), sum(n for _, _, _, n, _ in expected)


def test_pack_documents(spark, library):
    rows = packing.pack_documents(cases.frame(spark), JSON).collect()
    check_packing(rows, cases.pairs(), library, 1024)
    assert packing.pack_documents(cases.empty(spark), JSON).count() == 0


def test_packing_of_the_table_is_tight(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    for look_ahead, waste in ((20_000, 0.004), (1, 0.02), (100, 0.02)):
        rows = packing.pack_documents(docs, JSON, look_ahead=look_ahead).collect()
        sequences, tokens = check_packing(rows, texts, library, 1024)
        assert sequences <= (1 + waste) * tokens / 1024 + 1


def test_each_distinct_piece_is_looked_up_once_a_group():
    from vigil.llm.pieces import PieceEncoder

    class Counted(dict):
        looked = 0

        def __getitem__(self, piece):
            self.looked += 1
            return super().__getitem__(piece)

    encoder = PieceEncoder(lambda pieces: [p.encode() for p in pieces])
    encoder.known = Counted()
    texts = ["so it is " + "as it was " * 500 + "now", "", "  a\tb", "x\x00 y z", "é ß\n日"]
    assert encoder.texts(texts) == [t.encode() for t in texts]
    assert encoder.known.looked < 30
    assert encoder.texts([]) == [] and encoder.texts([""]) == [b""]


def test_a_column_becomes_strings_in_steps():
    import pyarrow as pa
    from vigil.llm.pieces import in_groups

    class Column:
        largest = 0

        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, at, n):
            Column.largest = max(Column.largest, n)
            return self.values.slice(at, n)

    texts = [None if i % 7 == 0 else "ab" * (i % 50) for i in range(2000)] + ["x" * 5000]
    runs = list(in_groups(Column(pa.array(texts)), chars=1000, rows=100))
    assert Column.largest == 100
    assert [t for _, run in runs for t in run] == [t or "" for t in texts]
    assert [first for first, _ in runs] == np.cumsum([0] + [len(run) for _, run in runs])[:-1].tolist()
    assert list(in_groups(pa.array([], pa.string()))) == []


def test_packing_in_the_pipeline_remembers_few_pieces(monkeypatch):
    import corpus_pipeline
    import pyarrow as pa

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    made = []
    monkeypatch.setattr(packing.F, "col", lambda name: cases)
    monkeypatch.setattr(cases, "cast", lambda kind: None, raising=False)
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type(
        "Now", (), {"partitionId": staticmethod(lambda: 0)}))}))
    monkeypatch.setattr(packing, "library_encoder", lambda *a: made.append(library_encoder(*a)) or made[-1])
    run = corpus_pipeline.pack(None, Docs(), "")
    most = 0
    for at in range(0, 700_000, 10_000):
        text = " ".join(f"{n:x}q{n}" for n in range(at, at + 10_000))
        assert sum(r.num_rows for r in run([pa.RecordBatch.from_pydict({"doc_id": [at], "text": [text]})])) > 1
        most = max(most, len(made[-1].known) + len(made[-1].older))
    assert 100_000 <= most <= 450_000
