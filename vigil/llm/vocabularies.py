"""Public tokenizers, loaded once per Python worker. Paths are parameters; nothing is copied here."""

from __future__ import annotations

import base64
import functools
import os

import numpy as np

from vigil.llm.memory import remembers
from vigil.llm.pieces import PieceEncoder


def _by_lines(tokenizer, pieces: list[str], lines: int = 2000) -> list[bytes]:
    """Ids of pieces without line ends, encoded as the lines of longer texts.

    A line end between them is always a token of its own, so that the ids fall apart there; it saves the
    library's costs for every single text."""
    texts = ["\n".join(pieces[i : i + lines]) for i in range(0, len(pieces), lines)]
    end = tokenizer.encode("\n", add_special_tokens=False).ids[0]
    out = []
    for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(ids == end).tolist()
        data = ids.tobytes()
        out += [data[4 * a : 4 * b] for a, b in zip([0] + [e + 1 for e in ends], ends + [len(ids)])]
    return out


@functools.lru_cache(maxsize=4)
def library_encoder(path: str, owner: str = "pieces", keep: int = 1_500_000) -> PieceEncoder:
    """Ids by the tokenizers library without added special tokens. A text that holds the string of one is encoded
    whole, as the library takes the string for the token wherever it stands. `owner` remembers about `keep` pieces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(pieces: list[str]) -> list[bytes]:
        # A piece that is white space, or ends with it, would join the line end behind it.
        plain = [p for p in pieces if p and "\n" not in p and not p[-1].isspace() and not p[1:2].isspace()]
        found = _by_lines(tokenizer, plain)
        if len(plain) == len(pieces):
            return found
        ids = dict(zip(plain, found))
        other = [p for p in pieces if p not in ids]
        ids.update(zip(other, library(other)))
        return [ids[p] for p in pieces]

    def library(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    encoder = PieceEncoder(encode, keep, special, library)
    remembers(owner, encoder.forget)
    return encoder


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
