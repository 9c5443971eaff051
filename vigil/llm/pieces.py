"""Cutting texts into pieces that a byte-level tokenizer encodes one by one, and encoding each piece once.

The pre-tokenizers of the byte-level vocabularies begin a new token at every space or line end that stands
alone between characters which are no white space, and also after such a line end. A text may therefore be
cut there, and equal pieces have equal ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where white space stands in longer runs, only a space before other characters begins a new token.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_MARK = "\x00"


#: White space besides the space and the line end.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _alone(text: str) -> bool:
    """Whether all white space is single spaces and line ends between other characters."""
    return not (not text or text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text
                or " \n" in text or "\n " in text or any(c in text for c in _OTHER_SPACE))


def _marked(text: str) -> str | None:
    """`text` with a mark wherever it is cut; none where the text itself holds the mark."""
    if _MARK in text:
        return None
    if _alone(text):
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")
    return _MARK.join(_CUT.split(text))  # runs of white space, at an end, or of another kind


def cut(text: str) -> list[str]:
    """The pieces of `text`; joined they give it back. An empty text has one empty piece."""
    marked = _marked(text)
    return _CUT.split(text) if marked is None else marked.split(_MARK)


class PieceEncoder:
    """Encodes texts piece by piece and remembers pieces across the texts and tasks of one Python worker.

    `encode` turns new pieces into their ids, as little-endian unsigned 32-bit integers. About `keep` pieces
    are remembered, in two generations: when the younger holds half of them, the older is forgotten. This
    bounds memory and changes no result. Texts that hold a string of `undivided` are not cut, but given to `whole`.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], keep: int = 1_000_000,
        undivided: Sequence[str] = (), whole: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self.encode = encode
        self.undivided = undivided
        self.whole = whole
        self.half = keep // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def texts(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.undivided)]
        if odd:
            found = dict(zip(odd, self.whole([texts[i] for i in odd])))
            rest = iter(self._cut([t for i, t in enumerate(texts) if i not in found]))
            return [found[i] if i in found else next(rest) for i in range(len(texts))]
        return self._cut(texts)

    def _cut(self, texts: list[str]) -> list[bytes]:
        marked = [_marked(t) for t in texts]
        if None in marked:
            found = iter(self._joined([m for m in marked if m is not None]))
            return [b"".join(self._ids(cut(t))) if m is None else next(found) for t, m in zip(texts, marked)]
        return self._joined(marked)

    def _joined(self, marked: list[str]) -> list[bytes]:
        """The ids of each marked text; each distinct piece of them is looked up once."""
        pieces = pc.split_pattern(pa.array(marked, pa.large_string()), _MARK)
        coded = pieces.values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
        ids = pa.array(self._ids(distinct), pa.large_binary()).take(coded.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64)[pieces.offsets.to_numpy()].tolist()
        held = memoryview(data or b"")
        return [bytes(held[a:b]) for a, b in zip(at, at[1:])]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.half:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set(pieces).difference(known)
        known.update((p, older[p]) for p in missing if p in older)
        new = list(missing.difference(known))
        known.update(zip(new, self.encode(new)))
        return [known[p] for p in pieces]


def in_groups(texts: pa.Array, chars: int = 1_000_000, rows: int = 250) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about `chars` characters, each with the place of its first; null counts as empty.

    One longer text makes a run of its own. The column becomes Python's strings `rows` at a time, never as a whole."""
    first, size, run = 0, 0, []
    values = (t for at in range(0, len(texts), rows) for t in texts.slice(at, rows).to_pylist())
    for i, text in enumerate(values):
        text = text or ""
        if run and size + len(text) > chars:
            yield first, run
            first, size, run = i, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield first, run
