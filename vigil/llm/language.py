"""Language identification by rank-order profiles of letter n-grams.

A language's profile is the list of its most frequent n-grams over all training documents, by falling
frequency. A document is given to the language whose profile its own list differs from least: the
out-of-place distance sums, over the document's most frequent n-grams, how far each one's rank is from its
rank in the profile; an n-gram that the profile lacks counts as the whole profile's length.

N-grams are packed into one 64-bit number, 21 bits a letter, so that numpy counts them by sorting.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.memory import begin
from vigil.llm.names import any_names

UNKNOWN = "und"

#: Stands for anything but letters; no letter, and not 0, so that n-grams of different lengths stay apart.
EDGE = 1

#: Languages are labels that people give; a table with more of them has something else in its lang column.
MOST_LANGUAGES = 10_000

#: n-grams of a longer text are counted stretch by stretch, so that memory stays bounded.
STRETCH = 1 << 21


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _symbols(text: str) -> np.ndarray:
    """Lower-cased letters as code points, and one EDGE for each run of anything else and at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(_letters()[codes], codes, EDGE)
    codes = np.concatenate([[EDGE], codes, [EDGE]])
    return codes[(codes != EDGE) | np.concatenate([[True], codes[:-1] != EDGE])]


def _grams(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Every n-gram of 1 to `longest` symbols but an EDGE alone or inside; one at an end marks a word's edge."""
    out = [symbols[symbols != EDGE]]
    gram = symbols
    for n in range(2, longest + 1):
        gram = gram[: len(symbols) - n + 1] << 21 | symbols[n - 1 :]
        keep = np.ones(len(gram), bool)
        for k in range(1, n - 1):
            keep &= symbols[k : k + len(gram)] != EDGE
        out.append(gram[keep])
    return np.concatenate(out)


def count_grams(text: str, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text and their counts, by ascending n-gram number."""
    symbols = _symbols(text)
    if len(symbols) <= STRETCH:
        return np.unique(_grams(symbols, longest), return_counts=True)
    found = []
    for start in range(0, len(symbols), STRETCH):
        stretch = symbols[start : start + STRETCH + longest - 1]
        grams, n = np.unique(_grams(stretch, longest), return_counts=True)
        # N-grams that begin in the next stretch are counted there.
        later, m = np.unique(_grams(stretch[STRETCH:], longest), return_counts=True)
        n[np.searchsorted(grams, later)] -= m
        found.append((grams, n))
    return _summed(found)


def _summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate([g for g, _ in counts]), return_inverse=True)
    total = np.bincount(place, np.concatenate([n for _, n in counts])).astype(np.int64)
    return grams[total > 0], total[total > 0]


def profiles(docs: DataFrame, longest: int = 3, size: int = 300) -> DataFrame:
    """lang, gram, place: the `size` most frequent n-grams of each language over all rows of `docs`
    (text, lang), place from 0; ties by the n-gram's number. Rows without text or lang teach nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        for batch in batches:
            held: dict[str, list] = {}
            letters: dict[str, int] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(count_grams(text, longest))
                letters[lang] = letters.get(lang, 0) + len(text)
                if letters[lang] > STRETCH:
                    held[lang], letters[lang] = [_summed(held[lang])], 0
            for lang, counts in held.items():
                grams, n = _summed(counts)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": grams, "n": n})

    counted = (docs.where("text is not null and lang is not null").select("text", "lang")
               .mapInArrow(run, "lang string, gram bigint, n bigint")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counted.withColumn("place", F.row_number().over(by_count) - 1).where(F.col("place") < size)
            .select("lang", "gram", "place"))


class Model:
    """The profiles of all languages as arrays; a few kilobytes a language."""

    def __init__(self, rows: list[tuple[str, int, int]], longest: int, size: int):
        self.longest, self.size = longest, size
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), np.int64)
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        number = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[number[lang], np.searchsorted(self.grams, gram)] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and 1 - distance / greatest possible distance; ties go to the first by name."""
        grams, counts = count_grams(text or "", self.longest)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        order = np.lexsort((grams, -counts))[: self.size]
        top = grams[order]
        at = np.searchsorted(self.grams, top)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != top)] = len(self.grams)
        places = self.places[:, at]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(top))))
        distance = apart.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(top))


def fit(docs: DataFrame, longest: int = 3, size: int = 300) -> Model:
    """A model from all rows of `docs` (text, lang). The driver gets `size` rows a language.

    More than MOST_LANGUAGES languages raise an error; without any training row every text is `und`."""
    rows = profiles(docs, longest, size).limit(MOST_LANGUAGES * size + 1).collect()
    if len(rows) > MOST_LANGUAGES * size:
        raise ValueError(f"the lang column has more than {MOST_LANGUAGES} languages")
    return Model([tuple(r) for r in rows], longest, size)


def predict(
    docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns `keep` of `docs`, and by `names` the language and score (0 to 1) of each whole text.

    `und` and 0 where the text is null or has no letter, or the model no language. Other columns are not
    read; repeated rows and null keys are predicted like any other row."""
    kept = docs.select(*keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*keep, *names])

    schema = kept.schema.add(names[0], "string").add(names[1], "double")
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the doc_id as text leaves 2 when divided by 4; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs`, learned from the rows not held out."""
    model = fit(docs.where(~held_out()))
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(marked, model, ("doc_id", "held_out"))


@any_names
def keep_identified(docs: DataFrame, least_score: float = 0.05) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is identified with at least `least_score`.

    The model is learned from all labelled rows that are not held out."""
    model = fit(docs.where(~held_out()))
    columns = tuple(docs.columns)
    found = predict(docs, model, columns, ("__lang", "__score"))
    return found.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least_score)).select(*columns)
