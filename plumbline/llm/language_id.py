"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone. A group of three letters is the
product of their vectors, the first rotated twice and the second once; a text is the sum of its groups, a language the
sum of its texts. The language whose vector has the largest cosine with the text's is the answer.

Learning counts letter groups per language in every training text, so what is shuffled are counts of different
groups; only the vectors of the languages come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, without

DIMENSIONS = 2048
KEPT_GROUPS = 16_000
TOGETHER = 4_000  # groups in one product
COUNTED_TOGETHER = 1_000_000  # groups counted at once
UNDETERMINED = "und"
ADDED = ["lang_pred", "score"]


class Space:
    """Vectors of letters and letter groups; the number of those kept in memory is bounded."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.groups = np.zeros((0, dimensions), np.int8)
        self.is_letter = np.zeros(0x110000, bool)
        self.is_letter[[c for c in range(0x110000) if chr(c).isalpha()]] = True

    def letter(self, code: int) -> np.ndarray:
        vector = self.letters.get(code)
        if vector is None:
            bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, self.dimensions)
            if len(self.letters) >= KEPT_GROUPS:
                self.letters.clear()
            vector = self.letters[code] = (2 * bits - 1).astype(np.int8)
        return vector

    def codes(self, text: str) -> np.ndarray:
        """The text's groups of three, lower case, other characters than letters as single spaces; none without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        letters = self.is_letter[points]
        if not letters.any():
            return np.zeros(0, np.int64)
        points = np.concatenate([[32], np.where(letters, points, 32), [32]])
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]

    def bound(self, code: int) -> np.ndarray:
        a, b, c = (self.letter((code >> s) & 0x1FFFFF) for s in (42, 21, 0))
        return np.roll(a, 2) * np.roll(b, 1) * c

    def rows(self, codes: list[int]) -> np.ndarray:
        """The vectors of at most ``KEPT_GROUPS`` groups."""
        new = [c for c in codes if c not in self.place]
        if len(self.place) + len(new) > KEPT_GROUPS:
            self.place, self.groups, new = {}, self.groups[:0], codes
        if len(self.place) + len(new) > len(self.groups):
            room = min(KEPT_GROUPS, (len(self.place) + len(new)) * 5 // 4)
            grown = np.zeros((max(room, len(self.place) + len(new)), self.dimensions), np.int8)
            grown[: len(self.groups)] = self.groups
            self.groups = grown
        for c in new:
            self.groups[len(self.place)] = self.bound(c)
            self.place[c] = len(self.place)
        return self.groups[[self.place[c] for c in codes]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each row of ``counts`` the sum of the groups' vectors, each as often as it is counted; ``codes`` differ."""
        total = np.zeros((len(counts), self.dimensions))
        for at in range(0, len(codes), TOGETHER):
            part = slice(at, at + TOGETHER)
            # Whole numbers; float32 holds them exactly below 2**24, which the counts of one part rarely leave.
            kind = np.float32 if counts[:, part].sum(axis=1).max() < 2**24 else np.float64
            total += counts[:, part].astype(kind) @ self.rows(codes[part].tolist()).astype(kind)
        return total

    def vectors(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """Number and vector of each text with letters, many texts in one product."""
        wait: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            codes = self.codes(text) if text else ()
            if len(codes):
                wait.append((i, *np.unique(codes, return_counts=True)))
                size += len(wait[-1][1])
            if wait and (size >= TOGETHER * 8 or len(wait) >= 64 or i == len(texts) - 1):
                yield from self._product(wait)
                wait, size = [], 0
        if wait:
            yield from self._product(wait)

    def _product(self, wait: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        every, place = np.unique(np.concatenate([codes for _, codes, _ in wait]), return_inverse=True)
        counts = np.zeros((len(wait), len(every)))
        counts[np.repeat(np.arange(len(wait)), [len(codes) for _, codes, _ in wait]), place] = np.concatenate([n for *_, n in wait])
        yield from zip([i for i, *_ in wait], self.bundle(every, counts), strict=True)


def _count(wait: dict[str, list[np.ndarray]], sums: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
    """Adds the waiting codes to the counts per language and empties them."""
    for language, parts in wait.items():
        codes, counts = np.unique(np.concatenate(parts), return_counts=True)
        if language in sums:
            known, so_far = sums[language]
            every, place = np.unique(np.concatenate([known, codes]), return_inverse=True)
            codes, counts = every, np.bincount(place, np.concatenate([so_far, counts])).astype(np.int64)
        sums[language] = codes, counts.astype(np.int64)
    wait.clear()


@dataclass
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # of length 1


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Language vectors from every row with a text and a language; no rows, no languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(1)
        for batch in batches:
            wait: dict[str, list[np.ndarray]] = {}
            sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            size = 0
            for language, body in zip(batch.column(0), batch.column(1), strict=True):
                wait.setdefault(language.as_py(), []).append(space.codes(body.as_py()))
                size += len(wait[language.as_py()][-1])
                if size >= COUNTED_TOGETHER:
                    _count(wait, sums)
                    size = 0
            _count(wait, sums)
            for language, (codes, counts) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "code", "n"]
                )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dimensions), {}
        for batch in batches:
            frame = batch.to_pandas()
            for language, part in frame.groupby("lang"):
                total = space.bundle(part["code"].to_numpy(), part["n"].to_numpy()[None, :])[0]
                sums[language] = sums.get(language, 0) + total
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([list(v) for v in sums.values()], pa.list_(pa.float64()))],
                ["lang", "vector"],
            )

    bounded_batches(docs.sparkSession)
    labelled = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = labelled.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, "lang string, code long, n long")
    sums = counts.groupBy("lang", "code").agg(F.sum("n").alias("n")).mapInArrow(bundle, "lang string, vector array<double>")
    rows = (
        sums.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    ).collect()  # languages times dimensions: does not grow with the documents
    languages = sorted({r["lang"] for r in rows})
    vectors = np.zeros((len(languages), dimensions))
    place = {language: k for k, language in enumerate(languages)}
    for r in rows:
        vectors[place[r["lang"]], r["i"]] = r["x"]
    return Profiles(languages, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300))


def identify(text: Column, profiles: Profiles) -> Column:
    """``lang_pred`` and ``score`` (the cosine, from 0 to 1) of a text as a struct."""
    languages, vectors, dimensions = profiles.languages, profiles.vectors, profiles.vectors.shape[1]

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(dimensions)
        for texts in batches:
            found = [(UNDETERMINED, 0.0)] * len(texts)
            for i, vector in space.vectors(list(texts)) if languages else ():
                cosines = vectors @ (vector / max(float(np.linalg.norm(vector)), 1e-300))
                best = int(np.argmax(cosines))  # of equal ones the first by name
                found[i] = (languages[best], float(min(1.0, max(0.0, cosines[best]))))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return identified.asNondeterministic()(text)  # not to be worked out again where a caller filters by it


def identify_languages(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``.

    ``und`` with score 0 stands for a null text, one without letters, and for any text if no language was learned. Whole
    texts count. Repeated rows get equal answers; of equal cosines the first language by name wins. Columns called
    ``lang_pred`` or ``score`` are replaced.
    """
    bounded_batches(docs.sparkSession)
    kept = without(docs, ADDED)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), identify(F.col(f"`{text}`"), profiles).alias("found"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in kept.columns], "found.lang_pred", "found.score")
