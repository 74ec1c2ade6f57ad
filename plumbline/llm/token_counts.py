"""Token counts of a unigram tokenizer without its tokens.

All vocabulary pieces that occur in a word are found by one pass of an Aho-Corasick automaton. Going from left to
right, each position keeps the best score of any segmentation up to it and the number of pieces of that segmentation.
Ties and unknown characters follow the unigram model of the public ``tokenizers`` library: of equal scores the one
whose last piece starts first wins; a character without a piece of its own may be taken as unknown at the lowest
score less 10; unknown neighbours are joined, and spelled in bytes if the model says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, without

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer's unigram model
KEPT_WORDS = 300_000
KEPT_WORD_LENGTH = 48


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def piece_counter(pieces: Sequence[tuple[str, float]], unknown_id: int, byte_fallback: bool) -> Callable[[str], int]:
    """A function that counts the pieces of a text."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for i, (piece, score) in enumerate(pieces):
        if piece:
            automaton.add_word(piece, (len(piece), score, i == unknown_id))
    automaton.make_automaton()
    vocabulary = {piece for piece, _ in pieces}
    unknown_score = min(score for _, score in pieces) - UNKNOWN_PENALTY
    kept: dict[str, int] = {}

    def of_unknown(run: str) -> int:
        return 1 if run in vocabulary or not byte_fallback else len(run.encode("utf-8", "replace"))

    def of_word(word: str) -> int:
        ending: list[list[tuple[int, float, bool]]] = [[] for _ in range(len(word) + 1)]
        for last, found in automaton.iter(word):
            ending[last + 1].append(found)
        # Per position: best score, pieces before the unknown run that ends here, start of that run or -1.
        scores, counts, runs = [0.0], [0], [-1]
        for end in range(1, len(word) + 1):
            best, start, unknown, single = None, -1, False, False
            for length, score, is_unknown in sorted(ending[end], reverse=True):  # first starts first
                single = single or length == 1
                total = scores[end - length] + score
                if best is None or total > best:
                    best, start, unknown = total, end - length, is_unknown
            if not single:
                total = scores[end - 1] + unknown_score
                if best is None or total > best:
                    best, start, unknown = total, end - 1, True
            run, count = runs[start], counts[start]
            if unknown:
                run = start if run < 0 else run
            else:
                count += 1 + (0 if run < 0 else of_unknown(word[run:start]))
                run = -1
            scores.append(best)
            counts.append(count)
            runs.append(run)
        return counts[-1] + (0 if runs[-1] < 0 else of_unknown(word[runs[-1] :]))

    def of_text(text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        total = 0
        for word in (marked[1:] if marked[0] == SPACE else marked).split(SPACE):
            count = kept.get(word)
            if count is None:
                count = of_word(SPACE + word)
                if len(word) <= KEPT_WORD_LENGTH:
                    if len(kept) >= KEPT_WORDS:  # a bound on memory; a word that is gone is counted anew
                        kept.clear()
                    kept[word] = count
            total += count
        return total

    return of_text


def token_count(
    text: Column, pieces: Sequence[tuple[str, float]], unknown_id: int = 0, byte_fallback: bool = True
) -> Column:
    """The number of pieces of ``text``; 0 for a null or empty one."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = piece_counter(pieces, unknown_id, byte_fallback)
        for texts in batches:
            yield pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    return counted(text)


def count_tokens(
    docs: DataFrame, pieces: Sequence[tuple[str, float]], text: str = "text", unknown_id: int = 0, byte_fallback: bool = True
) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``.

    A null or empty text has 0 tokens. Texts are counted whole, whatever their length; repeated rows are counted
    each. A column called ``n_tokens`` is replaced. The vocabulary (a file of bounded size) goes to each task.
    """
    bounded_batches(docs.sparkSession)
    kept = without(docs, ["n_tokens"])
    return kept.withColumn("n_tokens", token_count(F.col(f"`{text}`"), pieces, unknown_id, byte_fallback))
