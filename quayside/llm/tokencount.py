"""Counting the pieces of a unigram tokenizer without building them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import sole

MARK = "▁"  # stands for a space, as unigram vocabularies write it
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores this much below the worst piece
CACHE_ENTRIES = 400_000
LONG_WORD = 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file and a log-probability for each.

    The file at hand holds merges in order of rank and no probabilities, and tokenizers are never
    trained, so a piece's probability follows its rank by Zipf's law. Special and byte pieces
    cannot match text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return [(piece, -math.log(rank + 1)) for rank, piece in enumerate(dict.fromkeys(pieces), 1)]


class PieceCounter(dict):
    """Piece counts of words by Viterbi search, remembered per word and emptied when full."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        count = self.search(word)
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = count
        return count

    def search(self, word: str) -> int:
        """Pieces on the best path through `word`.

        The automaton lists the matches that end at each character, longest first. The dynamic
        programme keeps the best score and its piece count per end. A later candidate replaces an
        earlier one only if it scores strictly more, so among equal scores the one that starts
        first wins. A character that no one-character piece matches is also an unknown candidate, scored
        below all pieces and counted as its UTF-8 bytes.
        """
        n = len(word)
        best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        done = 0

        def close(upto: int, single: bool) -> None:
            """Finish position `upto`: without a one-character match there, its character is unknown."""
            if not single:
                score = best[upto - 1] + self.unknown
                if score > best[upto]:
                    best[upto], count[upto] = score, count[upto - 1] + len(word[upto - 1].encode())

        single = False
        for last, (length, score) in self.automaton.iter(word):
            end = last + 1
            while done + 1 < end:
                done += 1
                close(done, single)
                single = False
            total = best[end - length] + score
            if total > best[end]:
                best[end], count[end] = total, count[end - length] + 1
            single = single or length == 1
        while done < n:
            done += 1
            close(done, single)
            single = False
        return count[n]

    def of(self, text: str | None) -> int:
        """Each space is written as a mark that begins a word; the first word gets one too.

        A text that begins with a space needs none more. Two spaces in a row make a mark alone.
        """
        if not text:
            return 0
        parts = text.replace(MARK, " ").split(" ")
        if parts[0] == "":
            del parts[0]
        return sum(map(self.__getitem__, [MARK + part for part in parts]))


def counter(path: str) -> PieceCounter:
    """The worker's counter for a vocabulary file."""
    return sole(f"pieces {path}", lambda: PieceCounter(vocabulary(path)))


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_tokens, n_chars, tokens_per_char) of every row of `docs`.

    A narrow step: no shuffle, whole texts, one row in and one out. Null and empty texts have no
    tokens and a null ratio. Repeated rows and null ids come out as they went in; an empty table
    gives no rows; other columns are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(vocabulary_path)
        for batch in batches:
            counts, sizes = [], []
            for value in batch.column(1):
                text = value.as_py()
                counts.append(table.of(text))
                sizes.append(len(text or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                ["doc_id", "n_tokens", "n_chars"],
            )

    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id bigint, n_tokens bigint, n_chars bigint"
    )
    return counted.withColumn("tokens_per_char", F.col("n_tokens") / F.nullif("n_chars", F.lit(0)))
