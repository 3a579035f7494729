"""Quality classifier: support vectors on word n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

import functools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame

from quayside.llm import nbsvm
from quayside.llm.common import mix, sole

SIZE = 1 << 20


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        # Marks, digits and case say more of quality than the letters of a word that is met once.
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_SHAPE = bytes(
    ord("a") if chr(b).islower() and b < 128 else ord("A") if chr(b).isupper() and b < 128 else ord("0") if 48 <= b < 58 else ord("a") if b >= 128 else b
    for b in range(256)
)


class _Shapes(dict):
    """Hash of a word's shape: runs of small letters, capitals and digits shortened, other marks as they are."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        shape, last = bytearray(), 0
        for b in word.translate(_SHAPE):
            if b != last or b not in b"aA0":
                shape.append(b)
            last = b
        self[word] = value = xxhash.xxh3_64_intdigest(bytes(shape), 1)
        return value


def features(text: bytes | None) -> np.ndarray:
    """Numbers of the word, shape, and shape n-grams (one to three) of a text; none for an empty one."""
    content = (text or b"").split()
    if not content:
        return np.empty(0, np.int64)
    n = len(content)
    words, shapes, place = sole("quality", lambda: (_Words(), _Shapes(), np.empty(SIZE, np.int32)))
    word = np.fromiter(map(words.__getitem__, content), np.uint64, n)
    shape = np.fromiter(map(shapes.__getitem__, content), np.uint64, n)
    two = mix(shape[:-1] * np.uint64(3) + shape[1:])
    three = mix(two[:-1] * np.uint64(5) + shape[2:])
    pairs = mix(word[:-1] * np.uint64(7) + word[1:])
    ids = np.concatenate([word, shape, two, three, pairs]) & np.uint64(SIZE - 1)
    return nbsvm.each_once(ids.astype(np.int64), place)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, **options) -> DataFrame:
    """Every row and column of `docs` with score (0 to 1), predicted (score >= 0.5) and held_out.

    Learned from `labels.quality` outside `held_out`. The inputs are the whole text's n-grams of
    words and word shapes, nothing else. Ratios cover all labelled rows; the hinge-loss fit is on a
    bounded sample (`sample_rows`). Scoring is one narrow pass.

    Null and empty texts have the score of no features. Repeated rows score alike. Null labels are
    left out; without labels, or with one class only, all scores are that class's share. An empty
    table gives no rows. `docs` must not already have a column score.
    """
    return nbsvm.judge(docs, labels, "quality", features, SIZE, held_out, **options)


held_out = functools.partial(nbsvm.fold, 3)
