"""Toxicity classifier: support vectors on character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import nbsvm
from quayside.llm.common import mix, sole

SIZE = 1 << 20
ORDERS = (3, 5, 7)

_LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def features(text: bytes | None) -> np.ndarray:
    """Numbers of the character n-grams of a text, A-Z lower-cased and framed by spaces."""
    if not text:
        return np.empty(0, np.int64)
    place = sole("toxicity", lambda: np.empty(SIZE, np.int32))
    framed = b" " + text.translate(_LOWER) + b" "
    if framed.isascii():
        chars = np.frombuffer(framed, np.uint8).astype(np.uint64)
    else:
        chars = np.frombuffer(framed.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    chars = (chars + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids, gram, width = [], chars, 1
    for order in ORDERS:
        while width < order and len(gram) > 1:
            # A rolling polynomial: the gram one character longer.
            gram = gram[:-1] * np.uint64(0xD1342543DE82EF95) + chars[width:]
            width += 1
        if width == order:
            ids.append((mix(gram + np.uint64(order)) >> np.uint64(44)).astype(np.int64))
    return nbsvm.each_once(np.concatenate(ids), place) if ids else np.empty(0, np.int64)


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, **options) -> DataFrame:
    """Every row and column of `docs` with score (0 to 1), predicted (score >= 0.5) and held_out.

    Learned from `labels.toxic` outside `held_out`. The inputs are the whole text's character
    n-grams, nothing else. Ratios cover all labelled rows; the hinge-loss fit is on a bounded sample
    (`sample_rows`). Scoring is one narrow pass.

    Null and empty texts have the score of no features. Repeated rows score alike. Null labels are
    left out; without labels, or with one class only, all scores are that class's share. An empty
    table gives no rows. `docs` must not already have a column score.
    """
    return nbsvm.judge(docs, labels, "toxic", features, SIZE, held_out, **options)


def not_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows and columns of `docs` that are not predicted toxic, learned from all labels.

    Columns may have any names, also those of a score; all come back as they are.
    """
    name = next(n for n in (f"_toxicity_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    model = nbsvm.fit(nbsvm.labelled_texts(docs.select("doc_id", "text"), labels, "toxic"), features, SIZE, **options)
    return nbsvm.scored(docs, model, features, name).where(F.col(name) < 0.5).drop(name)
