"""Packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import array
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import sole

# Punctuation that a tokenizer with word ends always parts from a letter or digit before it.
# The apostrophe is absent: it may begin a contraction.
TAIL = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
LONG_CHUNK = 64
CACHE_ENTRIES = 250_000
MET = (1 << 22) - 1
# Letters whose small form is one letter too and that composition leaves as they are.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"


class WordIds(dict):
    """Little-endian ids of chunks without spaces, filled as chunks are met.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    chunks in turn. Trailing punctuation starts a piece of its own and letters are lower-cased by
    the tokenizer, so both are looked up apart, which keeps the table small. Half of
    all words are met once only, so a word enters when it is met again. A full table becomes the
    old one, from which words that are still met are taken over.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.old, self.met = tokenizer, {}, bytearray(MET + 1)
        self.tokenize = tokenizer.model.tokenize
        self.plain = re.compile(f"[a-z]{{1,{LONG_CHUNK}}}\\Z").match
        self.latin = re.compile(f"[{LATIN}]+\\Z").match
        self.ends_well = re.compile(f"[{LATIN}0-9]\\Z").search
        # One stop or comma between a letter and a space is a piece of its own.
        self.single = re.compile("(?<=[a-z])([.,]) ").sub
        small = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("÷", "")
        split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.alphabet = {ord(c): "".join(piece for piece, _ in split(c)) for c in small}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if self.plain(chunk):
                ids = _packed([piece.id for piece in self.tokenize(chunk)])
            else:
                ids = self.ids(chunk)
        if len(chunk) <= LONG_CHUNK:
            mark = hash(chunk) & MET
            if self.met[mark]:
                if len(self) >= CACHE_ENTRIES:
                    self.old = dict(self)
                    self.clear()
                    self.met = bytearray(MET + 1)
                self[chunk] = ids
            else:
                self.met[mark] = 1
        return ids

    def ids(self, chunk: str) -> bytes:
        body = chunk.rstrip(TAIL) if "<|" not in chunk else ""  # special tokens are found in the whole
        if body and (body.isascii() or self.latin(body)) and self.ends_well(body):
            low = body.lower()
            if low != chunk:
                return self[low] + (self[chunk[len(body) :]] if len(body) < len(chunk) else b"")
            if self.latin(low) and len(low) <= LONG_CHUNK:
                return _packed([piece.id for piece in self.tokenize(low.translate(self.alphabet))])
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text:
            try:
                text.encode("latin-1")  # then lower-casing is letter by letter
                text = self.single(r" \1 ", text.lower())
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file."""

    def make() -> WordIds:
        from tokenizers import Tokenizer

        return WordIds(Tokenizer.from_file(path))

    return sole(f"word ids {path}", make)


PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, slot bigint, row bigint"


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int, size: int) -> DataFrame:
    """Pieces of at most `size` ids of each document and its closing id, with the ids.

    All pieces of a document but the last are full. `slot` numbers a document's pieces, `row` is its place in `docs`.
    """
    end = array.array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(tokenizer_path)
        for batch in batches:
            rows, held = [], 0
            for doc, text, row in zip(*batch.columns, strict=True):
                doc, ids = doc.as_py(), table.of(text.as_py()) + end
                total = len(ids) // 4
                for slot, start in enumerate(range(0, total, size)):
                    piece = ids[4 * start : 4 * (start + size)]
                    rows.append((doc, start, len(piece) // 4, total, piece, slot, row.as_py()))
                    held += len(piece)
                if held > 4_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    row = F.monotonically_increasing_id()
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), row).mapInArrow(cut, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: longest first, each into the first bin that still holds it.

    A tournament tree over the bins carries the largest room below each node, so that the first
    bin with enough room is found by one descent. Equal lengths keep their order. Bins are
    numbered in the order in which they are opened.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [size] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, size - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            best = room[2 * node]
            room[node] = best if best >= room[2 * node + 1] else room[2 * node + 1]
    return bins, offsets


def packed(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 2048, group_bytes: int = 8_000_000
) -> DataFrame:
    """Pieces of `docs` (doc_id, text) with the sequence and offset at which each lies, and their ids.

    Documents are tokenised, closed by `end_id` and cut into pieces of `size` ids and a rest.
    Pieces are dealt into groups by a hash of document, piece and the row's place in `docs` (a written table, so that
    a repeated task sees the same places), each of about `group_bytes` of
    text, so a group's memory is bounded however long a document, large the corpus or often a row is repeated; one document's
    pieces may fall into many groups. Each group is packed alone by first-fit decreasing. At most
    the last few sequences of a group stay unfilled.

    Null and empty texts: the closing id alone. Repeated rows are packed each. A null doc_id is
    kept as null. An empty table gives no rows. Other columns are ignored.
    """
    if size < 1:
        raise ValueError("size must be positive")
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    pieces = tokenised(docs, tokenizer_path, end_id, size)
    # Repeated rows are told apart by their place, so they fall into different groups as well.
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "slot", "row"), F.lit(groups)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "row"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(np.int64), size)
        group["sequence_id"] = group["grp"] * (1 << 32) + bins
        group["offset"] = offsets
        return group.drop(columns=["grp", "slot", "row"])

    result = PIECES.replace(", slot bigint, row bigint", "") + ", sequence_id bigint, offset bigint"
    return pieces.groupBy("grp").applyInPandas(pack, result)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of `packed`: its ids in order, used length and padded length.

    A sequence is padded to the next full size unless its length is a power of two.
    """
    size = 2048
    used = F.sum("length")
    joined = F.expr(
        "array_sort(collect_list(struct(offset, ids)), (a, b) -> int(a.offset - b.offset))"
    )
    out = pieces.groupBy("sequence_id").agg(used.alias("used"), joined.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    power = F.bit_count("used") == 1
    return out.select("sequence_id", ids.alias("ids"), "used", F.when(power, F.col("used")).otherwise(size).alias("padded"))
