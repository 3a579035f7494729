"""Removal of benchmark passages from a corpus by a generalised suffix automaton."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, sole, texts, words


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the windows that occur in each.

    `window` consecutive words of an item are a window; an item of fewer words, but not none, is one
    window. `items` are (item_id, words).
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]  # transitions of each state
        self.link, self.length = [-1], [0]
        coded = []
        for item, content in items:
            if content:
                coded.append((item, [self.codes.setdefault(w, len(self.codes)) for w in content]))
        for _, content in coded:
            last = 0
            for code in content:
                last = self._extend(last, code)
        # A window's state is the one that its words lead to; the same words always lead there.
        self.long: dict[int, set] = {}  # state of a full window -> items that hold it
        self.short: dict[int, set] = {}  # state of a short item's words -> items
        for item, content in coded:
            if len(content) < window:
                state = 0
                for code in content:
                    state = self.step[state][code]
                self.short.setdefault((state, len(content)), set()).add(item)
                continue
            state, held = 0, 0
            for code in content:
                state, held = self.advance(state, held, code)
                if held >= window:
                    self.long.setdefault(self.suffix(state), set()).add(item)
        self.short_lengths: dict[int, list[tuple[int, frozenset]]] = {}
        for (state, length), found in self.short.items():
            self.short_lengths.setdefault(state, []).append((length, frozenset(found)))
        self._tails = self._short_tails()

    def _extend(self, last: int, code: int) -> int:
        step, link, length = self.step, self.link, self.length
        if code in step[last]:  # another item already has these words
            known = step[last][code]
            return known if length[known] == length[last] + 1 else self._copy(last, code, known)
        new = self._state({}, length[last] + 1)
        at = last
        while at != -1 and code not in step[at]:
            step[at][code] = new
            at = link[at]
        if at == -1:
            link[new] = 0
        else:
            known = step[at][code]
            link[new] = known if length[known] == length[at] + 1 else self._copy(at, code, known)
        return new

    def _copy(self, at: int, code: int, known: int) -> int:
        """Part the shorter words of a state from its longer ones."""
        copy = self._state(dict(self.step[known]), self.length[at] + 1)
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while at != -1 and self.step[at].get(code) == known:
            self.step[at][code] = copy
            at = self.link[at]
        return copy

    def _state(self, transitions: dict[int, int], length: int) -> int:
        self.step.append(transitions)
        self.length.append(length)
        self.link.append(-1)
        return len(self.step) - 1

    def advance(self, state: int, held: int, code: int) -> tuple[int, int]:
        """State and length of the longest suffix of the words so far that occurs in an item."""
        step, link = self.step, self.link
        while state and code not in step[state]:
            state = link[state]
            held = self.length[state]
        following = step[state].get(code)
        return (0, 0) if following is None else (following, held + 1)

    def suffix(self, state: int) -> int:
        """The state of the last `window` words; `state` must hold at least as many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _short_tails(self) -> list[tuple]:
        """Per state, the short items that end its words: (length, items), by suffix links."""
        tails: list[tuple] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            own = self.short_lengths.get(state)
            tails[state] = tails[self.link[state]] + (tuple(own) if own else ())
        return tails

    def scan(self, content: list[bytes]) -> tuple[list[tuple[int, int, int]], set]:
        """Spans of hit words as (first, end, longest match that ends in it), and the items found.

        Spans are in order and apart; words of adjacent or overlapping occurrences join.
        """
        get, window, tails = self.codes.get, self.window, self._tails
        spans: list[list[int]] = []
        items: set = set()
        state = held = 0
        for i, code in enumerate(map(get, content)):
            if code is None:
                state = held = 0
                continue
            state, held = self.advance(state, held, code)
            reach = 0
            if held >= window:
                at = self.suffix(state)
                if at in self.long:
                    items |= self.long[at]
                    reach = window
            if tails[state]:
                for length, found in tails[state]:
                    if length <= held:
                        items |= found
                        reach = max(reach, length)
            if reach:
                first = i + 1 - reach
                longest = held
                while spans and spans[-1][1] >= first:
                    before = spans.pop()
                    first, longest = min(first, before[0]), max(longest, before[2])
                spans.append([first, i + 1, longest])
        return [tuple(s) for s in spans], items


def item_blocks(
    items: DataFrame, scratch: Scratch, window: int, block_words: int
) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most about `block_words` words, so that an automaton's size is bounded.

    A longer item is cut into parts that share window - 1 words, which keeps all its windows. The
    blocks are numbered by running totals per hash bucket of items; one block at a time is read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                content = words(text)
                reach = max(1, block_words - window + 1)
                for start in range(0, max(1, len(content) - window + 1), reach):
                    part = content[start : start + reach + window - 1]
                    if part:
                        out.append((item, b" ".join(part), len(part)))
            ids, parts, sizes = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(parts, pa.binary()), pa.array(sizes, pa.int64())],
                ["item_id", "content", "size"],
            )

    parts = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string"), F.col("text").cast("string")).distinct()
    parts = scratch.keep(parts.mapInArrow(count, "item_id string, content binary, size bigint"))
    total = parts.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // block_words)
    # Twice as many blocks as needed on average, so that uneven ones stay within the bound as well.
    blocks = 2 * blocks if blocks > 1 else 1
    # Without items there is one empty block.
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item_id", "content"), F.lit(blocks)))
    for block in range(blocks):
        yield [(r.item_id, bytes(r.content).split(b" ")) for r in dealt.where(F.col("block") == block).collect()]


FOUND = "doc_id bigint, text_key binary, n_words bigint, spans array<struct<first:bigint,last:bigint,longest:bigint>>, items array<string>"


def overlaps(
    docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = 13, block_words: int = 200_000
) -> DataFrame:
    """Per row of `docs` (doc_id, text): a 128-bit key of the text, its word count, hit spans in words and the items it holds.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Documents are
    streamed word by word through the suffix automaton of the items, which carries the longest
    suffix that any item holds; where it reaches a window, the window's words are hit. Only the
    items are sent to the tasks, in blocks of bounded size. A benchmark of one block needs one
    narrow pass without a shuffle. Each further block takes a pass of its own, of which only the rows with hits are
    written; the hits of a text in all blocks are joined to its rows by its key.

    Null and empty texts have no words. Empty items, and items without an id, match nothing; repeated items count once.
    Every row has a result of its own, also repeated rows and rows with a null or repeated id, whatever the
    number of blocks. Empty tables give no rows, or rows without hits. Other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    body = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").cast("bigint"), body.alias("text"), text_key(body))
    found, more = None, []
    for block in item_blocks(items, scratch, window, block_words):
        shared, key = context.broadcast(block), scratch.path()

        def scan(batches, shared=shared, key=key):
            automaton = sole(key, lambda: ItemAutomaton(shared.value, window))
            for batch in batches:
                out = []
                for text in texts(batch.column(1)):
                    content = words(text)
                    spans, held = automaton.scan(content)
                    out.append((len(content), [dict(zip(SPAN, s, strict=True)) for s in spans], sorted(held)))
                columns = zip(*out, strict=True) if out else ((), (), ())
                kinds = (pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in SPAN])), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "text_key", "n_words", "spans", "items"],
                )

        if found is None:
            found = source.mapInArrow(scan, FOUND)
        else:
            hits = source.mapInArrow(scan, FOUND).where(F.size("items") > 0).select("text_key", "spans", "items")
            more.append(scratch.keep(hits.dropDuplicates(["text_key"])))
    if not more:
        return found
    found = scratch.keep(found)
    first = found.where(F.size("items") > 0).select("text_key", "spans", "items").dropDuplicates(["text_key"])
    every = functools.reduce(DataFrame.unionByName, more, first)
    # A text has one row per block here.
    merged = every.groupBy("text_key").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
    out = found.drop("spans", "items").join(merged, "text_key", "left")
    return out.select(
        "doc_id", "text_key", "n_words", _joined("coalesce(s, array())").alias("spans"),
        F.array_distinct(F.coalesce("i", F.array().cast("array<string>"))).alias("items"),
    )


SPAN = ("first", "last", "longest")


def _joined(spans) -> F.Column:
    """Sort spans and join those that touch."""
    return F.expr(
        f"""aggregate(array_sort({spans}), cast(array() as array<struct<first:bigint,last:bigint,longest:bigint>>),
        (done, s) -> if(size(done) > 0 and element_at(done, -1).last >= s.first,
          concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,
            'last', greatest(element_at(done, -1).last, s.last),
            'longest', greatest(element_at(done, -1).longest, s.longest)))),
          concat(done, array(s))))"""
    )


def judged(found: DataFrame, coverage: float = 0.05) -> DataFrame:
    """Add n_hit and contaminated: hit words reach the share `coverage` of all words, in whole numbers."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    out = found.withColumn("n_hit", hit)
    share = Fraction(str(coverage))
    reaches = share.denominator * F.col("n_hit") >= share.numerator * F.col("n_words")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & reaches)


def clean(docs: DataFrame, items: DataFrame, scratch: Scratch, coverage: float = 0.05, **options) -> DataFrame:
    """The rows and columns of `docs` that are not contaminated, unchanged.

    Only the keys of contaminated texts are joined back, so each row is judged by its own text, whatever its id.
    """
    bad = judged(overlaps(docs, items, scratch, **options), coverage).where("contaminated").select("text_key")
    return _with_key(docs, scratch.keep(bad.distinct()), "left_anti")


def text_key(text: Column) -> Column:
    """A 128-bit key of a text, null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def _with_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Join rows with `text_key` rows by the key of their text."""
    keys = keys.withColumnRenamed("text_key", "_text_key")
    return docs.join(keys, text_key(docs["text"].cast("string")) == keys["_text_key"], how).drop(keys["_text_key"])


def without_spans(docs: DataFrame, judged: DataFrame, longest: int = 50) -> DataFrame:
    """Texts without the spans whose longest match exceeds `longest` words, or any span if the document is contaminated.

    Returns doc_id and text for the documents that have spans. The text between the first and the
    last word of a span goes; what surrounds it stays as it was.
    """
    cuts = judged.where(F.size("spans") > 0).select(
        "text_key",
        F.expr(f"filter(spans, s -> contaminated or s.longest > {int(longest)})").alias("cuts"),
    )
    cuts = cuts.where(F.size("cuts") > 0).dropDuplicates(["text_key"])
    pairs = _with_key(docs.select("doc_id", "text"), cuts, "inner")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cut_words(t, [(s["first"], s["last"]) for s in c]) for t, c in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return pairs.mapInArrow(cut, "doc_id bigint, text string")


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> str:
    """`text` without the bytes from each span's first word to the end of its last."""
    import re

    places = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]]).decode()
