"""Set similarity join of documents on word n-grams, by MinHash banding and full verification."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import FOLD, Scratch, components, mix, numbered, sole, texts
from quayside.operators.joins import skew_join


def choose_bands(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """Bands and rows per band so that a pair at `threshold` shares a band with probability `recall`.

    Of all choices within `most_hashes` hash functions, the one with the most rows per band, which
    lets the fewest less similar pairs through.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        agree = threshold**rows
        bands = 1 if agree >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-agree)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding within most_hashes reaches the recall")
    return best


SLICE = 1 << 20


@functools.cache
def position_keys(size: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 64-bit hash of each word (see `common.words`), as sums of bytes times keys of their place in the word."""
    if not text:
        return np.empty(0, np.uint64)
    folded, out, at = text.translate(FOLD), [], 0
    while at < len(folded):  # slices that end between words keep the arrays small
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        inside = np.frombuffer(folded[at:end], np.uint8)
        held = inside != 32
        edges = np.flatnonzero(np.diff(held, prepend=False, append=False))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        at = end
        if not len(starts):
            continue
        chars = np.flatnonzero(held)
        place = chars - np.repeat(starts, sizes)
        keys = position_keys(1 << int(sizes.max() - 1).bit_length())
        sums = np.add.reduceat(keys[place] * inside[chars], np.cumsum(sizes) - sizes)
        out.append(mix(sums + sizes.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `n` words; fewer words, but not none, are one run."""
    sole("n-grams", lambda: None)
    h = word_hashes(text)
    if not len(h):
        return h
    width = min(n, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(total)])
    return np.unique(total)


@functools.cache
def hash_parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:count].astype(np.uint32), (seeds[count:] | np.uint64(1)).astype(np.uint32)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature of a set that is not empty."""
    salts, factors = hash_parameters(bands * rows)
    low = (grams >> np.uint64(20)).astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):  # keeps the products within the cache
        block = (low[at : at + 2048, None] ^ salts) * factors
        np.minimum(least, (block ^ (block >> np.uint32(15))).min(axis=0), out=least)
    total = np.arange(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + column)
    return total


SIGNED = "doc_id bigint, text_hash bigint, fp binary, size bigint, bands array<bigint>"
LINKS = "rep bigint, links bigint, root bigint"


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per row: a hash of the text, a 128-bit fingerprint of its n-gram set, the set's size and its band hashes.

    Texts without words have a null fingerprint.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes, hashes = [], [], []
            for text in texts(batch.column(1)):
                grams = shingles(text, n)
                sizes.append(len(grams))
                prints.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                hashes.append(band_hashes(grams, bands, rows).view(np.int64) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(prints, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "fp", "size", "bands"],
            )

    body = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), body, F.xxhash64(body)).mapInArrow(sign, SIGNED)


def similar(sets: list[np.ndarray], wanted: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the `wanted` pairs (a symmetric boolean matrix) have Jaccard similarity >= threshold.

    Shared members of rare n-grams are counted pair by pair, those of frequent ones by products of
    0/1 matrices over slices of n-grams, so that neither many rows nor many n-grams need much memory.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    counts = np.diff(np.r_[starts, len(grams)])
    shared = np.zeros((n, n), np.float32)
    rare = max(2, n // 64)
    for size in np.unique(counts):
        if size < 2 or size > rare:
            continue
        at = starts[counts == size]
        for first in range(0, len(at), max(1, 1_000_000 // int(size) ** 2)):
            lists = owner[at[first : first + max(1, 1_000_000 // int(size) ** 2), None] + np.arange(size)]
            pairs = (lists[:, :, None].astype(np.int64) * n + lists[:, None, :]).ravel()
            shared += np.bincount(pairs, minlength=n * n).reshape(n, n).astype(np.float32)
    common = np.flatnonzero(counts > rare)
    for first in range(0, len(common), 1024):
        part = common[first : first + 1024]
        held = np.zeros((n, len(part)), np.float32)
        for k, c in enumerate(part):
            held[owner[starts[c] : starts[c] + counts[c]], k] = 1
        shared += held @ held.T
    union = sizes[:, None] + sizes[None, :] - shared
    found = wanted & (shared >= threshold * union - 1e-6)
    np.fill_diagonal(found, False)
    return found


def linked(
    docs: DataFrame,
    scratch: Scratch,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    capacity: int = 1_000_000,
    unit_rows: int = 1000,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, copy_id, n_links, class_id, size (distinct n-grams).

    copy_id is the smallest doc_id with the same n-gram set. n_links counts the other documents at
    Jaccard similarity >= `threshold`, copies included. class_id is the smallest doc_id reachable by
    links.

    Documents with equal sets are one representative. Band hashes of representatives are shuffled;
    members of a bucket are linked to its smallest one and the components of those candidate links
    are found. A component whose sets hold at most `capacity` n-grams, or whose buckets have more pairs than it has itself, is
    compared as a whole, each pair once; of others each bucket is. A unit over the capacity, or of more than `unit_rows` members, is dealt into blocks, and
    each pair of blocks is a task of its own, so no task's memory, which grows with its n-grams and the square
    of its members, grows with the group and no pair is missed. In a task, pairs
    that share a band (and, for buckets, no earlier band) are verified on their full sets; counts of
    links and a spanning forest leave the task, never the pairs. The sets are computed anew from the
    texts of candidates, so they are neither written nor shuffled for documents without one.

    Null and empty texts, and texts without words: no links, a class of their own. Fewer than `n`
    words: the whole text is one n-gram. Repeated rows count as one document; a doc_id with different texts is a
    document for each set of n-grams, and its rows are linked and named each by their own text. A null doc_id has
    null results. An empty table gives no rows. Other columns are ignored.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = scratch.keep(signatures(docs, n, bands, rows))
    valid = signed.where("doc_id IS NOT NULL AND fp IS NOT NULL")
    reps = valid.groupBy("fp").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("source"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    reps = scratch.keep(reps.select("fp", "source.doc_id", "source.text_hash", "size", "bands"))
    # One doc_id may represent several sets, so these are numbered; the smallest number has the smallest doc_id.
    numbers = numbered(scratch, reps.select("fp", "doc_id", F.lit(1).alias("one")), "one", ["doc_id", "fp"], "rep")
    reps = scratch.keep(reps.join(numbers.select("fp", "rep"), "fp"))
    # Repeated rows have one doc_id; counting ids needs no list of them.
    distinct = valid.groupBy("fp", "doc_id").agg(F.lit(1).alias("one")).groupBy("fp").agg(F.count("one").alias("copies"))
    copies = scratch.keep(distinct.where("copies > 1"))
    rows_of = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    buckets = rows_of.groupBy("band", "hash").agg(F.count("rep").alias("members"), F.min("rep").alias("least"))
    buckets = scratch.keep(buckets.where("members > 1"))
    member_of = scratch.keep(rows_of.join(buckets, ["band", "hash"]).select("rep", "band", "hash", "least"))
    candidate = scratch.keep(components(scratch, member_of.select(F.col("rep").alias("a"), F.col("least").alias("b"))))

    named = member_of.select("rep").distinct().join(candidate, F.col("rep") == F.col("node"), "left")
    named = named.select("rep", F.coalesce("component", "rep").alias("component"))
    named = scratch.keep(named.join(reps.select("rep", "fp", "size"), "rep").join(copies, "fp", "left"))
    # Comparing a component's buckets one by one costs the sum of their squares; near copies share most bands, and then
    # comparing the component as a whole, each pair once, costs less.
    squares = buckets.select(F.col("least").alias("rep"), F.pow("members", F.lit(2)).alias("square")).join(named.select("rep", "component"), "rep")
    squares = squares.groupBy("component").agg(F.sum("square").alias("squares"))
    weight = named.groupBy("component").agg(F.sum("size").alias("weight"), F.count("rep").alias("rows"))
    weight = weight.join(squares, "component", "left")
    at_once = (F.col("weight") <= capacity) | (F.pow("rows", F.lit(2)) <= F.coalesce("squares", F.lit(0.0)))
    weight = scratch.keep(weight.select("component", at_once.alias("at_once")))
    # A component may hold most candidates.
    placed = skew_join(named, weight, "component")
    whole = placed.where("at_once").select(
        "rep", "size", "copies", F.lit(-1).alias("band"), F.col("component").alias("unit")
    )
    parts = placed.where("NOT at_once").select("rep", "size", "copies")
    parts = parts.join(member_of, "rep").select("rep", "size", "copies", "band", F.col("hash").alias("unit"))
    members = scratch.keep(whole.unionByName(parts))
    # A unit's n-grams and members decide its blocks.
    heavy = members.groupBy("band", "unit").agg(F.sum("size").alias("weight"), F.count("rep").alias("rows"))
    share = F.greatest(F.col("weight") / capacity, F.col("rows") / unit_rows)
    heavy = heavy.select("band", "unit", F.ceil(share).cast("int").alias("blocks"))
    heavy = scratch.keep(heavy.where("blocks > 1"))
    members = members.join(heavy, ["band", "unit"], "left")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = members.withColumn("block", F.coalesce(own, F.lit(0)))
    others = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    members = members.withColumn("other", others)
    members = members.select(
        "rep",
        F.coalesce("copies", F.lit(1)).alias("copies"),
        "band",
        "unit",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    body = F.col("text").cast("string")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    wanted = reps.join(named.select("rep"), "rep", "left_semi").select("rep", "doc_id", "text_hash")
    chosen = chosen.join(wanted, ["doc_id", "text_hash"]).groupBy("rep").agg(F.min("body").alias("body"))
    sets = scratch.keep(_sets(chosen, n, bands, rows))
    units = members.join(sets, "rep").groupBy("band", "unit", "low", "high")

    def links_of(unit: pd.DataFrame) -> pd.DataFrame:
        return _links_of(unit, threshold)

    found = scratch.keep(units.applyInPandas(links_of, LINKS))

    joined = components(scratch, found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = scratch.keep(
        named.select("rep", "fp")
        .join(copies, "fp", "full")
        .join(reps.select("fp", F.col("rep").alias("first"), F.col("doc_id").alias("copy_id")), "fp")
        .join(counts, F.col("first") == counts["rep"], "left")
        .join(joined, F.col("first") == F.col("node"), "left")
        .select(
            "fp",
            "copy_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
            F.coalesce("component", "first").alias("class"),
        )
        .join(reps.select(F.col("rep").alias("class"), F.col("doc_id").alias("class_id")), "class")
        .drop("class")
    )
    known = F.col("doc_id").isNotNull()
    return signed.select("doc_id", "text_hash", "fp", "size").join(classes, "fp", "left").select(
        "doc_id",
        "text_hash",
        F.when(known, F.coalesce("copy_id", "doc_id")).alias("copy_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
        F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
        "size",
    )


def _sets(chosen: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, hashes = [], []
            for text in texts(batch.column(1)):
                found = shingles(text, n)
                grams.append(found.tobytes())
                hashes.append(band_hashes(found, bands, rows).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grams, pa.binary()), pa.array(hashes, pa.binary())],
                ["rep", "grams", "hashes"],
            )

    return chosen.mapInArrow(build, "rep bigint, grams binary, hashes binary")


def _links_of(unit: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of each member inside one unit or pair of blocks, and a root of its linked members."""
    unit = unit.sort_values("rep", ignore_index=True)
    n, band = len(unit), int(unit["band"].iloc[0])
    reps = unit["rep"].to_numpy(np.int64)
    hashes = np.stack([np.frombuffer(h, np.uint64) for h in unit["hashes"]])
    block = unit["block"].to_numpy()
    if unit["low"].iloc[0] != unit["high"].iloc[0]:
        wanted = block[:, None] != block[None, :]  # pairs within a block have a task of their own
    else:
        wanted = np.ones((n, n), bool)
    shares = np.zeros((n, n), bool)
    for k in range(hashes.shape[1] if band < 0 else band):
        shares |= hashes[:, k, None] == hashes[None, :, k]
    wanted &= shares if band < 0 else ~shares
    sets = [np.frombuffer(g, np.uint64) for g in unit["grams"]]
    found = similar(sets, wanted, threshold)
    links = found @ unit["copies"].to_numpy(np.int64)
    root = np.arange(n)
    while True:  # smallest label among neighbours, then of that label's holder
        least = np.where(found, root[None, :], n).min(axis=1, initial=n)
        following = np.minimum(root, least)
        following = following[following]
        if (following == root).all():
            break
        root = following
    held = links > 0
    return pd.DataFrame({"rep": reps[held], "links": links[held].astype(np.int64), "root": reps[root][held]})


def one_of_each(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of `docs`, all columns, of the smallest doc_id of each class; null ids stay.

    Of a doc_id with different texts only the rows whose own text is a copy go.
    """
    gone = linked(docs, scratch, **options).where("doc_id <> class_id").select("doc_id", "text_hash").distinct()
    gone = scratch.keep(gone.withColumnsRenamed({"doc_id": "_gone", "text_hash": "_hash"}))
    own = (F.col("doc_id").cast("bigint") == F.col("_gone")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    return docs.join(gone, own, "left_anti")
