"""The trie of the beginnings that conversations share, by ternary search trees over ranges of conversations."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, numbered
from quayside.operators.joins import skew_join

NONE = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """Sequences of turn ids. A node is a turn after its parent's; `low` and `high` lead to smaller and larger
    turns at its place, `down` to those of the next place. Node 0 is the root, which has no turn.
    """

    def __init__(self, ids: list[list[int]], sizes: list[list[int]], counts: list[int], firsts: list[int]):
        """Of sorted, distinct sequences: the middle one goes in first, then the middles of both halves, so that
        the turns after a node form a balanced search tree.
        """
        self.turn, self.low, self.high, self.down = [-1], [-1], [-1], [-1]
        self.size, self.count, self.first, self.end = [0], [0], [firsts[0]], [-1]
        halves = [(0, len(ids))]
        while halves:
            start, stop = halves.pop()
            if start < stop:
                middle = (start + stop) // 2
                self.end[self._insert(ids[middle], sizes[middle], counts[middle], firsts[middle])] = middle
                halves += [(start, middle), (middle + 1, stop)]

    def _insert(self, ids: list[int], sizes: list[int], count: int, first: int) -> int:
        node, turns, low, high = 0, self.turn, self.low, self.high
        self._pass(0, count, first)
        for turn, size in zip(ids, sizes, strict=True):
            at = self.down[node]
            if at < 0:
                at = self.down[node] = self._new(turn, size, first)
            while (here := turns[at]) != turn:
                links = low if turn < here else high
                if links[at] < 0:
                    links[at] = self._new(turn, size, first)
                at = links[at]
            self._pass(at, count, first)
            node = at
        return node

    def _new(self, turn: int, size: int, first: int) -> int:
        for column, value in (
            (self.turn, turn), (self.low, -1), (self.high, -1), (self.down, -1), (self.size, size), (self.count, 0), (self.first, first), (self.end, -1),
        ):
            column.append(value)
        return len(self.turn) - 1

    def _pass(self, node: int, count: int, first: int) -> None:
        self.count[node] += count
        if first < self.first[node]:
            self.first[node] = first

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, parent, depth) in the order of the sequences, parents first. The root's parent is -1."""
        yield 0, -1, 0
        stack = [(self.down[0], 0, 1, False)]
        while stack:
            node, parent, depth, ready = stack.pop()
            if node < 0:
                continue
            if ready:
                yield node, parent, depth
                stack.append((self.down[node], node, depth + 1, False))
            else:
                stack += [(self.high[node], parent, depth, False), (node, parent, depth, True), (self.low[node], parent, depth, False)]

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a sequence in the tree, from the root."""
        nodes = [0]
        for turn in ids:
            at = self.down[nodes[-1]]
            while self.turn[at] != turn:
                at = self.low[at] if turn < self.turn[at] else self.high[at]
            nodes.append(at)
        return nodes


def prefix_keys(ids: list[int]) -> list[str]:
    """A key for each beginning of a sequence, the empty one first."""
    running, keys = hashlib.sha256(), [NONE]
    for turn in ids:
        running.update(b"%d," % turn)
        keys.append(running.copy().hexdigest())
    return keys


# Nodes of a shard. Those on the path of its first or last sequence may be shared with other shards: they have a
# key and sums that add up over shards. `total` and `distinct` sum bytes over the node's subtree, once per member
# and once per node. The row of a shard's root also holds its outermost sequences.
NODES = (
    "shard int, depth bigint, key string, parent_key string, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, total bigint, distinct bigint, before bigint, on_first boolean, on_last boolean, ends string, "
    "head array<bigint>, tail array<bigint>, head_sizes array<bigint>"
)


def shard_nodes(shard: int, ids: list, sizes: list, counts: list, firsts: list, more: list, ends: list) -> dict[str, list]:
    """Columns of NODES for one range of sorted, distinct sequences."""
    tree = TernaryTree(ids, sizes, counts, firsts)
    order = list(tree.walk())
    n = len(tree.turn)
    children, leaves, total, distinct, parent_of = [0] * n, [0] * n, [0] * n, [0] * n, [-1] * n
    for node, parent, _ in reversed(order):
        if not children[node]:
            leaves[node] = 1
        total[node] += tree.count[node] * tree.size[node]
        distinct[node] += tree.size[node]
        parent_of[node] = parent
        if parent >= 0:
            children[parent] += 1
            leaves[parent] += leaves[node]
            total[parent] += total[node]
            distinct[parent] += distinct[node]
    key, before = {}, {}
    paths = [tree.path(ids[0]), tree.path(ids[-1])]
    for nodes, own in zip(paths, (ids[0], ids[-1]), strict=True):
        so_far = 0
        for node, name in zip(nodes, prefix_keys(own), strict=True):
            key[node], before[node] = name, so_far
            so_far += tree.size[node]
    first, last = set(paths[0]), set(paths[1])
    rows = []
    for node, parent, depth in order:
        end, edge, above = tree.end[node], node in key, parent in key
        rows.append((
            shard, depth, key.get(node), key.get(parent), tree.first[node], tree.first[parent] if parent >= 0 and not above else None,
            tree.count[node], children[node] + (end >= 0 and more[end]), leaves[node], total[node], distinct[node], before.get(node),
            node in first if edge else None, node in last if edge else None, ends[end] if end >= 0 else None,
            *((ids[0], ids[-1], sizes[0]) if node == 0 else (None, None, None)),
        ))
    return dict(zip((c.split()[0] for c in NODES.split(", ")), map(list, zip(*rows, strict=True)), strict=True))


def encoded(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, place, turn_id, size) of every turn with a conv_id: its place from 0, a number for its (role, text)
    from a dictionary of all different ones, and its text's UTF-8 bytes.

    Turns are ordered by `turn`, null first, equal ones by a digest of role and text; repeated rows are turns of their
    own. Null role or text count as empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("size")
    )
    rows = scratch.keep(numbered(scratch, rows, "conv_id", ["turn", "digest"], "place"))
    different = rows.select("digest", "size").distinct().withColumn("one", F.lit(1))
    dictionary = numbered(scratch, different, "one", ["digest"], "turn_id").select("digest", "size", "turn_id")
    # A turn that many conversations share is a hot key.
    out = skew_join(rows.select("conv_id", "place", "digest"), scratch.keep(dictionary), "digest")
    return scratch.keep(out.select("conv_id", "place", "turn_id", "size"))


def trie(rows: DataFrame, lengths: DataFrame, scratch: Scratch, shard_turns: int = 100_000, span: int = 1024) -> DataFrame:
    """One row per node of the trie of conversations.

    `rows` has (conv_id, depth, turn_id, size), with depth from 1 without gaps; `lengths` (conv_id, length) has every
    conversation, also those without a turn. A node is a beginning that conversations share, its members; the root is the
    empty one. conv_id is a node's smallest member, parent_conv_id that of its parent (null at the root), n_convs the
    number of members, n_children of nodes one turn longer, n_leaves of childless nodes in its subtree, itself
    included, saved_tokens the bytes that its subtree's turns need less when each node holds its turn once, and
    ends_sha256 the digest of the members that end there: their ids in decimal, ascending, joined by commas.

    Equal conversations are one sequence with a count. Sequences are dealt by ranges, so that neighbours, which share
    most, meet in a task; it builds a ternary search tree with the medians first and sums it up along an iterative
    traversal. Only nodes on the path of a shard's first or last sequence may occur in other shards. Their sums leave
    out what the shard before has too (the beginning that its last sequence shares with the first one here),
    so adding them up by node merges the shards; no step depends on the depth.

    A conversation is held by a task up to where no other one follows it, found by hashes of its beginnings of
    every `span` turns; what is left of it is a chain of nodes that leave the rows one by one. So only beginnings that
    several conversations share need room. The ids of members that end together are streamed into their digest in one
    task, as SHA-256 needs; nothing is held there. No conversations give no rows.
    """
    unshared = scratch.keep(_cuts(rows, lengths, span))
    parted = scratch.keep(skew_join(rows, unshared, "conv_id", "left"))
    paths = parted.where("cut IS NULL OR depth <= cut").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "turn_id", "size"))).alias("t"), F.first(F.col("cut").isNotNull()).alias("more")
    )
    paths = paths.select("conv_id", "more", F.col("t.turn_id").alias("ids"), F.col("t.size").alias("sizes"))
    empty = F.array().cast("array<bigint>")
    silent = lengths.where("length = 0").select("conv_id", F.lit(False).alias("more"), empty.alias("ids"), empty.alias("sizes"))
    paths = paths.unionByName(silent)
    paths = scratch.keep(paths.withColumn("seq", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)))
    groups = paths.groupBy("seq", "ids", "sizes", "more").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    groups = scratch.keep(groups)
    many = groups.where("n > 1").select("seq")
    lists = list_digests(skew_join(paths.select("seq", "conv_id"), many, "seq"), scratch)
    ends = F.when(F.col("more"), F.lit(None)).when(F.col("n") == 1, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.col("digest"))
    sequences = scratch.keep(groups.join(lists, "seq", "left").select("ids", "sizes", "n", "conv_id", "more", ends.alias("ends")))
    nodes = scratch.keep(_shards(sequences, shard_turns))
    merged = scratch.keep(_merged(nodes))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("key IS NULL").withColumn("saved_tokens", F.col("total") - F.col("distinct"))
    inner = inner.withColumn("ends_sha256", F.coalesce("ends", F.lit(NONE)))
    # Children of a merged node, of which one may have most nodes: dealt by shard as well.
    of = nodes.where("key IS NOT NULL").select("shard", "key").join(merged.select("key", F.col("conv_id").alias("c")), "key")
    below = inner.where("parent_key IS NOT NULL").join(of.withColumnRenamed("key", "parent_key"), ["shard", "parent_key"])
    below = below.withColumn("parent_conv_id", F.col("c"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    edge = merged.join(parents, "parent_key", "left")
    rest = parted.where("depth > cut")
    last = F.col("depth") == F.col("length")
    one = F.lit(1).cast("bigint")
    chain = rest.select(
        "conv_id", F.col("depth").cast("bigint"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NONE).alias("ends_sha256"),
    )
    parts = [inner.where("parent_key IS NULL"), below, edge, chain]
    return parts[0].select(*out).union(parts[1].select(*out)).union(parts[2].select(*out)).union(parts[3].select(*out))


def _cuts(rows: DataFrame, lengths: DataFrame, span: int) -> DataFrame:
    """(conv_id, length, cut) of the long conversations that no other one follows beyond their first `cut` turns.

    A beginning is known by the combined hash of its turns. Different ones with equal hashes would only move a cut further.
    """
    long = lengths.where(F.col("length") > span)
    own = skew_join(rows.select("conv_id", "depth", "turn_id"), long.select("conv_id"), "conv_id")
    parts = own.groupBy("conv_id", F.floor((F.col("depth") - 1) / span).alias("part")).agg(
        F.bit_xor(F.xxhash64("depth", "turn_id")).alias("x"), F.count(F.lit(1)).alias("n")
    )
    # A row per `span` turns, of which the window streams.
    so_far = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("x", F.bit_xor("x").over(so_far)).where(F.col("n") == span).select("conv_id", "part", "x")
    common = parts.groupBy("part", "x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part", "x")
    shared = parts.join(common, ["part", "x"]).groupBy("conv_id").agg(F.max("part").alias("part"))
    cut = (F.coalesce("part", F.lit(-1)) + 2) * span
    return long.join(shared, "conv_id", "left").select("conv_id", "length", cut.alias("cut")).where("cut < length")


def list_digests(members: DataFrame, scratch: Scratch, chunk: int = 1 << 16) -> DataFrame:
    """(seq, digest): SHA-256 of the conv_ids of each seq in decimal, ascending and joined by commas.

    Ranges of (seq, conv_id) are joined to chunks in many tasks; the chunks of a seq then pass one task in order.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, first, held, size = None, None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["seq", "first", "chunk"])

        for batch in batches:
            for s, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (s != seq or size > chunk):
                    yield out()
                    held, size = [], 0
                if not held:
                    seq, first = s, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, running = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([running.hexdigest()])], ["seq", "digest"])

        for batch in batches:
            for s, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if s == seq:
                    running.update(b",")
                else:
                    if running:
                        yield out()
                    seq, running = s, hashlib.sha256()
                running.update(text.encode())
        if running:
            yield out()

    dealt = scratch.keep(members).repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    chunks = scratch.keep(dealt.mapInArrow(join, "seq string, first bigint, chunk string"))
    return scratch.keep(chunks.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(digest, "seq string, digest string"))


def _shards(sequences: DataFrame, shard_turns: int) -> DataFrame:
    """NODES of every range of the sequences."""
    turns = sequences.agg(F.sum(F.size("ids") + 1).alias("n")).first().n or 0
    dealt = sequences.repartitionByRange(max(1, math.ceil(turns / shard_turns)), "ids").sortWithinPartitions("ids")
    dealt = dealt.select("ids", "sizes", "n", "conv_id", "more", "ends", F.spark_partition_id().alias("shard"))
    names = [c.split()[0] for c in NODES.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], [], []]
        shard = None
        for batch in batches:
            for column, values in zip(held, batch.columns, strict=False):
                column += values.to_pylist()
            if batch.num_rows:
                shard = batch.column(6)[0].as_py()
        if shard is not None:
            found = shard_nodes(shard, *held)
            at = pa.table({c: pa.array(found[c], ARROW[c]) for c in names})
            yield from at.to_batches(max_chunksize=20_000)

    return dealt.mapInArrow(build, NODES)


ARROW = {"shard": pa.int32(), "on_first": pa.bool_(), "on_last": pa.bool_(), "key": pa.string(), "parent_key": pa.string(), "ends": pa.string()}
ARROW |= {c: pa.list_(pa.int64()) for c in ("head", "tail", "head_sizes")}
ARROW |= {c.split()[0]: pa.int64() for c in NODES.split(", ") if c.endswith(" bigint")}


def common_length(a: Column, b: Column) -> Column:
    """Number of equal values that two arrays begin with; -1 where one is null."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))

    def step(so_far: Column, equal: Column) -> Column:
        on = so_far["on"] & equal
        return F.struct((so_far["n"] + on.cast("int")).alias("n"), on.alias("on"))

    return F.coalesce(F.aggregate(same, start, step, lambda s: s["n"]), F.lit(-1))


def _merged(nodes: DataFrame) -> DataFrame:
    """The nodes that several shards may have, each once."""
    shared = nodes.where("key IS NOT NULL")
    # A row per shard.
    row = Window.orderBy("shard")
    edges = shared.where("depth = 0").select(
        "shard",
        "head_sizes",
        common_length(F.lag("tail").over(row), F.col("head")).alias("common"),
        (common_length(F.lead("head").over(row), F.col("tail")) == F.size("tail")).alias("goes_on"),
    )
    bytes_ = F.aggregate(F.slice("head_sizes", 1, F.greatest("common", F.lit(0))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    edges = edges.select("shard", "common", "goes_on", bytes_.alias("common_bytes"))
    own = shared.join(edges, "shard")
    also = F.col("on_first") & (F.col("depth") <= F.col("common"))  # in the shard before as well
    n = lambda condition: F.coalesce(condition, F.lit(False)).cast("bigint")
    own = own.withColumns({
        "distinct": F.col("distinct") - F.when(also, F.col("common_bytes") - F.col("before")).otherwise(0),
        "n_children": F.col("n_children") - n(F.col("on_first") & (F.col("depth") < F.col("common"))),
        "n_leaves": F.col("n_leaves") - n(F.col("on_last") & F.col("goes_on")),
    })
    sums = own.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "total", "distinct")], F.max("ends").alias("ends"),
    )
    return sums.withColumn("saved_tokens", F.col("total") - F.col("distinct")).withColumn("ends_sha256", F.coalesce("ends", F.lit(NONE)))


def borrowed(turns: DataFrame, scratch: Scratch, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others, from the `encoded` turns: rows and lengths as `trie` takes them.

    Conversation c begins with the first h turns of c - c % `every` (all if it has fewer, none if it is absent), then come its own
    after its first h; h is the CRC-32 of c in decimal modulo `most`. c % `every` takes the sign of c.
    """
    c = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("m"))
    convs = convs.select("conv_id", "m", (F.crc32(c.cast("string").cast("binary")) % most).alias("h"), (c - c % every).alias("base"))
    convs = scratch.keep(convs)
    lent = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("m").alias("given")), "base", "left")
    front = F.least("h", F.coalesce("given", F.lit(0)))
    plain = F.col("base") == c  # begins with its own turns
    convs = lent.select("conv_id", "base", "h", plain.alias("plain"), front.alias("front"), F.when(plain, F.col("m")).otherwise(front + F.greatest(F.col("m") - F.col("h"), F.lit(0))).alias("length"))
    convs = scratch.keep(convs)
    own = skew_join(turns, convs.select("conv_id", "h", "plain", "front"), "conv_id").where("plain OR place >= h")
    own = own.select("conv_id", F.when(F.col("plain"), F.col("place")).otherwise(F.col("place") - F.col("h") + F.col("front")).alias("p"), "turn_id", "size")
    # At most `most` turns of a conversation go to at most `every` others.
    heads = turns.where(F.col("place") < most - 1).withColumnRenamed("conv_id", "base")
    taken = heads.join(convs.where("NOT plain AND front > 0").select("base", "conv_id", "front"), "base").where("place < front")
    rows = own.union(taken.select("conv_id", F.col("place").alias("p"), "turn_id", "size"))
    rows = scratch.keep(rows.select("conv_id", (F.col("p") + 1).cast("bigint").alias("depth"), "turn_id", "size"))
    return rows, convs.select("conv_id", "length")
