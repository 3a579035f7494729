"""Near copies among vectors by a robust-pruned flat graph over overlapping shards."""

from __future__ import annotations

import functools
import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, components, numbered
from quayside.operators.joins import skew_join

log = logging.getLogger(__name__)


def unit_rows(values: list) -> np.ndarray:
    """Rows of equal length, scaled to length 1 in double precision."""
    x = np.array(values, np.float64)
    return x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)


def robust_prune(near: np.ndarray, sims: np.ndarray, vectors: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours to keep of `near`, nearest first (similarities `sims`).

    The nearest is kept and drops every other that it is nearer to, by the factor `alpha`, than the point is;
    then the next. What remains points into different directions. Distances are angles' chords.
    """
    gap = np.maximum(0, 2 - 2 * sims)
    among = np.maximum(0, 2 - 2 * (vectors[near] @ vectors[near].T))
    alive, kept = np.ones(len(near), bool), []
    for k in range(len(near)):
        if alive[k]:
            kept.append(k)
            if len(kept) == degree:
                break
            alive &= alpha**2 * among[k] > gap
    return near[kept]


def shard_graph(vectors: np.ndarray, degree: int, pool: int, alpha: float) -> np.ndarray:
    """Adjacency (n x n booleans) of one shard's robust-pruned graph, with reversed edges.

    Each point's candidates are its `pool` nearest in the shard and a few at random, which keep
    far parts of the shard connected.
    """
    n = len(vectors)
    adjacent = np.zeros((n, n), bool)
    if n < 2:
        return adjacent
    rng = np.random.default_rng(n)
    pool = min(pool, n - 1)
    for at in range(0, n, 512):
        sims = vectors[at : at + 512] @ vectors.T
        sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
        nearest = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        for i, near in enumerate(nearest):
            far = rng.integers(0, n, 4)
            near = np.unique(np.concatenate([near, far[far != at + i]]))
            near = near[np.argsort(-sims[i, near], kind="stable")]
            adjacent[at + i, robust_prune(near, sims[i, near], vectors, degree, alpha)] = True
    return adjacent | adjacent.T


def search(
    vectors: np.ndarray, neighbours: list[np.ndarray], queries: np.ndarray, entries: list[np.ndarray], beam: int, threshold: float, slack: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: the points within `threshold` that a range-expanding greedy search reaches, with similarities.

    From its entries the search moves along the graph and always expands its best point not yet
    expanded, while that is among the `beam` best. Whatever comes within `slack` of the threshold is expanded
    as well, so the range grows until no neighbour of a point in it is new.
    """
    seen = np.zeros(len(vectors), bool)
    for number, query in enumerate(queries):
        seen[:] = False
        found = np.unique(entries[number])
        seen[found] = True
        sims = vectors[found] @ query
        fresh = np.ones(len(found), bool)
        while True:
            best = np.argsort(-sims, kind="stable")[:beam]
            expand = fresh & (sims >= threshold - slack)
            if not expand.any():  # not yet, or no longer, in range: the best beam points lead
                lead = best[fresh[best]][:4]
                if not len(lead):
                    break
                expand[lead] = True
            fresh &= ~expand
            following = np.concatenate([neighbours[p] for p in found[expand]])
            following = np.unique(following[~seen[following]])
            if len(following):
                seen[following] = True
                found = np.concatenate([found, following])
                sims = np.concatenate([sims, vectors[following] @ query])
                fresh = np.concatenate([fresh, np.ones(len(following), bool)])
        hit = sims >= threshold
        yield number, found[hit], sims[hit]


# Rows that are compared with all centroids at a time.
SLICE = 512


def _sampled(points: DataFrame, purpose: str, rows: int) -> DataFrame:
    """(rep, vector) of about `rows` points, taken by a hash; the share is compared in double precision, so never cut to none."""
    place = F.pmod(F.xxhash64("rep", F.lit(purpose)), F.lit(1 << 53)).cast("double")
    return points.where(place < min(1.0, rows / max(1, points.count())) * 2.0**53).select("rep", "vector")


def centroids(vectors: DataFrame, count: int, sample_rows: int, steps: int = 6) -> np.ndarray:
    """`count` directions by spherical k-means on at most about `sample_rows` rows taken by a hash of the id."""
    rows = _sampled(vectors, "fit", sample_rows).toArrow().sort_by("rep")["vector"].to_pylist()
    if not rows:
        return np.zeros((0, 0))
    x = unit_rows(rows)
    rng = np.random.default_rng(11)
    c = x[rng.choice(len(x), min(count, len(x)), replace=False)]
    for _ in range(steps):
        nearest = np.concatenate([np.argmax(x[at : at + SLICE] @ c.T, axis=1) for at in range(0, len(x), SLICE)])
        moved = np.zeros_like(c)
        np.add.at(moved, nearest, x)
        norms = np.linalg.norm(moved, axis=1)
        held = norms > 1e-12
        c[held] = moved[held] / norms[held, None]
    return c


ASSIGNED = "rep bigint, vector array<double>, copies bigint, shards array<int>"
FOUND = "rep bigint, links bigint, root bigint, doors array<struct<shard:bigint,entry:bigint>>"


def linked(
    embeddings: DataFrame,
    scratch: Scratch,
    threshold: float = 0.9,
    overlap: int = 3,
    shard_rows: int = 1500,
    degree: int = 24,
    pool: int = 64,
    alpha: float = 1.2,
    beam: int = 24,
    slack: float = 0.05,
    sample_rows: int = 20_000,
    least_recall: float = 0.95,
    audit_rows: int = 400,
) -> DataFrame:
    """One row per row of `embeddings` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other vectors at cosine >= `threshold` (in double precision, equal vectors
    included), component_id is the smallest vec_id reachable by links, kept marks it.

    Equal vectors are one point. Points go to the shards of their `overlap` nearest centroids; the
    centroids are fitted on a bounded sample, everything else covers all rows. A shard beyond
    twice `shard_rows` is dealt into blocks, each pair of blocks is a shard of its own, so every pair of
    its points still meets. Each shard's graph is built alone by robust pruning; a point's adjacency
    lists from its shards are united. Every point is a query in its own shards, from each shard's medoid.
    Points found within range that also lie in shards the query has not been to are doors: the query
    goes on there from them, round by round, until no door is new; a shard's many guests are shared out to several tasks. A pair is counted in the first shard that the
    query meets it in, by rounds and then by number, so counts, doors and a spanning forest of all links met leave
    a task, but no pairs. Links are exact: each is verified by its cosine.

    The result is audited: about `audit_rows` points are turned by an angle within the threshold and sent through the same
    search; the links they find are held against brute force over all points, so something is measured
    however few links there are. Under `least_recall` all is done again with more overlap and a wider beam, twice; then every
    pair of blocks of the table is compared by brute force, which is exact.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
    vectors of other lengths with each other. Repeated rows are one vector; a vec_id with several vectors counts and
    links as one more for each, and each of its rows has the results of its own vector. A null vec_id has a null
    component. An empty table gives no rows. Other columns are ignored.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("vector")
    )
    # Exact equality would part -0.0 from 0.0.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    fine = F.col("vec_id").isNotNull() & (F.size("vector") > 0)
    fine &= F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine &= F.exists("vector", lambda x: x != 0)
    valid = rows.where(F.coalesce(fine, F.lit(False))).distinct()
    points = valid.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("vec_id").alias("copies"))
    # One vec_id may come first in several points, so these are numbered; the smallest number has the smallest vec_id.
    points = numbered(scratch, points.withColumn("one", F.lit(1)), "one", ["first", "vector"], "rep")
    points = scratch.keep(points.select("rep", "first", "vector", "copies"))
    sizes = [r.n for r in points.groupBy(F.size("vector").alias("n")).count().orderBy("n").collect()]
    found = edges = None
    for size in sizes:  # one embedding model gives one length; others are graphs of their own
        part = points.where(F.size("vector") == size)
        more, wider = overlap, beam
        for attempt in range(4):
            exact = attempt == 3
            graph = _Graph(part, scratch, size, threshold, more, shard_rows, degree, pool, alpha, wider, slack, sample_rows, exact)
            recall = 1.0 if exact else audit(part, graph, scratch, threshold, audit_rows)
            log.info("vectors of length %d: recall %.4f with overlap %d", size, recall, more)
            if recall >= least_recall:
                break
            more, wider = 2 * more, 2 * wider
        links, forest = graph.links()
        found = links if found is None else found.unionByName(links)
        edges = forest if edges is None else edges.unionByName(forest)
    if found is None:
        empty = F.lit(None).cast("bigint")
        found = points.select("rep", empty.alias("links")).where("false")
        edges = points.select(F.col("rep").alias("a"), empty.alias("b")).where("false")
    joined = components(scratch, edges)
    per = points.join(found.select("rep", "links"), "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    per = per.withColumn("component", F.coalesce("component", "rep"))
    smallest = points.select(F.col("rep").alias("component"), F.col("first").alias("component_id"))
    per = scratch.keep(
        per.join(smallest, "component").select(
            "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        )
    )
    # A vector that many rows have is a hot key.
    out = skew_join(rows, per, "vector", "left")
    known = F.col("vec_id").isNotNull()
    out = out.select(
        "vec_id",
        F.when(known, F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
        F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


# A shard's number is its centroid and two blocks; the parts never overlap.
BLOCK_BITS = 24


class _Graph:
    """The united graph of all shards of `points` (rep, vector, copies), and searches in it."""

    def __init__(
        self, points: DataFrame, scratch: Scratch, size: int, threshold: float, overlap: int, shard_rows: int,
        degree: int, pool: int, alpha: float, beam: int, slack: float, sample_rows: int, exact: bool,
    ):
        self.scratch, self.overlap, self.guests = scratch, overlap, 4 * shard_rows
        self.step = functools.partial(_visit, threshold=threshold, beam=0 if exact else beam, slack=slack)
        spark = points.sparkSession
        # More shards than that are not told apart by a bounded sample; crowded ones are dealt into blocks.
        count = 1 if exact else min(max(1, math.ceil(points.count() * overlap / shard_rows)), 16_384)
        self.shared = spark.sparkContext.broadcast(centroids(points, count, sample_rows))
        assigned = scratch.keep(self._assign(points.select("rep", "vector", "copies")))
        crowd = assigned.select(F.explode("shards").alias("shard")).groupBy("shard").count()
        crowded = crowd.where(F.col("count") > 2 * shard_rows).collect()
        blocks = {r.shard: math.ceil(r["count"] / shard_rows) for r in crowded}
        if any(n >= 1 << BLOCK_BITS for n in blocks.values()):
            raise ValueError(f"a shard needs {max(blocks.values())} blocks; raise shard_rows")
        self.many = F.create_map(*[F.lit(v) for pair in blocks.items() for v in pair]) if blocks else None
        self.placed = scratch.keep(self._place(assigned))
        members = self.placed.withColumn("shard", F.explode("places"))

        def build(shard: pd.DataFrame) -> pd.DataFrame:
            shard = shard.sort_values("rep", ignore_index=True)
            adjacent = shard_graph(np.stack(shard["vector"].to_numpy()), degree, pool, alpha)
            reps = shard["rep"].to_numpy()
            return pd.DataFrame({"rep": reps, "near": [reps[np.flatnonzero(row)].tolist() for row in adjacent]})

        if exact:
            self.graph = scratch.keep(members.withColumn("near", F.array().cast("array<bigint>")))
            return
        lists = members.select("rep", "vector", "shard").groupBy("shard").applyInPandas(build, "rep bigint, near array<bigint>")
        # The union of a point's lists is bounded by its shards and the reversed edges of each.
        lists = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        joined = members.join(scratch.keep(lists), "rep")
        self.graph = scratch.keep(joined.select("shard", "rep", "vector", "copies", "places", "near"))

    def _assign(self, points: DataFrame) -> DataFrame:
        shared, overlap = self.shared, self.overlap

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    x = unit_rows(part.column(1).to_pylist())
                    near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, : min(overlap, len(c))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            pa.array(list(x), pa.list_(pa.float64())),
                            part.column(2),
                            pa.array(np.sort(near, axis=1).astype(np.int32).tolist(), pa.list_(pa.int32())),
                        ],
                        ["rep", "vector", "copies", "shards"],
                    )

        return points.mapInArrow(assign, ASSIGNED)

    def _place(self, assigned: DataFrame) -> DataFrame:
        """`places`: the numbers of the shards, and of pairs of blocks of crowded ones, that a point is in."""

        def numbers(shard):
            whole = F.shiftleft(shard.cast("bigint"), 2 * BLOCK_BITS)
            if self.many is None:
                return F.array(whole)
            n = F.coalesce(self.many[shard], F.lit(1))
            own = F.pmod(F.xxhash64("rep", shard), n)
            pair = lambda o: F.shiftleft(F.least(own, o.cast("bigint")), BLOCK_BITS) + F.greatest(own, o.cast("bigint"))
            return F.transform(F.sequence(F.lit(0), n - 1), lambda o: whole + pair(o))

        places = F.array_sort(F.flatten(F.transform("shards", numbers)))
        return assigned.withColumn("places", places).drop("shards")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(rep, links) of the points with links to other points, and edges (a, b) that join what these links join."""
        found = self._search(self.placed)
        edges = found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
        return self.scratch.keep(found.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))), edges

    def links_of(self, queries: DataFrame) -> DataFrame:
        """(rep, links) of other vectors (rep, vector), whose reps are no point's."""
        placed = self.scratch.keep(self._place(self._assign(queries.withColumn("copies", F.lit(1).cast("bigint")))))
        return self._search(placed).where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))

    def _search(self, placed: DataFrame) -> DataFrame:
        """FOUND without doors, of all rounds."""
        none = F.array().cast("array<bigint>")
        visit = placed.select(
            F.explode("places").alias("shard"), "rep", "vector", none.alias("before"), F.col("places").alias("now"), none.alias("entries")
        )
        rounds, step, scratch = [], self.step, self.scratch
        while True:

            def go(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
                return step(shard, queries)

            # Members are few per shard, guests are not: a shard with many is searched in several tasks.
            parts = visit.groupBy("shard").agg(F.ceil(F.count("rep") / self.guests).cast("int").alias("parts")).where("parts > 1")
            parts = scratch.keep(parts)
            visit = visit.join(parts, "shard", "left").withColumn("part", F.pmod(F.hash("rep"), F.coalesce("parts", F.lit(1)))).drop("parts")
            graph = self.graph.join(parts, "shard", "left")
            graph = graph.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
            met = visit.groupBy("shard", "part").cogroup(graph.groupBy("shard", "part")).applyInPandas(go, FOUND)
            met = scratch.keep(met)
            rounds.append(met.select("rep", "links", "root"))
            been = visit.groupBy("rep").agg(F.first(F.concat("before", "now")).alias("before"))
            doors = met.where(F.size("doors") > 0).select("rep", F.explode("doors").alias("door"))
            doors = doors.groupBy("rep", F.col("door.shard").alias("shard")).agg(F.collect_set("door.entry").alias("entries"))
            doors = doors.join(been, "rep").where(~F.array_contains("before", F.col("shard")))
            now = doors.groupBy("rep").agg(F.sort_array(F.collect_set("shard")).alias("now"))
            following = doors.join(now, "rep").join(placed.select("rep", "vector"), "rep")
            visit = scratch.keep(following.select("shard", "rep", "vector", "before", "now", "entries"))
            if visit.isEmpty():
                break
        return functools.reduce(DataFrame.unionByName, rounds)


def _visit(shard: pd.DataFrame, queries: pd.DataFrame, threshold: float, beam: int, slack: float) -> pd.DataFrame:
    """Search one shard for its queries; see `linked` for which pairs count here.

    A row with links is a query and its own root; the others are the edges of the forest.
    """
    empty = pd.DataFrame({"rep": [], "links": [], "root": [], "doors": []}, dtype=object)
    if not len(queries) or not len(shard):
        return empty
    shard = shard.sort_values("rep", ignore_index=True)
    number = int(shard["shard"].iloc[0])
    reps, copies = shard["rep"].to_numpy(np.int64), shard["copies"].to_numpy(np.int64)
    vectors = np.stack(shard["vector"].to_numpy())
    at = {r: i for i, r in enumerate(reps.tolist())}
    # Of the united lists, what lies in this shard.
    neighbours = [np.array([at[r] for r in near if r in at], np.int64) for near in shard["near"]]
    places = [p.tolist() for p in shard["places"]]
    medoid = int(np.argmax(vectors @ vectors.mean(axis=0)))
    queries = queries.sort_values("rep", ignore_index=True)
    entries = [np.array([medoid, *(at[e] for e in q if e in at)], np.int64) for q in queries["entries"]]
    wanted = np.stack(queries["vector"].to_numpy())
    # Labels of what the links join: places in `names`, whose order makes the smallest one the root.
    names = np.union1d(reps, queries["rep"].to_numpy(np.int64))
    label, inside, own = np.arange(len(names)), np.searchsorted(names, reps), np.searchsorted(names, queries["rep"])
    out = []
    if beam:
        reached = search(vectors, neighbours, wanted, entries, beam, threshold, slack)
    else:  # by brute force
        reached = ((k, np.flatnonzero(vectors @ query >= threshold), None) for k, query in enumerate(wanted))
    for k, hits, _ in reached:
        rep, before, now = int(queries["rep"][k]), set(queries["before"][k].tolist()), queries["now"][k].tolist()
        been = before.union(now)
        joins = np.unique(label[np.append(inside[hits], own[k])])
        if len(joins) > 1:
            label[np.isin(label, joins)] = joins[0]
        links, doors = 0, {}
        for hit in hits.tolist():
            other = int(reps[hit])
            if other == rep:
                continue
            shards = places[hit]
            if before.isdisjoint(shards) and min(s for s in now if s in shards) == number:
                links += int(copies[hit])
                for s in shards:
                    if s not in been:
                        doors.setdefault(s, other)
        if links:
            out.append((rep, links, rep, [{"shard": s, "entry": e} for s, e in doors.items()]))
    moved = np.flatnonzero(label != np.arange(len(names)))
    out += [(a, 0, b, []) for a, b in zip(names[moved].tolist(), names[label[moved]].tolist(), strict=True)]
    return pd.DataFrame(out, columns=["rep", "links", "root", "doors"]) if out else empty


def planted(points: DataFrame, size: int, threshold: float, rows: int, seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Negative ids and unit vectors near about `rows` points: each point turned so that their cosine lies between the
    threshold and half-way from there to 1, so all have a link.
    """
    x = unit_rows(_sampled(points, "audit", rows).toArrow().sort_by("rep")["vector"].to_pylist() or [[1.0] * size])
    draw = np.random.default_rng(seed)
    aside = draw.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    lengths = np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = draw.uniform(threshold + 1e-9, (1 + threshold) / 2, size=(len(x), 1))
    turned = np.where(lengths > 1e-9, cosine * x + np.sqrt(1 - cosine**2) * aside / np.maximum(lengths, 1e-12), x)
    return -1 - np.arange(len(x)), turned


def audit(points: DataFrame, graph: _Graph, scratch: Scratch, threshold: float, rows: int) -> float:
    """Share of the true links of planted vectors to the points that a search of the graph finds.

    The planted vectors, a bounded number, are sent to all tasks, which count their links by brute force.
    """
    size = points.select(F.size("vector")).first()[0]
    ids, x = planted(points, size, threshold, rows)
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast((ids, x))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        held = np.zeros(len(ids), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                near = unit_rows(part.column(1).to_pylist()) @ x.T >= threshold
                held += np.array(part.column(2).to_pylist()) @ near
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(held[met])], ["rep", "n"])

    true = points.select("rep", "vector", "copies").mapInArrow(count, "rep bigint, n bigint")
    true = true.groupBy("rep").agg(F.sum("n").alias("n"))
    queries = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "rep bigint, vector array<double>")
    found = graph.links_of(scratch.keep(queries))
    sums = true.join(found, "rep", "left").agg(F.sum("n").alias("n"), F.sum("links").alias("k")).first()
    if not sums.n:
        raise RuntimeError("the audit has nothing to measure")
    return (sums.k or 0) / sums.n
