"""Neighbour search, dataset manifest and conversation trie against plain versions, and their odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import hash_forest, merkle, prefix_trie
from quayside.llm.common import Scratch, numbered, ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def test_places_in_a_group(spark, scratch):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", None, "hot", "hot", "hot"]), draw.choice([None, 1, 2, 3, 4])) for _ in range(2000)]
    found = numbered(scratch, spark.createDataFrame(rows, "grp string, at int"), "grp", ["at"]).collect()
    assert sorted((r.grp or "", r["at"] or 0) for r in found) == sorted((g or "", a or 0) for g, a in rows)
    for grp in {g for g, _ in rows}:
        own = sorted((r.place, r["at"] or 0) for r in found if r.grp == grp)
        assert [p for p, _ in own] == list(range(len(own))) and [a for _, a in own] == sorted(a for _, a in own)
        assert {r.total for r in found if r.grp == grp} == {len(own)}


# --- nearest neighbours


def plain_neighbours(rows, k, every=20):
    """Ranked (query, [(vec_id, score)]) by brute force over valid rows, distinct."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in good:
        if i % every == 0:
            found = sorted((-math.sumprod(v, w), j) for j, w in good if j != i and len(w) == len(v))
            out.setdefault(i, []).append([(j, -s) for s, j in found[:k]])
    return out


def searched(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [[(v, s) for _, v, s in sorted(found)]] for q, found in out.items()}


def test_neighbours_odd_rows(spark, scratch):
    e = [1.0, 0.0, 0.5]
    nan, inf = float("nan"), float("inf")
    rows = [(0, e), (20, e), (20, e), (3, [2.0, 0.0, 1.0]), (40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [nan, 1.0, 0.0]), (8, [None, 1.0, 0.0]),
            (9, [inf, 1.0, 0.0]), (120, [-1.0, 0.0, 0.0]), (None, e), (140, [1.0, 0.0]), (12, [1e100, -0.0, 5e99]), (160, [0.0, 1.0, 0.0]), (7, [0.0, 5.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("place", F.lit("x")).withColumn("score", F.lit(1))
    for k, shard_rows in ((20, 8192), (2, 3)):
        found = hash_forest.search(table, scratch, k=k, shard_rows=shard_rows, miss=0.0)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        expected = plain_neighbours([(i, [x + 0.0 if x is not None else x for x in v] if v else v) for i, v in rows], k)
        assert searched(found.collect()) == {q: n for q, n in expected.items() if n[0]}
    assert hash_forest.search(table.limit(0), scratch).count() == 0


def test_copies_and_ties_go_to_the_smaller_id(spark, scratch):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(1000 + i, [0.0, 1.0]) for i in range(50)] + [(300, [1.0, 1.0]), (301, [1.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert searched(hash_forest.search(table, scratch, shard_rows=2).collect()) == plain_neighbours(rows, 20)


@pytest.mark.parametrize("shard_rows", [8192, 300])
def test_neighbours_are_found(spark, scratch, shard_rows):
    draw = np.random.default_rng(4)
    base = np.repeat(draw.normal(size=(30, 24)), 30, axis=0)
    x = np.concatenate([base + 0.3 * draw.normal(size=base.shape), draw.normal(size=(1100, 24))])
    x *= draw.uniform(0.2, 3, size=(len(x), 1))  # an inner product prefers long vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = searched(hash_forest.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), scratch, shard_rows=shard_rows).collect())
    expected = plain_neighbours(rows, 20)
    assert found.keys() == expected.keys() and all(len(n[0]) == 20 for n in found.values())
    right = np.mean([len({v for v, _ in found[q][0]} & {v for v, _ in expected[q][0]}) / 20 for q in expected])
    assert right >= 0.93
    for q, ranked in found.items():
        assert ranked[0] == sorted(ranked[0], key=lambda n: (-n[1], n[0]))
        assert all(s == math.sumprod(rows[q][1], rows[v][1]) for v, s in ranked[0])


def test_a_poor_search_is_done_again(spark, scratch, monkeypatch):
    draw = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(800, 16)))]
    seen, real = [], hash_forest.recall
    monkeypatch.setattr(hash_forest, "recall", lambda *a: seen.append(real(*a)) or seen[-1])
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = hash_forest.search(table, scratch, trees=2, miss=0.9, least_recall=0.999).collect()
    assert len(seen) == 2 and seen[0] < 0.999  # the third pass looks at everything
    assert searched(found) == plain_neighbours(rows, 20)


def test_the_forest_finds_what_agrees():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(500, 8))
    longest = hash_forest.norms(x).max()
    forest = hash_forest.PrefixForest(x, longest, hash_forest.planes(5, 12, 8), 12)
    low, high = forest.ranges(x[:20])
    text = [[format(int(v), "012b") for v in row] for row in hash_forest.strings(hash_forest.raised(x, longest), forest.directions, 12)]
    unit = np.concatenate([x[:20] / hash_forest.norms(x[:20])[:, None], np.zeros((20, 1))], axis=1)
    wanted = [[format(int(v), "012b") for v in row] for row in hash_forest.strings(unit, forest.directions, 12)]
    for level in range(13):
        for tree in range(5):
            for q in range(20):
                own = set(forest.order[tree, low[level, tree, q] : high[level, tree, q]].tolist())
                assert own == {i for i in range(500) if text[tree][i][:level] == wanted[tree][q][:level]}


# --- manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes, fanout):
    """The root and each node's siblings, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // fanout * fanout
            paths[i].append(("".join(level[run:place]), "".join(level[place + 1 : run + fanout])))
            at[i] = place // fanout
        level = [sha(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def plain_manifest(rows, fanout):
    """{(doc_id, leaf): (subroot, root, path)} of rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in rows:
        by.setdefault("0" if row[1] is None else "1" + row[1], []).append((row[0] is not None, row[0], plain_leaf(row)))
    trees = {}
    for grp in sorted(by, key=lambda g: g.encode()):
        own = sorted(by[grp], key=lambda r: (r[0], r[1] or 0, r[2]))
        trees[grp] = (own, *plain_tree([leaf for _, _, leaf in own], fanout))
    root, above = plain_tree([t[1] for t in trees.values()], fanout) if trees else (None, [])
    out = []
    for (own, subroot, paths), up in zip(trees.values(), above, strict=True):
        out += [(doc, leaf, subroot, root, tuple(path + up)) for (_, doc, leaf), path in zip(own, paths, strict=True)]
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [16, 2, 3])
def test_manifest_equals_the_plain_tree(spark, scratch, fanout):
    draw = random.Random(fanout)
    sources = [None, "", "a", "ä", "Z", "hot", "hot", "hot", *[f"s{i}" for i in range(20)]]
    rows = [(draw.choice([None, draw.randint(-9, 400)]) if i % 9 == 0 else i, draw.choice(sources), draw.choice([None, "de"]), draw.choice([None, i]),
             draw.choice([None, "", "Text é", "x" * 100_000 if i == 5 else "Y"])) for i in range(400)]
    rows += [(1, "dup", None, 1, "same")] * 4 + [(7, "alone", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS]).alias("leaf"), F.lit(1).alias("root"), F.create_map(F.lit("a"), F.lit(1)).alias("_pos"))
    made = merkle.manifest(leaves, scratch, fanout=fanout)
    assert made.columns == ["doc_id", "source", "_pos", "leaf", "subroot", "root", "path"]
    found = made.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).withColumn("sibs", merkle.siblings_digest(F.col("path"))).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in found), key=str) == plain_manifest(rows, fanout)
    assert all(r.again == r.root and r.sibs == sha(*[s.left + s.right for s in r.path]) for r in found)
    wrong = made.withColumn("again", merkle.folded(F.sha2("leaf", 256), F.col("path")))
    assert wrong.where("again = root").count() == 0
    assert merkle.manifest(leaves.limit(0), scratch).count() == 0


# --- conversations


def plain_trie(conversations):
    """Nodes of the trie of {conv_id: [(role, text)]}."""
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    total, leaves, children = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        saved = (len(own) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            total[node[:d]] += saved
            leaves[node[:d]] += not children[node]
    ends = lambda node: sorted(c for c in members[node] if len(conversations[c]) == len(node))
    return sorted(
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node], total[node], sha(",".join(map(str, ends(node)))))
        for node, own in members.items()
    )


def plain_borrowed(rows):
    """Rebuilt conversations of rows (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0))] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :] for c in own}


def trie_rows(df):
    return sorted(tuple(r) for r in df.collect())


def conversations_of(draw):
    rows = []
    for c in range(150):
        for turn in range(draw.choice([1, 3, 6, 9, 14])):
            rows.append((c, draw.choice([turn]), draw.choice(["user", None, "bot"]) if turn > 2 else "user", "é" if turn < 2 else draw.choice(["", None, "a", "bc"])))
    rows += [(c, t, "hot", f"t{t}") for c in range(1000, 1060) for t in range(12)]  # copies
    return rows + [(2000, t, "long", str(t % 3)) for t in range(400)] + [(2005, t, "long", str(t % 3) if t < 300 else "z") for t in range(310)]


@pytest.mark.parametrize("shard_turns, span", [(100_000, 1024), (40, 16), (7, 5), (1, 3)])
def test_trie_equals_the_plain_one(spark, scratch, shard_turns, span):
    rows = conversations_of(random.Random(shard_turns))
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    own = prefix_trie.borrowed(prefix_trie.encoded(table, scratch), scratch)
    found = prefix_trie.trie(*own, scratch, shard_turns=shard_turns, span=span)
    rebuilt = plain_borrowed(rows)
    assert {r.conv_id: r.length for r in own[1].collect()} == {c: len(t) for c, t in rebuilt.items()}
    expected = plain_trie(rebuilt)
    assert len(expected) > 500 and [tuple(-1 if v is None else v for v in r) for r in expected] == sorted(
        tuple(-1 if v is None else v for v in r) for r in found.collect()
    )


def test_trie_odd_rows(spark, scratch):
    rows = [(None, 0, "user", "x"), (5, None, None, "a"), (5, 0, "user", None), (5, 1, "user", ""), (6, 0, None, "a"), (6, 0, None, "a"), (9, None, None, None), (9, 2, "user", "y" * 1_000_000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("place", F.lit(1)).withColumn("size", F.lit("x"))
    found = prefix_trie.trie(*prefix_trie.borrowed(prefix_trie.encoded(table, scratch), scratch), scratch)
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, found.collect())) == sorted(map(key, plain_trie(plain_borrowed(rows))))
    none = prefix_trie.borrowed(prefix_trie.encoded(table.limit(0), scratch), scratch)
    assert prefix_trie.trie(*none, scratch).count() == 0


def test_the_tree_is_balanced_and_ordered():
    ids = [[i, j] for i in range(64) for j in range(i % 5)]
    tree = prefix_trie.TernaryTree(ids, [[1] * len(s) for s in ids], [1] * len(ids), list(range(len(ids))))
    order = list(tree.walk())
    assert [tree.turn[n] for n, _, depth in order if depth == 1] == sorted({s[0] for s in ids})
    assert [tree.path(s)[-1] for s in ids] == [n for n, _, depth in order if depth == 2]

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.down[0]) <= 12
