"""The operators' inner parts against brute force."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from quayside.llm import decontaminate, linkgraph, nbsvm, ngram_join, packing, secrets, tokencount, vector_graph, warc
from quayside.llm.common import words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_word_table_equals_the_tokenizer():
    table = packing.word_ids(WORD_BPE)
    draw = random.Random(2)
    alphabet = [*"aAbzZ'sStd.,!-_ \n\t019éÉßÿÀΣσς日本́İ😀×÷µªº…<|>", "'s", "'LL", "<|endoftext|>", "'re", "fi"]
    samples = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    for text in [*samples, "", None, "x" * 5000]:
        expected = table.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(table.of(text), "<u4").tolist() == expected, text


def test_first_fit_decreasing_equals_the_plain_search():
    draw = random.Random(5)
    for _ in range(300):
        lengths = np.array([draw.randint(1, 20) for _ in range(draw.randint(1, 60))])
        bins, offsets = packing.first_fit_decreasing(lengths, 20)
        room, expected = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
            if at == len(room):
                room.append(20)
            expected[i] = (at, 20 - room[at])
            room[at] -= lengths[i]
        assert [(int(b), int(o)) for b, o in zip(bins, offsets, strict=True)] == [expected[i] for i in range(len(lengths))]


def test_piece_counts_equal_the_unigram_tokenizer():
    vocabulary = tokencount.vocabulary(PIECES)
    low = min(s for _, s in vocabulary)
    byte_pieces = [(f"<0x{i:02X}>", low) for i in range(256)]
    exact = Tokenizer(models.Unigram([("<unk>", low), *vocabulary, *byte_pieces], unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = tokencount.counter(PIECES)
    draw = random.Random(1)
    samples = ["".join(draw.choice([*"ab thé\n日er", "\U0001f600", "▁"]) for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    for text in [*samples, "", " ", "  a  b", "日本語 テキスト", "x" * 3000, " lead", "trail "]:
        assert counter.of(text) == len(exact.encode(text, add_special_tokens=False).ids), text
    assert counter.of(None) == 0


def test_ties_go_to_the_match_that_starts_first():
    counter = tokencount.PieceCounter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁ab", -2.0)])
    assert counter.search("▁ab") == 1


@pytest.mark.parametrize("window", [2, 3, 5])
def test_automaton_equals_brute_force(window):
    draw = random.Random(window)
    for _ in range(400):
        letters = [b"a", b"b", b"c"][: draw.randint(1, 3)]
        items = [(str(k), [draw.choice(letters) for _ in range(draw.randint(0, 9))]) for k in range(draw.randint(0, 5))]
        content = [draw.choice([*letters, b"z"]) for _ in range(draw.randint(0, 30))]
        hit, held = set(), set()
        for item, own in items:
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for k in range(len(content) - size + 1):
                    if content[k : k + size] == own[i : i + size]:
                        hit |= set(range(k, k + size))
                        held.add(item)
        spans, found = decontaminate.ItemAutomaton(items, window).scan(content)
        assert {i for first, end, _ in spans for i in range(first, end)} == hit and found == held


def test_spans_are_cut_out_of_the_text():
    assert decontaminate.cut_words(b"One two, three. Four!", [(1, 3)]) == "One . Four!"
    assert decontaminate.cut_words("é x".encode(), [(0, 2)]) == ""


def test_words_and_their_hashes():
    text = "It's ÉTÉ, a1-b2  x\x7fy".encode()
    assert words(text) == [b"it", b"s", "ÉtÉ".encode(), b"a1", b"b2", b"x", b"y"]
    assert len(ngram_join.word_hashes(text)) == 7
    assert words(None) == words(b"") == [] and len(ngram_join.word_hashes(b" .,")) == 0
    long = b"ab cd " * 400_000
    hashes = ngram_join.word_hashes(long)
    assert len(hashes) == 800_000 and len(set(hashes.tolist())) == 2


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.95)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 160


def test_similar_pairs_equal_set_arithmetic():
    draw = random.Random(9)
    sets = [np.unique(np.array(draw.sample(range(30), draw.randint(1, 25)), np.uint64)) for _ in range(150)]
    wanted = np.ones((150, 150), bool)
    found = ngram_join.similar(sets, wanted, 0.5)
    for i in range(150):
        for j in range(150):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert found[i, j] == (i != j and len(a & b) >= 0.5 * len(a | b) - 1e-9)


def test_dual_coordinate_descent_parts_the_classes():
    draw = np.random.default_rng(3)
    rows = []
    for i in range(400):
        noise = np.unique(draw.integers(10, 500, 30))
        rows.append((np.concatenate([noise, [i % 2]]), i % 2))
    counts = np.ones((2, 500))
    for features, label in rows:
        counts[label, features] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    model = nbsvm.fit_rows(rows, ratios, 1.0, 20)
    assert all((model.score(model.margin(f)) >= 0.5) == bool(label) for f, label in rows)
    one = nbsvm.fit_rows(rows[::2], ratios, 1.0, 20)  # a single class: its share, whatever the text
    assert one.score(one.margin(rows[0][0])) == one.score(one.margin(rows[1][0])) < 0.5


def test_a_forest_learns_a_rule():
    draw = np.random.default_rng(4)
    x = draw.random((600, len(secrets.FEATURES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] > 0.4)).astype(int)
    forest = secrets.Forest(tuple(secrets.grow(x[:400], y[:400], seed) for seed in range(24)))
    assert ((forest.scores(x[400:]) >= 0.5) == y[400:]).mean() > 0.9
    assert secrets.Forest(()).scores(x).tolist() == [0.0] * 600


def test_search_finds_what_brute_force_finds():
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(40, 16))
    x = vector_graph.unit_rows(list(np.repeat(centres, 10, axis=0) + 0.1 * draw.normal(size=(400, 16))))
    adjacent = vector_graph.shard_graph(x, 16, 32, 1.2)
    neighbours = [np.flatnonzero(row) for row in adjacent]
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    true = x @ x.T >= 0.9
    found = np.zeros_like(true)
    for k, hits, sims in vector_graph.search(x, neighbours, x, [np.array([medoid])] * 400, 24, 0.9, 0.05):
        found[k, hits] = True
        assert (sims >= 0.9).all()
    assert (found & true).sum() / true.sum() > 0.98 and not (found & ~true).any()


def test_gzip_streams_are_read_in_pieces():
    import gzip

    record = lambda n: b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (n, n) + b"x" * n + warc.END
    whole = b"".join(record(n) for n in (0, 5, 3_000_000, 1))
    for packed in (gzip.compress(whole), gzip.compress(whole[:70]) + gzip.compress(whole[70:])):
        chunks = [packed[i : i + 1000] for i in range(0, len(packed), 1000)]
        parts = list(warc.record_parts(warc.inflate(iter(chunks))))
        heads = [warc.header_fields(h)["warc-record-id"] for h, _ in parts if h]
        assert heads == [f"<urn:page:{n}>" for n in (0, 5, 3_000_000, 1)]
        assert sum(len(p) for _, p in parts) == 3_000_006 + 4 * len(warc.END)
        with pytest.raises(ValueError):
            list(warc.record_parts(warc.inflate(iter([packed[:-200]]))))


def test_rules_are_parted_at_the_first_slash():
    rule = linkgraph.Rule("example.net/en/", True)
    assert (rule.host, rule.path) == ("example.net", "/en/")
