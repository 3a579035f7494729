"""Secret scans: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import sole, texts
from quayside.llm.secret_examples import examples

# Candidates are runs of characters that keys are written in, long enough to be one, and what `places` finds.
CANDIDATE = re.compile(rb"[A-Za-z0-9_+/=-]{16,}")
# What stands before a value that is assigned to a name.
ASSIGNED = re.compile(rb"([A-Za-z0-9_.-]{1,40})[\"']?\s{0,2}(?:=>|:=|=|:)\s{0,2}[\"']?$")
# Names under which credentials are kept, words that mark placeholders.
CREDENTIAL = re.compile(rb"token|secret|passw|passwd|pwd|api.?key|apikey|auth|credential|private|access.?key|bearer", re.I)
PLACEHOLDER = re.compile(rb"example|sample|dummy|placeholder|changeme|xxxx|your[_-]|test|fake|redacted", re.I)
# Beginnings that issuers give their keys.
ISSUED = re.compile(rb"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|sk-|AIza|eyJ)")
# Fixed value: words before or after a value that tell what else it is.
DIGEST = re.compile(rb"commit|\brev|merge|checkout|sha-?\d|md5|hash|digest|checksum|integrity|uuid|\bid\b|etag|session|base64|import|define|\bno\b|order|\.(?:zip|tar|gz)\b", re.I)
# A credential's name before what assigns a value, and the value: quoted up to the closing quote, or up to a space.
NAMED = re.compile(
    rb"(?:token(?!i)|secret(?!ar)|passw|pwd|api.?key|auth(?!or(?!ization))|credential|private|access.?key|bearer)"
    rb"[A-Za-z0-9_.-]{0,40}[\"'`\]]{0,2}(?:\s{0,2}:\s{0,2}[A-Za-z0-9_.]{1,40})?\s{0,2}$",
    re.I,
)
ASSIGNS = re.compile(rb"=>|:=|=|:")
VALUE = re.compile(
    rb"\s{0,2}(?:(?:bearer|basic)\s{1,2})?"
    rb"(?:\"((?:\\.|[^\"\\\r\n])+)\"|'((?:\\.|[^'\\\r\n])+)'|`((?:\\.|[^`\\\r\n])+)`|[\"'`]?((?:[^\s\"'`]|[\"'`](?=\w))+))",
    re.I,
)
# In addresses: a password or a key before the host, and the values of a query.
USER = re.compile(rb"://(?:[^\s/?#:@\"'<>]*:)?([^\s/?#\"'<>]+)@")
QUERY = re.compile(rb"[?&][A-Za-z0-9_.~%\[\]-]{1,40}=([^\s&#\"'`<>]+)")


def places(text: bytes) -> Iterator[tuple[int, int, bool]]:
    """Where a value stands that may be a secret by its place, and whether the place names a credential.

    Values of one kind of place do not nest: what a value holds is not looked at again, so however a line is made, its
    values are together no longer than it is.
    """
    queried = set()  # in a query a value ends at the next one's name
    for m in QUERY.finditer(text):
        queried.add(m.start(1))
        yield (*m.span(1), False)
    for m in USER.finditer(text):
        yield (*m.span(1), True)
    at = 0
    while m := ASSIGNS.search(text, at):
        at = m.end()
        if NAMED.search(text[max(0, m.start() - 96) : m.start()]) and (value := VALUE.match(text, m.end())):
            start, end = value.span(value.lastindex)
            if start not in queried:
                yield start, end, True
                at = end


FEATURES = (
    "length", "digits", "upper", "lower", "marks", "entropy", "switches", "transition", "rarest",
    "coverage", "hex", "common_length", "issued", "assigned", "credential_name", "placeholder",
    "quoted", "in_address", "before_credential", "after_quote", "path_example", "path_code",
    "path_depth", "repeats", "digest_name", "call", "dots",
)
CLASSES = 40


def _classes() -> np.ndarray:
    """Character classes for transitions: a-z (case folded), each digit, marks, everything else."""
    table = np.full(256, CLASSES - 1, np.int64)
    for b in range(128):
        c = chr(b)
        if c.isalpha():
            table[b] = ord(c.lower()) - 97
        elif c.isdigit():
            table[b] = 26 + int(c)
        elif c in "_+/=-":
            table[b] = 36
        elif c.isspace():
            table[b] = 37
        elif b > 32:
            table[b] = 38
    return table


CLASS_OF = _classes()


def transitions(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of character classes after one another, over all texts of `docs`.

    Each task adds up its rows; at most CLASSES squared rows per task are combined.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for text in texts(batch.column(0)):
                if text:
                    c = CLASS_OF[np.frombuffer(text, np.uint8)]
                    held += np.bincount(c[:-1] * CLASSES + c[1:], minlength=len(held))
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(held[met])], ["pair", "n"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "pair bigint, n bigint")
    total = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.ones(CLASSES * CLASSES)
    counts[total["pair"].to_numpy()] += total["n"].to_numpy()
    counts = counts.reshape(CLASSES, CLASSES)
    return np.log2(counts / counts.sum(axis=1, keepdims=True))


def dictionary(path: str) -> frozenset[str]:
    return sole(f"dictionary {path}", lambda: _dictionary(path))


def _dictionary(path: str) -> frozenset[str]:
    """Letter-only pieces of three letters or more of a public vocabulary."""
    from tokenizers import Tokenizer

    pieces = Tokenizer.from_file(path).get_vocab()
    found = (p.removesuffix("</w>").lower() for p in pieces)
    return frozenset(p for p in found if len(p) >= 3 and p.isascii() and p.isalpha())


def coverage(value: bytes, known: frozenset[str]) -> float:
    """Share of characters in dictionary pieces, taken longest first from the left."""
    low, at, held = value.decode().lower(), 0, 0
    while at < len(low):
        for size in range(min(12, len(low) - at), 2, -1):
            if low[at : at + size] in known:
                held += size
                at += size
                break
        else:
            at += 1
    return held / len(low)


def describe(text: bytes, start: int, end: int, path: str, log: np.ndarray, known: frozenset[str], named: bool = False) -> list[float]:
    """The features of one candidate, in the order of FEATURES; `named` tells that its place names a credential."""
    value = text[start:end]
    n = len(value)
    raw = np.frombuffer(value, np.uint8)
    classes = CLASS_OF[raw]
    digits = int((classes // 10 == 2).sum() + ((classes >= 30) & (classes < 36)).sum() - ((classes >= 20) & (classes < 26)).sum())
    marks = int((classes == 36).sum())
    upper = sum(65 <= b <= 90 for b in value)
    counts = np.bincount(raw)
    share = counts[counts > 0] / n
    kind = np.select([classes < 26, classes < 36], [0, 1], 2) * 2 + (raw < 97)
    steps = log[classes[:-1], classes[1:]]
    before, after = text[max(0, start - 64) : start], text[end : end + 24]
    assigned = ASSIGNED.search(before)
    longest = max((len(m.group()) for m in re.finditer(rb"(.)\1*", value)), default=0)
    return [
        n, digits / n, upper / n, (n - digits - marks - upper) / n, marks / n,
        float(-(share * np.log2(share)).sum()), float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        float(steps.mean()) if n > 1 else 0.0, float(steps.min()) if n > 1 else 0.0, coverage(value, known),
        float(re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", value) is not None), float(n in (20, 32, 36, 40, 64)),
        float(ISSUED.match(value) is not None), float(named or assigned is not None),
        float(named or assigned is not None and CREDENTIAL.search(assigned.group(1)) is not None),
        float(PLACEHOLDER.search(value + b" " + before[-24:]) is not None),
        float(before[-1:] in (b'"', b"'", b"`")), float(re.search(rb"(://|@|www\.)\S*$", before) is not None or after[:1] == b"@"),
        float(CREDENTIAL.search(before) is not None), float(after[:1] in (b'"', b"'", b"`")),
        float(re.search(r"(?i)test|example|sample|fixture|docs?/", path) is not None),
        float(re.search(r"(?i)\.(py|js|java|env|ya?ml|json|ini|cfg|conf|sh|go|rb|pem)$", path) is not None),
        float(path.count("/")), longest / n, float(DIGEST.search(before[-32:] + b" " + after) is not None),
        float(re.search(rb"[(){}<>$%\[\]]", value) is not None or after[:1] in (b"(", b")")), value.count(b".") / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: split feature (-1 in a leaf), threshold, left and right child, share of positives."""

    trees: tuple[tuple[np.ndarray, ...], ...]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                low = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += value[at]
        return total / max(1, len(self.trees))


def grow(rows: np.ndarray, labels: np.ndarray, seed: int, depth: int = 10, least: int = 2) -> tuple[np.ndarray, ...]:
    """One tree on a balanced bootstrap; each split takes the best Gini gain among a few random features."""
    rng = np.random.default_rng(seed)
    ones, zeros = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    size = max(1, len(labels) // 2)
    drawn = np.concatenate([rng.choice(c, size) for c in (ones, zeros) if len(c)])
    rows, labels = rows[drawn], labels[drawn].astype(np.float64)
    tried = max(2, math.isqrt(rows.shape[1]))
    nodes: list[list[float]] = []

    def split(members: np.ndarray, level: int) -> int:
        place = len(nodes)
        share = float(labels[members].mean())
        nodes.append([-1, 0.0, 0, 0, share])
        if level == depth or len(members) < 2 * least or share in (0.0, 1.0):
            return place
        best = (1e-9, 0, 0.0)
        for f in rng.permutation(rows.shape[1])[:tried]:
            order = members[np.argsort(rows[members, f], kind="stable")]
            x, y = rows[order, f], np.cumsum(labels[order])
            cut = np.flatnonzero(x[1:] > x[:-1]) + 1
            cut = cut[(cut >= least) & (cut <= len(x) - least)]
            if not len(cut):
                continue
            left, total = y[cut - 1], y[-1]
            right, n = total - left, len(x)
            gain = left**2 / cut + right**2 / (n - cut) - total**2 / n
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                middle = float((x[cut[k] - 1] + x[cut[k]]) / 2)
                best = (float(gain[k]), int(f), middle if middle < x[cut[k]] else float(x[cut[k] - 1]))
        if best[0] <= 1e-9:
            return place
        low = rows[members, best[1]] <= best[2]
        nodes[place][:2] = best[1:]
        nodes[place][2] = split(members[low], level + 1)
        nodes[place][3] = split(members[~low], level + 1)
        return place

    split(np.arange(len(rows)), 0)
    table = np.array(nodes)
    return (*(table[:, k].astype(kind) for k, kind in enumerate((np.int64, float, np.int64, np.int64, float))),)


@dataclass(frozen=True)
class Scanner:
    """What a scan needs besides the texts: character transitions, a dictionary's path and a forest."""

    log: np.ndarray
    dictionary_path: str
    forest: Forest | None = None

    def candidates(self, text: bytes | None, path: str | None) -> list[tuple[int, int, list[float]]]:
        if not text:
            return []
        known = dictionary(self.dictionary_path)
        spans = {m.span(): False for m in CANDIDATE.finditer(text)}
        for start, end, named in places(text):
            spans[start, end] = named or spans.get((start, end), False)
        return [
            (start, end, describe(text, start, end, path or "", self.log, known, named))
            for (start, end), named in sorted(spans.items())
        ]


FOUND = "doc_id bigint, start bigint, length bigint, value_sha256 string, features array<double>, score double"


def findings(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """One row per candidate of `docs` (doc_id, text, source): where it lies, its features and score.

    Candidates may overlap: an assigned value and a run inside it are judged each.
    start and length count characters. The value itself is not returned, only its SHA-256. Without
    a forest the score is null. Null and empty texts have no candidates; the source stands for the
    path and may be null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = []
            for doc, text, path in zip(
                batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                at = chars = 0
                for start, end, features in known.candidates(text, path):
                    chars += len(text[at:start].decode())
                    at, value = start, text[start:end]
                    rows.append((doc, chars, len(value.decode()), hashlib.sha256(value).hexdigest(), features))
            if not rows:
                continue
            columns = list(zip(*rows, strict=True))
            forest = known.forest
            scores = forest.scores(np.array(columns[4])).tolist() if forest else [None] * len(rows)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.float64()]
            names = [c.split()[0] for c in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip([*columns, scores], kinds, strict=True)], names
            )

    return _inputs(docs).mapInArrow(scan, FOUND)


def _inputs(docs: DataFrame) -> DataFrame:
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), path.alias("source"))


PLANTED = "doc_id bigint, text string, source string, start bigint, length bigint, label int, kind string, held_out boolean"


def planted(spark: SparkSession, **options) -> DataFrame:
    """The findings of `secret_examples` as a table: PLANTED. Any table of reviewed findings may stand in for it."""
    return spark.createDataFrame(list(examples(**options)), PLANTED)


def labelled_findings(reviewed: DataFrame, scanner: Scanner) -> DataFrame:
    """Candidates in the texts of `reviewed` (see PLANTED) with the label of the reviewed value they overlap, else 0; and held_out.

    The label is what the table says of the value, whatever the candidate's features.
    """
    known = reviewed.select("doc_id", F.col("start").alias("_start"), F.col("length").alias("_length"), "label", "held_out")
    found = findings(reviewed, scanner).drop("score").join(known, "doc_id")
    over = (F.col("start") < F.col("_start") + F.col("_length")) & (F.col("_start") < F.col("start") + F.col("length"))
    return found.select("doc_id", "start", "value_sha256", "features", F.when(over, F.col("label")).otherwise(0).alias("label"), "held_out")


def measured(findings_: DataFrame, forest: Forest, threshold: float = 0.5) -> dict[str, tuple[float, float]]:
    """(precision, recall) of labelled findings: of all candidates as they are (`before`) and of those the forest keeps (`after`)."""
    rows = findings_.select("features", "label").toArrow()  # a table of reviewed findings, not of a corpus
    label = rows["label"].to_numpy()
    kept = forest.scores(np.array(rows["features"].to_pylist()).reshape(len(label), len(FEATURES))) >= threshold
    secret = max(1, int((label == 1).sum()))
    right = int((kept & (label == 1)).sum())
    return {"before": (secret / max(1, len(label)), 1.0), "after": (right / max(1, int(kept.sum())), right / secret)}


def train(labelled: DataFrame, trees: int = 48, sample_rows: int = 20_000, held_out: Column | None = None) -> Forest:
    """A forest from labelled findings (features, value_sha256, label 0 or 1); other labels are left out.

    About `sample_rows` findings of each label are taken by a hash of the value, so that their size is
    bounded, and sent to the tasks; each tree is grown in a task of its own. Without both labels the
    forest has no trees and scores 0.
    """
    rows = labelled.where("label IN (0, 1)")
    if held_out is not None:
        rows = rows.where(~held_out)
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Forest(())
    part = F.pmod(F.xxhash64("doc_id", "start", "value_sha256"), F.lit(1 << 53)).cast("double")
    share = F.when(F.col("label") == 1, sample_rows * 2.0**53 / counts[1]).otherwise(sample_rows * 2.0**53 / counts[0])
    sample = rows.where(part < share).select("doc_id", "start", "value_sha256", "features", "label").toArrow()
    sample = sample.sort_by([(n, "ascending") for n in ("doc_id", "start", "value_sha256")])
    spark = labelled.sparkSession
    values = np.array(sample["features"].to_pylist())
    shared = spark.sparkContext.broadcast((values, sample["label"].to_numpy()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                tree = grow(*shared.value, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seed])] + [pa.array([part.tolist()]) for part in tree],
                    ["seed", "feature", "threshold", "low", "high", "value"],
                )

    schema = "seed bigint, feature array<bigint>, threshold array<double>, low array<bigint>, high array<bigint>, value array<double>"
    grown = spark.range(trees).repartition(trees).mapInArrow(build, schema).collect()
    return Forest(tuple(tuple(np.array(column) for column in row[1:]) for row in sorted(grown)))


def fitted(docs: DataFrame, dictionary_path: str, reviewed: DataFrame | None = None, **options) -> Scanner:
    """A scanner for `docs`: character transitions of all their texts, and a forest trained on reviewed findings.

    `reviewed` has PLANTED's columns; by default it is `planted`. Findings that are held out are not learned from.
    """
    scanner = Scanner(transitions(docs), dictionary_path)
    known = labelled_findings(planted(docs.sparkSession) if reviewed is None else reviewed, scanner)
    return Scanner(scanner.log, dictionary_path, train(known, held_out=F.col("held_out"), **options))


def scanned(docs: DataFrame, dictionary_path: str, threshold: float = 0.5, reviewed: DataFrame | None = None, **options) -> DataFrame:
    """Findings of `docs`: doc_id, start, length, value_sha256, score and is_secret.

    Each candidate is scored by the forest, which alone decides: is_secret holds from `threshold` on. Repeated rows give
    repeated findings; an empty table gives no rows.
    """
    scanner = fitted(docs, dictionary_path, reviewed, **options)
    return findings(docs, scanner).drop("features").withColumn("is_secret", F.col("score") >= threshold)


def redacted(
    docs: DataFrame, dictionary_path: str, threshold: float = 0.5, mark: str = "[secret]", reviewed: DataFrame | None = None, **options
) -> DataFrame:
    """`docs` with every found secret replaced by `mark`, in one narrow pass; rows and columns stay.

    n_chars, where there is one, is counted anew for texts that change. Null texts stay null.
    """
    scanner = fitted(docs, dictionary_path, reviewed, **options)
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    names = docs.columns
    at = names.index("text")
    path = names.index("source") if "source" in names else None
    size = names.index("n_chars") if "n_chars" in names else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            bodies = texts(batch.column(at))
            paths = batch.column(path).to_pylist() if path is not None else [None] * batch.num_rows
            out, counted = [], batch.column(size).to_pylist() if size is not None else None
            for i, (text, where) in enumerate(zip(bodies, paths, strict=True)):
                found = known.candidates(text, str(where or ""))
                rows = np.array([f for *_, f in found]).reshape(len(found), len(FEATURES))
                secret = known.forest.scores(rows) >= threshold
                cuts = [f[:2] for f, s in zip(found, secret, strict=True) if s]
                if cuts:
                    parts, done = [], 0
                    for start, end in cuts:
                        if start >= done:
                            parts += [text[done:start], mark.encode()]
                        done = max(done, end)  # what overlaps is one mark
                    text = b"".join([*parts, text[done:]])
                    if counted is not None:
                        counted[i] = len(text.decode())
                out.append(None if text is None else text.decode())
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            if counted is not None:
                columns[size] = pa.array(counted, batch.column(size).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(replace, kinds)
