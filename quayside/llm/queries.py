"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, hash_forest, linkgraph, merkle, nbsvm, ngram_join, packing, prefix_trie, quality, secrets, tokencount, toxicity, vector_graph, warc
from quayside.llm.common import Scratch, ship, table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


RULES = [
    linkgraph.Rule("net/", False),
    linkgraph.Rule("example.net/en/", True),
    linkgraph.Rule("example.com/de/", False),
    linkgraph.Rule("org/fr/", True),
]
ROUNDS = 8


def op2_sql() -> str:
    """The same walk, unrolled. Hosts whose two scores nearly meet do not occur in the data."""
    rest = "substr(url, instr(url, '://') + 3)"
    fits = [
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        for r in sorted(RULES, key=lambda r: -len(r.text))
    ]
    order = sorted(RULES, key=lambda r: -len(r.text))
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, order, strict=True))
    says = " ".join(f"WHEN {f} THEN '{'allow' if r.allow else 'block'}'" for f, r in zip(fits, order, strict=True))
    quoted = lambda pattern: pattern.replace("'", "''")
    parts = [
        f"""p AS (SELECT page_id, html,
  CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract({rest}, '^([^/?#]*)', 1, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN instr(url, '://') > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path FROM pages)""",
        f"""links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{quoted(linkgraph.LINK)}', 1)) AS l FROM p
  UNION ALL SELECT host, regexp_extract(unnest(string_split(s, ',')), '^\\s*((?:[A-Za-z][A-Za-z0-9+.-]*:)?//\\S+)', 1)
  FROM (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '{quoted(linkgraph.SRCSET)}', 1)) AS s FROM p)
  UNION ALL SELECT host, base FROM (SELECT host, base, unnest(regexp_extract_all(html, '{quoted(linkgraph.RELATIVE)}', 0))
    FROM (SELECT host, html, regexp_extract(coalesce(html, ''), '{quoted(linkgraph.BASE)}', 1) AS base FROM p) WHERE base <> ''))""",
        """edges AS (SELECT kind, src, dst, sum(weight) AS weight FROM (
  SELECT 'link' AS kind, src, translate(regexp_extract(l, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst,
    1 AS weight FROM links
  UNION ALL SELECT 'parent', host, regexp_replace(host, '^[^.]*\\.', ''), 1 FROM (SELECT DISTINCT host FROM p) WHERE len(string_split(host, '.')) > 2
) WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY kind, src, dst)""",
        """walks AS (SELECT walk, src, dst, CASE kind WHEN 'parent' THEN 0.2 ELSE 0.8 END * weight / sum(weight) OVER (PARTITION BY walk, kind, src) AS share FROM (
  SELECT 'trust' AS walk, kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', kind, dst, src, weight FROM edges))""",
        f"""r AS (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {says} END AS ruled FROM p)""",
        """seeds AS (SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS walk, host,
  count(*) / sum(count(*)) OVER (PARTITION BY ruled) AS seed FROM r WHERE host <> '' AND ruled IS NOT NULL GROUP BY ruled, host)""",
        "s0 AS (SELECT walk, host, seed AS score FROM seeds)",
    ]
    for k in range(1, ROUNDS + 1):
        parts.append(f"""s{k} AS (SELECT walk, host, sum(part) AS score FROM (
  SELECT w.walk, w.dst AS host, 0.85 * share * score AS part FROM walks w JOIN s{k - 1} s ON w.walk = s.walk AND w.src = s.host
  UNION ALL SELECT walk, host, 0.15 * seed FROM seeds) GROUP BY walk, host)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT page_id, r.host, path, rule, coalesce(ruled,
  CASE WHEN coalesce(d.score, 0) > coalesce(t.score, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN s{ROUNDS} t ON t.host = r.host AND t.walk = 'trust' LEFT JOIN s{ROUNDS} d ON d.host = r.host AND d.walk = 'distrust'"""


@query("op2_link_graph", op2_sql())
def op2_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linkgraph.judged(table(spark, sf_dir, "pages"), RULES, Scratch(spark, "op2"), ROUNDS)
    return out.select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS last FROM p),
bits AS (SELECT page_id, html, last, lpad(bin(CAST(('0x' || sha1(html)[1:10]) AS BIGINT)), 40, '0') || lpad(bin(CAST(('0x' || sha1(html)[11:20]) AS BIGINT)), 40, '0')
  || lpad(bin(CAST(('0x' || sha1(html)[21:30]) AS BIGINT)), 40, '0') || lpad(bin(CAST(('0x' || sha1(html)[31:40]) AS BIGINT)), 40, '0') AS b FROM m)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    CAST(16 * CAST(b[5*i+1] AS INT) + 8 * CAST(b[5*i+2] AS INT) + 4 * CAST(b[5*i+3] AS INT) + 2 * CAST(b[5*i+4] AS INT) + CAST(b[5*i+5] AS INT) AS INT) + 1]), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits"""


@query("op3_warc", OP3_SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(spark, table(spark, sf_dir, "pages"), Scratch(spark, "op3"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = quality.quality_scores(docs, labels, nbsvm.fold(3) == 1)
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


@query("op6_vector_graph")
def op6_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.linked(table(spark, sf_dir, "embeddings"), Scratch(spark, "op6"))


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
), wins AS (
  SELECT item, CAST(least(13, len(ws)) AS BIGINT) AS size, array_to_string(ws[i : i + 12], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT size FROM wins),
places AS (
  SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, sizes WHERE len(ws) >= size)
), found AS (SELECT doc_id, p.size, i, item FROM places p JOIN wins USING (win)),
hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, i, size FROM found))
  GROUP BY doc_id
), its AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS h FROM found GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hits ON w.doc_id = hits.doc_id LEFT JOIN its ON w.doc_id = its.doc_id"""


@query("op7_decontamination", OP7_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op7")
    )
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return decontaminate.judged(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        digest.alias("items_sha256"),
        "contaminated",
    )


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = toxicity.toxicity_scores(docs, labels, nbsvm.fold(5) == 0)
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"), Scratch(spark, "op10")).drop("size", "text_hash")


@query("op11_hash_forest")
def op11_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.search(table(spark, sf_dir, "embeddings"), Scratch(spark, "op11"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# CRC-32 in SQL: its byte table, eight shifts per entry.
_SHIFT = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
CRC_TABLE = [
    "t0 AS (SELECT i, CAST(i AS BIGINT) AS c FROM range(256) r(i))",
    *[f"t{k} AS (SELECT i, {_SHIFT} AS c FROM t{k - 1})" for k in range(1, 9)],
    "crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM t8)",
]


def crc_sql(column: str) -> str:
    """CRC-32 of an integer column in decimal, from the table `crc_table`."""
    return f"""xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
    lambda c, d: xor(c >> 8, crcs[xor(c & 255, d) + 1])), 4294967295)"""


def op12_sql(levels: int = 5) -> str:
    """The same tree, unrolled: up to 16 ** `levels` rows a source, and sources."""
    part = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')".format
    own = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in [*own, text]) + ")"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        *CRC_TABLE,
        f"""rows_ AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lowered)} AS lowered, {crc_sql('doc_id')} % 5 = 0 AS tampered FROM documents, crc_table)""",
        """p0 AS (SELECT coalesce('1' || source, '0') AS grp, *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS total FROM rows_)""",
    ]

    def climb(name: str) -> None:
        parts.append(f"{name}0 AS (SELECT grp, pos, total, leaf AS digest FROM {'p0' if name == 'n' else 'h0'})")
        for k in range(1, levels + 1):
            below = f"{name}{k - 1}"
            parts.append(
                f"""{name}{k} AS (SELECT grp, pos // 16 AS pos, max(total + 15) // 16 AS total, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
  FROM {below} WHERE total > 1 GROUP BY grp, pos // 16)"""
            )

    climb("n")
    tops = " UNION ALL ".join(f"SELECT grp, digest FROM n{k} WHERE total = 1" for k in range(levels + 1))
    parts.append(f"subroots AS ({tops})")
    parts.append("h0 AS (SELECT '' AS grp, grp AS source_key, digest AS leaf, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS total FROM subroots)")
    climb("m")
    parts.append(f"top AS ({' UNION ALL '.join(f'SELECT digest AS root FROM m{k} WHERE total = 1' for k in range(levels + 1))})")

    def walk(name: str, start: str, out: str) -> None:
        """Fold each row of `start` (grp, place, node, sibs) up the levels."""
        before = start
        for k in range(levels):
            after = f"{out}{k}"
            side = "coalesce((SELECT string_agg(x.digest, '' ORDER BY x.pos) FROM {0}{1} x WHERE x.grp = w.grp AND x.pos // 16 = w.place // 16 AND x.pos {2} w.place), '')".format
            parts.append(
                f"""{after} AS (SELECT * EXCLUDE (up, l, r) REPLACE (CASE WHEN up THEN sha256(l || node || r) ELSE node END AS node,
  CASE WHEN up THEN sibs || l || r ELSE sibs END AS sibs, place // 16 AS place) FROM (SELECT w.*, EXISTS (SELECT 1 FROM {name}{k} x WHERE x.grp = w.grp AND x.total > 1) AS up, {side(name, k, '<')} AS l, {side(name, k, '>')} AS r FROM {before} w) w)"""
            )
            before = after

    parts.append("w AS (SELECT doc_id, grp, pos AS place, leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS node, '' AS sibs FROM p0)")
    walk("n", "w", "u")
    parts.append(f"v AS (SELECT w.* REPLACE ('' AS grp, h.pos AS place), h.leaf AS subroot FROM u{levels - 1} w JOIN h0 h ON h.source_key = w.grp)")
    walk("m", "v", "z")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(sibs) AS proof_sha256, node AS folded_root, node = root AS verified FROM z{levels - 1}, top"""


@query("op12_merkle_manifest", op12_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS]).alias("leaf"),
        F.when(tampered, merkle.leaf_digest(*lowered)).alias("tampered"),
    )
    found = merkle.manifest(leaves, Scratch(spark, "op12"))
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP13_SQL = "WITH " + ",\n".join(CRC_TABLE) + f""",
own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hs AS (SELECT conv_id, ts, {crc_sql('conv_id')} % 9 AS h FROM own, crc_table),
rebuilt AS (SELECT a.conv_id, coalesce(b.ts[1:h], []) || a.ts[h + 1:] AS ts FROM hs a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
members AS (SELECT conv_id, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(strlen(p[d].t), 0) AS saved,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM members GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (SELECT anc, sum(saved) AS saved, count(*) FILTER (WHERE childless) AS leaves FROM (
  SELECT n.p[1:unnest(range(0, d + 1))] AS anc, saved, c.n IS NULL AS childless FROM nodes n LEFT JOIN children c ON c.p = n.p) GROUP BY anc)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.anc = n.p LEFT JOIN children c ON c.p = n.p LEFT JOIN nodes up ON n.d > 0 AND up.p = n.p[1:n.d - 1]"""


@query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op13")
    turns = prefix_trie.encoded(table(spark, sf_dir, "conversations"), scratch)
    return prefix_trie.trie(*prefix_trie.borrowed(turns, scratch), scratch)
