"""Registered queries of this package and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    jaccard,
    language,
    licenses,
    lm,
    maxscore,
    merkle,
    mixing,
    packing,
    pages,
    pii,
    quality,
    secrets,
    topk,
)
from orderlens.llm.text import join_spans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: quality rules

_QUALITY_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
tri AS (SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM
        (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, cast(len(words) AS bigint) AS n_words,
  cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS bigint) AS word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
  cast(len(lines) AS bigint) AS n_lines,
  cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
  cast(coalesce(n, 0) AS bigint) AS n_repeat_words,
  cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS bigint) AS n_upper
  FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 AS b0, 100 * n_repeat_words > 50 * n_words AS b1,
  word_chars < 3 * n_words AS b2, word_chars > 10 * n_words AS b3, 10 * n_symbols > n_words AS b4,
  2 * n_dup_lines > n_lines AS b5, 100 * n_repeat_words > 25 * n_words AS b6,
  10 * n_upper > 3 * word_chars AS b7, n_words > 100000 AS b8 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper,
  cast(b0::int + 2 * b1::int + 4 * b2::int + 8 * b3::int + 16 * b4::int + 32 * b5::int
       + 64 * b6::int + 128 * b7::int + 256 * b8::int AS bigint) AS failed_bits,
  b0 OR b1 AS base_failed,
  NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5 OR b7 OR (b6 AND b8)) AS kept
FROM f
"""


@query("op1_quality_ledger", _QUALITY_SQL)
def op1_quality_ledger(spark, sf_dir):
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    return entries.withColumn("base_failed", ~quality.kept(quality.BASE)).withColumn(
        "kept", quality.kept(quality.STRICT)
    )


# --- 2: mixing sources to target weights


@query("op2_pfair_mix")
def op2_pfair_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


# --- 3: license scans


@query("op3_license_scan")
def op3_license_scan(spark, sf_dir):
    scanned = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d["pinned"])
    return scanned.select(
        "doc_id", "n_words", "detections", base.alias("base")
    ).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda d: d["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda d: d["start"])).cast("long").alias("last_word"),
        licenses.labels(F.col("base")).alias("base_labels"),
        licenses.labels(licenses.standing(F.col("detections"))).alias("labels"),
        licenses.confidence(F.col("detections")).alias("score"),
    )


# --- 4: packing


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_packing")
def op4_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


# --- 5: personal data


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


@query("op5_pii_bootstrap")
def op5_pii_bootstrap(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    fixed = F.col("fixed")
    return found.select(
        "doc_id",
        *[
            F.size(F.filter(fixed, _is_kind(kind))).cast("long").alias(f"n_{kind}")
            for kind in pii.KINDS
        ],
        F.sha2(join_spans(fixed), 256).alias("base_sha256"),
        join_spans(F.concat(fixed, "learned")).alias("spans"),
        F.size("learned").cast("long").alias("n_learned"),
    )


# --- 6: n-gram Jaccard join

_JACCARD_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT r, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (WITH RECURSIVE f(a, b) AS (SELECT r, r FROM t
    UNION SELECT f.a, e.b FROM f JOIN e ON f.b = e.a) SELECT a, b FROM f)
SELECT t.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM t LEFT JOIN n USING (r) JOIN reach ON reach.a = t.r JOIN t o ON o.r = reach.b
GROUP BY t.r, t.doc_id
"""


@query("op6_ngram_jaccard", _JACCARD_SQL)
def op6_ngram_jaccard(spark, sf_dir):
    rule = jaccard.Similarity(shingle=4, percent=85)
    return jaccard.join(table(spark, sf_dir, "documents"), rule=rule)


# --- 7: language-model scoring


@query("op7_bloom_lm")
def op7_bloom_lm(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


# --- 8: secret scans


@query("op8_secret_scan")
def op8_secret_scan(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    fixed, random = F.col("fixed"), F.col("random")
    return found.select(
        "doc_id",
        *[secrets.count_kind(fixed, kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(join_spans(fixed), 256).alias("base_sha256"),
        join_spans(secrets.all_spans(fixed, random)).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )


# --- 9: HTML extraction


@query("op9_host_suffix_array")
def op9_host_suffix_array(spark, sf_dir):
    texts = pages.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


# --- 10: exact top-k search

_TOP_K_SQL = """
WITH v AS (SELECT DISTINCT vec_id,
    list_transform(embedding, lambda x: floor(64 * cast(x AS double))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    cast(list_inner_product(q.v, c.v) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int)
  AS rank, vec_id, score FROM s QUALIFY rank <= 20
"""


@query("op10_ball_tree_top_k", _TOP_K_SQL)
def op10_ball_tree_top_k(spark, sf_dir):
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double"))
    rows = table(spark, sf_dir, "embeddings").where(topk.valid(F.col("embedding")))
    rows = rows.select("vec_id", whole.alias("vector"))
    return topk.top_k(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


# --- 11: Merkle dataset manifest

_LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _merkle_sql(levels: int = 14, group_levels: int = 6) -> str:
    """Levels are written out one by one; so many hold 3 ** levels rows a source and sources."""

    def framed(column: str) -> str:
        text = f"cast({column} AS varchar)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(c) for c in [*_LEAF_COLUMNS[:4], text]) + ")"

    def trees(n: str, s: str, x: str, top: int) -> list[str]:
        parts = []
        for k in range(top):
            parts += [
                f"{n}{k + 1} AS MATERIALIZED (SELECT g, p // 3 AS p, sha256(string_agg(h, '' ORDER BY p)) "
                f"AS h, (w + 2) // 3 AS w FROM {n}{k} WHERE w > 1 GROUP BY g, p // 3, w)",
                f"{s}{k} AS (SELECT g, p, coalesce(string_agg(h, '') OVER (PARTITION BY g, p // 3 "
                "ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
                "coalesce(string_agg(h, '') OVER (PARTITION BY g, p // 3 ORDER BY p ROWS BETWEEN "
                f"1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {n}{k} WHERE w > 1)",
                f"{x}{k + 1} AS (SELECT r, g, p // 3 AS p, CASE WHEN b IS NULL THEN f ELSE "
                f"sha256(b || f || a) END AS f, proof || coalesce(b || a, '') AS proof "
                f"FROM {x}{k} LEFT JOIN {s}{k} USING (g, p))",
            ]
        return parts

    def ends(n: str, top: int) -> str:
        return " UNION ALL ".join(f"SELECT g, h FROM {n}{k} WHERE w = 1" for k in range(top + 1))

    joined = "replace(text, chr(10), '')"
    crc = (
        "xor(list_reduce(list_transform(string_split(cast(doc_id AS varchar), ''), "
        "lambda c: cast(ascii(c) AS bigint)), lambda x, y: list_reduce(range(8), lambda v, i: "
        "CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(x, y)), "
        "4294967295), 4294967295)"
    )
    return ", ".join(
        [
            "WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, source, doc_id, "
            f"{leaf('text')} AS leaf, CASE WHEN {crc} % 2 = 0 THEN "
            f"{leaf(joined)} ELSE {leaf('text')} END AS told "
            "FROM documents)",
            "l AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, "
            "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, "
            "count(*) OVER (PARTITION BY source) AS w FROM t)",
            "n0 AS (SELECT g, p, leaf AS h, w FROM l)",
            "x0 AS (SELECT r, g, p, told AS f, '' AS proof FROM l)",
            *trees("n", "s", "x", levels),
            f"sub AS MATERIALIZED ({ends('n', levels)})",
            "m0 AS (SELECT 0 AS g, g AS p, h, count(*) OVER () AS w FROM sub)",
            f"y0 AS (SELECT r, 0 AS g, g AS p, f, proof FROM x{levels})",
            *trees("m", "u", "y", group_levels),
            f"top AS ({ends('m', group_levels)})",
        ]
    ) + (
        " SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(y.proof) AS proof_sha256, "
        "y.f AS folded_root, y.f = top.h AS verified "
        f"FROM l JOIN y{group_levels} y USING (r) JOIN sub ON sub.g = l.g CROSS JOIN top"
    )


@query("op11_merkle_manifest", _merkle_sql())
def op11_merkle_manifest(spark, sf_dir):
    """Rows whose id has an even checksum are told without their line breaks, and so found out."""
    docs = table(spark, sf_dir, "documents")
    first, text = [F.col(c) for c in _LEAF_COLUMNS[:4]], F.col("text")
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    told = F.when(even, merkle.leaf(*first, F.replace(text, F.lit("\n"), F.lit(""))))
    rows = docs.select("doc_id", "source", merkle.leaf(*first, text).alias("leaf"), told.alias("told"))
    made = merkle.manifest(rows, F.col("leaf"), group="source", order=["doc_id"])
    folded = merkle.fold(F.coalesce("row.told", "leaf"), F.col("path"))
    return made.leaves.select(
        "row.doc_id",
        "leaf",
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# --- 12: ranked lexical search

_SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) AS n_all, cast(sum(len(w)) AS hugeint) AS length FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT r, doc_id, cast(100 - 90 + (90 * cast(len(w) AS hugeint) * n_all) // length AS bigint)
        AS m FROM d, s WHERE len(w) > 0),
q AS (SELECT DISTINCT i, item_id, unnest(w) AS term FROM i),
f AS (SELECT i, item_id, r, doc_id,
    cast(sum(cast(floor(1000 * ln((2.0::double * n_all + 2) / (2 * df + 1))) AS bigint)
      * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS bigint) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (r), s GROUP BY ALL)
SELECT item_id, cast(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS int) AS rank,
  doc_id, score FROM f WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_pair_maxscore", _SEARCH_SQL)
def op12_pair_maxscore(spark, sf_dir):
    return maxscore.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10
    )


# --- 13: language identification


@query("op13_cross_parsing")
def op13_cross_parsing(spark, sf_dir):
    return language.predict(table(spark, sf_dir, "documents"))
