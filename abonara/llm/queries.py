"""Registered queries of the operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abonara.llm import (decontam, lm, merkle, minhash, mixing, quality, secrets, shards, suffixes, tokens, toxicity, tries,
                         winnow)
from abonara.llm.common import ascii_lower, crc
from abonara.session import tune


def _spans_sql(kind: str, pattern: str, keep: str) -> str:
    """Spans of one kind, by lengths of the pieces between matches."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, pieces_len + len_before AS s, pieces_len + len_before + length(m) AS e FROM (
    SELECT doc_id, m, k, coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS len_before,
           sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS pieces_len
    FROM (SELECT doc_id, unnest(ms) AS m, unnest(string_split_regex(body, '{pattern}')[1:len(ms)]) AS piece,
                 unnest(range(len(ms))) AS k
          FROM (SELECT doc_id, body, regexp_extract_all(body, '{pattern}') AS ms FROM d)))
  WHERE {keep}"""


SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
found AS ({_spans_sql("assign", secrets.RULES[0].pattern.replace("'", "''"), "length(regexp_extract(m, '" + secrets.RULES[0].pattern.replace("'", "''") + "', 2)) >= 12")}
  UNION ALL {_spans_sql("access", "AKIA[A-Z0-9]+", "length(m) >= 18")}
  UNION ALL {_spans_sql("hex", "[0-9a-f]+", "length(m) >= 16")}),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END) AS spans
        FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""


def _crc_sql(value: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    mixed = f"CASE WHEN k % 8 = 0 THEN xor(a, ascii(({value})[(k // 8 + 1)::INT])::BIGINT) ELSE a END"
    step = f"CASE WHEN ({mixed}) & 1 = 1 THEN xor(({mixed}) >> 1, 3988292384::BIGINT) ELSE ({mixed}) >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], range(8 * length({value}))), lambda a, k: {step}), 4294967295::BIGINT)"


TRIE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc_sql("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place <= c.h
      UNION ALL SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, text,
        md5(role || '|' || md5(text)) AS turn FROM r),
p AS (SELECT conv_id, depth, len(string_split_regex(text, '[^\x20\x09-\x0D]+')) - 1 AS words,
        string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM d
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM m GROUP BY depth, path),
k AS (SELECT n.*, u.conv_id AS parent_conv_id,
        (SELECT count(*) FROM n AS b WHERE b.depth = n.depth + 1 AND left(b.path, length(n.path)) = n.path) AS n_children
      FROM n LEFT JOIN n AS u ON u.depth = n.depth - 1 AND u.path = left(n.path, length(n.path) - 32)),
-- Every node beside the nodes above it and itself, by the pieces of its path.
a AS (SELECT conv_id, depth, n_convs, words, n_children, path, unnest(range(0, depth + 1)) AS up FROM k),
s AS (SELECT up AS depth, left(path, 32 * up) AS path, count(*) FILTER (n_children = 0) AS n_leaves,
        sum((n_convs - 1) * words) AS saved_tokens FROM a GROUP BY 1, 2)
SELECT k.conv_id::BIGINT AS conv_id, k.depth::BIGINT AS depth, k.parent_conv_id, k.n_convs::BIGINT AS n_convs,
  k.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM k JOIN s USING (depth, path)"""


def _merkle_sql(levels: int = 10) -> str:
    """Level by level; ``levels`` of the groups' trees and of the upper tree, 8^10 leaves each."""
    piece = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(piece(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {text})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"h AS (SELECT doc_id, lang, {leaf(piece('text'))} AS leaf, CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 3 = 0 "
             f"THEN {leaf(piece(lower))} ELSE {leaf(piece('text'))} END AS seen FROM documents)",
             "w AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
             "count(*) OVER (PARTITION BY lang) AS alive FROM h)",
             "n0 AS (SELECT lang, i, alive, leaf AS d FROM w)"]
    for name, after in (("n", "t"), ("t", "root")):
        parts += [f"{name}{k + 1} AS (SELECT lang, i // 8 AS i, (alive + 7) // 8 AS alive, sha256(string_agg(d, '' ORDER BY i)) AS d "
                  f"FROM {name}{k} WHERE alive > 1 GROUP BY lang, i // 8, alive)" for k in range(levels)]
        tops = " UNION ALL ".join(f"SELECT lang, d FROM {name}{k} WHERE alive = 1" for k in range(levels + 1))
        parts.append(f"{name}top AS ({tops})")
        if name == "n":
            parts.append("o AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS alive FROM ntop)")
            parts.append("t0 AS (SELECT 0 AS lang, i, alive, subroot AS d FROM o)")
        parts += [f"s{name}{k} AS (SELECT lang, i, coalesce(string_agg(d, '') OVER (PARTITION BY lang, i // 8 ORDER BY i ROWS BETWEEN "
                  f"UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(d, '') OVER (PARTITION BY lang, i // 8 ORDER BY i "
                  f"ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE alive > 1)" for k in range(levels)]
    parts.append("f0 AS (SELECT doc_id, lang, i, leaf, seen AS f, '' AS proof FROM w)")
    step = ("f{b} AS (SELECT doc_id, f.{g}, {keep} f.i // 8 AS i, leaf, CASE WHEN s.i IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, "
            "CASE WHEN s.i IS NULL THEN proof ELSE proof || s.l || s.r END AS proof FROM f{a} AS f LEFT JOIN s{n}{k} AS s "
            "ON {on} AND f.i = s.i)")
    parts += [step.format(a=k, b=k + 1, g="lang", keep="", n="n", k=k, on="f.lang IS NOT DISTINCT FROM s.lang") for k in range(levels)]
    parts.append(f"fu0 AS (SELECT doc_id, subroot, o.i, leaf, f, proof FROM f{levels} AS f JOIN o ON f.lang IS NOT DISTINCT FROM o.lang)")
    parts += [step.format(a=f"u{k}", b=f"u{k + 1}", g="subroot", keep="", n="t", k=k, on="true") for k in range(levels)]
    return ("WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root, "
            f"f = d AS verified FROM fu{levels}, ttop")



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Whole texts travel to Python: smaller batches bound a worker's memory.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_spans(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shards(table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    chosen = mixing.copies(table(spark, folder, "documents"))
    return chosen.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, convs = tries.turns_of(table(spark, folder, "conversations"))
    conv = F.col("conv_id")
    return tries.trie(*tries.rebuilt(turns, convs, fork=crc(conv) % 4, base=conv - conv % 20, most=3))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.neighbours(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle.verified(docs, crc(docs["doc_id"]) % 3 == 0, {"text": ascii_lower(docs["text"])})


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_suffix_dedup, op3_secret_scan, op4_sharding, op5_toxicity, op6_lm_scores, op7_token_counts, op8_decontamination, op9_quality_rules, op10_mixing,
    op11_prefix_trie, op12_fingerprints, op13_merkle_manifest)}
SQL: dict[str, str] = {"op3_secret_scan": SECRETS_SQL, "op11_prefix_trie": TRIE_SQL, "op13_merkle_manifest": _merkle_sql()}
