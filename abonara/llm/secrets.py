"""Secret scans through an incremental blob ledger, in DataFrame functions only.

Every version of every document is content-addressed: its blob is the SHA-256 of its text. The
ledger names the (blob, rule, rule version) pairs that have been scanned. Only unseen pairs are
scanned, once for all copies and versions; stored and new findings are joined back to every path
that holds the blob. Matches of a blob are extracted and the pieces between them split off; a running
sum of their lengths gives code-point spans.

Nulls and empty texts are the empty blob and have no findings. A null id keeps its row. Repeated
documents share one scan and keep a row each. Very long texts take time in proportion to their
length and findings. Empty tables give empty results; other columns of the documents are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``pattern`` matches leftmost and without overlap; a match is a finding when its ``part``
    (a group of the pattern; None: all of the match) has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    part: int | None
    least: int


#: Keywords in either case, spelled out so that only A-Z and a-z count as letters.
KEYWORDS = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
            "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])")
RULES = (
    # Version 1 also counted an unquoted '=' and the keyword before it as part of the value.
    Rule("assign", 3, KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]+", None, 18),
    # A run of hexadecimal digits is matched whole, so asking for 16 here finds the same spans.
    Rule("hex", 1, "[0-9a-f]{16,}", None, 16),
)
LEDGER = "blob string, rule string, rule_version int"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def lengths_of(text: Column, rule: Rule) -> Column:
    """Per match, in order: code points of the text before it since the last match, of the match, and whether it is a finding.

    Matches and the pieces between them are taken once per text and walked side by side.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    # There is one piece more than matches; its match is null.
    return F.zip_with(pieces, found, lambda piece, match: F.struct(
        F.length(piece).alias("gap"), F.length(match).alias("size"), _least(match, rule).alias("kept")))


def with_spans(found: DataFrame) -> DataFrame:
    """(blob, rule, rule_version, lengths) to spans (start, end): a running sum along the matches of a text.

    The time is in proportion to the matches, however many a text has. Rows of one blob are already
    together, so nothing is shuffled again.
    """
    rows = found.select("blob", "rule", "rule_version", F.posexplode_outer("lengths").alias("place", "m"))
    along = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(along)
    placed = rows.select("blob", "rule", "rule_version", "m.kept", (end - F.col("m.size")).cast("int").alias("start"), end.cast("int").alias("end"))
    span = F.when(F.col("kept"), F.struct("start", "end"))
    return placed.groupBy("blob", "rule", "rule_version").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _least(match: Column, rule: Rule) -> Column:
    part = match if rule.part is None else F.regexp_extract(match, rule.pattern, rule.part)
    return F.length(part) >= rule.least


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per path and version: id, blob, text."""
    return docs.select(docs[id_col].alias("doc_id"), blob_of(docs[text_col]).alias("blob"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("body"))


def scan(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of the unseen pairs: blob, rule, rule_version, spans (empty when nothing is found).

    One text per blob is read, that of the smallest id. With a ledger, a blob seen under all rules
    is not read at all; else each rule keeps the blobs that it has not seen. The result is what
    is to be added to the ledger and to the findings.
    """
    one = paths.groupBy("blob").agg(F.min("doc_id").alias("first_id"))
    pair = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    todo = one.withColumn("todo", pair)
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "rule_version")).alias("seen"))
        todo = (todo.join(seen, "blob", "left")
                .withColumn("todo", F.array_except("todo", F.coalesce("seen", F.array().cast(
                    "array<struct<rule:string,rule_version:int>>")))).drop("seen"))
    todo = todo.where(F.size("todo") > 0).select(F.col("blob").alias("b"), "first_id", "todo")
    unread = paths.join(todo.hint("shuffle_hash"), (F.col("blob") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    each = F.array(*[
        F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"),
                 F.when(F.array_contains(F.col("todo.rule"), r.kind), lengths_of(F.col("body"), r)).alias("lengths"))
        for r in rules])
    found = unread.select("blob", F.filter(each, lambda x: x["lengths"].isNotNull()).alias("found"))
    # Rows with the same id and the same text are the same scan.
    found = found.groupBy("blob").agg(F.first("found").alias("found"))
    return with_spans(found.select("blob", F.inline("found")))


def ledger_of(findings: DataFrame) -> DataFrame:
    return findings.select("blob", "rule", "rule_version").distinct()


def findings_by_path(paths: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per path and version: spans of each rule, under its version, as an array column named by its kind."""
    per_blob = findings.groupBy("blob").agg(*[
        F.first(F.when((F.col("rule") == r.kind) & (F.col("rule_version") == r.version), F.col("spans")), ignorenulls=True).alias(r.kind) for r in rules])
    return paths.select("doc_id", "blob").join(per_blob, "blob", "left")


def spans_text(kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then by the order of the kinds, comma-joined."""
    def named(rank: int, kind: str) -> Column:
        return F.transform(F.coalesce(F.col(kind), F.array().cast("array<struct<start:int,end:int>>")), lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("name")))

    parts = [named(rank, kind) for rank, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.sort_array(F.concat(*parts)), lambda x: x["name"]), ",")


def report(docs: DataFrame, stored: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of findings of each base rule, their digest, and all spans.

    ``stored``: the results of earlier scans. Their pairs are the ledger and are not scanned again;
    their findings are reported beside the new ones.
    """
    paths = versions(docs, id_col, text_col)
    found = scan(paths, None if stored is None else ledger_of(stored), rules)
    if stored is not None:
        found = stored.select("blob", "rule", "rule_version", "spans").unionByName(found)
    each = findings_by_path(paths, found, rules)
    base = [r.kind for r in RULES]
    counts = [F.when(F.col(k).isNull(), F.lit(0)).otherwise(F.size(k)).cast("long").alias(f"n_{k}") for k in base]
    return each.select("doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                       spans_text([r.kind for r in rules]).alias("spans"))
