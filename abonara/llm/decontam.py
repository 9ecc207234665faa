"""Benchmark decontamination with one Aho-Corasick automaton over the windows of test items.

Both sides are lower-cased (A-Z) and cut into words of ASCII letters, digits and non-ASCII
characters. A window is ``window`` consecutive words of an item (a shorter item is one window).
The automaton reads each normalised text once; a match is mapped to words and from there to
bytes of the original text.

Broadcast bound: patterns are cut into blocks of ``block_bytes``, each an automaton of its own. An
automaton has at most a node per byte of its patterns, about 45 bytes each, so a worker holds less
than 200 MB of it. A benchmark of one block is matched in one pass without a shuffle. With more
blocks the texts are numbered, every block scans them in tasks of its own, which return only rows
with hits, and the hits of a row are put together; a benchmark of any size is matched whole.

Nulls and empty texts have no words and no hits; a null ``item_id`` takes part but has no name to
list. Repeated items count once per id, repeated documents are judged one by one, an empty table
gives an empty result, and other columns of the documents are not read. A very long text is read
through in one go and is no unit of memory beyond itself.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import NOT_ALNUM, texts, word_spans, written

WINDOW = 13
BLOCK_BYTES = 4_000_000
_TABLE = bytes(32 if NOT_ALNUM[b | 32 if 65 <= b <= 90 else b] else (b | 32 if 65 <= b <= 90 else b)
               for b in range(256))


def normalised(body: bytes) -> list[bytes]:
    return body.translate(_TABLE).split()


def patterns(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int):
    """Blocks of (window, item ids); the rows of the benchmark stream in one by one."""
    block: dict[bytes, set] = defaultdict(set)
    size = 0
    for item, body in texts(benchmark, id_col, text_col).select(F.col("doc_id").cast("string"), "body").toLocalIterator():
        words = normalised(bytes(body))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            key = b" ".join(words[k:k + window])
            size += len(key) if key not in block else 8
            block[key].add(item)
        if size > block_bytes:
            yield dict(block)
            block, size = defaultdict(set), 0
    if block:
        yield dict(block)


def _automaton(block: dict):
    import ahocorasick

    found = ahocorasick.Automaton()
    for key, items in block.items():
        found.add_word(" " + key.decode("latin-1") + " ", (len(key) + 2, tuple(items)))
    found.make_automaton()
    return found


def _scan(body: bytes, automaton):
    """(word ranges, items) of one text; ranges are (first, past the last)."""
    words = normalised(body)
    if not words or automaton is None:
        return len(words), [], set()
    line = " " + b" ".join(words).decode("latin-1") + " "
    found = [(end - size + 1, end, items) for end, (size, items) in automaton.iter(line)]
    if not found:
        return len(words), [], set()
    lead = np.cumsum([0] + [len(w) + 1 for w in words])  # place of the blank before each word
    ranges = [(int(np.searchsorted(lead, a)), int(np.searchsorted(lead, b))) for a, b, _ in found]
    return len(words), ranges, set().union(*(items for *_, items in found))


def _step(handle, last: bool):
    def run(batches):
        automaton = _automaton(handle.value) if handle is not None else None
        for batch in batches:
            out = defaultdict(list)
            before = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for body, (hits, items) in zip(batch.column("body").to_pylist(), before):
                n, ranges, names = _scan(body, automaton)
                hits = [(hits[k], hits[k + 1]) for k in range(0, len(hits), 2)] + ranges
                names = names | set(items)
                if not last:
                    out["keep"].append(bool(hits))
                    out["hits"].append([x for pair in hits for x in pair])
                    out["items"].append(list(names))
                    continue
                merged: list[list[int]] = []
                for a, b in sorted(set(hits)):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                spans = []
                if merged:
                    data = np.frombuffer(body, np.uint8)
                    start, end, _, _ = word_spans(np.frombuffer(body.translate(_TABLE), np.uint8),
                                                  np.array([0, len(data)]))
                    spans = [{"start": int(start[a]), "end": int(end[b - 1])} for a, b in merged]
                ids = sorted(x for x in names if x is not None)
                out["n_words"].append(n)
                out["n_hit"].append(sum(b - a for a, b in merged))
                out["n_items"].append(len(names))
                out["items"].append(ids)
                out["items_sha256"].append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                out["spans"].append(spans)
            if last:
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), **out}, schema=pa.schema(
                        [("doc_id", batch.schema.field("doc_id").type), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                         ("n_items", pa.int64()), ("items", pa.list_(pa.string())), ("items_sha256", pa.string()),
                         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))
            else:
                found = pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(out["hits"], pa.list_(pa.int64())), pa.array(out["items"], pa.list_(pa.string()))],
                    names=["row", "hits", "items"])
                yield found.filter(pa.array(out["keep"], pa.bool_()))
    return run


def _hits_of_blocks(rows: DataFrame, handles: list) -> DataFrame:
    """``rows`` (doc_id, body) with the hits of all blocks. A task scans for one block only."""
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "decontam_texts")
    none = [F.array().cast("array<bigint>").alias("hits"), F.array().cast("array<string>").alias("items")]
    found = None
    for handle in handles:
        one = numbered.select("row", "body", *none).mapInArrow(_step(handle, False), "row long, hits array<bigint>, items array<string>")
        found = one if found is None else found.unionByName(one)
    of_row = found.groupBy("row").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    return numbered.join(of_row, "row", "left").select(
        "doc_id", "body", *[F.coalesce(c, F.array().cast(f"array<{t}>")).alias(c) for c, t in (("hits", "bigint"), ("items", "string"))])


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  share: tuple[int, int] = (1, 20), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, hit words, items, byte spans of the hits, verdict.

    ``contaminated``: hit words are at least ``share`` (numerator, denominator) of all words.
    """
    context = docs.sparkSession.sparkContext
    handles = [context.broadcast(b) for b in patterns(benchmark, item_col, item_text, window, block_bytes)] or [None]
    rows = texts(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]
    if len(handles) > 1:
        rows, handles = _hits_of_blocks(rows, handles), [None]
    else:
        rows = rows.select("doc_id", "body", F.array().cast("array<bigint>").alias("hits"), F.array().cast("array<string>").alias("items"))
    out = rows.mapInArrow(
        _step(handles[0], True),
        f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items array<string>, items_sha256 string, "
        "spans array<struct<start: bigint, end: bigint>>")
    above, below = share
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (below * F.col("n_hit") >= above * F.col("n_words")))
