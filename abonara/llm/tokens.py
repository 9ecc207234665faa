"""Token counts under a unigram segmentation, with dynamic programming shared over a trie.

A pre-token is a word mark followed by a run without ASCII white space. Its token count is that of
the segmentation into vocabulary pieces with the highest sum of piece scores (ties: the longest
last piece). A task inserts its distinct pre-tokens in a trie, whose nodes keep the forward scores:
those of a shared prefix are computed once, and the count at the last node is that of the word. A character that begins no piece scores ten less than
the lowest piece and counts one token per UTF-8 byte.

The scores are those in the given model file, read as a unigram model; nothing is trained. Counts
of a byte-pair file are therefore those of its best-scoring segmentation, not of its merge order.

Nulls, empty and blank texts have no tokens. Repeated documents are counted one by one, an empty
table gives an empty result, other columns are not read. The counts of ``CACHE`` distinct pre-tokens
and a trie of ``NODES`` nodes are remembered and then begun anew, so counts do not depend on them. A very long
text is many pre-tokens.
"""

from __future__ import annotations

import gc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from abonara.llm.common import texts

MARK = "▁"
CACHE = 400_000
#: Nodes of a task's trie, about 350 bytes each.
NODES = 300_000
UNKNOWN_PENALTY = 10.0
_NO_END = object()
#: Where the file of public vocabularies lies; a parameter of every call.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def vocabulary(model_file: str) -> dict[str, float]:
    """Ordinary pieces and their scores; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {model.id_to_piece(k): model.get_score(k) for k in range(model.get_piece_size())
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))}


class Trie:
    """Pre-tokens by their beginnings; every node keeps its forward score and its token count.

    A node is [score, count, children]. Inserting a word walks the nodes it shares with any word
    before it and computes the rest once. At ``limit`` nodes the trie starts anew.
    """

    def __init__(self, pieces: dict[str, float], limit: int = NODES):
        self.pieces, self.limit = pieces, limit
        # Every end of a piece, with the score of those that are pieces themselves.
        self.ends = {piece[at:]: None for piece in pieces for at in range(len(piece))} | pieces
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.root, self.nodes, self.steps = [0.0, 0, None], 0, 0

    def terminal(self, word: str) -> int:
        """Token count of ``word``."""
        if self.nodes > self.limit:
            self.root, self.nodes = [0.0, 0, None], 0
        node, best, count, pieces, ends = self.root, [0.0], [0], self.pieces, self.ends
        for char in word:
            child = node[2].get(char) if node[2] else None
            if child is None:
                break
            node = child
            best.append(node[0])
            count.append(node[1])
        for end in range(len(best), len(word) + 1):
            char = word[end - 1]
            top, tokens = None, 0
            for start in range(end - 1, -1, -1):
                # Once no piece ends like this, no longer one does.
                score = ends.get(word[start:end], _NO_END)
                if score is _NO_END:
                    break
                if score is not None and (top is None or best[start] + score >= top):
                    top, tokens = best[start] + score, count[start] + 1
            if char not in pieces and (top is None or best[end - 1] + self.unknown > top):
                top, tokens = best[end - 1] + self.unknown, count[end - 1] + len(char.encode("utf-8", "replace"))
            best.append(top)
            count.append(tokens)
            child = [top, tokens, None]
            if node[2] is None:
                node[2] = {}
            node[2][char] = node = child
            self.nodes += 1
            self.steps += 1
        return count[-1]


def _counter(handle):
    def run(batches):
        trie, known = Trie(handle.value), {}
        # The nodes hold no cycles; collecting would only walk them again and again.
        gc.disable()
        try:
            yield from counted(batches, trie, known)
        finally:
            gc.enable()

    def counted(batches, trie, known):
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            out = []
            for first in range(0, len(bodies), 500):
                bags = [Counter(body.split()) for body in bodies[first:first + 500]]
                if len(known) > CACHE:
                    known.clear()
                fresh = {MARK + w.decode("utf-8", "replace"): w for bag in bags for w in bag if w not in known}
                for word, raw in fresh.items():
                    known[raw] = trie.terminal(word)
                for bag in bags:
                    out.append((sum(bag.values()), sum(n * known[w] for w, n in bag.items())))
            sizes = np.array([len(b) for b in bodies], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array([a for a, _ in out], pa.int64()),
                 pa.array([b for _, b in out], pa.int64())], names=["doc_id", "n_bytes", "n_pretokens", "n_tokens"])
    return run


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 model_file: str = MODEL_FILE) -> DataFrame:
    """Per document: n_bytes, n_pretokens, n_tokens. The vocabulary is broadcast: its size is the file's."""
    handle = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file))
    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(_counter(handle), f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes bigint, "
                                             "n_pretokens bigint, n_tokens bigint")
