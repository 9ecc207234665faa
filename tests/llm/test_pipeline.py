"""The pipeline's stages on rows with null and repeated ids, held against plain versions."""

import collections
import random
import zlib

import corpus_pipeline
from abonara.llm import mixing


def test_decisions_hold_for_their_own_row(spark, tmp_path):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    copied, repeated, leaked = say(50), say(60), say(40)
    good = [say(rng.randint(25, 90)) for _ in range(30)]
    rows = [(None if k % 2 else k, t) for k, t in enumerate(good)]
    rows += [(None, "too short"), (None, say(20) + " " + leaked), (None, copied), (None, copied), (900, copied)]
    rows += [(700, repeated), (700, repeated), (800, say(45)), (800, "short too")]
    rows = [(i, t, "ab"[k % 2]) for k, (i, t) in enumerate(rows)]
    for name, data, schema in (("documents", rows, "doc_id int, text string, source string"), ("labels", [], "doc_id int, quality int"),
                               ("benchmark", [(1, leaked)], "item_id int, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    pairs = lambda df: collections.Counter((r.doc_id, r.text) for r in df.collect())
    want = collections.Counter((i, t) for i, t, _ in rows if len(t.split()) >= 20)
    docs = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert pairs(docs) == want
    for pair in ((None, copied), (700, repeated)):
        want[pair] -= 1
    want -= collections.Counter({(None, copied): 1})  # the copy with an id stays
    docs = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert pairs(docs) == want
    want = collections.Counter({p: n for p, n in want.items() if leaked not in p[1]})
    docs = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert pairs(docs) == want and set(want.values()) == {1}
    own, goal = collections.Counter(), {}
    for r in mixing.copies(docs, keep=("text",)).collect():
        own[r.source] += r.taken
        goal[r.source] = r.target
    mix = corpus_pipeline.source_mix(spark, docs, str(tmp_path))
    taken, again = (mix.collect() for _ in range(2))
    assert mix.columns == ["doc_id", "text", "source"] and sorted(map(str, taken)) == sorted(map(str, again))
    got = collections.Counter()
    for r in taken:
        got[r.source] += len(r.text.split())
    assert got == own and all(abs(got[s] - goal[s]) <= 90 for s in goal)
    shards = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(r.text_crc32 for r in shards) == collections.Counter(zlib.crc32(r.text.encode()) for r in taken)


def _tables(spark, folder, rows, schema):
    for name, data, columns in (("documents", rows, schema), ("labels", [], "doc_id int, quality int"),
                                ("benchmark", [], "item_id int, text string")):
        spark.createDataFrame(data, columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_empty_tables_give_no_rows(spark, tmp_path):
    folder = _tables(spark, tmp_path, [], "doc_id int, text string, source string")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_null_and_empty_texts_and_clashing_columns(spark, tmp_path):
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    texts = [say(30) for _ in range(12)]
    bad = "short"
    rows = [(k, t, "ab"[k % 2], k % 3, "x", k) for k, t in enumerate(texts)]
    # The same id with a rejected text, and the same value in columns that stages use for themselves.
    rows += [(0, bad, "a", 0, "x", 0), (1, None, None, 1, "x", 1), (2, "", "b", 2, "x", 2), (3, " \n ", "b", 0, "x", 3)]
    folder = _tables(spark, tmp_path, rows, "doc_id int, text string, source string, pipeline_row int, body string, component_id int")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, folder)
    assert sorted(r.text for r in kept.collect()) == sorted(texts)
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.decontamination):
        kept = stage(spark, kept, folder)
        assert sorted((r.doc_id, r.text, r.pipeline_row, r.component_id) for r in kept.collect()) == sorted(
            (k, t, p, c) for k, t, _, p, _, c in rows if t in texts)
    mix = corpus_pipeline.source_mix(spark, kept, folder)
    assert mix.columns == docs.columns and {r.text for r in mix.collect()} <= set(texts)
    assert corpus_pipeline.run(spark, folder).count() == mix.count()
