"""Every stage of the pipeline against brute force on its own input, and the whole run against the stages."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import brute_contamination, brute_groups, empty, filled, odd
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm import mixing, quality
from marlstone.llm.common import remainder, shared_folder, written

ROWS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*ROWS).collect()]


@pytest.fixture(scope="module")
def steps(spark, small):
    """Each stage's input and its result, written and read again."""
    docs, found = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, small), shared_folder(spark), "out")
        found[name] = docs, out
        docs = out
    return found


def test_quality_stage(spark, small, steps):
    before, after = steps["quality classifier"]
    model = quality.train(before, spark.read.parquet(f"{small}/labels.parquet"), condition=remainder(F.col("doc_id"), 5) != 0)
    whole = rows_of(before)
    scores = model.predict(np.array([quality.statistics((r[1] or "").encode()) for r in whole]))
    assert Counter(rows_of(after)) == Counter(r for r, s in zip(whole, scores, strict=True) if s >= 0.3)


def test_near_duplicate_stage(steps):
    before, after = steps["n-gram Jaccard join"]
    whole = rows_of(before)
    stay = {d for d, _, c in brute_groups([r[:2] for r in whole], 5, 80) if d == c}
    assert Counter(rows_of(after)) == Counter(r for r in whole if str(r[0]) in stay)


def test_near_duplicates_by_row(spark, small):
    """Ids that are null or repeated drop no unrelated text; copies go whatever their ids; texts without words all stay."""
    text = lambda k: " ".join(f"{k}{i}" for i in range(30))
    rows = [
        (1, text("a"), "keep"), (None, text("b"), "keep"), (None, text("a") + " more", "copy"), (5, text("c"), "keep"), (5, text("d"), "keep"), (7, text("c"), "copy"), (None, text("b"), "same"),
        (8, text("e"), "keep"), (8, text("e"), "same"), (9, "", "keep"), (9, "", "keep"), (None, None, "keep"), (10, text("d").replace("d29", "x"), "copy"), (0, text("f"), "keep"), (None, text("f"), "copy"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()
    got = Counter((r["doc_id"], r["text"]) for r in kept)
    assert got == Counter(dict.fromkeys(((d, t) for d, t, n in rows if n == "keep"), 1)) + Counter([(9, "")])


def test_columns_of_any_name(spark, small):
    """Names that stages use inside, dotted and quoted ones, pass through every stage."""
    names = ["_quality_score", "_s_bytes", "k0", "t", "d", "h", "c0", "_key", "_copy", "row", "stays", "a.b", "x`y", "label", "_d"]
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60).select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(list(r)[len(ROWS) :] == list(range(len(names))) for r in rows)


def test_benchmark_stage(spark, small, steps):
    before, after = steps["benchmark decontamination"]
    whole = rows_of(before)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    gone = {d for d, *_, bad in brute_contamination([r[:2] for r in whole], items) if bad}
    assert Counter(rows_of(after)) == Counter(r for r in whole if r[0] not in gone)


def test_mixing_stage(steps):
    before, after = steps["mixing sources to target weights"]
    sizes, source_sizes, taken = {}, defaultdict(int), defaultdict(int)
    for r in rows_of(before):
        sizes[r] = len((r[1] or "").split())
        source_sizes[r[3]] += sizes[r]
    drawn = Counter(rows_of(after))
    assert set(drawn) <= set(sizes) and max(drawn.values()) <= 2
    for r, n in drawn.items():
        taken[r[3]] += n * sizes[r]
    for source, target in filled(source_sizes).items():
        largest = max(n for r, n in sizes.items() if r[3] == source)
        assert abs(taken[source] - target) <= 2 * largest + 0.1 * target


def test_token_stage_and_run(spark, small, steps):
    before, after = steps["token-ID / binary output"]
    encoder = Tokenizer.from_file(str(corpus_pipeline.TOKENIZER))
    want, start = [], 0
    for r in sorted(rows_of(before)):
        ids = encoder.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, after.select(*columns).collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).select(*columns).collect())) == want


def test_repeated_rows_share_their_draws(spark, monkeypatch):
    """A row that stands there very often; its copies are emitted in parts."""
    monkeypatch.setattr(mixing, "EMITTED", 7)
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 90 + [(1, "a b d", "en", "s", 5), (2, "x y", "en", "t", 3), (None, None, None, None, None)], ", ".join(f"{c} {t}" for c, t in zip(ROWS, ("long", "string", "string", "string", "long"), strict=True)))
    decided = mixing.mix_decisions(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0").collect()
    assert dict(Counter(r[0] for r in rows_of(mixing.mix(docs)))) == {r["doc_id"]: r["n"] for r in decided}


def test_odd_input(spark, small):
    for docs in (odd(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns
            docs = written(out, shared_folder(spark), "out")
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
