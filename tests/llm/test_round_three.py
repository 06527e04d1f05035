"""Clustering, the BPE transducer and the divergence audit, against brute force."""

import hashlib
import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marlstone.llm import bpe, divergence, drake, queries
from marlstone.llm.common import open_shared

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


# Shared folder


@pytest.mark.parametrize(
    ("uri", "kind", "path"),
    [("file:///a/b", "LocalFileSystem", "/a/b"), ("/a/b", "LocalFileSystem", "/a/b"), ("dbfs:/a/b", "LocalFileSystem", "/dbfs/a/b"), ("s3a://bucket/a", "S3FileSystem", "bucket/a"), ("s3n://bucket/a", "S3FileSystem", "bucket/a"), ("wasbs://c@account.blob.core.windows.net/a", "AzureFileSystem", "c/a")],
)
def test_stores(monkeypatch, uri, kind, path):
    """Stores by their names in Hadoop; nothing is read, so no network is needed."""
    monkeypatch.setenv("AWS_DEFAULT_REGION", "us-east-1")
    monkeypatch.setenv("AWS_EC2_METADATA_DISABLED", "true")
    found, where = open_shared(f"{uri}?region=us-east-1" if uri.startswith("s3") else uri)
    assert type(found).__name__ == kind and where == path
    with pytest.raises(pa.ArrowInvalid):
        open_shared("nothing://a/b")


# Clustering


def kept(rows, dimensions, scale):
    out = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x):
            out.append((vec_id, tuple(math.floor(max(-(2.0**62), min(2.0**62, scale * v))) for v in x)))
    return out


def brute_clusters(rows, k, rounds, dimensions, scale):
    """Every vector measured in every round, with whole numbers."""
    vectors = kept(rows, dimensions, scale)
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(x) for _, x in sorted(vectors, key=key)[:k]]
    distance = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min(range(len(centroids)), key=lambda c: (distance(x, centroids[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in vectors:
            groups[nearest(x)].append(x)
        for c, xs in groups.items():
            centroids[c] = [sum(v) // len(xs) for v in zip(*xs, strict=True)]
    cut = lambda n: min(n, 2**63 - 1)
    found = [(i, nearest(x), cut(distance(x, centroids[nearest(x)]))) for i, x in vectors]
    within = Counter()
    for _, c, d in found:
        within[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, cut(within[c]), cut(sum(within.values())), sha[c]) for i, c, d in found), key=str)


def clustered(df, **options):
    rows = drake.cluster_report(df, **options).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize(("seed", "k", "dimensions", "spread"), [(1, 8, 4, 1.0), (2, 13, 3, 0.01), (3, 3, 2, 30.0), (4, 30, 5, 1.0)])
def test_clusters(spark, seed, k, dimensions, spread):
    """Random vectors with ties, copies and vectors that do not count; several numbers of centroids, so of bounds."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-spread, spread) for _ in range(dimensions)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, spread / 4) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(400 + i, [float(rng.randrange(-2, 3)) * spread for _ in range(dimensions)]) for i in range(60)]  # a grid: ties
    rows += [(500, rows[0][1]), (500, rows[0][1]), (None, rows[1][1]), (None, [0.0] * dimensions), (1, rows[2][1])]
    rows += [(600, None), (601, []), (602, [0.0] * (dimensions + 1)), (603, [None] + [0.0] * (dimensions - 1)), (604, [float("nan")] * dimensions), (605, [float("inf")] + [0.0] * (dimensions - 1)), (606, [-0.0] * dimensions)]
    rows = [(i, x if x is None else [v if v is None else float(np.float32(v)) for v in x]) for i, x in rows]
    df = spark.createDataFrame([(i, x, "c") for i, x in rows], "vec_id long, embedding array<float>, cluster string").repartition(5)
    assert clustered(df, k=k, rounds=6, dimensions=dimensions, scale=64) == brute_clusters(rows, k, 6, dimensions, 64)


def test_large_and_few_vectors(spark):
    """Numbers beyond 32 and 64 bits, fewer vectors than centroids, one vector, none."""
    rng = random.Random(6)
    for size in (2.0**12, 2.0**20, 2.0**30, 3e38):
        rows = [(i, [float(np.float32(rng.uniform(-size, size))) for _ in range(3)]) for i in range(40)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
        assert clustered(df, k=4, rounds=3, dimensions=3) == brute_clusters(rows, 4, 3, 3, 1024)
    for n in (3, 1, 0):
        df = spark.createDataFrame(rows[:n], "vec_id long, embedding array<float>")
        assert clustered(df, k=8, rounds=2, dimensions=3) == brute_clusters(rows[:n], 8, 2, 3, 1024)


def test_bounds_hold_and_save_work():
    """After every move the assignment is that of measuring all, every bound holds, and most vectors are not measured again."""
    rng = np.random.default_rng(3)
    centroids = rng.integers(-1000, 1000, (12, 6))
    x = (centroids[rng.integers(0, 12, 3000)] + rng.normal(0, 60, (3000, 6))).astype(np.int32)
    first = drake.Bounds(drake.Measure(centroids.tolist(), 1000), None, 3)
    near, upper, lower = first.first(first.measure.prepared(x))
    bounds, skipped = 3, []
    for step in range(8):
        old, centroids = centroids, centroids + rng.integers(-20, 21, centroids.shape) // (step + 1)
        moved = [float(np.sqrt(((a - b) ** 2).sum())) * (1 + drake.MARGIN) for a, b in zip(old, centroids, strict=True)]
        bounds = max(1, bounds - (step == 4))
        turn = drake.Bounds(drake.Measure(centroids.tolist(), 2000), moved, bounds)
        measured = []
        some, full = turn.measure.some, turn.measure.all
        turn.measure.some = lambda x, which: (measured.append(len(x)), some(x, which))[1]  # noqa: B023
        turn.measure.all = lambda x: (measured.append(len(x)), full(x))[1]  # noqa: B023
        near, upper, lower, _ = turn.next(x, near, upper, lower)
        exact = ((x[:, None, :].astype(np.int64) - centroids[None]) ** 2).sum(axis=2)
        assert (near[:, 0] == exact.argmin(axis=1)).all() and near.shape[1] == bounds + 1 and lower.shape[1] == bounds + 1
        d = np.sqrt(exact)
        rows = np.arange(len(x))
        assert (upper >= d[rows, near[:, 0]]).all()
        for z in range(bounds):
            assert (lower[:, z] <= d[rows, near[:, z + 1]]).all()
        rest = d.copy()
        np.put_along_axis(rest, near, np.inf, axis=1)
        assert (lower[:, -1] <= rest.min(axis=1)).all()
        skipped.append(1 - sum(measured) / len(x))
    assert min(skipped[1:]) > 0.5


# BPE


@pytest.fixture(scope="module", params=[WORDS, BYTES], ids=["words", "bytes"])
def vocabulary(request):
    settings = open(request.param, "rb").read()
    return request.param, settings, Tokenizer.from_str(settings.decode())


def random_texts(rng):
    texts = ["", " ", "abc", "<|endoftext|>x<|startoftext|> y<|endoftext|>", "É́Á ǅ İstanbul ΣΑΣ ﬁ   x y z", "a" * 9000, "ab" * 7000, "퟿🙂é" * 800, "!" * 6000, "1234 5.6", "don't I'LL we're", "\x00\x85\x1c", "́a", "﻿"]
    for n in (1, 7, 60, 9000):
        texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(n)), "".join(rng.choice(["the", "ing", "er", "é", "ß", " ", "Z", "9", ",,", "日本", "\n", "\t"]) for _ in range(n))]
        texts.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x300, 0x370), rng.randrange(0x400, 0x3000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(n)))
    return texts


def test_encoding_is_the_librarys(spark, vocabulary):
    path, _, library = vocabulary
    texts = random_texts(random.Random(11))
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(0, texts[3], None, 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, t int").repartition(3)
    coded = bpe.encode(df, path, ids_col="n.`s")
    assert coded.columns == ["doc_id", "ids", "t", "n.`s"]
    got = bpe.decode(coded, path, ids_col="n.`s").collect()
    want = Counter()
    for i, t, x, n in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, x, n, tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r["doc_id"], r["ids"], r["t"], tuple(r["n.`s"]), r["text"]) for r in got) == want
    empty = spark.createDataFrame([], df.schema)
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0
    assert [r["text"] for r in bpe.decode(spark.createDataFrame([(None,), ([],), ([None, 999_999, -1],)], "ids array<int>"), path).collect()] == ["", "", ""]


def test_query_against_the_library(spark, small):
    library = Tokenizer.from_file(WORDS)
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op12_bpe_transducer(spark, small).collect():
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_transducer_emits_what_is_stable(vocabulary):
    """Parts of any size give the tokens of the whole, and no more than a window is held."""
    _, settings, _ = vocabulary
    merges, rng = bpe.Merges(json.loads(settings)["model"]), random.Random(4)
    for alphabet in ("etaoin", "a", "ab", "thequickbrownfox"):
        piece = "".join(rng.choice(alphabet) for _ in range(12_000))
        whole = merges.merged(merges.symbols(piece, ends=True))
        machine, out, at = bpe.Transducer(merges, 0), [], 0
        assert machine.window < 3000
        while at < len(piece):
            n = rng.choice([1, 7, 500, 4000])
            out += machine.feed(piece[at : at + n])
            at += n
            assert len(machine.held) <= 2 * machine.window
        assert len(out) > len(whole) / 2 and out + machine.end() == whole and machine.held == ""


def random_merges(rng, letters, n, suffix):
    """A merge list over few letters: each merge joins two tokens that are there."""
    tokens = [*letters, *(x + suffix for x in letters if suffix)]
    pairs = []
    while len(pairs) < n:
        u, v = rng.choice([t for t in tokens if not suffix or not t.endswith(suffix)]), rng.choice(tokens)
        if u + v not in tokens and len(u + v) < 9:
            pairs.append([u, v])
            tokens.append(u + v)
    return {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": pairs, "end_of_word_suffix": suffix or None}


@pytest.mark.parametrize("suffix", ["", "$"])
def test_lookahead_is_sufficient(suffix):
    """Whatever follows a text, its tokens that end before the lookahead are those of the text alone; and the bound is not idle."""
    rng, different = random.Random(8), 0
    for _ in range(60):
        merges = bpe.Merges(random_merges(rng, "abc", rng.randrange(3, 14), suffix))
        lengths = {i: merges.length(t) for t, i in merges.vocab.items()}
        for _ in range(300):
            text, more = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randrange(1, 40), rng.randrange(1, 20)))
            ends = lambda ids: np.cumsum([0, *(lengths[i] for i in ids)]).tolist()  # noqa: B023, E731
            a, b = ends(merges.merged(merges.symbols(text, ends=False))), ends(merges.merged(merges.symbols(text + more, ends=True)))
            differ = [p for p in range(len(text)) if (p in a) != (p in b)]
            assert all(p > len(text) - merges.lookahead for p in differ)
            different += bool(differ)
        simple = merges.symbols("abcab" * 30, ends=True)
        assert merges.merged(list(simple)) == plain_merged(merges, list(simple))
    assert different > 300
    # A chain in which every symbol of the lookahead is needed: what follows the last one decides on the first.
    merges = bpe.Merges({"type": "BPE", "vocab": {x: i for i, x in enumerate([*"abcde", "ab", "ca", "dc", "ed"])}, "merges": [["a", "b"], ["c", "a"], ["d", "c"], ["e", "d"]], "end_of_word_suffix": None})
    tokens = lambda text: ["abcde"[i] if i < 5 else ["ab", "ca", "dc", "ed"][i - 5] for i in merges.merged(merges.symbols(text, ends=True))]
    assert merges.lookahead == 4 and tokens("eeedca") == ["e", "e", "ed", "ca"] and tokens("eeedcab") == ["e", "e", "e", "dc", "ab"]


def plain_merged(merges, ids):
    """The earliest pair of the list, leftmost first, until there is none."""
    while True:
        found = [(merges.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges.ranks]
        if not found:
            return ids
        rank, i = min(found)
        ids[i : i + 2] = [merges.made[rank]]


def test_refused_vocabularies():
    model = {"type": "BPE", "vocab": {x: i for i, x in enumerate(["a", "b", "c", "ab", "abc"])}, "merges": [["ab", "c"], ["a", "b"]]}
    with pytest.raises(ValueError, match="makes its parts"):
        bpe.Merges(model)
    for extra in ({"unk_token": "a"}, {"dropout": 0.1}, {"byte_fallback": True}, {"type": "Unigram"}):
        with pytest.raises(ValueError, match="plain BPE"):
            bpe.Merges(model | {"merges": []} | extra)
    with pytest.raises(ValueError, match="decoder"):
        bpe.Decoder(json.dumps({"model": model, "decoder": {"type": "Metaspace"}}).encode())


def test_decoder_in_steps(vocabulary):
    """Random ids, of which many are parts of characters, whole and in steps of any size."""
    _, settings, library = vocabulary
    decoder, rng = bpe.Decoder(settings), random.Random(9)
    for _ in range(400):
        ids = np.array([rng.randrange(len(decoder.table) + 3) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randrange(1, 60))])
        want = library.decode(ids.tolist(), skip_special_tokens=False)
        assert decoder.decode(ids) == want
        out, at = "", 0
        while at < len(ids):
            n = rng.randrange(1, 5)
            out += decoder.feed(ids[at : at + n])
            at += n
        assert out + decoder.end() == want


# Divergence


def brute_audit(rows, least, added, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    docs = [(lang or "", source or "", Counter(terms(text))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        having = Counter(t for _, _, c in mine for t in c)
        kept = [t for t, n in having.items() if n >= least]
        share = lambda c: {t: 1 + (divergence.WHOLE * (c[t] + added)) // (sum(c[x] for x in kept) + added * len(kept)) for t in kept}  # noqa: B023, E731
        groups = {s: sum((c for _, x, c in mine if x == s), Counter()) for s in {d[1] for d in mine}}
        p, q = {s: share(c) for s, c in groups.items()}, share(sum((c for *_, c in mine), Counter()))
        for s in groups:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(found[:limit])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 3, 50), (2, 1, 4), (3, 1000, 50)])
def test_audit(spark, seed, least, top):
    """Random documents with ties, groups without terms, nulls, repeated rows and a term that all share."""
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "É", "é", "straße", "naïve", "日本", "𝒳", "x", "don't", "a1b", "ﬀ", "Ω", "ω"]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "Ü", "𝒳", None, "s10"]), " ".join(rng.choices(vocabulary, k=rng.randrange(12)))) for _ in range(150)]
    rows += [("fr", "only", "alpha " * 500), ("it", "s1", None), ("it", "s2", "123 _"), ("pt", "s1", "x"), *[("en", "s1", "Alpha.beta-É")] * 40]
    df = spark.createDataFrame([(*r, "e") for r in rows], "lang string, source string, text string, term string").repartition(4)
    got = divergence.audit(df, least=least, top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, least, divergence.ADDED, top)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_shares_are_exact(spark):
    """Counts of a large corpus: beyond 64 bits when multiplied, beyond 53 when divided."""
    cases = [(10**14 + 7, 3 * 10**14 + 1, 12_345_678), (0, 10**15, 1), (2**52 + 1, 2**53 - 3, 999_999_937), (0, 0, 1), (5, 5, 1)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share(df.c, df.n, df.v)).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in cases]


def test_counts_of_a_batch():
    """Counting in Arrow, with a sliced batch and texts at its ends."""
    texts = ["x", "A a b", None, "", "é É b-b", "  ", "z9z"]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 7), pa.array(["s", "s", "r", "r", "s", "r", "s"]), pa.array(["" if t is None else t for t in texts])], ["lang", "source", "t"]).slice(1)
    got = {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in divergence.counted(batch).to_pylist()}
    assert got == {("l", "s", "a"): (2, 1), ("l", "s", "b"): (3, 2), ("l", "s", "é"): (1, 1), ("l", "s", "É"): (1, 1), ("l", "s", "z"): (2, 1), ("l", "s", ""): (0, 0), ("l", "r", ""): (0, 0)}
