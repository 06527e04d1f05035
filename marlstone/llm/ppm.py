"""Language-model scores by prediction by partial matching (PPM, method C) over bytes, with symbol exclusion.

A context trie of order 5 is learnt from all training texts: byte 6-grams are counted in every partition and added up by key, and the
shorter contexts are their marginals. A symbol's probability in the longest context that the trie has is count / (total + distinct); the
escape, distinct / (total + distinct), leads to the next shorter context, in which the symbols of the longer one are excluded; below order
0 the remaining byte values are equally likely. The seen sets are nested, so of an excluded context its total, its number of symbols and
the count that the shorter context has of them are enough. Byte 0xFF, which UTF-8 never has, begins and ends each text.

The trie is two tables in the shared folder, of contexts and of their symbols, whatever its size. Contexts of a frequency that keeps
their symbols within GRAMS are read by all workers; if a context is among them, so are the shorter ones, so a place there is scored at once.
The distinct 6-grams at all other places are counted by text and joined with the tables. Scores do not depend on GRAMS.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, in_parts, open_shared, return_memory, shared_dataset, shared_folder, ship_code, utf8_values, written

ORDER = 5
#: Symbols of contexts, of all orders, that all workers read (12 bytes each, and 20 for a context, in a file that the workers of a machine
#: share); the rest of the trie is joined.
GRAMS = 3_000_000
#: Most frequent tokens whose counts all workers read; the counts of all others are joined.
FREQUENT = 100_000
#: Distinct tokens or 6-grams that a worker holds before it passes its counts on.
HELD = 200_000
#: Bytes of text that one step takes.
STEP_BYTES = 600_000

_models: dict[str, object] = {}


def laid_out(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts between edges as one byte array; where each begins, and its number of symbols, the end included."""
    edge = b"\xff" * ORDER
    raw = np.frombuffer(edge + b"".join(v + edge for v in values), np.uint8)
    sizes = np.array([len(v) for v in values], np.int64)
    return raw, ORDER + np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]]).astype(np.int64), sizes + 1


def gram_keys(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 6-gram that ends at each symbol, as a number with the symbol in the lowest byte, and the symbols of each text."""
    raw, starts, sizes = laid_out(values)
    total = int(sizes.sum())
    at = np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    key = np.zeros(len(raw), np.int64)
    for k in range(ORDER, -1, -1):
        key[ORDER:] = (key[ORDER:] << 8) | raw[ORDER - k : len(raw) - k]
    return key[at], sizes


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with counts from parts of such."""
    keys, counts = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def looked_for(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted numbers among sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Trie:
    """Contexts and symbols of a trie, or of its frequent part. contexts: for each order its sorted contexts, their totals, numbers of
    symbols and counts of these in the shorter context; grams: for each order its sorted grams and their counts. whole: whether all of the
    trie is here; if not, each context that is here has all its symbols, and the contexts without its first bytes are here too."""

    def __init__(self, contexts: list[tuple], grams: list[tuple], whole: bool = True):
        self.contexts, self.grams, self.whole = contexts, grams, whole

    def values(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each 6-gram's last byte after the others; NaN where a context is not here but may be in the trie."""
        value = np.zeros(len(keys))
        rest = np.arange(len(keys))  # those that no context has settled
        same, seen = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(ORDER, -1, -1):
            gram = keys[rest] & (256 ** (k + 1) - 1)
            at, there = looked_for(self.contexts[k][0], gram >> 8)
            if not self.whole:
                value[rest[~there]] = np.nan
                rest, gram, at, same, seen, there = (x[there] for x in (rest, gram, at, same, seen, there))
            _, total, distinct, shared = self.contexts[k]
            if not len(total):
                continue
            left = np.where(there, distinct[at] - seen, 0.0)
            room = np.where(there, total[at] - same + left, 1)
            spot, hit = looked_for(self.grams[k][0], gram)
            if len(self.grams[k][1]):
                value[rest[hit]] += np.log10(self.grams[k][1][spot[hit]] / room[hit])
            escape = (left > 0) & ~hit
            value[rest[escape]] += np.log10(left[escape] / room[escape])
            same, seen = np.where(there, shared[at], same), np.where(there, distinct[at], seen)
            rest, same, seen = rest[~hit], same[~hit], seen[~hit]
        value[rest] -= np.log10(256 - seen)
        return value

    def scores(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The log10 probability of each text, its end included, without the places that are not here; of these (text, 6-gram, times)."""
        if not values:
            return np.zeros(0), *(np.zeros(0, np.int64) for _ in range(3))
        keys, sizes = gram_keys(values)
        uniq, where = np.unique(keys, return_inverse=True)
        value = self.values(uniq)
        lost = np.isnan(value)
        score = np.add.reduceat(np.where(lost, 0, value)[where], np.cumsum(sizes) - sizes)
        other = np.flatnonzero(lost[where]) if lost.any() else np.zeros(0, np.int64)
        text = np.searchsorted(np.cumsum(sizes), other, "right")
        pair, times = np.unique(text * len(uniq) + where[other], return_counts=True)
        return score, pair // len(uniq), uniq[pair % len(uniq)], times


class AdaptivePPM:
    """The same model, learnt from the text itself while it is scored; for texts of other kinds than the corpus. Order by order in Python."""

    def __init__(self, order: int = ORDER):
        self.order, self.trie = order, {}

    def symbol(self, context: bytes, byte: int) -> float:
        """log10 probability of a byte after a context, which is then learnt."""
        result, excluded = 0.0, set()
        for n in range(min(self.order, len(context)), -1, -1):
            counts = {s: c for s, c in self.trie.get(context[len(context) - n :], {}).items() if s not in excluded}
            if not counts:
                continue
            total = sum(counts.values()) + len(counts)
            if byte in counts:
                result += math.log10(counts[byte] / total)
                break
            result += math.log10(len(counts) / total)
            excluded |= set(counts)
        else:
            result -= math.log10(256 - len(excluded))
        for n in range(min(self.order, len(context)) + 1):
            node = self.trie.setdefault(context[len(context) - n :], {})
            node[byte] = node.get(byte, 0) + 1
        return result

    def log10(self, value: bytes) -> float:
        edge = b"\xff" * self.order
        whole = edge + value + b"\xff"
        return sum(self.symbol(whole[i - self.order : i], whole[i]) for i in range(self.order, len(whole)))


def adaptive_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, score): every text's log10 probability by a model that begins empty; null counts as empty."""
    ship_code(df.sparkSession)

    def scan(batches):
        for batch in chunks(batches, "t"):
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array([AdaptivePPM(order).log10(v) for v in utf8_values(batch.column("t"))], pa.float64())], ["doc_id", "score"])

    return df.select(df[id_col].alias("d"), df[text_col].alias("t")).mapInArrow(scan, f"doc_id {df.schema[id_col].dataType.simpleString()}, score double")


def token_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens of the texts, the end as the last, each token's place among these, text after text, and the tokens of each text.
    Tokens are told apart by Arrow; null is empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    kind = pa.binary() if pa.types.is_string(coded.dictionary.type) else pa.large_binary()
    tokens = coded.dictionary.cast(kind)
    # White space at the ends of a text leaves an empty token; the end of a text is an empty token too, but told by its place.
    codes, sizes = coded.indices.to_numpy().astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if (blank := pc.index(tokens, pa.scalar(b"", kind)).as_py()) >= 0:
        real = codes != blank
        codes, text = codes[real], text[real]
    sizes = np.bincount(text, minlength=len(sizes))
    return pa.concat_arrays([tokens, pa.array([b""], kind)]), np.insert(codes, np.cumsum(sizes), len(tokens)), sizes + 1


def counted(batches):
    """Training texts (t) to partial counts: (gram, token, n), one of gram and token being null; the token of an end is empty."""
    tokens: list[pa.Table] = []
    grams: list[tuple[np.ndarray, np.ndarray]] = []

    def added_tokens() -> pa.Table:
        return pa.concat_tables(tokens).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"])

    def of_tokens(t: pa.Table):
        token, n = (t[c].combine_chunks() for c in ("token", "n"))
        return pa.RecordBatch.from_arrays([pa.nulls(len(t), pa.int64()), token.cast(pa.binary()), n], ["gram", "token", "n"])

    def of_grams(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.binary()), pa.array(counts)], ["gram", "token", "n"])

    for batch in chunks(batches, "t", STEP_BYTES):
        names, codes, _ = token_codes(batch.column("t"))
        n = np.bincount(codes, minlength=len(names))
        tokens.append(pa.table({"token": names, "n": n}).filter(pa.array(n > 0)))
        new = np.sort(gram_keys(utf8_values(batch.column("t")))[0])
        first = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]]))
        grams.append((new[first], np.diff(np.append(first, len(new)))))
        if sum(map(len, tokens)) > 2 * HELD:
            tokens = [added_tokens()]
            if len(tokens[0]) > HELD:
                yield from in_parts(of_tokens(tokens.pop()))
        if sum(len(x) for x, _ in grams) > 4 * HELD:
            grams = [added(grams)]
            if len(grams[0][0]) > 2 * HELD:
                yield from in_parts(of_grams(*grams.pop()))
    if tokens:
        yield from in_parts(of_tokens(added_tokens()))
    if grams:
        yield from in_parts(of_grams(*added(grams)))
    tokens, grams = [], []
    return_memory()


def least_count(df: DataFrame, count: str, weight: Column, most: int) -> tuple[int, bool]:
    """The least count such that rows of at least that count weigh no more than `most` together, and whether that is all rows. A histogram
    of a few hundred steps of the count is all that comes to the driver."""
    step = F.floor(F.log2(F.col(count)) * 16).alias("step")
    steps = df.groupBy(step).agg(F.sum(weight).alias("weight"), F.min(count).alias("least")).orderBy(F.desc("step")).collect()
    least, sum_ = 1 << 62, 0
    for row in steps:
        sum_ += row["weight"]
        if sum_ > most:
            return least, False
        least = row["least"]
    return least, True


def trie_tables(grams: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The whole trie, written: (k, gram, n) of all orders, and (k, context, total, distinct, same)."""
    low = lambda k: F.col("gram").bitwiseAND(F.lit(256 ** (k + 1) - 1))
    levels = grams.select(F.lit(ORDER).alias("k"), "gram", "n")
    for k in range(ORDER):
        levels = levels.unionByName(grams.groupBy(low(k).alias("gram")).agg(F.sum("n").alias("n")).select(F.lit(k).alias("k"), "gram", "n"))
    levels = written(levels, folder, "levels")
    masks = F.element_at(F.array(*(F.lit(256**k - 1) for k in range(ORDER + 1))), F.col("k") + 1)
    shorter = levels.select((F.col("k") + 1).alias("k"), F.col("gram").alias("up"), F.col("n").alias("up_n"))
    up = levels.withColumn("up", F.col("gram").bitwiseAND(masks)).join(shorter, ["k", "up"], "left")
    contexts = up.groupBy("k", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum(F.coalesce("up_n", F.lit(0))).alias("same"))
    return levels, written(contexts, folder, "contexts")


def sorted_arrays(folder: str, name: str, key: str, *columns: str):
    """For each order the keys of a table of the folder, sorted, and its columns in their order; counts that fit take half the room."""
    table = shared_dataset(f"{folder}/{name}")
    for k in range(ORDER + 1):
        t = table.to_table(columns=[key, *columns], filter=pc.field("k") == k, use_threads=False, memory_pool=pa.system_memory_pool())
        order = np.argsort(t[key].to_numpy())
        yield t[key].to_numpy()[order]
        for c in columns:
            x = t[c].to_numpy()
            yield (x.astype(np.int32) if len(x) and x.max() < 1 << 31 else x)[order]


def write_model(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Writes the part of the trie that all workers read, which GRAMS bounds, as one file of sorted arrays, and gives the kind, the place and the
    length of each. The file appears under its name when it is complete."""

    def write(_):
        fs, path = open_shared(f"{folder}/model")
        temporary = f"{path}-{uuid.uuid4().hex}"
        rows, at = [], 0
        with fs.open_output_stream(temporary) as out:
            for table in (("top_contexts", "context", "total", "distinct", "same"), ("top_grams", "gram", "n")):
                for x in sorted_arrays(folder, *table):
                    data = np.ascontiguousarray(x).tobytes()
                    out.write(data + b"\0" * (-len(data) % 8))
                    rows.append((x.dtype.str, at, len(x)))
                    at += len(data) + -len(data) % 8
        fs.move(temporary, path)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (range(len(rows)), *zip(*rows, strict=True))], ["i", "kind", "at", "n"])
        return_memory()

    found = spark.range(1, numPartitions=1).mapInArrow(write, "i long, kind string, at long, n long")
    return [(r["kind"], r["at"], r["n"]) for r in sorted(found.collect())]


def read_model(folder: str, whole: bool, layout: list[tuple[str, int, int]]) -> tuple[Trie, dict[bytes, int]]:
    """The frequent part of the trie and the frequent tokens, as a worker has them: arrays of a file that the workers of a machine map
    together where the shared folder is mounted, and have as copies of their own where it is not."""
    fs, path = open_shared(f"{folder}/model")
    if isinstance(fs, LocalFileSystem):
        data = np.asarray(np.memmap(path, np.uint8, "r")) if fs.get_file_info(path).size else np.zeros(0, np.uint8)
    else:
        with fs.open_input_file(path) as file:
            data = np.frombuffer(file.read(), np.uint8)
    arrays = [data[at : at + n * np.dtype(kind).itemsize].view(kind) for kind, at, n in layout]
    contexts, grams = arrays[: 4 * (ORDER + 1)], arrays[4 * (ORDER + 1) :]
    tokens = shared_dataset(f"{folder}/top_tokens").to_table(use_threads=False)
    known = dict(zip(tokens["token"].to_pylist(), tokens["n"].to_pylist(), strict=True))
    grouped = lambda x, n: [tuple(x[i : i + n]) for i in range(0, len(x), n)]
    return Trie(grouped(contexts, 4), grouped(grams, 2), whole), known


def resolved(wanted: DataFrame, levels: DataFrame, contexts: DataFrame) -> DataFrame:
    """(gram, value): log10 probabilities of the last bytes of the wanted 6-grams after the bytes before, from the whole trie."""
    out = wanted.select("gram")
    for k in range(ORDER + 1):
        out = out.withColumn(f"gram{k}", F.col("gram").bitwiseAND(F.lit(256 ** (k + 1) - 1))).withColumn(f"context{k}", F.shiftright(f"gram{k}", 8))
        of = contexts.where(F.col("k") == k).select(F.col("context").alias(f"context{k}"), *(F.col(c).alias(f"{c}{k}") for c in ("total", "distinct", "same")))
        symbols = levels.where(F.col("k") == k).select(F.col("gram").alias(f"gram{k}"), F.col("n").alias(f"n{k}"))
        # Short contexts and grams are few (256^2 rows at most) and each is asked for by very many places.
        out = out.join(F.broadcast(of) if k <= 2 else of, f"context{k}", "left").join(F.broadcast(symbols) if k <= 1 else symbols, f"gram{k}", "left")
    value = -F.log10(256 - F.col("distinct0"))
    for k in range(ORDER + 1):
        gone, gone_distinct = (F.coalesce(f"same{k + 1}", F.lit(0)), F.coalesce(f"distinct{k + 1}", F.lit(0))) if k < ORDER else (F.lit(0), F.lit(0))
        distinct = F.col(f"distinct{k}") - gone_distinct
        left = F.col(f"total{k}") - gone + distinct
        value = F.when(F.col(f"n{k}") > 0, F.log10(F.col(f"n{k}") / left)).otherwise(F.when(distinct > 0, F.log10(distinct / left)).otherwise(0.0) + value)
    return out.select("gram", value.alias("value"))


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None, grams: int = GRAMS, frequent: int = FREQUENT) -> DataFrame:
    """For every row of df: doc_id, n_tokens, n_known, train_tokens, base_score and score.

    train: a condition on df's columns; rows for which it holds are learnt from (default: all; null: not). The score is the log10
    probability of the text by the whole trie, however many of its `grams` all workers read, base_score that of its tokens by add-one
    smoothed counts: words `[^\x20\x09-\x0D]+` after lower-casing A-Z, and one end. Null text counts as empty and has an end only.
    Repeated rows count as often as they are there. Without training rows all probabilities are those of a model without counts
    (base_score then is 0, for lack of a vocabulary). Ids may be of any type; other columns are not read; an empty table gives an empty
    result.
    """
    spark = df.sparkSession
    ship_code(spark)
    folder = shared_folder(spark)
    learnt = df if train is None else df.where(train)
    counts = written(learnt.select(df[text_col].alias("t")).mapInArrow(counted, "gram long, token binary, n long").groupBy("gram", "token").agg(F.sum("n").alias("n")), folder, "counts")
    tokens = counts.where("gram is null").select("token", "n")
    levels, contexts = trie_tables(counts.where("gram is not null").select("gram", "n"), folder)
    least, whole_trie = least_count(contexts, "total", F.col("distinct"), grams)
    top = contexts.where(F.col("total") >= least)
    written(top, folder, "top_contexts")
    written(levels.join(top.select("k", "context"), (F.shiftright("gram", 8) == F.col("context")) & (levels["k"] == top["k"]), "left_semi"), folder, "top_grams")
    layout = write_model(spark, folder)
    least, all_tokens = least_count(tokens, "n", F.lit(1), frequent)
    written(tokens.where(F.col("n") >= least), folder, "top_tokens")
    train_tokens, distinct = (x or 0 for x in tokens.agg(F.sum("n"), F.count("*")).first())
    whole = train_tokens + distinct + 1
    id_type = df.schema[id_col].dataType.simpleString()

    def scan(batches):
        if folder not in _models:
            _models.clear()
            _models[folder] = read_model(folder, whole_trie, layout)
            return_memory()
        trie, known = _models[folder]
        for batch in chunks(batches, "t", STEP_BYTES):
            names, codes, sizes = token_codes(batch.column("t"))
            count = np.array([known.get(w, -1) for w in names.to_pylist()], np.float64)
            begin = np.cumsum(sizes) - sizes
            own = np.log10((np.maximum(count, 0) + 1) / whole)
            # A token that may have a count elsewhere is left to the join; if all tokens are here, it has none.
            away = (count < 0) & (not all_tokens)
            base = np.add.reduceat(np.where(away, 0.0, own)[codes], begin) if len(begin) else np.zeros(0)
            n_known = np.add.reduceat((count >= 0)[codes].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
            rare = np.flatnonzero(away[codes])
            pair, often = np.unique(np.searchsorted(begin, rare, "right") * len(names) + codes[rare], return_counts=True)
            of_text, of_name = pair // len(names) - 1, pair % len(names)
            score, at, keys, times = trie.scores(utf8_values(batch.column("t")))
            n, m, g = batch.num_rows, len(pair), len(at)
            numbers = batch.column("uid").to_numpy()
            tokens = names.take(pa.array(of_name)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([numbers, numbers[of_text], numbers[at]])),
                    pa.concat_arrays([batch.column("d"), pa.nulls(m + g, batch.column("d").type)]),
                    pa.array(np.concatenate([sizes, often, times]).astype(np.int64)),
                    pa.concat_arrays([pa.array(n_known), pa.nulls(m + g, pa.int64())]),
                    pa.concat_arrays([pa.array(base), pa.nulls(m + g, pa.float64())]),
                    pa.concat_arrays([pa.array(score, pa.float64()), pa.nulls(m + g, pa.float64())]),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), tokens, pa.nulls(g, pa.binary())]),
                    pa.concat_arrays([pa.nulls(n + m, pa.int64()), pa.array(keys)]),
                ],
                ["uid", "doc_id", "n", "n_known", "base", "score", "token", "gram"],
            )

    rows = df.select(df[id_col].alias("d"), df[text_col].alias("t"), F.monotonically_increasing_id().alias("uid"))
    rows = written(rows.mapInArrow(scan, f"uid long, doc_id {id_type}, n long, n_known long, base double, score double, token binary, gram long"), folder, "scored")
    docs = rows.where("token is null and gram is null").select("uid", "doc_id", F.col("n").alias("n_tokens"), "n_known", "base", "score")
    if all_tokens:
        docs = docs.withColumns({"more": F.lit(0), "rest": F.lit(0.0)})
    else:
        rare = rows.where("token is not null").select("uid", "token", F.col("n").alias("times"))
        rare = rare.join(tokens, "token", "left").groupBy("uid").agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
            F.sum(F.col("times") * F.log10((F.coalesce(F.col("n"), F.lit(0)) + 1) / F.lit(float(whole)))).alias("rest"),
        )
        docs = docs.join(rare, "uid", "left")
    if not whole_trie:
        beyond = rows.where("gram is not null").select("uid", "gram", F.col("n").alias("times"))
        values = written(resolved(beyond.select("gram").distinct(), levels, contexts), folder, "resolved")
        beyond = beyond.join(values, "gram").groupBy("uid").agg(F.sum(F.col("times") * F.col("value")).alias("beyond"))
        docs = docs.join(beyond, "uid", "left").withColumn("score", F.col("score") + F.coalesce("beyond", F.lit(0.0)))
    return docs.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score",
    )
