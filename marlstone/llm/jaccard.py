"""Exact n-gram Jaccard join by universe partition and pigeonhole.

A document is the set of its word shingles (64-bit hashes). Equal sets are one class; only classes are compared. Classes fall into bands
of sizes, each at most 1/threshold of the one below, so linked classes are in one band or in neighbouring ones, and every class is indexed
for its own band and for the next. For a band, linked sets differ in at most H shingles. The universe of shingles is cut into segments by
hash; a set's part in a segment is indexed by its hash, and in some segments also with each one shingle left out. A pair that has no part
in common then differs in at least one shingle in every plain segment and in at least two in every segment with deletions, more than H in
all. How many segments carry deletions is chosen by cost for each band.

There are a few segments more than need be, so a linked pair shares more parts than its slack, and a set may leave out as many of its most
frequent parts: in one order of all parts by frequency, the rarest part that a pair shares is never among them.

Sets that share a part are candidates. Each class has a parity bitmap, of 2 to 4 bits a shingle; the bits in which two bitmaps differ are no
more than the shingles in which the sets do, so a candidate with too many is refused without reading the sets. Rare parts give candidates
as rows; the members of a frequent part are compared in blocks of bounded size, whose tasks return a root for each class and no pairs.
The candidates that remain are nearly all links. They join to clusters, a cluster is cut into blocks bounded in classes and in shingles,
and in a task the sets of two blocks are compared exactly, by an inverted index of their shingles; tasks return a root and a number of
links for each class. The components of these true links are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_TABLE, SENT_WHOLE, Remembered, chunks, delete_tables, looked_up, quoted, shared_folder, ship_code, utf8_values, written
from .dedup import heavy_digests

#: Words of a shingle and the threshold in hundredths.
WORDS, PERCENT = 4, 85
#: Parts that more classes share are frequent: left out where the slack allows, compared in blocks where it does not.
FREQUENT = 16
#: A part that so many texts of one Python step have is dealt out by class instead of meeting in one task.
CROWD = 16
#: Classes of a block of a frequent part; classes and shingles of a block of a cluster.
PART_BLOCK, BLOCK, BLOCK_SHINGLES = 512, 512, 1 << 20
#: Classes with more copies than about 2 in so many rows are indexed once only, by a broadcast list of them.
COUNTERS = 1024
#: Share of the shingles of unrelated sets that the allocation of segments takes to agree.
AGREE = 0.03
#: Words whose hashes a worker remembers while a task lasts.
REMEMBERED = 200_000


_hashes = Remembered(xxhash.xxh64_intdigest, REMEMBERED)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply), salted."""
    x = (x + np.uint64(salt & 0xFFFFFFFFFFFFFFFF)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(values: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text after text, and their numbers. Fewer words than a shingle has make one shingle."""
    _hashes.turn()
    parts, sizes = [], []
    for value in values:
        text = value.translate(LOWER_TABLE).split()
        if not text:
            sizes.append(0)
            continue
        h = np.fromiter(map(_hashes.__getitem__, text), np.uint64, len(text))
        n = max(1, len(h) - words + 1)
        mix = np.full(n, min(len(h), words), np.uint64)
        for k in range(min(words, len(h))):
            mix = mixed(mix * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n], k + 1)
        mix = np.unique(mix)
        parts.append(mix)
        sizes.append(len(mix))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def summed(values: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, where, values)
    return out


def set_hashes(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash for each set, whatever the order of its shingles."""
    return mixed(summed(mixed(h, 11), np.repeat(np.arange(len(sizes)), sizes), len(sizes)) ^ mixed(summed(mixed(h, 13), np.repeat(np.arange(len(sizes)), sizes), len(sizes)), 17), 19) ^ sizes.astype(np.uint64)


class Bands:
    """Sizes, differences and segments of every band."""

    def __init__(self, rows: int, percent: int = PERCENT, largest: int = 1 << 40):
        self.percent = percent
        ends = [0]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
        self.ends = np.array(ends[1:], np.int64)  # the largest size of each band
        self.capacity, self.deletions = [], []
        for end in self.ends.tolist():
            # |r| + |s| - 2 overlap, with overlap at least percent / (100 + percent) of the sum
            h = (100 - percent) * 2 * end // (100 + percent)
            capacity = h + 2 + h // 10
            self.capacity.append((h, capacity))
            self.deletions.append(self.cheapest(end, h, capacity, rows))
        self.h = np.array([x[0] for x in self.capacity], np.int64)
        self.weight = np.array([x[1] for x in self.capacity], np.int64)
        self.deletions = np.array(self.deletions, np.int64)
        self.segments = self.weight - self.deletions

    @staticmethod
    def cheapest(size: int, h: int, capacity: int, rows: int) -> int:
        """Of the segments with deletions, the number that costs least: rows of the index and pairs that meet by chance. In unrelated
        sets a share of AGREE of the shingles is taken to agree, and one class in eight to be in the band."""
        if h == 0:
            return 0

        def cost(d: int) -> float:
            m = capacity - d
            t = size / m
            met = (m - d) * AGREE**t + d * (1 + t) * AGREE ** max(t - 1, 0)
            return m + d * t + met * rows / 8

        return min(range(0, capacity // 2 + 1, max(1, capacity // 16)), key=cost)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, sizes, "left")


def index_rows(h: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part hash, number of the set, 2 * slack + side) of all sets for both bands; side: 0 for the own band, 1 for the next; slack: the
    rows of that side that the set may leave out."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    element = mixed(h, 23)
    parts, owners, slacks = [], [], []
    band = bands.of(sizes)
    for side in (0, 1):
        b = np.minimum(band + side, len(bands.ends) - 1)
        used = (sizes > 0) & (bands.h[b] > 0)
        m = np.where(used, bands.segments[b], 0)
        first = np.cumsum(m) - m
        mine = used[owner]
        own, e = owner[mine], element[mine]
        local = (mixed(h[mine], 29) % m[own].astype(np.uint64)).astype(np.int64)
        where = first[own] + local
        total = int(m.sum())
        sums, counts = summed(e, where, total), np.bincount(where, minlength=total)
        set_of = np.repeat(np.arange(len(sizes)), m)
        number = np.arange(total) - first[set_of]
        tag = mixed(number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b[set_of].astype(np.uint64), 31)
        double = number < bands.deletions[b][set_of]
        # Empty parts, and single shingles that a deletion makes empty, are left out first; a set with more of them than it may leave out
        # keeps them all and leaves out nothing.
        blank = np.where(counts == 0, 1 + double, np.where(double & (counts == 1), 2, 0))
        left_out = np.bincount(set_of, blank, len(sizes)).astype(np.int64)
        spare = bands.weight[b] - bands.h[b] - 1
        keep_empty = left_out > spare
        # A segment with deletions counts twice, but may be shared by one row only.
        slack = np.where(keep_empty, 0, spare - left_out) // np.where(bands.deletions[b] > 0, 2, 1)
        mark = (2 * slack + side).astype(np.int32)
        chosen = (counts > 0) | keep_empty[set_of]
        drop = double[where]
        fewer = drop & ((counts[where] > 1) | keep_empty[own])
        parts += [mixed(sums + tag, 37)[chosen], mixed(sums[where] - e + tag[where], 37)[fewer]]
        owners += [set_of[chosen], own[fewer]]
        slacks += [mark[set_of[chosen]], mark[own[fewer]]]
    return np.concatenate(parts), np.concatenate(owners), np.concatenate(slacks)


def longs_of(sizes: np.ndarray) -> np.ndarray:
    """Longs of a set's bitmap, a power of two: 2 to 4 bits for each shingle."""
    return 1 << np.ceil(np.log2(np.maximum(1, -(-sizes // 32)))).astype(np.int64)


def bitmaps(h: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Parity bitmaps: a bit is set if an odd number of the set's shingles falls on it. The upper half of a bitmap can be folded on the
    lower one, which gives the bitmap of half the size."""
    longs = longs_of(sizes)
    first = np.cumsum(longs) - longs
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bit = 64 * first[owner] + (mixed(h, 41) & (64 * longs[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * int(longs.sum())) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(np.append(first, longs.sum()).astype(np.int32)), pa.array(words))


def may_link(a_n, b_n, differing, percent: int):
    """Whether sets of these sizes may link if they differ in so many bits; for columns and arrays alike."""
    both = a_n + b_n
    return both - 2 * ((percent * both + percent + 99) // (100 + percent)) >= differing


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label) of all nodes of the edges (a, b); label: the smallest node that is reachable.

    In every round each node hooks to the smallest neighbour of its smallest neighbour, and edges between nodes become edges between their
    hooks; only nodes that something hooked to are left. Then labels go back down, round by round. Every round is written.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), folder, f"{name}-edges")
    hooks, nodes = [], []
    while True:
        number = len(hooks)
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        low = ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("low"))
        low = written(low, folder, f"{name}-low-{number}")
        nodes.append(low.count())
        hook = looked_up(low, low.select(F.col("node").alias("low"), F.col("low").alias("up")), "low", rows=nodes[-1]).select("node", "up")
        hooks.append(written(hook, folder, f"{name}-hook-{number}"))
        for end in ("a", "b"):
            edges = looked_up(edges, hooks[-1].select(F.col("node").alias(end), F.col("up").alias(f"up_{end}")), end, rows=nodes[-1])
            if end == "a" and nodes[-1] > SENT_WHOLE:  # else the second plan would hold the first several times
                edges = written(edges, folder, f"{name}-half-{number}")
        edges = edges.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).where("a <> b").distinct()
        edges = written(edges, folder, f"{name}-edges-{number}")
        if nodes[-1] > SENT_WHOLE:
            delete_tables(edges.sparkSession, folder, f"{name}-half-{number}")
        if edges.isEmpty():
            break
    labels = hooks[-1].withColumnRenamed("up", "label")
    for number, hook in reversed(list(enumerate(hooks[:-1]))):
        further = labels.select(F.col("node").alias("up"), "label")
        labels = written(looked_up(hook, further, "up", rows=nodes[number + 1]).select("node", F.coalesce("label", "up").alias("label")), folder, f"{name}-{number}")
    return labels


def roots_of(names: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest of the names that each one reaches in a matrix of links."""
    root = np.full(len(names), -1)
    for y in np.argsort(names, kind="stable").tolist():
        if root[y] >= 0:
            continue
        reached = np.zeros(len(names), bool)
        near = np.arange(len(names)) == y
        while near.any():
            reached |= near
            near = linked[near].any(axis=0) & ~reached
        root[reached] = y
    return names[root]


def hooked(names: np.ndarray, sizes: np.ndarray, bits: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the classes of two blocks of a frequent part, those that may link with others, and the smallest class that each reaches so."""
    names, at = np.unique(names, return_index=True)
    sizes, bits = sizes[at], [bits[i] for i in at.tolist()]
    least = min(map(len, bits))
    folded = np.stack([np.bitwise_xor.reduce(x.reshape(-1, least), axis=0) for x in bits]).view(np.uint64)
    linked = np.zeros((len(names), len(names)), bool)
    for y in range(len(names)):
        differing = np.bitwise_count(folded ^ folded[y]).sum(axis=1, dtype=np.int64)
        linked[y] = may_link(sizes, sizes[y], differing, percent)
    root = roots_of(names, linked)
    return names[root != names], root[root != names]


def linked_in(t: pa.Table, percent: int) -> pa.Table:
    """Of the classes of two blocks (or of one), compared across (or within): each one's links, and the smallest class that they reach.
    Exact intersections come from an inverted index of the blocks' shingles, a row of counts at a time."""
    t = t.take(pa.array(np.unique(t["class"].to_numpy(), return_index=True)[1]))  # a row that was repeated may come from several tasks
    names, block = t["class"].to_numpy(), t["block"].to_numpy()
    lists = t["shingles"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
    flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    m = len(names)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    posted, ordered = owner[order], flat[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.empty(len(flat), np.int64)
    group[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(flat)))
    within = t["low"][0] == t["high"][0]
    ends = np.cumsum(sizes)
    linked = np.zeros((m, m), bool)
    for y in range(m):
        g = group[ends[y] - sizes[y] : ends[y]]
        n = length[g]
        at = np.arange(n.sum()) + np.repeat(first[g] - (np.cumsum(n) - n), n)
        shared = np.bincount(posted[at], minlength=m)
        linked[y] = 100 * shared >= percent * (sizes[y] + sizes - shared)
        linked[y] &= True if within else block != block[y]
        linked[y, y] = False
    return pa.table({"class": pa.array(names), "root": pa.array(roots_of(names, linked)), "links": pa.array(linked.sum(axis=1))})


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """For every row of df: doc_id, n_shingles, n_links (other texts, equal sets counting once, that link with it), component_id, the
    smallest id that is reachable by links, itself included, and what tells rows apart: text_hash and stays.

    A set is made of the `words`-word shingles of a text, A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`; a text of fewer words is one
    shingle; null, empty and blank texts have none and link with nothing. Rows link if 100 * shared >= percent * united. Rows that
    repeat are in one component. The null id is never the smallest one unless a component has no other. stays: whether a row's id and text
    are those of its component's first row, by id, null last, then by the hash of the text; rows that repeat it in both have it too. Sets
    and shingles are told apart by 64-bit hashes. Ids may be of any type that sorts. Other columns are not read; an empty table gives an
    empty result.
    """
    spark = df.sparkSession
    ship_code(spark)
    folder = shared_folder(spark)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("d"), df[text_col].alias("t"), text_key(df[text_col]).alias("h"))
    bands = Bands(df.count(), percent)

    def measure(batches):
        for batch in chunks(batches, "t"):
            h, sizes = shingle_sets(utf8_values(batch.column("t")), words)
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("h"), pa.array(sizes), signed(set_hashes(h, sizes)), bitmaps(h, sizes)], ["doc_id", "h", "n", "class", "bits"])
        _hashes.clear()

    docs = written(rows.mapInArrow(measure, f"doc_id {id_type}, h long, n long, class long, bits array<long>"), folder, "docs")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("h").alias("h"))
    classes = docs.where("n > 0").groupBy("class").agg(F.min(first).alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = written(classes, folder, "classes")
    docs = docs.drop("bits")

    # Copies of very frequent texts are indexed by one of them.
    frequent = heavy_digests(docs.where("n > 0").select(F.col("class").alias("digest")), COUNTERS).withColumnRenamed("digest", "class")
    once = {r["class"]: r["h"] for r in classes.join(F.broadcast(frequent), "class").select("class", "rep.h").collect()}

    def index(batches):
        """(part, class, slack, kind). Parts that many texts here have are of kind 1, and come with rows of kind 2 that count them (slack)."""
        for batch in chunks(batches, "t"):
            h, sizes = shingle_sets(utf8_values(batch.column("t")), words)
            names, texts = set_hashes(h, sizes).view(np.int64), batch.column("h").to_pylist()
            seen: set[int] = set()
            use = np.zeros(len(sizes), bool)
            for i, c in enumerate(names.tolist()):
                use[i] = sizes[i] > 0 and c not in seen and once.get(c, texts[i]) == texts[i]
                seen.add(c) if use[i] else None
            h, kept = h[np.repeat(use, sizes)], names[use]
            part, owner, slack = index_rows(h, sizes[use], bands)
            there, where, times = np.unique(part, return_inverse=True, return_counts=True)
            kind = (times[where] >= CROWD).astype(np.int32)
            for at in range(0, len(part), 500_000):
                some = slice(at, at + 500_000)
                yield pa.RecordBatch.from_arrays([signed(part[some]), pa.array(kept[owner[some]]), pa.array(slack[some]), pa.array(kind[some])], ["part", "class", "slack", "kind"])
            there, times = there[times >= CROWD], times[times >= CROWD].astype(np.int32)
            yield pa.RecordBatch.from_arrays([signed(there), pa.nulls(len(there), pa.int64()), pa.array(times), pa.array(np.full(len(there), 2, np.int32))], ["part", "class", "slack", "kind"])
        _hashes.clear()

    # Rows of kind 1 are dealt by part and class, and find the size of their part afterwards.
    apart = F.col("part").bitwiseXOR(F.when(F.col("kind") == 1, F.xxhash64("class")).otherwise(F.lit(0).cast("long")))
    together = Window.partitionBy("key")
    index_table = rows.mapInArrow(index, "part long, class long, slack int, kind int").select(apart.alias("key"), "class", "slack", "kind")
    crowd = F.sum(F.when(F.col("kind") == 2, F.col("slack"))).over(together)
    met = index_table.withColumns({"low": F.min("class").over(together), "high": F.max("class").over(together), "crowd": crowd}).where("low < high or crowd > 0 or kind = 1")
    met = met.select("key", "class", F.when(F.col("kind") < 2, F.col("slack")).alias("slack"), "kind", "crowd").distinct()
    part = F.col("key").bitwiseXOR(F.when(F.col("kind") == 1, F.xxhash64("class")).otherwise(F.lit(0).cast("long"))).alias("part")
    size = F.when(F.col("kind") != 1, F.coalesce("crowd", F.count("*").over(together))).alias("size")
    shared = written(met.select(part, "class", "slack", "kind", size), folder, "shared")

    in_crowds = looked_up(shared.where("kind = 1").drop("size"), shared.where("kind = 2").select("part", "size"), "part")
    sized = shared.where("kind = 0").unionByName(in_crowds)
    cold, hot = sized.where(F.col("size") <= FREQUENT), sized.where(F.col("size") > FREQUENT)
    most_frequent = Window.partitionBy("class", F.col("slack") % 2).orderBy(F.desc("size"), "part")
    hot = hot.withColumn("place", F.row_number().over(most_frequent)).where(F.col("place") > F.floor(F.col("slack") / 2)).select("part", "class")
    hot = written(hot, folder, "hot")

    asked_for = cold.select("class").unionByName(hot.select("class")).distinct()
    known = written(classes.join(asked_for, "class", "left_semi").select("class", "n", "bits"), folder, "known")
    members = cold.groupBy("part").agg(F.array_sort(F.collect_set("class")).alias("m")).where("size(m) > 1")
    pairs = members.select(F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x as a, y as b))))")).alias("p")).select("p.*").distinct()
    side = lambda e: known.select(F.col("class").alias(e), F.col("n").alias(f"n_{e}"), F.col("bits").alias(f"bits_{e}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where("2 * least(size(bits_a), size(bits_b)) >= greatest(size(bits_a), size(bits_b))")
    fold = lambda e, f: f"if(size(bits_{e}) > size(bits_{f}), zip_with(slice(bits_{e}, 1, size(bits_{f})), slice(bits_{e}, size(bits_{f}) + 1, size(bits_{f})), (x, y) -> x ^ y), bits_{e})"
    differing = f"aggregate(zip_with({fold('a', 'b')}, {fold('b', 'a')}, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"
    candidates = pairs.where(f"n_a + n_b - 2 * (({percent} * (n_a + n_b) + {percent + 99}) div {100 + percent}) >= {differing}").select("a", "b")

    blocks = F.ceil(F.col("count") / PART_BLOCK).cast("int")
    in_parts = looked_up(hot, hot.groupBy("part").count(), "part").select("part", "class", blocks.alias("blocks"), F.pmod(F.xxhash64("class"), blocks).cast("int").alias("block"))
    in_parts = in_parts.join(known, "class").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    in_parts = in_parts.select("part", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "n", "bits")

    def hook(t: pa.Table) -> pa.Table:
        bits = t["bits"].combine_chunks()
        bits = bits if isinstance(bits, pa.ListArray) else bits.chunk(0)
        flat, ends = bits.flatten().to_numpy(), np.cumsum(bits.value_lengths().to_numpy())
        names, roots = hooked(t["class"].to_numpy(), t["n"].to_numpy(), np.split(flat, ends[:-1]), percent)
        return pa.table({"a": pa.array(names), "b": pa.array(roots)})

    hooks = written(in_parts.groupBy("part", "low", "high").applyInArrow(hook, "a long, b long"), folder, "hooks")
    clusters = components(candidates.unionByName(hooks), folder, "clusters").withColumnRenamed("node", "class")

    # Blocks of each cluster, and in a task the pairs of two of them.
    placed = written(clusters.join(classes.select("class", "n", "rep"), "class"), folder, "members")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    placed = looked_up(placed, placed.groupBy("label").agg(blocks.alias("blocks")), "label")
    placed = placed.select("class", "label", "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"), F.col("rep.id").alias("id"), F.col("rep.h").alias("text"))
    placed = written(placed, folder, "placed")
    # Only texts whose slot is set in a bitmap of fixed size (2 ** 22 slots, sent as 65,536 longs) go into the join.
    slot = lambda c: F.pmod(c, F.lit(1 << 22))
    word, bit = lambda c: F.shiftright(slot(c), 6), lambda c: slot(c).bitwiseAND(F.lit(63)).cast("int")
    bitmap = placed.groupBy(word(F.col("text")).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("text")))).alias("_bits"))
    likely = rows.withColumn("_word", word(F.col("h"))).join(F.broadcast(bitmap), "_word").where(F.call_function("bit_get", F.col("_bits"), bit(F.col("h"))) == 1).select("d", "t", "h")
    asked = likely.join(placed, (likely["h"] == placed["text"]) & likely["d"].eqNullSafe(placed["id"])).select("t", "class", "label", "block", "blocks")

    def collect_sets(batches):
        """Each class of a task once, for every block that its block meets."""
        seen: set[int] = set()
        for batch in chunks(batches, "t"):
            h, sizes = shingle_sets(utf8_values(batch.column("t")), words)
            names, ends = set_hashes(h, sizes).view(np.int64), np.cumsum(sizes)
            label, block, blocks = (batch.column(c).to_pylist() for c in ("label", "block", "blocks"))
            for at in np.flatnonzero(names == batch.column("class").to_numpy()).tolist():
                if int(names[at]) in seen:
                    continue
                seen.add(int(names[at]))
                one = h[ends[at] - sizes[at] : ends[at]].view(np.int64)
                for other in range(blocks[at]):
                    columns = [pa.array([names[at]]), pa.array([label[at]]), *(pa.array([x], pa.int32()) for x in (block[at], min(block[at], other), max(block[at], other)))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array([0, len(one)], pa.int32()), pa.array(one))], ["class", "label", "block", "low", "high", "shingles"])
        _hashes.clear()

    sets = asked.mapInArrow(collect_sets, "class long, label long, block int, low int, high int, shingles array<long>")
    found = sets.groupBy("label", "low", "high").applyInArrow(lambda t: linked_in(t, percent), "class long, root long, links long")
    found = written(found, folder, "found")
    delete_tables(spark, folder, "shared", "hot", "hooks", "known", "members", "placed")
    links = found.where("root <> class").select(F.col("root").alias("a"), F.col("class").alias("b"))
    labels = components(links, folder, "components").withColumnRenamed("node", "class")

    # The first row of each component, told to its classes, and by these to all rows.
    linked = written(labels.join(classes.select("class", "rep"), "class").join(found.groupBy("class").agg(F.sum("links").alias("n_links")), "class"), folder, "linked")
    linked = looked_up(linked, linked.groupBy("label").agg(F.min("rep").alias("best")), "label").select("class", "n_links", "best")
    named = classes.select("class", "rep").join(linked, "class", "left").select("class", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("best", "rep").alias("best"))
    named = written(named, folder, "named")
    stays = (F.col("best.h") == F.col("h")) & F.col("best.id").eqNullSafe(F.col("doc_id"))
    of_class = looked_up(docs.where("n > 0"), named, "class").select("doc_id", F.col("n").alias("n_shingles"), "n_links", F.col("best.id").alias("component_id"), F.col("h").alias("text_hash"), stays.alias("stays"))
    alone = docs.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"), F.col("h").alias("text_hash"), F.lit(True).alias("stays"))
    return of_class.unionByName(alone)


def first_of_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of df, with all their columns, that stay: of each component the one with the smallest id, null last, then with the smallest
    hash of its text. Rows are told apart by id and text, so rows that share an id but no links all stay, as do all rows without words; of
    rows that repeat both one stays, with the other columns of any of them."""
    folder = shared_folder(df.sparkSession)
    groups = jaccard_groups(df, id_col, text_col, words, percent).select("doc_id", "text_hash", "stays", "n_shingles")
    groups = written(groups, folder, "groups")
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.select(*(df[quoted(c)].alias(n) for c, n in zip(df.columns, names, strict=True)), df[id_col].alias("d"), text_key(df[text_col]).alias("h"))
    of = lambda x: (rows["h"] == x["text_hash"]) & rows["d"].eqNullSafe(x["doc_id"])
    gone = groups.where(~F.col("stays")).select("doc_id", "text_hash").distinct()
    kept = rows.join(gone, of(gone), "left_anti")
    again = groups.where("stays and n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if not again.isEmpty():
        one = rows.join(again, of(again), "left_semi").dropDuplicates(["d", "h"])
        kept = kept.join(again, of(again), "left_anti").unionByName(one)
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)))
