"""Benchmark decontamination with suffix arrays of the training texts.

Each shard of the training texts (a few megabytes, within one task) is turned into word numbers of the test vocabulary. Words outside it
end a suffix as the end of a text does, for no match reaches beyond them. A first pass refuses what cannot match: rolling hashes of the
shard's runs of test words are looked up among those of the test set's windows, so its cost grows with the shard, not with the test set.
The runs where a window may stand get a suffix array, sorted to their full length, and every test suffix that may begin a window there is
binary-searched in it (equal windows once): the range found are the places where the window stands. From the places where a match begins,
the longest verbatim match and its location come from a binary search in the suffix array of the test set.

The test set is written once as blocks of bounded size with their suffix arrays and window hashes in the shared folder. Workers keep a few
blocks and read more of them there, one at a time for a shard, so the training texts are read in a single pass, whatever the size of the
test set, and the driver holds neither.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, CHUNK_BYTES, chunks, quoted, shared_dataset, shared_folder, ship_code, utf8_values, written

#: Words of a window.
WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Bytes of test items in a block, about; bounds what a worker holds of the test set.
BLOCK_BYTES = 8_000_000
#: Blocks that a worker keeps; a larger test set is read for every shard, and its shards are larger.
KEPT, LARGE_SHARD = 2, 16_000_000
#: Base of the rolling hashes, odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Bits of the table that refuses most hashes at once, at most.
TABLE_BITS = 24

_blocks: dict[str, list] = {}
_powers: list[np.ndarray] = []


def words_of(value: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; multi-byte characters are word characters throughout."""
    return value.translate(ALNUM_TABLE).split()


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """The places of all numbers but 0 in the order of their suffixes, which end before the next 0; by prefix doubling."""
    places = np.flatnonzero(ids)
    if not len(places):
        return places
    rank = ids.astype(np.int64)
    ends = np.append(np.flatnonzero(ids == 0), len(ids))
    longest = int((ends[np.searchsorted(ends, places)] - places).max())
    span, order = 1, np.argsort(rank[places], kind="stable")
    while span < longest:
        after = np.zeros(len(ids), np.int64)
        after[:-span] = rank[span:] if span < len(ids) else 0
        # What lies beyond a suffix's end counts as nothing.
        after[places[ends[np.searchsorted(ends, places)] - places <= span]] = 0
        key = rank[places] * (rank.max() + 1) + after[places]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        rank[places[order]] = new
        if new[-1] == len(places):
            break
        span *= 2
    return places[order]


def differing(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes a[at:] and b[bt:], `most` words at most; 0 ends both."""
    out = most.copy()
    active = np.arange(len(at))
    k = 0
    while len(active):
        active = active[most[active] > k]
        x, y = a[at[active] + k], b[bt[active] + k]
        stop = (x != y) | (x == 0)
        out[active[stop]] = k
        active = active[~stop]
        k += 1
    return out


def bound(text: np.ndarray, array: np.ndarray, needles: np.ndarray, at: np.ndarray, n: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each needle, the n words from a place in `needles`, in a suffix array: how many suffixes are less than it, or with
    `after`, less than it or begin with it."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        k = differing(text, array[middle], needles, at[open_], n[open_])
        whole = k == n[open_]
        less = np.where(whole, after, text[array[middle] + k] < needles[at[open_] + np.minimum(k, n[open_] - 1)])
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    return low


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hashes of all runs of words of a text in which 0 separates."""

    def __init__(self, text: np.ndarray):
        up, self.down = powers(len(text))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(text.astype(np.uint64) * up)])
        self.zeros = np.concatenate([[0], np.cumsum(text == 0)])

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where n words stand without a 0, and their hashes."""
        if len(self.zeros) <= n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.zeros[n:] == self.zeros[:-n])
        return at, self.at(at, n)

    def at(self, at: np.ndarray, n) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.down[at]


class Block:
    """A block of the test set: its words' numbers, its text as numbers with a 0 behind each item, and its suffix array."""

    def __init__(self, row: dict):
        read = lambda name, kind="<u4": np.frombuffer(row[name], kind)
        self.names, self.ids, self.array = row["names"], read("ids").astype(np.int64), read("suffixes").astype(np.int64)
        self.numbers = {w: i + 1 for i, w in enumerate(row["words"].split(b" ") if row["words"] else [])}
        ends = np.flatnonzero(self.ids == 0)
        self.starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        # Distinct windows by their length and hash; owners are sets of items that share windows.
        self.at, self.n, self.hashes, self.owners = read("at").astype(np.int64), read("n", "u1").astype(np.int64), read("hashes", "<u8"), read("owners")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(self.n)) + 1, [len(self.n)]]) if len(self.n) else np.zeros(1, np.int64)
        self.groups = [(int(self.n[a]), a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        self.shortest = int(self.n[0]) if len(self.n) else 0
        self.set_ends, self.set_items = np.cumsum(read("set_sizes")), read("set_items")
        self.shift = np.uint64(64 - min(TABLE_BITS, max(8, int(8 * len(self.n)).bit_length())))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[(self.hashes >> self.shift).astype(np.int64)] = True

    def items(self, owner: int) -> list[str]:
        """Names of the items of a set."""
        return [self.names[i] for i in self.set_items[self.set_ends[owner - 1] if owner else 0 : self.set_ends[owner]].tolist()]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Block:
        return cls(cls.row(items, window))

    @staticmethod
    def row(items: list[tuple[str, bytes]], window: int = WINDOW) -> dict:
        """A block's row of the table that holds the test set; items without words are left out."""
        numbers: dict[bytes, int] = {}
        names, found = [], []
        for name, value in items:
            if words := words_of(value):
                names.append(name)
                found += [numbers.setdefault(w, len(numbers) + 1) for w in words]
                found.append(0)
        ids = np.array(found, np.int64)
        ends = np.flatnonzero(ids == 0)
        starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        rolling = Rolling(ids)
        sets: dict[tuple, int] = {}
        windows: list[tuple] = []
        sizes = np.minimum(ends - starts, window)
        for n in np.unique(sizes):
            mine = np.flatnonzero(sizes == n)
            count = (ends - starts)[mine] - n + 1
            item = np.repeat(mine, count)
            at = starts[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
            keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, n)[at].astype(">u4")).view(f"S{4 * n}").ravel()
            _, first, which = np.unique(keys, return_index=True, return_inverse=True)
            order = np.lexsort((item, which))
            groups = np.split(item[order], np.flatnonzero(np.diff(which[order])) + 1)
            owners = np.array([sets.setdefault(tuple(np.unique(one).tolist()), len(sets)) for one in groups], np.int64)
            hashes = rolling.at(at[first], int(n))
            by = np.argsort(hashes, kind="stable")
            windows.append((at[first][by], np.full(len(first), n), hashes[by], owners[by]))
        at, n, hashes, owners = (np.concatenate(x) for x in zip(*windows, strict=True)) if windows else (np.zeros(0, np.int64),) * 4
        pack = lambda a, kind="<u4": np.asarray(a).astype(kind).tobytes()
        return {
            "names": names, "words": b" ".join(numbers), "ids": pack(ids), "suffixes": pack(suffix_array(ids)), "at": pack(at), "n": pack(n, "u1"), "hashes": pack(hashes, "<u8"), "owners": pack(owners),
            "set_sizes": pack([len(x) for x in sets]), "set_items": pack([i for x in sets for i in x]),
        }

    def possible(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text where a window may stand, and the windows that may, by their hashes."""
        rolling, places, windows = Rolling(text), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, a, b in self.groups:
            at, hashes = rolling.of(n)
            some = self.table[(hashes >> self.shift).astype(np.int64)]
            at, hashes, own = at[some], hashes[some], self.hashes[a:b]
            low = np.searchsorted(own, hashes)
            same = own[np.minimum(low, b - a - 1)] == hashes
            places.append(at[same])
            seen = np.unique(hashes[same])
            low, high = np.searchsorted(own, seen), np.searchsorted(own, seen, "right")
            count = high - low
            windows.append(a + np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        return np.concatenate(places), np.concatenate(windows)


#: Columns of the table of blocks.
BLOCK_COLUMNS = {"names": pa.list_(pa.string())} | dict.fromkeys(("words", "ids", "suffixes", "at", "n", "hashes", "owners", "set_sizes", "set_items"), pa.binary())


def laid(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ids laid end to end with a 0 behind each: the places of ids, the text, and where the runs end."""
    place = np.repeat(begin, size + 1) + np.arange((size + 1).sum()) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1)
    last = np.cumsum(size + 1) - 1
    text = ids[np.minimum(place, max(len(ids) - 1, 0))]
    text[last] = 0
    return place, text, last


class Found:
    """What a block of the test set has in common with a shard: places (in the shard's words) with their windows, and longest matches."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, block: Block):
        # Runs of test words within a text, those that are long enough.
        edge = np.ones(len(ids) + 1, bool)
        edge[1:-1] = (ids[1:] == 0) | (ids[:-1] == 0)
        edge[starts] = True
        edge = np.flatnonzero(edge)
        begin, size = edge[:-1], np.diff(edge)
        keep = (size >= max(1, block.shortest)) & (ids[begin] > 0) if len(begin) else np.zeros(0, bool)
        begin, size = begin[keep], size[keep]
        _, text, last = laid(ids, begin, size)
        at, which = block.possible(text)
        # Of these the ones where a window may stand.
        some = np.unique(np.searchsorted(last, at))
        place, text, last = laid(ids, begin[some], size[some])
        array = suffix_array(text)
        needles, n = block.at[which], block.n[which]
        low = bound(text, array, block.ids, needles, n, False)
        high = bound(text, array, block.ids, needles, n, True)
        count = high - low
        self.window = np.repeat(which, count)
        at = array[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        self.place, self.n = place[at], block.n[self.window]
        # A match begins where the window a word earlier is none; its length is the common prefix with a neighbour in the test set.
        begins = np.zeros(len(text) + 1, bool)
        begins[at] = True
        begins[1:] &= ~begins[:-1]
        self.begin = np.flatnonzero(begins[: len(text)])
        most = last[np.searchsorted(last, self.begin)] - self.begin if len(self.begin) else self.begin
        spot = bound(block.ids, block.array, text, self.begin, most, False)
        best, which = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
        for near in (spot, spot - 1):
            ok = (near >= 0) & (near < len(block.array))
            there = block.array[np.clip(near, 0, max(len(block.array) - 1, 0))] if len(block.array) else near
            size = np.where(ok, differing(text, self.begin, block.ids, there, np.where(ok, most, 0)), 0)
            which, best = np.where(size > best, there, which), np.maximum(best, size)
        self.item = np.searchsorted(block.starts, which, "right") - 1
        self.begin, self.words, self.item_start = place[self.begin], best, which - block.starts[np.maximum(self.item, 0)] if len(which) else which


def blocks_in(uri: str, n_blocks: int):
    """The blocks of the test set in a folder, one at a time; a few are kept by the worker."""
    if uri in _blocks:
        yield from _blocks[uri]
        return
    kept = []
    for batch in shared_dataset(uri).to_batches(batch_size=1, batch_readahead=1, fragment_readahead=1, use_threads=False):
        for row in batch.to_pylist():
            block = Block(row)
            if n_blocks <= KEPT:
                kept.append(block)
            yield block
    if n_blocks <= KEPT:
        _blocks.clear()
        _blocks[uri] = kept


def write_test_set(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int, window: int) -> tuple[str, int]:
    """The URI of a table with the test set in blocks of about `block_bytes`, dealt by hash, and their number at most; a null id counts as the
    empty one."""
    items = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("name"), F.coalesce(benchmark[text_col], F.lit("")).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = -(-size // block_bytes) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("name", "t"), F.lit(n_blocks)))

    def build(t: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([Block.row(sorted(zip(t["name"].to_pylist(), utf8_values(t["t"].combine_chunks()), strict=True)), window)], pa.schema(BLOCK_COLUMNS))

    folder = shared_folder(benchmark.sparkSession)
    written(items.groupBy("block").applyInArrow(build, ", ".join(f"{c} {'array<string>' if c == 'names' else 'binary'}" for c in BLOCK_COLUMNS)), folder, "tests")
    return f"{folder}/tests", n_blocks


def shard_words(values: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of texts, all their words as numbers of these, and each text's number of words."""
    texts = pa.array([v.translate(ALNUM_TABLE) for v in values], pa.large_binary())
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), texts.buffers()))
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    code, text = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(values)), lists.value_lengths().to_numpy())
    full = np.fromiter(map(len, distinct), np.int64, len(distinct)) > 0  # a split gives empty strings at the ends
    kept = full[code] if len(code) else np.zeros(0, bool)
    return distinct, code[kept], np.bincount(text[kept], minlength=len(values))


def searched(values: list[bytes], blocks) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[dict]]]:
    """For each text its number of words, words hit, sorted item ids, and longest matches, over all blocks of the test set."""
    distinct, words, n_words = shard_words(values)
    starts = np.cumsum(n_words) - n_words
    text_of = np.repeat(np.arange(len(values)), n_words)
    hit = np.zeros(len(words), bool)
    items: list[set[str]] = [set() for _ in values]
    matches: list[list[dict]] = [[] for _ in values]
    for block in blocks:
        get = block.numbers.get
        found = Found(np.fromiter((get(w, 0) for w in distinct), np.int64, len(distinct))[words], starts, block)
        if not len(found.place):
            continue
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, found.place, 1)
        np.subtract.at(cover, found.place + found.n, 1)
        hit |= np.cumsum(cover[:-1]) > 0
        # Items are told by the sets that share windows, one at a time for a text.
        n_sets = len(block.set_ends)
        pairs = np.unique(text_of[found.place] * n_sets + block.owners[found.window])
        for text, which in zip((pairs // n_sets).tolist(), (pairs % n_sets).tolist(), strict=True):
            items[text].update(block.items(which))
        for at, n, item, start in zip(found.begin.tolist(), found.words.tolist(), found.item.tolist(), found.item_start.tolist(), strict=True):
            text = int(text_of[at])
            matches[text].append({"start": at - int(starts[text]), "words": n, "item_id": block.names[item], "item_start": start})
    n_hit = np.bincount(text_of[hit], minlength=len(values))
    return n_words, n_hit, [sorted(x) for x in items], matches


MATCHES = "array<struct<start:long,words:long,item_id:string,item_start:long>>"


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, one_in: int = ONE_IN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every row of df, in no order: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the longest matches, one for each
    place where a match with a block begins: (start, words, item_id, item_start), the longest of the block there.

    Null and empty texts have no words and no hits. Items without words are passed over; items that share an id count as one; a null
    item id counts as the empty id. Repeated rows each get a result. Other columns are not read. Empty tables give empty results, or no
    hits.
    """
    ship_code(df.sparkSession)
    uri, n_blocks = write_test_set(benchmark, item_col, item_text, block_bytes, window)
    limit = CHUNK_BYTES if n_blocks <= KEPT else LARGE_SHARD
    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())]))

    def scan(batches):
        for batch in chunks(batches, "t", limit):
            n_words, n_hit, items, matches = searched(utf8_values(batch.column("t")), blocks_in(uri, n_blocks))
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            bad = (n_hit > 0) & (one_in * n_hit >= n_words)
            columns = [batch.column("d"), pa.array(n_words), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()), pa.array(bad), pa.array(matches, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"])

    schema = f"doc_id {df.schema[id_col].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, matches {MATCHES}"
    return df.select(df[id_col].alias("d"), df[text_col].alias("t")).mapInArrow(scan, schema)


def remove_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, one_in: int = ONE_IN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of df, with all their columns, that are not contaminated; one pass over df, whatever the size of the test set."""
    ship_code(df.sparkSession)
    uri, n_blocks = write_test_set(benchmark, item_col, item_text, block_bytes, window)
    limit = CHUNK_BYTES if n_blocks <= KEPT else LARGE_SHARD
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index(text_col)

    def scan(batches):
        for batch in batches:
            for part in chunks([pa.RecordBatch.from_arrays([batch.column(at), pa.array(np.arange(batch.num_rows))], ["t", "row"])], "t", limit):
                n_words, n_hit, _, _ = searched(utf8_values(part.column("t")), blocks_in(uri, n_blocks))
                stay = np.flatnonzero((n_hit == 0) | (one_in * n_hit < n_words))
                yield batch.take(pa.array(part.column("row").to_numpy()[stay]))

    rows = df.select(*(df[quoted(c)].alias(n) for c, n in zip(df.columns, names, strict=True)))
    return rows.mapInArrow(scan, rows.schema).select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)))
