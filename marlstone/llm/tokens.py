"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Ids go in blocks of 256: the block's minimum is subtracted, the rest packed at the width
that most of the block needs (a percentile), and what does not fit goes to an exception list. An index has the start of every block, so a
reader can fetch any document without decoding the rest. Layout, little-endian:

    magic (8) | ids u64 | blocks u32 | documents u32 | block starts u64[blocks + 1], from the file's start
    | document ids i64[documents] | null marks u8[documents] | document starts u64[documents + 1], in ids | blocks

    block: minimum u32 | width u8 | exceptions u16 | 32 * width bytes, first value in the highest bits | positions u8[exceptions]
    | differences u32[exceptions]
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Remembered, chunks, open_shared, shared_folder, ship_code, written

MAGIC = b"PFORIDS1"
BLOCK = 256
#: The width of a block fits this share of its differences.
PERCENTILE = 0.9
#: Ids of a file, after which the next one begins.
FILE_IDS = 2_000_000
#: The id after each document.
END_ID = 1
#: Words, and words without marks, whose ids a worker remembers (see Remembered).
REMEMBERED = 250_000
#: Blocks packed at once.
AT_ONCE = 2048

_memory: dict[str, Encoder] = {}


def packed_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """The sizes of the blocks and their bytes."""
    sizes, out = [], []
    for at in range(0, len(ids), BLOCK * AT_ONCE):
        part = ids[at : at + BLOCK * AT_ONCE].astype(np.uint32)
        n = -(-len(part) // BLOCK)
        if n * BLOCK > len(part):
            part = np.concatenate([part, np.full(n * BLOCK - len(part), part[-1], np.uint32)])
        part = part.reshape(n, BLOCK)
        low = part.min(axis=1)
        rest = part - low[:, None]
        fit = np.partition(rest, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))]
        width = np.ceil(np.log2(fit.astype(np.float64) + 1)).astype(np.int64)
        outlier = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
        n_out = outlier.sum(axis=1)
        body: list[bytes] = [b""] * n
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            if w:
                bits = np.unpackbits(rest[rows].astype(">u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2)[:, :, 32 - w :]
                data = np.packbits(bits.reshape(len(rows), -1), axis=1).tobytes()
            for k, row in enumerate(rows.tolist()):
                body[row] = data[k * 32 * w : (k + 1) * 32 * w] if w else b""
        for row in range(n):
            extra = b""
            if n_out[row]:
                where = np.flatnonzero(outlier[row])
                extra = where.astype(np.uint8).tobytes() + rest[row, where].astype("<u4").tobytes()
            block = int(low[row]).to_bytes(4, "little") + bytes([int(width[row])]) + int(n_out[row]).to_bytes(2, "little") + body[row] + extra
            sizes.append(len(block))
            out.append(block)
    return np.array(sizes, np.int64), b"".join(out)


def to_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    sizes, body = packed_blocks(ids)
    head = 24 + 8 * (len(sizes) + 1) + 9 * len(doc_ids) + 8 * (len(doc_ids) + 1)
    return b"".join([
        MAGIC, np.uint64(len(ids)).tobytes(), np.uint32(len(sizes)).tobytes(), np.uint32(len(doc_ids)).tobytes(),
        (head + np.concatenate([[0], np.cumsum(sizes)])).astype("<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes(), body,
    ])


def read_head(data: bytes):
    """Number of ids, block starts, document ids, null marks and document starts of a file."""
    if data[:8] != MAGIC:
        raise ValueError("no file of token ids")
    n = int(np.frombuffer(data, "<u8", 1, 8)[0])
    blocks, docs = (int(x) for x in np.frombuffer(data, "<u4", 2, 16))
    at = 24
    starts = np.frombuffer(data, "<u8", blocks + 1, at)
    doc_ids = np.frombuffer(data, "<i8", docs, at := at + 8 * (blocks + 1))
    nulls = np.frombuffer(data, np.uint8, docs, at := at + 8 * docs)
    return n, starts, doc_ids, nulls, np.frombuffer(data, "<u8", docs + 1, at + docs)


def read_ids(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids from first to before last of a file; only their blocks are decoded."""
    n, starts, *_ = read_head(data)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    a, b = first // BLOCK, -(-last // BLOCK)
    at = starts[a:b].astype(np.int64)
    take = lambda where, size: raw[where[:, None] + np.arange(size)]
    low = np.ascontiguousarray(take(at, 4)).view("<u4").ravel()
    width, n_out = raw[at + 4].astype(np.int64), np.ascontiguousarray(take(at + 5, 2)).view("<u2").ravel().astype(np.int64)
    out = np.zeros((b - a, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        for rows in np.array_split(np.flatnonzero(width == w), max(1, (width == w).sum() // AT_ONCE)):
            bits = np.unpackbits(take(at[rows] + 7, 32 * w), axis=1).reshape(len(rows), BLOCK, w)
            full = np.zeros((len(rows), BLOCK, 32), np.uint8)
            full[:, :, 32 - w :] = bits
            out[rows] = np.packbits(full, axis=2).view(">u4")[:, :, 0]
    if n_out.sum():
        row = np.repeat(np.arange(b - a), n_out)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n_out) - n_out, n_out)
        base = (at + 7 + 32 * width)[row]
        out[row, raw[base + k]] = np.ascontiguousarray(take(base + n_out[row] + 4 * k, 4)).view("<u4").ravel()
    return (out + low[:, None]).ravel()[first - a * BLOCK : last - a * BLOCK]


class Encoder:
    """Ids of texts by the tokenizers library.

    A vocabulary with any other normaliser or splitter than those below gets whole texts. With these, words between ASCII white space are
    encoded once and remembered: nothing is joined or dropped across white space, and upper and lower case are one, so the ids are those of
    the whole text. A word of small Latin letters with or without ASCII marks behind it is not changed by the normaliser and is split
    where the marks begin, so both parts go straight to the model. Texts keep their case if a special token's string may stand in them,
    since these strings are matched before anything else, or if combining marks do, since a small letter may be composed with one where its
    capital is not."""

    # The normaliser and the splitter that words may be told apart for.
    normalizer = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    splitter = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}

    #: Small letters, ASCII or Latin-1, and a run of ASCII marks.
    plain = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")

    def __init__(self, settings: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(settings.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = self.splits_at_blanks(json.loads(settings))
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {n: bytes_of.pre_tokenize_str(chr(n))[0][0] for n in range(0xDF, 0x100)}
        self.model = self.tokenizer.model
        self.words = Remembered(self.of_word, REMEMBERED)

    @classmethod
    def splits_at_blanks(cls, settings: dict) -> bool:
        before = settings.get("pre_tokenizer") or {}
        parts = before.get("pretokenizers") or [{}]
        added = settings.get("added_tokens") or []
        return (
            settings.get("normalizer") == cls.normalizer and parts[0] == cls.splitter and [x["type"] for x in parts[1:]] == ["ByteLevel"]
            and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"] and settings["model"]["type"] == "BPE" and not settings["model"].get("dropout")
            and all("<|" in x["content"] and not re.search(r"\s", x["content"]) and not (x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]) for x in added)
        )

    def of_part(self, part: bytes) -> bytes:
        """Ids of small letters, straight from the model."""
        text = part.decode() if part.isascii() else part.decode().translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def of_word(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters
            return self.of_part(word)
        if m := self.plain.fullmatch(word):
            return self.words[m[1]] + self.words[m[2]] if m[2] else self.of_part(word)
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), text after text with the end id, and each text's number of ids."""
        texts = pc.fill_null(texts, "")
        if not self.by_words:
            found = [np.array([*e.ids, END_ID], "<u4") for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(x) for x in found], np.int64)
        as_is = pc.match_substring_regex(texts, r"<\||[\x{300}-\x{37F}]")
        lists = pc.ascii_split_whitespace(pc.if_else(as_is, texts, pc.ascii_lower(texts)))
        # Every distinct word is looked up once; Arrow tells words apart.
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary() if pa.types.is_string(coded.dictionary.type) else pa.large_binary()).to_pylist()
        known = [self.words[w] if w else b"" for w in words] + [array("I", [END_ID]).tobytes()]
        self.words.turn()
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        per_text = lists.value_lengths().to_numpy()
        at = np.insert(coded.indices.to_numpy(), np.cumsum(per_text), len(words))
        n = sizes[at]
        ids = flat[np.arange(n.sum()) + np.repeat(starts[at] - (np.cumsum(n) - n), n)]
        first = np.cumsum(per_text + 1) - (per_text + 1)
        return ids, np.add.reduceat(n, first) if len(first) else n


def encoder(settings: bytes) -> Encoder:
    """One encoder for each worker process, of the latest vocabulary."""
    name = hashlib.blake2b(settings).hexdigest()
    if name not in _memory:
        _memory.clear()
        _memory[name] = Encoder(settings)
    return _memory[name]


def write_files(batches, tokenizer: bytes, folder: str, file_ids: int = FILE_IDS):
    """Encodes sorted rows (d, t), writes files and yields (part, no, path, n_ids, n_docs) of each. A file appears under its name by a
    rename when it is complete, and a repeated task writes the same file again."""
    part, no = TaskContext.get().partitionId(), 0
    fs, root = open_shared(folder)
    of = encoder(tokenizer)
    doc_ids: list[int | None] = []
    counts: list[int] = []
    held: list[np.ndarray] = []

    def flush():
        nonlocal no
        data = to_file(doc_ids, counts, np.concatenate(held))
        name = f"{root}/part-{part:06d}-{no:06d}.pfor"
        temporary = f"{root}/_{uuid.uuid4().hex}"
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(temporary) as out:
            out.write(data)
        fs.move(temporary, name)
        row = {"part": [part], "no": [no], "path": [name.rsplit("/", 1)[-1]], "n_ids": [sum(counts)], "n_docs": [len(counts)]}
        no += 1
        for x in (doc_ids, counts, held):
            x.clear()
        return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("no", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    size = 0
    for batch in chunks(batches, "t"):
        ids, each = of.encode(batch.column("t"))
        begin, end = 0, 0
        for doc, n in zip(batch.column("d").to_pylist(), each.tolist(), strict=True):
            doc_ids.append(doc)
            counts.append(n)
            end += n
            size += n
            if size >= file_ids:
                held.append(ids[begin:end])
                yield flush()
                begin, size = end, 0
        if end > begin:
            held.append(ids[begin:end])
    if held:
        yield flush()


def write_tokens(df: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of df's texts to files below `folder`, documents in ascending order of their id (null last, then by text), and
    returns the table of files (path, n_ids, n_docs, first_id: ids in the files before), itself written below `folder`.

    The files come in order of (part, no). Ids are whole numbers, as the format has them, or strings of such; any other string id fails. Null
    text counts as empty; repeated rows are repeated in the files; an empty table gives none; other columns are not read.
    """
    ship_code(df.sparkSession)
    rows = df.select(df[id_col].cast("long").alias("d"), df[text_col].alias("t"))
    settings = Path(tokenizer).read_bytes()  # the file need not be on the executors
    key = [F.col("d").asc_nulls_last()]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key, "t")
    files = written(ordered.mapInArrow(lambda x: write_files(x, settings, f"{folder}/ids", file_ids), "part int, no int, path string, n_ids long, n_docs long"), folder, "files")
    # One row for a file of millions of ids: this window sees a few rows for each terabyte.
    order = Window.orderBy("part", "no")
    return files.withColumn("first_id", F.sum("n_ids").over(order) - F.col("n_ids"))


def read_tokens(df_files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files that the table names."""
    spark = df_files.sparkSession
    ship_code(spark)
    if df_files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    data = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(f"{folder}/ids")

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                content = content.as_py()
                _, _, doc_ids, nulls, starts = read_head(content)
                raw = memoryview(read_ids(content).astype("<u4").tobytes())
                ends = starts.astype(np.int64)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns = [pa.array([path] * len(crc)), pa.array(np.array(doc_ids), mask=nulls.astype(bool)), pa.array(ends[:-1]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = data.select(F.element_at(F.split("path", "/"), -1).alias("path"), "content").mapInArrow(decode, "path string, doc_id long, at long, n_tokens long, ids_crc32 long")
    docs = docs.join(df_files.select("path", "first_id"), "path")
    return docs.select("doc_id", (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_table(df: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Writes the files and reads them back."""
    folder = folder or shared_folder(df.sparkSession)
    return read_tokens(write_tokens(df, tokenizer, folder, **options), folder)
