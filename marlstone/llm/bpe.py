"""BPE encoding as a streaming transducer of bounded lookahead, and decoding as an incremental byte-to-text machine.

Encoding. Merges apply in the order of the list, so of a piece of text whose end is not known yet only the last few symbols can still come
out differently. How many follows from the list alone. Compare the merges of a piece x with those of x and more text: at first both have a
boundary at the end of x. A merge (u, v) across the last common boundary, in one of the two only, moves that boundary left by the length of
u. The next one to move it is later in the list and has a right part that begins with u, as u, or what u grew into, now stands right of the
boundary. So the longest such chain of merges, weighed by the lengths of their left parts, bounds how far any later text can reach back:
`lookahead` finds it in one pass over the list. The transducer holds a window, merges it, emits the tokens that end before the last
`lookahead` symbols, and goes on with the rest; boundaries that stay are never merged over, so the rest can be merged by itself. Its
memory is the window, whatever the length of a piece.

This takes a list in which a merge comes after those that make its parts, as all trained lists are; any other is refused.

Decoding. Ids become bytes, and bytes text, step by step; bytes of an unfinished character wait for the next step.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, quoted, ship_code
from .tokens import Encoder

#: Symbols that the transducer holds at a time, if that is more than the lookahead needs.
WINDOW = 4096
#: Windows of fewer symbols are merged by looking at all pairs again.
SMALL = 40
#: Ids that the decoder takes in one step.
STEP = 65_536

_memory: dict[tuple[str, str], object] = {}


class Merges:
    """A merge list over vocabulary ids. Symbols are the characters of a piece; the last one has the suffix, if the vocabulary has one."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "fuse_unk")):
            raise ValueError("only plain BPE vocabularies can be streamed")
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.made = [self.vocab[u + v] for u, v in pairs]
        self.ranks = {(self.vocab[u], self.vocab[v]): rank for rank, (u, v) in enumerate(pairs)}
        self.lookahead = self.reach(pairs)
        self.longest = max(map(self.length, self.vocab), default=1)

    def length(self, token: str) -> int:
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)

    def reach(self, pairs: list[tuple[str, str]]) -> int:
        """The sufficient lookahead: the heaviest chain of merges, each later in the list than the one before and with a right part that the
        left part of the one before begins."""
        starts: dict[str, set[str]] = {}  # the tokens that a token began as, itself included
        weight: dict[str, int] = {}  # heaviest chain so far that ends with this left part
        first: dict[str, int] = {}
        for rank, (u, v) in enumerate(pairs):
            first.setdefault(u + v, rank)
        for rank, (u, v) in enumerate(pairs):
            if any(first.get(x, -1) >= rank for x in (u, v)):
                raise ValueError(f"merge {rank} comes before one that makes its parts")
            chain = self.length(u) + max((weight.get(x, 0) for x in starts.get(v, {v})), default=0)
            weight[u] = max(weight.get(u, 0), chain)
            starts.setdefault(u + v, {u + v}).update(starts.get(u, {u}))
        return max(weight.values(), default=0)

    def symbols(self, piece: str, ends: bool) -> list[int]:
        """Ids of the characters; one that the vocabulary has not is passed over."""
        known = [self.vocab.get(c) for c in piece]
        if ends and piece:
            known[-1] = self.vocab.get(piece[-1] + self.suffix)
        return [x for x in known if x is not None]

    def merged(self, ids: list[int]) -> list[int]:
        """The tokens of symbols: the earliest merge of the list first, of equal ones the leftmost."""
        ranks, made, none = self.ranks.get, self.made, len(self.made)
        if len(ids) > SMALL:
            return self._merged_by_heap(ids)
        while len(ids) > 1:
            found = [ranks(pair, none) for pair in zip(ids, ids[1:])]
            rank = min(found)
            if rank == none:
                break
            at = found.index(rank)
            ids[at : at + 2] = [made[rank]]
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        ranks, made, n = self.ranks.get, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, at, at + 1) for at in range(n - 1) if (rank := ranks((ids[at], ids[at + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at, right = heapq.heappop(heap)
            # A pair that has changed since is no longer this merge.
            if ids[at] < 0 or after[at] != right or ranks((ids[at], ids[right])) != rank:
                continue
            ids[at], ids[right] = made[rank], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
                if (new := ranks((ids[at], ids[after[at]]))) is not None:
                    heapq.heappush(heap, (new, at, after[at]))
            if before[at] >= 0 and (new := ranks((ids[before[at]], ids[at]))) is not None:
                heapq.heappush(heap, (new, before[at], at))
        return [x for x in ids if x >= 0]


class Transducer:
    """Tokens of one piece that comes in parts: feed() gives those that no later text can change, end() the rest."""

    def __init__(self, merges: Merges, window: int = WINDOW):
        self.merges = merges
        self.window = max(window, 2 * (merges.lookahead + merges.longest))
        self.lengths = {i: merges.length(t) for t, i in merges.vocab.items()} if len(merges.vocab) else {}
        self.held = ""

    def feed(self, part: str) -> list[int]:
        out: list[int] = []
        for at in range(0, len(part), self.window):
            self.held += part[at : at + self.window]
            while len(self.held) > self.window:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        """The last symbol of the window may be the piece's last and have the suffix, so it stays out. Characters that are not in the
        vocabulary separate nothing; they are dropped as they come."""
        vocab = self.merges.vocab
        known = "".join(c for c in self.held[: self.window] if c in vocab)
        tokens = self.merges.merged(self.merges.symbols(known, ends=False))
        size, sure = 0, len(known) - self.merges.lookahead
        for n, token in enumerate(tokens):
            if size + self.lengths[token] > sure:
                break
            size += self.lengths[token]
        else:
            n = len(tokens)
        self.held = known[size:] + self.held[self.window :]
        return tokens[:n]

    def end(self) -> list[int]:
        piece, self.held = self.held, ""
        return self.merges.merged(self.merges.symbols(piece, ends=True))


class StreamEncoder(Encoder):
    """Ids as the tokenizers library gives them. Its normaliser and splitter make the pieces, the transducer their tokens; with a vocabulary
    whose words can be told apart, short words are remembered."""

    def __init__(self, settings: bytes):
        super().__init__(settings)
        described = json.loads(settings)
        added = described.get("added_tokens") or []
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError("added tokens that match by rules cannot be streamed")
        self.merges = Merges(described["model"])
        self.added = {x["content"]: x["id"] for x in added}
        names = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.transducer = Transducer(self.merges)

    def of_piece(self, piece: str) -> list[int]:
        if len(piece) <= SMALL:
            return self.merges.merged(self.merges.symbols(piece, ends=True))
        out = self.transducer.feed(piece)
        return out + self.transducer.end()

    def of_part(self, part: bytes) -> bytes:
        text = part.decode() if part.isascii() else part.decode().translate(self.alphabet)
        return array("I", self.of_piece(text)).tobytes()

    def of_word(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters
            return self.of_part(word)
        if m := self.plain.fullmatch(word):
            return self.words[m[1]] + self.words[m[2]] if m[2] else self.of_part(word)
        return self.of_text(word.decode()).tobytes()

    def of_text(self, text: str) -> array:
        ids = array("I")
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                before, normalizer = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
                plain = normalizer.normalize_str(part) if normalizer else part
                for piece, _ in before.pre_tokenize_str(plain) if before else [(plain, None)]:
                    ids.extend(self.of_piece(piece))
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), text after text, and each text's number of ids."""
        if not self.by_words:
            found = [self.of_text(x) for x in pc.fill_null(texts, "").to_pylist()]
            return np.frombuffer(b"".join(x.tobytes() for x in found), "<u4"), np.array([len(x) for x in found], np.int64)
        ids, sizes = super().encode(texts)
        return np.delete(ids, np.cumsum(sizes) - 1), sizes - 1


class Decoder:
    """Text of ids that come in steps: feed() gives what is certain, end() the rest. Ids that the vocabulary has not are passed over.

    A vocabulary without a decoder has its tokens joined by blanks; a byte-level one has the bytes that its tokens stand for, and a
    replacement character for what is no UTF-8."""

    def __init__(self, settings: bytes):
        described = json.loads(settings)
        kind = (described.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no decoder of the kind {kind}")
        self.glue = b"" if kind else b" "
        tokens = {i: t for t, i in described["model"]["vocab"].items()} | {x["id"]: x["content"] for x in described.get("added_tokens") or []}
        if kind:
            # The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for those from U+0100 on, in order.
            shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
            byte_of = {chr(b): b for b in shown} | {chr(0x100 + n): b for n, b in enumerate(sorted({*range(0x100)} - {*shown}))}
            known = lambda t: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        else:
            known = str.encode
        self.table = [None] * (max(tokens, default=-1) + 1)
        for i, t in tokens.items():
            self.table[i] = known(t)
        self.complete = None not in self.table
        self.reset()

    def reset(self) -> None:
        self.state, self.begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids) -> str:
        table = self.table
        if self.complete and len(ids) and ids.max() < len(table):
            parts = [table[i] for i in ids.tolist()]
        else:
            parts = [table[i] for i in ids.tolist() if i < len(table) and table[i] is not None]
        if not parts:
            return ""
        data = (self.glue if self.begun else b"") + self.glue.join(parts)
        self.begun = True
        return self.state.decode(data)

    def end(self) -> str:
        rest = self.state.decode(b"", True)
        self.reset()
        return rest

    def decode(self, ids: np.ndarray) -> str:
        out = [self.feed(ids[at : at + STEP]) for at in range(0, len(ids), STEP)]
        return "".join([*out, self.end()])


def remembered(made, settings: bytes):
    """One encoder and one decoder for each worker process, of the latest vocabulary."""
    key = (made.__name__, hashlib.blake2b(settings).hexdigest())
    if key not in _memory:
        for old in [k for k in _memory if k[0] == made.__name__]:
            del _memory[old]
        _memory[key] = made(settings)
    return _memory[key]


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df without its text, with the text's ids (array of int) as `ids_col`; a column of that name is replaced.

    The ids are those of the tokenizers library without special tokens of its own, truncation and padding; strings of added tokens that
    stand in a text are these tokens. Null and empty texts have no ids; a text of any length is taken whole, and of its longest piece the
    transducer holds one window; rows that repeat are repeated; an empty table stays empty; columns of any name pass through.
    """
    ship_code(df.sparkSession)
    settings = Path(tokenizer).read_bytes()  # the file need not be on the executors
    others = [c for c in df.columns if c not in (text_col, ids_col)]
    rows = df.select(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)), F.col(quoted(text_col)).alias("t"))

    def run(batches):
        of = remembered(StreamEncoder, settings)
        for batch in chunks(batches, "t"):
            ids, sizes = of.encode(batch.column("t"))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*batch.schema.names[:-1], "ids"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).toDF(*others, ids_col)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """df with the text of its ids as `text_col`, special tokens included; a column of that name is replaced.

    Null ids give an empty text, and so do none; a null or unknown id among them is passed over, as the library does with an unknown one.
    An empty table stays empty; columns of any name pass through."""
    ship_code(df.sparkSession)
    settings = Path(tokenizer).read_bytes()
    others = [c for c in df.columns if c not in (ids_col, text_col)]
    rows = df.select(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate([*others, ids_col])))

    def run(batches):
        of = remembered(Decoder, settings)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for at in range(0, batch.num_rows, 512):
                part = lists.slice(at, 512)
                ids = pc.fill_null(part.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.uint32)
                ends = np.cumsum(pc.fill_null(part.value_lengths(), 0).to_numpy(zero_copy_only=False)).tolist()
                texts = [of.decode(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 512).columns, pa.array(texts, pa.string())], [*batch.schema.names, "t"])

    found = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("t", T.StringType())]))
    return found.toDF(*others, ids_col, text_col)


def digests(df: DataFrame, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    listed = F.concat_ws(" ", F.col(ids_col).cast("array<string>"))
    return df.select("doc_id", F.size(ids_col).cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2(text_col, 256).alias("decoded_sha256"))
