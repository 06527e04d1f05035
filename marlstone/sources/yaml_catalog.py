"""YAML documents with an envelope and a list of rows.

All files go through Hadoop's file systems. A large document is cut before each row of its list, and tasks parse the pieces (see Cut); a
small one, or one that cannot be cut so, is read as one row of bytes and parsed in one task; rows of a large one are handed on in parts and kept
as a table. Rows have a column for every field, `_pos`, `_keys` (the keys that a row has, in order), `_type` (mapping, or what else stands there) and
`_rest`: the JSON text of each value that no field holds, be its key unknown or its type another one. Written rows have their keys in
order, so a document that is read and written again keeps what it had. Writing is Spark's: tasks write rows as text, and the driver
appends their files one after the other, a few kilobytes at a time.
"""

from __future__ import annotations

import datetime
import functools
import json
import os
import pickle
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFERRED, ENTRY
from .storage import Store, beside, ship_package, work_folder, written

QUEUE_NAME = "deferred.yml"
#: The version and the names in an envelope.
VERSION, ENTRIES, TARGETS, DATED = 1, "entries", "targets", "generated_at"
#: A date in JSON, which YAML writes without quotes.
DATE_MARK = "!date"
#: Documents of up to so many bytes are parsed whole; what stands before and after the list of a larger one has at most that many.
WHOLE_BYTES = 1 << 20
#: So many pieces are parsed, or rows of a document that is parsed whole taken, before their rows are handed on.
PIECES = 1_000
REST = T.StructField("_rest", T.MapType(T.StringType(), T.StringType()))
EXTRA = [T.StructField("_type", T.StringType()), REST]


def queue_path(registry_path: str) -> str:
    """The queue lies beside the registry."""
    return os.path.join(os.path.dirname(registry_path), QUEUE_NAME)


def to_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, default=lambda x: {DATE_MARK: x.isoformat()} if isinstance(x, datetime.date) else str(x))


def from_json(text: str):
    def dated(d):
        return (datetime.date if len(d[DATE_MARK]) == 10 else datetime.datetime).fromisoformat(d[DATE_MARK]) if list(d) == [DATE_MARK] else d

    return json.loads(text, object_hook=dated)


def type_of(value) -> str:
    for name, kinds in (("null", type(None)), ("boolean", bool), ("number", (int, float)), ("string", str), ("date", datetime.date), ("list", list), ("mapping", dict)):
        if isinstance(value, kinds):
            return name
    return type(value).__name__


def plain(value, kind: str):
    """A value as its field's type, and whether that is all of it."""
    if value is None:
        return None, True
    if kind == "array":
        return ([str(v) for v in value], all(isinstance(v, str) for v in value)) if isinstance(value, list) else (None, False)
    if kind == "boolean":
        return bool(value), isinstance(value, bool)
    if isinstance(value, list | dict):
        return None, False
    return value.isoformat() if isinstance(value, datetime.date) else str(value), isinstance(value, str)


#: Text and rows that libyaml and the parser and emitter in Python treat alike: lines of plain or single-quoted words, names as keys, short ASCII
#: texts. It takes a fifth of the time; everything else, or all where it is not installed, is Python's.
ALIKE = re.compile(rb"(?: *(?:- )*(?:[A-Za-z_][\w-]{0,63}:)?(?: ?(?:\[\]|\{\}|'[A-Za-z0-9 _./:*?=&+,()~;-]{0,80}'|[A-Za-z0-9./](?:[A-Za-z0-9_./*?=&+,()~;-]|:(?=[^\s])| (?=[A-Za-z0-9/(])){0,80}))?\n)+")
ALIKE_KEY, ALIKE_TEXT = re.compile(r"[A-Za-z_][\w-]{0,63}", re.ASCII), re.compile(r"[ -~]{0,80}")


def alike(value, nested: bool = False) -> bool:
    if isinstance(value, str):
        return bool(ALIKE_TEXT.fullmatch(value))
    if isinstance(value, list):
        return not nested and all(alike(v, True) for v in value)
    return value is None or isinstance(value, bool)


def loaded(text: bytes) -> object:
    import yaml

    doc = yaml.load(text, getattr(yaml, "CSafeLoader", yaml.SafeLoader) if len(text) <= WHOLE_BYTES and ALIKE.fullmatch(text) else yaml.SafeLoader)
    return {} if doc is None or doc == "" else doc


def opened(content: bytes, name: str, keep: bool = True) -> tuple[object, int, Iterator[list]]:
    """(document, number of its list's rows, the rows in parts). Rows of a large document are made one by one and kept in a file until its end, since
    only then its text is known to be right and the list to be the last of that name; the document's list is empty then. keep: rows are wanted."""
    if len(content) <= WHOLE_BYTES:
        doc = loaded(content)
        rows = doc.get(name) if isinstance(doc, dict) else None
        rows = rows if isinstance(rows, list) else []
        return doc, len(rows), (rows[i : i + PIECES] for i in range(0, len(rows), PIECES))
    loader = row_loader()(content)
    loader.start(name, keep)
    try:
        doc = loader.get_single_data()
    finally:
        loader.dispose()
    doc = {} if doc is None or doc == "" else doc
    rows = doc.get(name) if isinstance(doc, dict) else None
    if rows is LISTED:
        doc[name] = []
        return doc, loader.n, loader.parts()
    rows = rows if isinstance(rows, list) else []  # one with an anchor, or from another mapping
    return doc, len(rows), (rows[i : i + PIECES] for i in range(0, len(rows), PIECES))


#: Stands for a list whose rows are kept elsewhere; no text can have the tag.
LISTED, LISTED_TAG = object(), "\0listed"


@functools.cache
def row_loader() -> type:
    """PyYAML's safe loader, but for the list of a document's mapping: its rows are made one by one, and their nodes forgotten."""
    import yaml

    class RowLoader(yaml.SafeLoader):
        def start(self, name: str, keep: bool) -> None:
            self.wanted, self.keep, self.depth = name, keep, 0

        def compose_node(self, parent, index):
            if self.depth == 0:
                self.around = self.peek_event().anchor  # a row may hold the document then, which is whole at its end only
            named = self.depth == 1 and isinstance(index, yaml.ScalarNode) and index.tag == "tag:yaml.org,2002:str" and index.value == self.wanted
            if named and not self.around and self.check_event(yaml.SequenceStartEvent) and self.peek_event().anchor is None and self.peek_event().tag is None:
                return self.compose_rows()
            self.depth += 1
            try:
                return super().compose_node(parent, index)
            finally:
                self.depth -= 1

        def compose_rows(self):
            start = self.get_event()
            self.n, self.part, self.file = 0, [], tempfile.TemporaryFile()
            self.depth += 1
            while not self.check_event(yaml.SequenceEndEvent):
                row = self.construct_document(self.compose_node(None, self.n))
                self.n += 1
                if self.keep:
                    self.part.append(row)
                if len(self.part) == PIECES:
                    pickle.dump(self.part, self.file)
                    self.part = []
            self.depth -= 1
            return yaml.ScalarNode(LISTED_TAG, "", start.start_mark, self.get_event().end_mark)

        def parts(self) -> Iterator[list]:
            self.file.seek(0)
            for _ in range((self.n - len(self.part)) // PIECES if self.keep else 0):
                yield pickle.load(self.file)
            if self.part:
                yield self.part

    RowLoader.add_constructor(LISTED_TAG, lambda loader, node: LISTED)
    return RowLoader


def dumped(rows: list) -> str:
    import yaml

    simple = all(isinstance(r, dict) and all(ALIKE_KEY.fullmatch(k) and alike(v) for k, v in r.items()) for r in rows)
    return yaml.dump(rows, Dumper=getattr(yaml, "CSafeDumper", yaml.SafeDumper) if simple else yaml.SafeDumper, allow_unicode=True, sort_keys=False, width=120)


def laid_out(row, at: int, schema: T.StructType) -> dict:
    """A row of a document as the columns of schema, `_type` and `_rest`."""
    out = {f.name: None for f in schema} | {"_pos": at, "_type": type_of(row), "_rest": None}
    if not isinstance(row, dict):
        out["_rest"] = {"": to_json(row)}
        return out
    keys = [str(k) for k in row]
    if "_keys" in out:
        out["_keys"] = keys
    kinds = {f.name: f.dataType.typeName() for f in schema if not f.name.startswith("_")}
    rest = {}
    for key, value in zip(keys, row.values(), strict=True):
        if key in kinds:
            out[key], whole = plain(value, kinds[key])
        if key not in kinds or not whole:
            rest[key] = to_json(value)
    return out | {"_rest": rest or None}


def bytes_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


@dataclass
class Cut:
    """Where a document is cut. Every `separator` (a line's end, an indentation, a dash) begins a piece; the first `before` pieces and the last
    `after` ones belong to the text around the list, whose keys are in `doc`; `tail` follows the last row in its piece, and `end` is the last piece of all.

    A piece that is parsed by itself as a list of one row, without anchors and marks of documents, ends outside of quotes and brackets. So
    does the text before the list. Then each next piece starts where the list's next row does, and the rows are those of the whole
    document. Where one piece is anything else, the document is parsed whole."""

    separator: bytes
    before: int
    after: int
    tail: bytes
    end: bytes
    doc: dict

    @classmethod
    def of(cls, store: Store, path: str, name: str) -> Cut | None:
        if not store.is_file(path) or (size := store.size(path)) <= WHOLE_BYTES:
            return None
        head = store.part(path, 0, WHOLE_BYTES)
        found = re.search(rb"(?m)^" + re.escape(name.encode()) + rb":[ \t]*(?:#[^\n]*)?\r?\n(?:[ \t]*(?:#[^\n]*)?\r?\n)*( *)- ", head)
        if not found or re.search(rb"(?m)^%", head[: found.end()]) or head.startswith(b"\xef\xbb\xbf"):
            return None
        separator = b"\n" + found[1] + b"- "
        at = max(found.end(), size - WHOLE_BYTES)
        end = store.part(path, at, size - at)
        key = re.search(rb"\n(?=[^\s#\-])", end)
        tail = end[key.end() :] if key else b""
        mark = uuid.uuid4().hex
        try:
            doc = loaded(head[: found.end()] + b"x" + mark.encode() + b"\n" + tail)
        except Exception:  # the whole document's parser tells what is wrong
            return None
        if not isinstance(doc, dict) or doc.get(name) != [f"x{mark}"] or end.endswith(separator) or (separator not in end and at > found.end()):
            return None
        return cls(separator, head[: found.end()].count(separator), tail.count(separator), tail.split(separator)[0], end.split(separator)[-1], doc)

    def row(self, piece: bytes):
        """(row, whether the tail was taken off), or None for a piece that is not one row."""
        found, short = one_row(self.separator[1:] + piece + b"\n"), False
        if found and piece == self.end:  # no line may end it
            found = found if one_row(self.separator[1:] + piece) == found else None
        if not found and self.tail and piece.endswith(self.tail):
            found, short = one_row(self.separator[1:] + piece[: -len(self.tail)]), True
        return (found[0], short) if found else None


def one_row(text: bytes) -> list | None:
    """The list that a text is, if it has one row and ends where it seems to."""
    if re.search(rb"(?m)^(---|\.\.\.)", text):
        return None
    try:
        if re.search(rb"(?<![A-Za-z0-9_/=.])[&*][A-Za-z0-9_-]", text) and has_anchor(text):
            return None
        rows = loaded(text)
    except Exception:  # the whole document's parser tells what is wrong
        return None
    return rows if isinstance(rows, list) and len(rows) == 1 else None


def has_anchor(text: bytes) -> bool:
    import yaml

    return any(getattr(e, "anchor", None) for e in yaml.parse(text, yaml.SafeLoader))


def pieces(spark: SparkSession, path: str, cut: Cut, schema: T.StructType) -> DataFrame | None:
    """The rows of a document that is cut, as a table between steps, or None if a piece is not one row."""
    ship_package(spark)
    given = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_piece", T.LongType()), T.StructField("_is", T.StringType())])

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()  # a block's pieces come in their order
        for frame in frames:
            for start in range(0, len(frame), PIECES):
                part = frame.iloc[start : start + PIECES]
                out = []
                for block, piece in zip(part["block"], part["value"], strict=True):
                    found = cut.row(bytes(piece))
                    row = laid_out(found[0], 0, schema) if found else dict.fromkeys(full.names)
                    out.append(row | {"_block": block, "_piece": seen[block], "_is": "none" if not found else "last" if found[1] else "row"})
                    seen[block] += 1
                yield pd.DataFrame(out, columns=full.names, dtype=object)

    full = T.StructType([*schema.fields, *EXTRA, *given])
    text = spark.read.option("lineSep", cut.separator.decode()).text(path).select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))
    table = written(text.mapInPandas(parse, full), work_folder(spark), "pieces")
    # A row for each block of the file.
    blocks = table.groupBy("_block").agg(F.max("_piece").alias("n")).orderBy("_block").collect()
    ends = [-cut.before]
    for block in blocks:
        ends.append(ends[-1] + block["n"] + 1)
    n = ends[-1] - cut.after
    starts = spark.createDataFrame([(b["_block"], at) for b, at in zip(blocks, ends, strict=False)], "_block long, _start long")
    rows = table.join(F.broadcast(starts), "_block").withColumn("_pos", F.col("_start") + F.col("_piece")).where(F.col("_pos").between(0, n - 1))
    wanted = F.when((F.col("_pos") == n - 1) & F.lit(cut.tail != b""), "last").otherwise("row")
    checked = rows.agg(F.count("*").alias("n"), F.count_if(F.col("_is") != wanted).alias("odd")).first()
    return None if checked["odd"] or checked["n"] != n else rows.select(*schema.names, *(f.name for f in EXTRA))


def parsed(spark: SparkSession, path: str, schema: T.StructType = ENTRY, name: str = ENTRIES, missing: str = "fail", keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows (see read) and the envelope (see envelope) of a document. keep: the rows are used, so those of a large one are a table."""
    store = Store(spark, path)
    full = T.StructType([*schema.fields, *EXTRA])
    if missing == "empty" and not store.exists(path):
        return spark.createDataFrame([], full), spark.createDataFrame([("mapping", ["version", name], {"version": "number", name: "list"}, {"version": str(VERSION)}, 0)], ENVELOPE)
    if (cut := Cut.of(store, path, name)) and (rows := pieces(spark, path, cut, schema)) is not None:
        return rows, rows.agg(F.count("*").alias("n_rows")).select(*envelope_columns(cut.doc, name), "n_rows")
    rows = whole_rows(spark, path, full, schema, name)
    if keep and store.is_file(path) and store.size(path) > WHOLE_BYTES:  # each use of its rows would parse it again
        rows = written(rows, work_folder(spark), "rows")
    return rows, whole_envelope(spark, path, name)


def read(spark: SparkSession, path: str, schema: T.StructType = ENTRY, name: str = ENTRIES, missing: str = "fail") -> DataFrame:
    """The rows of a document. missing: `fail`, or `empty` for no rows where there is no file. A document whose list is absent, or is no
    list, has no rows; see envelope. An unparsable document is an error."""
    return parsed(spark, path, schema, name, missing)[0]


def whole_rows(spark: SparkSession, path: str, full: T.StructType, schema: T.StructType, name: str) -> DataFrame:
    ship_package(spark)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                at = 0
                for rows in opened(content, name)[2]:
                    yield pd.DataFrame([laid_out(r, at + i, schema) for i, r in enumerate(rows)], columns=full.names, dtype=object)
                    at += len(rows)

    return bytes_of(spark, path).mapInPandas(parse, full)


ENVELOPE = "type string, keys array<string>, types map<string,string>, values map<string,string>, n_rows long"


def enveloped(doc, name: str) -> dict:
    """What an envelope tells of a document, but for the number of rows."""
    found = {str(k): v for k, v in doc.items()} if isinstance(doc, dict) else {}
    return {
        "type": type_of(doc), "keys": list(found), "types": {k: type_of(v) for k, v in found.items()},
        "values": {k: to_json(v) for k, v in found.items() if k != name},
    }


def envelope_columns(doc, name: str) -> list[Column]:
    told = enveloped(doc, name)
    texts = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv)).cast("map<string,string>")
    return [F.lit(told["type"]).alias("type"), F.array(*map(F.lit, told["keys"])).alias("keys"), texts(told["types"]).alias("types"), texts(told["values"]).alias("values")]


def envelope(spark: SparkSession, path: str, name: str = ENTRIES, missing: str = "fail") -> DataFrame:
    """One row for a document: its type, its keys in order, the type of each and the JSON of each but the list, and the number of rows. An
    empty document is an empty mapping; a missing one with `empty` is one of the right version without rows."""
    return parsed(spark, path, ENTRY, name, missing, keep=False)[1]


def whole_envelope(spark: SparkSession, path: str, name: str) -> DataFrame:
    store = Store(spark, path)
    if store.is_file(path) and store.size(path) == 0:  # readers pass over empty files
        return spark.createDataFrame([("mapping", [], {}, {}, 0)], ENVELOPE)
    ship_package(spark)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                doc, n, _ = opened(content, name, keep=False)
                yield pd.DataFrame([enveloped(doc, name) | {"n_rows": n}])

    return bytes_of(spark, path).mapInPandas(parse, ENVELOPE)


def dated(head: dict, run_date: str, name: str = ENTRIES) -> dict:
    """An envelope (see head_of) of a written document: this version and this date, whatever else it has, keys in their order."""
    return head | {name: None} | {"version": VERSION, DATED: run_date}


def head_of(row) -> dict:
    """Keys and values of an envelope's row, the list's value left out as None."""
    return {k: from_json(row["values"][k]) if k in row["values"] else None for k in row["keys"]}


def column_json(rows: DataFrame) -> Column:
    fields = [c for c in rows.columns if not c.startswith("_")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def dealt(rows: DataFrame, *order: str) -> DataFrame:
    """rows in order, in as many even parts as there are cores. A row's text takes long for its size, by which Spark would put rows into a few parts."""
    return rows.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism, *order).sortWithinPartitions(*order)


def texts(rows: DataFrame) -> DataFrame:
    """(value): the YAML text of each row, in the order of rows. `_keys` says which keys a row has, all fields without it."""
    ship_package(rows.sparkSession)
    fields = [c for c in rows.columns if not c.startswith("_")]
    keys = F.col("_keys") if "_keys" in rows.columns else F.lit(None).cast("array<string>")
    rest = F.col("_rest") if "_rest" in rows.columns else F.lit(None).cast("map<string,string>")

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for entry, keys, rest in zip(frame["entry"], frame["keys"], frame["rest"], strict=True):
                row, others = json.loads(entry), {k: from_json(v) for k, v in json.loads(rest).items()} if rest else {}
                whole = {k: others[k] if k in others else row.get(k) for k in (fields if keys is None else keys)}
                out.append(dumped([others[""] if "" in others and keys is None else whole])[:-1])
            yield pd.DataFrame({"value": out})

    return rows.select(column_json(rows).alias("entry"), keys.alias("keys"), F.to_json(rest).alias("rest")).mapInPandas(render, "value string")


def frame_of(head: dict, name: str) -> tuple[str, str]:
    """The envelope's text before and after the rows."""
    import yaml

    text = lambda d: yaml.safe_dump(d, allow_unicode=True, sort_keys=False, width=120) if d else ""
    keys = list(head)
    at = keys.index(name)
    return text({k: head[k] for k in keys[:at]}), text({k: head[k] for k in keys[at + 1 :]})


def stage(rows: DataFrame, path: str, head: dict, name: str = ENTRIES) -> str:
    """Writes a whole document beside path and gives its name. rows are ordered; head is the envelope, with the list's key in its place."""
    store = Store(rows.sparkSession, path)
    folder, staged = beside(path, "rows"), beside(path, "new")
    before, after = frame_of(head, name)
    try:
        texts(rows).write.text(store.uri(folder))
        parts = store.files(folder, ".txt")
        empty = not any(store.size(p) for p in parts)
        store.write(staged, before, f"{name}: []\n" if empty else f"{name}:\n", parts, after)
    finally:
        store.delete(folder)
    return staged


def save(rows: DataFrame, path: str, head: dict, name: str = ENTRIES) -> None:
    """Writes a document; it is complete before it replaces an old one."""
    store = Store(rows.sparkSession, path)
    store.move(stage(rows, path, head, name), path)


def dump(rows: DataFrame, out, head: dict, name: str = ENTRIES) -> None:
    """Writes a document to an open file, such as standard output; rows come part by part."""
    before, after = frame_of(head, name)
    out.write(before)
    first = True
    for row in texts(rows).toLocalIterator():
        out.write((f"{name}:\n" if first else "") + row["value"] + "\n")
        first = False
    out.write((f"{name}: []\n" if first else "") + after)
