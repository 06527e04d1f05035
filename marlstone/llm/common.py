"""Shared folder, code shipping and text helpers used by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words where a contract says `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\f\r"
#: Java and RE2 class of the same characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: bytes.translate table: A-Z lower-cased, everything that is no word character of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` to a blank.
ALNUM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: bytes.translate table: A-Z lower-cased, nothing else changed.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Characters of text that one Python step holds at a time.
CHUNK_BYTES = 4_000_000
#: Rows of a table that is sent whole to all tasks (keys and a few numbers: about a megabyte).
SENT_WHOLE = 1 << 14

_shipped: set[str] = set()


class Remembered(dict):
    """Values of a function by its argument, the latest `most` at least, `2 * most` and one step's at most: a full memory becomes the old
    one, which still answers."""

    def __init__(self, made, most: int):
        super().__init__()
        self.made, self.most, self.old = made, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.made(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            super().clear()

    def clear(self) -> None:
        super().clear()
        self.old = {}


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers once per application, so that they need no installation of it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="ship-"))
    target = folder / f"{top.name}_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession, keep: bool = False) -> str:
    """A new folder (its URI) below spark.checkpoint.dir, which driver and executors share. It is removed when the application ends, unless
    `keep`. Where that setting is unset, a local session gets a temporary folder; on a cluster that is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = Path(tempfile.mkdtemp(prefix="marlstone-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", top)
    uri = f"{top.rstrip('/')}/work-{uuid.uuid4().hex}"
    if not keep:
        file_system(spark, uri)[0].deleteOnExit(file_system(spark, uri)[1])
    return uri


def file_system(spark: SparkSession, uri: str):
    """Hadoop's (file system, path) of a URI."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df as a table written in the shared folder: lineage ends there, and a lost executor costs no recomputation of what came before."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(big: DataFrame, small: DataFrame, key: str, often: int = 512, rows: int | None = None) -> DataFrame:
    """big with the columns of small, which has one row for a key at most, or nulls. Rows with one of the `often` most frequent keys get
    them by a broadcast of so many rows, only the rest is shuffled; so a key of very many rows meets in no task. Where small is known to
    have `rows` and these are few, all are sent: a plan of one join, where the other has a dozen exchanges, all of which the driver keeps."""
    if rows is not None and rows <= SENT_WHOLE:
        return big.join(F.broadcast(small), key, "left")
    frequent = big.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(often).select(key)
    sent = F.broadcast(small.join(F.broadcast(frequent), key).withColumn("_sent", F.lit(True)))
    split = big.join(sent, key, "left")
    rest = split.where(F.col("_sent").isNull()).select(*big.columns).join(small, key, "left")
    columns = [*big.columns, *(c for c in small.columns if c != key)]
    return split.where("_sent").select(*columns).unionByName(rest.select(*columns))


def delete_tables(spark: SparkSession, folder: str, *names: str) -> None:
    """Removes tables of a folder that nothing reads any more."""
    for name in names:
        fs, path = file_system(spark, f"{folder}/{name}")
        fs.delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever signs it has."""
    return f"`{name.replace('`', '``')}`"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""
    flat = text
    for space in SPACES[1:]:
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    flat = F.trim(F.regexp_replace(flat, " {2,}", " "))  # single blanks, which are most, cost no match
    blanks = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(F.octet_length(flat) > 0, blanks + 1).otherwise(0).cast("long")


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(mod))


def utf8_values(column: pa.Array) -> list[bytes]:
    """The column's values as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def return_memory() -> None:
    """Gives freed memory back to the system: workers outlive the tasks that needed it, and share an executor's memory. Where the C library
    has no such call, it keeps what it has."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def chunks(batches, text: str, limit: int = CHUNK_BYTES):
    """Arrow batches cut so that each holds about `limit` bytes of text, or one row. After each of the batches freed memory is given back."""
    for batch in batches:
        sizes = [0 if x is None else x for x in pa.compute.binary_length(batch.column(text)).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
        return_memory()


def in_parts(batch: pa.RecordBatch, rows: int = 100_000):
    """A large batch in parts: the JVM holds a whole one outside its heap."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def open_shared(uri: str):
    """(file system, path) of a URI in the shared store, for Python workers. Hadoop's names of stores are told to Arrow by its own: S3 as s3a
    or s3n, Azure as wasb(s) or abfs(s), and DBFS as the folder where it is mounted. Of others Arrow knows file, hdfs, viewfs, s3 and gs."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme in ("wasb", "wasbs"):
        uri = f"abfs{'s' if scheme == 'wasbs' else ''}:{rest.replace('.blob.core.', '.dfs.core.', 1)}"
    elif scheme == "dbfs":
        uri = f"file:///dbfs/{rest.lstrip('/')}"
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def shared_dataset(uri: str):
    """A table of the shared store as a pyarrow dataset, for Python workers."""
    from pyarrow import dataset
    from pyarrow.fs import FileSelector

    fs, root = open_shared(uri)
    files = sorted(f.path for f in fs.get_file_info(FileSelector(root)) if f.path.endswith(".parquet"))
    return dataset.dataset(files, filesystem=fs, format="parquet")
