"""Files of the store that driver and executors share, through Hadoop's file systems, and the package for the executors' workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers once per application, so that they need no installation and no working directory."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


class Store:
    """The file system that a path lies on. Local files are written without checksum files beside them, so that other programs may
    change them."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        fs = self.path(path).getFileSystem(self.conf)
        self.fs = fs.getRawFileSystem() if fs.getUri().getScheme() == "file" and hasattr(fs, "getRawFileSystem") else fs

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def size(self, path: str) -> int:
        return self.fs.getFileStatus(self.path(path)).getLen()

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self.fs.getFileStatus(self.path(path)).isFile()

    def uri(self, path: str) -> str:
        return self.fs.makeQualified(self.path(path)).toString()

    def read(self, path: str) -> str:
        """A small file as text."""
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def part(self, path: str, start: int, n: int) -> bytes:
        """At most n bytes of a file, from start."""
        stream = self.fs.open(self.path(path))
        try:
            stream.seek(start)
            return bytes(stream.readNBytes(n))
        finally:
            stream.close()

    def write(self, path: str, *parts: str | list[str], new: bool = False) -> None:
        """A file of texts and, in lists, of other files' contents, which are copied in a few kilobytes at a time. new: it must not exist."""
        out = self.fs.create(self.path(path), not new)
        try:
            for part in parts:
                if isinstance(part, str):
                    out.write(bytearray(part.encode()))
                    continue
                for name in part:
                    stream = self.fs.open(self.path(name))
                    try:
                        self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 65_536, False)
                    finally:
                        stream.close()
        finally:
            out.close()

    def files(self, folder: str, suffix: str = "") -> list[str]:
        """Files of a folder that Spark wrote, by name."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path(folder)) if s.isFile()]
        return [f"{folder}/{n}" for n in sorted(names, key=lambda n: (len(n), n)) if n[0] not in "._" and n.endswith(suffix)]

    def empty_files(self, folder: str) -> list[str]:
        found = [s.getPath() for s in self.fs.listStatus(self.path(folder)) if s.isFile() and s.getLen() == 0]
        return sorted(p.toString() for p in found if p.getName()[0] not in "._")

    def move(self, source: str, target: str) -> None:
        """source takes target's place."""
        if not self.fs.rename(self.path(source), self.path(target)):
            self.delete(target)
            if not self.fs.rename(self.path(source), self.path(target)):
                raise OSError(f"{source} cannot be moved to {target}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def beside(path: str, what: str) -> str:
    """A new hidden name in the folder of a path."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/.{name}.{uuid.uuid4().hex}.{what}" if folder or path.startswith("/") else f".{name}.{uuid.uuid4().hex}.{what}"


class Replacement:
    """Several documents that change together or not at all.

    New contents are staged beside their documents. A journal in the folder of the first one then names all documents; their old files are
    set aside and the staged ones take their places; when the journal goes, the change has happened. What stopped before that is undone by
    recover(), which every command calls first. Only one replacement can be under way, since a journal is never overwritten."""

    def __init__(self, spark: SparkSession, *paths: str):
        self.store, self.paths = Store(spark, paths[0]), paths
        folder, _, name = paths[0].rpartition("/")
        self.journal = f"{folder}/.{name}.journal" if folder or paths[0].startswith("/") else f".{name}.journal"

    def recover(self) -> bool:
        """Puts back what an unfinished replacement had set aside; whether there was one."""
        import json

        if not self.store.exists(self.journal):
            return False
        text = self.store.read(self.journal)
        # A journal that is not complete was being written: nothing had been moved yet.
        for path, staged, aside, existed in json.loads(text)["documents"] if text.endswith("}\n") else []:
            if existed and self.store.exists(aside):
                self.store.move(aside, path)
            elif not existed and not self.store.exists(staged):
                self.store.delete(path)
            self.store.delete(staged)
        self.store.delete(self.journal)
        return True

    def replace(self, staged: list[str]) -> None:
        import json

        rows = [(p, s, beside(p, "old"), self.store.exists(p)) for p, s in zip(self.paths, staged, strict=True)]
        self.store.write(self.journal, json.dumps({"documents": rows}) + "\n", new=True)
        for path, new, aside, existed in rows:
            if existed:
                self.store.move(path, aside)
            self.store.move(new, path)
        self.store.delete(self.journal)
        for _, _, aside, _ in rows:
            self.store.delete(aside)


def work_folder(spark: SparkSession) -> str:
    """A new folder (its URI) below spark.checkpoint.dir for tables between steps, removed when the application ends. Where that setting is
    unset, a local session gets a temporary folder; on a cluster that is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = Path(tempfile.mkdtemp(prefix="marlstone-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", top)
    uri = f"{top.rstrip('/')}/steps-{uuid.uuid4().hex}"
    store = Store(spark, uri)
    store.fs.deleteOnExit(store.path(uri))
    return uri


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df as a table of the folder: its lineage ends there."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
