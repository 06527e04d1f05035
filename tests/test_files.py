"""Documents and commands: what is in the files before and after."""

import io
import json
import subprocess
import sys
from pathlib import Path

import pytest
import yaml
from pyspark.sql import functions as F

from marlstone import cli
from marlstone.operators import payload, seed
from marlstone.plans import documents
from marlstone.schema import DEFERRED, ENTRY
from marlstone.sources import storage, yaml_catalog

DAY = "2026-07-20"


def entry(name, **more):
    return {"name": name, "url": f"https://{name}.com/x", "kind": "collection", "scan_paths": ["s/*"], "last_verified": "2026-01-01"} | more


def dumped(doc):
    return yaml.safe_dump(doc, sort_keys=False, allow_unicode=True, width=120)


def put(path, *rows, **head):
    path.write_text(dumped({"version": 1, "generated_at": "2026-01-01"} | head | {"entries": list(rows)}), encoding="utf-8")
    return str(path)


@pytest.fixture
def catalogue(tmp_path):
    """A registry and a queue with keys that no schema has, nulls, other types and a comment-free envelope with more keys."""
    long = "word " * 60
    rows = [entry("b", homepage="https://é.org", notes=None, extra={"z": [1, None, {"y": 2.5}], "a": True}, description=long), entry("a", tags=["t", 7], added=__import__("datetime").date(2026, 1, 2))]
    registry = put(tmp_path / "registry.yml", *rows, owner={"team": "x"})
    queue = [{"url": "https://q.com/1", "name": "q", "reason": "gated", "first_seen": "2026-01-01", "seen_by": ["me"]}, {"url": "https://q.com/2", "name": None, "reason": "r", "first_seen": "2026-01-01"}]
    put(tmp_path / "deferred.yml", *queue)
    return tmp_path, registry, rows, queue


def verdicts(path, *rows, wrapped=True):
    path.write_text(json.dumps({"verdicts": rows} if wrapped else list(rows)))
    return str(path)


def approve(e, url=None):
    return {"decision": "approve", "candidate": {"url": url or e["url"], "name": e["name"]}, "suggested_entry": e}


def test_round_trip_keeps_everything(spark, catalogue):
    """A document that is read and written again is the same text."""
    folder, registry, *_ = catalogue
    head = yaml_catalog.head_of(yaml_catalog.envelope(spark, registry).first())
    rows = yaml_catalog.read(spark, registry)
    yaml_catalog.save(rows.repartition(3).orderBy("_pos"), f"{folder}/again.yml", head)
    assert Path(f"{folder}/again.yml").read_text() == Path(registry).read_text()
    assert sorted(p.name for p in folder.iterdir()) == ["again.yml", "deferred.yml", "registry.yml"]  # no parts, no checksum files
    got = rows.orderBy("_pos").collect()
    assert got[0]["_keys"][-4:] == ["homepage", "notes", "extra", "description"] and got[0]["notes"] is None
    assert json.loads(got[0]["_rest"]["extra"]) == {"z": [1, None, {"y": 2.5}], "a": True} and set(got[1]["_rest"]) == {"tags", "added"}
    empty = put(folder / "empty.yml")
    yaml_catalog.save(yaml_catalog.read(spark, empty), empty, {"version": 1, "entries": None, "generated_at": "x"})
    assert yaml.safe_load(Path(empty).read_text()) == {"version": 1, "entries": [], "generated_at": "x"}


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_merge_command(spark, catalogue, capsys, mode):
    folder, registry, rows, queue = catalogue
    patch = {"name": "b", "url": "https://b.com/x", "kind": "registry", "scan_paths": [], "homepage": None, "extra": [1], "stars": 5}
    new = {"url": "https://n.com/x", "name": "aa", "kind": "collection", "scan_paths": ["p"], "rating": 4.5, "license": None}
    found = [
        approve(patch), approve(new, "https://q.com/1"), {"decision": "defer", "candidate": {"url": "https://q.com/3", "name": "é"}},
        {"decision": "defer", "candidate": {"url": "https://q.com/4"}, "reason": None}, {"decision": "reject", "candidate": {"url": "https://q.com/9"}, "reason": "stale"},
    ]
    args = ["merge", registry, verdicts(folder / "v.json", *found, wrapped=mode == "strict"), "--run-date", DAY, "--mode", mode]
    assert cli.main(args) == 0
    assert capsys.readouterr().out == "added=1 refreshed=1 deferred=2 rejected=1\n"
    want = {"version": 1, "generated_at": DAY, "owner": {"team": "x"}, "entries": [rows[1], new | {"last_verified": DAY}, rows[0] | patch | {"last_verified": DAY}]}
    assert (folder / "registry.yml").read_text() == dumped(want)
    added = [{"url": "https://q.com/3", "name": "é", "reason": "deferred", "first_seen": DAY}, {"url": "https://q.com/4", "name": None, "reason": None, "first_seen": DAY}]
    left = [queue[1], *added] if mode == "strict" else [queue[1], queue[0], *added]
    assert (folder / "deferred.yml").read_text() == dumped({"version": 1, "generated_at": DAY, "entries": left})
    assert sorted(p.name for p in folder.iterdir()) == ["deferred.yml", "registry.yml", "v.json"]


def test_merge_starts_a_catalogue(spark, tmp_path, capsys):
    path = verdicts(tmp_path / "v.json", approve(entry("n")), {"decision": "defer", "candidate": {"url": "https://d.com"}, "reason": "gated"})
    assert cli.main(["merge", str(tmp_path / "new.yml"), path, "--run-date", DAY]) == 0 and "added=1 refreshed=0 deferred=1 rejected=0" in capsys.readouterr().out
    assert (tmp_path / "new.yml").read_text() == dumped({"version": 1, "entries": [entry("n") | {"last_verified": DAY}], "generated_at": DAY})
    assert yaml.safe_load((tmp_path / "deferred.yml").read_text())["entries"] == [{"url": "https://d.com", "name": None, "reason": "gated", "first_seen": DAY}]


@pytest.mark.parametrize(
    "bad",
    [
        [{"decision": "maybe", "candidate": {"url": "u"}}], [{"decision": "approve", "candidate": {"url": "u"}, "suggested_entry": {"name": "z", "url": "u", "kind": "registry"}}],
        [{"decision": "approve", "candidate": {"url": "u"}}], [approve(entry("a", url="https://other.com/x"))],
    ],
)
def test_bad_verdicts_change_nothing(spark, catalogue, capsys, bad):
    folder, registry, *_ = catalogue
    before = {p.name: p.read_bytes() for p in folder.iterdir()}
    path = verdicts(folder / "v.json", approve(entry("fine")), *bad)
    assert cli.main(["merge", registry, path, "--run-date", DAY]) == 1
    out = capsys.readouterr()
    assert out.out == "" and out.err.startswith("ERROR: verdict 1: ") and out.err.count("\n") == 1
    assert {p.name: p.read_bytes() for p in folder.iterdir() if p.name != "v.json"} == before


@pytest.mark.parametrize("stop", [1, 2, 3, 4])
@pytest.mark.parametrize("queue_exists", [True, False])
def test_crash_between_renames(spark, catalogue, capsys, monkeypatch, stop, queue_exists):
    """Whichever rename is the last, the next command finds both documents as they were, and the same merge then gives the same line."""
    folder, registry, *_ = catalogue
    if not queue_exists:
        (folder / "deferred.yml").unlink()
    before = {p.name: p.read_bytes() for p in folder.iterdir()}
    path = verdicts(folder / "v.json", approve(entry("fine")), {"decision": "defer", "candidate": {"url": "https://d.com"}, "reason": "gated"})
    moved, move = [], storage.Store.move

    def crashing(self, source, target):
        moved.append(target)
        if len(moved) == stop:
            raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(storage.Store, "move", crashing)
    if stop == 4 and not queue_exists:  # one move less
        assert cli.main(["merge", registry, path, "--run-date", DAY]) == 0
        return
    with pytest.raises(KeyboardInterrupt):
        cli.main(["merge", registry, path, "--run-date", DAY])
    monkeypatch.setattr(storage.Store, "move", move)
    assert any(p.name.endswith(".journal") for p in folder.iterdir())
    assert cli.main(["validate", registry]) in (0, 1)
    assert {p.name: p.read_bytes() for p in folder.iterdir() if p.name != "v.json"} == before
    capsys.readouterr()
    assert cli.main(["merge", registry, path, "--run-date", DAY]) == 0
    assert capsys.readouterr().out == "added=1 refreshed=0 deferred=1 rejected=0\n"
    assert sorted(p.name for p in folder.iterdir()) == ["deferred.yml", "registry.yml", "v.json"]


def test_incomplete_journal_and_second_merge(spark, catalogue):
    """A journal that was being written means nothing had moved; while one is there no other replacement begins."""
    folder, registry, *_ = catalogue
    both = storage.Replacement(spark, registry, yaml_catalog.queue_path(registry))
    (folder / ".registry.yml.journal").write_text('{"documents": [')
    with pytest.raises(Exception, match="(?i)exist"):
        both.replace([registry, registry])
    assert both.recover() and not both.recover() and sorted(p.name for p in folder.iterdir()) == ["deferred.yml", "registry.yml"]


@pytest.mark.parametrize(
    ("text", "says"),
    [
        ("version: 1\n", "entries is no list but absent"), ("version: 1\nentries: {}\n", "entries is no list but a mapping"), ("version: 1\nentries:\n- a\n", "entry 0: an entry is no mapping but a string"),
        ("version: 1\nentries: null\n", "entries is no list but absent"), ("version: 2\nentries: []\n", "version is 2, not 1"), ("", "version is absent, not 1"), ("- 1\n", "the document is no mapping but a list"),
        ("version: '1'\nentries: []\n", 'version is "1", not 1'), ("version: 1\nentries:\n- {name: 5, url: 'https://a.b', kind: registry, scan_paths: [], last_verified: 2026-01-01}\n", "entry 0: bad name 5"),
        ("version: 1\nentries:\n- {name: x, url: 'https://a.b', kind: registry, scan_paths: a, last_verified: 2026-01-01}\n", "entry 0: scan_paths is no list"),
    ],
)
def test_envelope(spark, tmp_path, capsys, text, says):
    path = tmp_path / "r.yml"
    path.write_text(text)
    assert cli.main(["validate", str(path)]) == 1
    out = capsys.readouterr()
    assert out.out == "" and out.err == f"ERROR: {says}\n"


def test_valid_documents(spark, tmp_path, capsys):
    good = entry("c", last_verified=__import__("datetime").date(2026, 5, 8), requires_crawler="yes", scan_paths=[])
    for rows in ([], [good]):
        path = put(tmp_path / "r.yml", *rows)
        assert cli.main(["validate", path]) == 0 and capsys.readouterr().out == f"OK: {len(rows)} entries valid in {path}\n"


def test_dedupe_keeps_unknown_keys_and_nulls(spark, catalogue, capsys, monkeypatch):
    _, registry, *_ = catalogue
    kept = [
        {"zeta": {"k": None}, "url": "https://C.com/é/", "name": None, "topics": ["x", 1], "homepage": "h", "stars": None, "lane": 7},
        {"name": "d", "url": "https://d.com/1"},
    ]
    known = {"url": "https://B.com/x/", "name": "q"}
    for doc in ({"lane": "l", "candidates": [kept[0], known, kept[1]]}, [{"candidates": [kept[0]]}, known, {"candidates": []}, kept[1]], [kept[0], known, kept[1]]):
        monkeypatch.setattr("sys.stdin", io.StringIO(json.dumps(doc)))
        assert cli.main(["dedupe", "-", registry]) == 0
        want = {"new_candidates": [kept[0] | {"url": "https://c.com/é"}, kept[1]], "skipped": 1}
        assert capsys.readouterr().out == json.dumps(want, indent=2) + "\n"
    monkeypatch.setattr("sys.stdin", io.StringIO(json.dumps([known])))
    assert cli.main(["dedupe", "-", registry]) == 0 and capsys.readouterr().out == json.dumps({"new_candidates": [], "skipped": 1}, indent=2) + "\n"
    monkeypatch.setattr("sys.stdin", io.StringIO("{}"))
    assert cli.main(["dedupe", "-", registry]) == 1


def test_seed_keeps_unknown_keys(spark, tmp_path, capsys):
    blocks = [{"name": "z", "url": "https://z.com", "homepage": "h", "n": None, "deep": {"b": 1, "a": [2]}}, {"name": "a", "last_verified": "2026-01-02", "scan_paths": [1]}]
    text = "".join(f"text é\n```yaml seed\n{dumped(b)}```\n" for b in blocks)
    (tmp_path / "s.md").write_text(text)
    assert cli.main(["seed", str(tmp_path / "s.md"), "--run-date", DAY]) == 0
    assert capsys.readouterr().out == dumped({"version": 1, "generated_at": DAY, "entries": [blocks[1], blocks[0] | {"last_verified": DAY}]})
    places = seed.seed_blocks(spark.createDataFrame([(text,)], "value string")).collect()
    assert [text[r.place - 1 :].startswith(r.block) for r in places] == [True, True] and [r["_pos"] for r in places] == [0, 1]
    for block, says in (("- a", "no mapping"), ("url: x", "no name")):
        (tmp_path / "s.md").write_text(f"```yaml seed\n{block}\n```\n")
        assert cli.main(["seed", str(tmp_path / "s.md")]) == 1 and says in capsys.readouterr().err


def test_manifest_keys(spark, tmp_path, capsys):
    """Keys that an entry has come first, defaults after them."""
    rows = [entry("b", ref=None), {"url": "https://a.com", "name": "a", "kind": "registry"}, entry("c", ref=5, requires_crawler=True)]
    assert cli.main(["manifest", put(tmp_path / "r.yml", *rows), "--run-date", DAY]) == 0
    want = [
        {"name": "b", "url": "https://b.com/x", "ref": None, "kind": "collection", "scan_paths": ["s/*"], "requires_crawler": False},
        {"name": "a", "url": "https://a.com", "kind": "registry", "requires_crawler": False, "ref": "", "scan_paths": []},
        {"name": "c", "url": "https://c.com/x", "ref": 5, "kind": "collection", "scan_paths": ["s/*"], "requires_crawler": True},
    ]
    assert capsys.readouterr().out == dumped({"version": 1, "generated_at": DAY, "targets": want})


def test_corpus_of_payloads(spark, tmp_path):
    """Payload files of a folder: candidates of the well-formed ones, and for each of the others the file and the reason."""
    files = {
        "a.json": '{"lane": "x", "candidates": [{"url": "u1"}, {"url": "u2"}]}', "b.json": "{broken", "c.json": '{"lane": "b"}', "d.json": "[7]", "e.json": "", "f.json": "[]", "g.json": "7",
        "h.json": '{"candidates": {"url": "u"}}', "i.json": '[{"candidates": 3}]', "j.json": '[{"candidates": [{"url": "u3", "extra": null}]}, {"url": "u4"}]',
    }
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    corpus = payload.read_corpus(spark, str(tmp_path / "in"))
    name = F.regexp_extract("path", "([^/]+)$", 1).alias("name")
    report = {r["name"]: (r["n_candidates"], r["reason"], r["size"]) for r in payload.corpus_report(corpus).select(name, "n_candidates", "reason", "size").collect()}
    want = {"a": (2, None), "b": (0, "no JSON"), "c": (0, "no candidates"), "d": (0, "an item is no candidate"), "e": (0, "empty"), "f": (0, None), "g": (0, "neither an object nor a list"), "h": (0, "candidates are no list of objects"), "i": (0, "an item is no candidate"), "j": (2, None)}
    assert report == {f"{k}.json": (*v, len(files[f"{k}.json"])) for k, v in want.items()}
    rows = payload.flatten_candidates(payload.in_order(corpus), strict=False).orderBy("_file", "_outer", "_inner").select("url", "_keys").collect()
    assert [tuple(r) for r in rows] == [("u1", ["url"]), ("u2", ["url"]), ("u3", ["url", "extra"]), ("u4", ["url"])]
    with pytest.raises(Exception, match="neither"):
        payload.flatten_candidates(corpus).collect()


def test_other_working_directory(tmp_path):
    """Commands work where the package is not in the working directory, as executors are sent it."""
    put(tmp_path / "r.yml", entry("a"))
    top = str(Path(cli.__file__).resolve().parents[1])
    code = f"import sys; sys.path.insert(0, {top!r}); from marlstone import cli; sys.exit(cli.main(['manifest', 'r.yml', '--run-date', '{DAY}']))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and yaml.safe_load(done.stdout)["targets"][0]["name"] == "a", done.stderr[-2000:]


def test_missing_files(spark, tmp_path, capsys):
    none = str(tmp_path / "none.yml")
    assert yaml_catalog.read(spark, none, DEFERRED, missing="empty").count() == 0 and yaml_catalog.envelope(spark, none, missing="empty").first()["keys"] == ["version", "entries"]
    assert yaml_catalog.queue_path(str(tmp_path / "r.yml")) == str(tmp_path / "deferred.yml") and ENTRY.names[0] == "_pos"
    assert cli.main(["validate", none]) == 1 and cli.main(["merge", none, str(tmp_path / "v.json")]) == 1
    assert list(tmp_path.iterdir()) == [] and capsys.readouterr().err.count("ERROR: ") == 2


ROWS = "".join(f"- name: n{i}\n  url: https://e.com/{i}\n  scan_paths:\n  - a\n  - 'b{i}'\n  notes: \"x\n\n    y {i}\"\n  extra: [1, {{a: 2026-01-02}}]\n" for i in range(60))
HEAD = "version: 1\nentries:\n"
CUTTABLE = {
    "plain": HEAD + ROWS, "keys behind": HEAD + ROWS + "generated_at: '2026-01-01'\nowner:\n- a\n- b: 1\n", "list before": "owner:\n- a\n- c\nversion: 1\nentries:  # rows\n\n# more\n" + ROWS,
    "indented": "# top\n---\nversion: 1\nentries:\n" + "".join(f"  {line}\n" for line in ROWS.splitlines()) + "last: {a: 1}\n", "no end": HEAD + ROWS.strip(), "kept": HEAD + "- name: |+\n    a\n\n" + ROWS,
    "returns": (HEAD + ROWS).replace("\n", "\r\n"), "other rows": HEAD + ROWS + "- 5\n- [a]\n- null\n- é: 'ü'\n", "kept before keys": HEAD + ROWS + "- name: |+\n    b\n\nafter: 1\n",
}
WHOLE = {
    "anchors": HEAD + "- &a\n  name: x\n" + ROWS + "- *a\n", "quoted dash": HEAD + ROWS + "- name: 'a\n- b'\n", "dash alone": HEAD + ROWS + "-\n  name: z\n", "twice": HEAD + ROWS + "entries:\n- name: last\n",
    "list in quotes": 'note: "\nentries:\n- a"\nversion: 1\nentries:\n' + ROWS, "kept at the end": HEAD + ROWS + "- name: |+\n    b\n\n", "no end, kept": HEAD + ROWS + "- name: |+\n    kept", "flow": "{version: 1, entries: [" + "{name: a}, " * 300 + "]}", "other list": "version: 1\nothers:\n" + ROWS,
}
BROKEN = {"marks": HEAD + ROWS + "...\n- name: x\n", "anchor twice": HEAD + "- &a x\n" + ROWS + "- &a y\n", "open": HEAD + ROWS + "- name: 'x\n", "key in rows": HEAD + "- a\nx: 1\n" + ROWS}


@pytest.mark.parametrize("text", [*CUTTABLE.values(), *WHOLE.values(), *BROKEN.values()], ids=[*CUTTABLE, *WHOLE, *BROKEN])
def test_document_in_pieces(spark, tmp_path, monkeypatch, text):
    """Rows and envelope of a document that is cut are those of the document that is parsed whole, wherever its file is split."""
    path = tmp_path / "registry.yml"
    path.write_bytes(text.encode())

    def told():
        try:
            rows, envelope = yaml_catalog.parsed(spark, str(path))
            return [r.asDict() for r in rows.orderBy("_pos").collect()], envelope.first().asDict()
        except Exception as error:
            return cli.told(error)

    want, done = told(), []
    assert isinstance(want, str) == (text in BROKEN.values())
    cutting = yaml_catalog.pieces
    monkeypatch.setattr(yaml_catalog, "pieces", lambda *a: done.append(cutting(*a)) or done[-1])
    monkeypatch.setattr(yaml_catalog, "WHOLE_BYTES", 1_000)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2311")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert told() == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert any(d is not None for d in done) == (text in CUTTABLE.values())


def test_fast_yaml_is_the_same():
    """Whichever parser and emitter a text or a row gets, the result is that of those in Python."""
    import random

    chance = random.Random(3)
    parts = ["name:", "  url:", "- ", "  - ", "\n", "a", "b: c", " ", "'", "''", "x#y", " #c", ":", "[]", "{}", "1", "2.5", "true", "~", "2026-05-08", "1:30", "<<:", "=", "key:\n", "    ", "http://a/b?c=d&e=f", "*", " - ", "(x)", "?", "\t", "&a", "|", ">", "é"]
    texts = [s for s in ("- " + "".join(chance.choices(parts, k=chance.randrange(1, 14))) + "\n" for _ in range(20_000)) if yaml_catalog.ALIKE.fullmatch(s.encode())]
    assert len(texts) > 500

    def told(read, text):
        try:
            return repr(read(text))
        except yaml.YAMLError:
            return "error"

    assert [t for t in texts if told(yaml_catalog.loaded, t.encode()) != told(yaml.safe_load, t.encode())] == []
    signs = "'\": #-[]{},&*!|>%@`?1.e0~\\abc  é\n\u2028\U0001f600"
    for _ in range(2_000):
        word = lambda: "".join(chance.choices(signs, k=chance.choice([0, 1, 2, 4, 8, 30, 100, 200])))
        row = {chance.choice(["name", "y", "null", "on", "k-1", "", "a b", "x" * 130]): chance.choice([None, True, 1, word(), [word(), word()], {"a": word()}]) for _ in range(4)}
        assert yaml_catalog.dumped([row]) == dumped([row])


def test_stream_reads_its_files_once(spark, small, monkeypatch):
    """What a merge goes over many times is a table, not the verdict files."""
    from marlstone.plans import registry
    from marlstone.streaming import verdicts as stream

    read, merge = [], stream.merge
    monkeypatch.setattr(stream, "merge", lambda r, q, v, *a: read.extend(v.inputFiles()) or merge(r, q, v, *a))
    rows = registry.queries()["streamed_registry"](spark, small)
    assert rows.count() > 0 and read and all(p.endswith(".parquet") for p in read)


def test_texts_are_made_by_all_cores(spark, tmp_path, monkeypatch):
    """Small rows are dealt to all cores before their texts are made, and the document has them in order."""
    sizes, write = [], storage.Store.write
    monkeypatch.setattr(storage.Store, "write", lambda self, path, *parts, **more: sizes.extend(self.size(f) for p in parts if isinstance(p, list) for f in p) or write(self, path, *parts, **more))
    rows = spark.range(999, -1, -1).repartition(3).select(F.col("id").alias("_pos"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    path = documents.saved(rows, str(tmp_path / "registry.yml"), DAY)
    assert [r["name"] for r in yaml.safe_load(Path(path).read_text())["entries"]] == [f"n{i}" for i in range(1000)]
    assert sum(sizes) > 0 and max(sizes) < 0.5 * sum(sizes) and sum(s > 0 for s in sizes) == spark.sparkContext.defaultParallelism


LONG = {
    "root in a row": "--- &r\nversion: 1\nentries:\n- a: *r\n" + ROWS, "anchored list": "entries: &l\n" + ROWS + "again: *l\n", "merged": "base: &b\n  entries: [1, 2]\n<<: *b\nversion: 1\nowner: |\n" + "  x\n" * 600, "merged and own": "base: &b\n  entries: [1, 2]\n<<: *b\n" + HEAD + ROWS,
    "shared": HEAD + "- &a {x: 1, <<: {y: 2}}\n" + ROWS + "- {<<: *a, z: [*a, 3]}\n", "in rows too": HEAD + "- entries: [1]\n" + ROWS, "tagged": "entries: !!seq\n" + ROWS, "then a number": HEAD + ROWS + "entries: 5\n", "a list": ROWS, "odd tag": HEAD + ROWS + "x: !listed y\n",
}


@pytest.mark.parametrize("text", [*CUTTABLE.values(), *WHOLE.values(), *BROKEN.values(), *LONG.values()], ids=[*CUTTABLE, *WHOLE, *BROKEN, *LONG])
def test_rows_made_one_by_one(monkeypatch, text):
    """A document whose rows are made one by one is the document as PyYAML loads it."""

    def told(read):
        try:
            return repr(read())
        except yaml.YAMLError as error:
            return str(error)

    def parts(keep):
        doc, n, rows = yaml_catalog.opened(text.encode(), "entries", keep)
        rows = list(rows)
        assert all(len(r) <= 7 for r in rows)
        got = [x for part in rows for x in part]
        assert len(got) == n or not keep and got == []
        return doc | {"entries": got} if isinstance(doc, dict) and got and doc["entries"] == [] else doc

    monkeypatch.setattr(yaml_catalog, "WHOLE_BYTES", 1_000)
    monkeypatch.setattr(yaml_catalog, "PIECES", 7)
    assert len(text) > 1_000 and told(lambda: parts(True)) == told(lambda: yaml.safe_load(text.encode()))
    told(lambda: parts(False))


def peak_of(monkeypatch, task, content):
    """Bytes of Python's objects, at most, while a task goes through a document that cannot be cut; and what it made."""
    import tracemalloc

    import pandas as pd

    frames = iter([pd.DataFrame({"content": [content]})])
    monkeypatch.setattr(yaml_catalog, "WHOLE_BYTES", 1_000)
    monkeypatch.setattr(yaml_catalog, "PIECES", 20)
    monkeypatch.setattr(yaml_catalog, "ship_package", lambda spark: None)
    monkeypatch.setattr(yaml_catalog, "bytes_of", lambda spark, path: type("Files", (), {"mapInPandas": lambda self, f, schema: f(frames)})())
    made = task()
    tracemalloc.start()
    try:
        lengths = [len(f) for f in made]
        return tracemalloc.get_traced_memory()[1], lengths
    finally:
        tracemalloc.stop()


UNCUT = (HEAD + "- &a x\n" + ROWS * 10).encode()


def test_whole_documents_rows_are_handed_on(monkeypatch):
    """The memory of a document's rows does not grow with their number where the document cannot be cut."""
    full = yaml_catalog.T.StructType([*ENTRY.fields, *yaml_catalog.EXTRA])
    peak, lengths = peak_of(monkeypatch, lambda: yaml_catalog.whole_rows(None, "", full, ENTRY, "entries"), UNCUT)
    assert sum(lengths) == 601 and max(lengths) == 20 and peak < 10 * len(UNCUT)


def test_whole_documents_envelope_keeps_no_rows(monkeypatch):
    """Neither does the memory of its envelope."""
    monkeypatch.setattr(yaml_catalog, "Store", lambda spark, path: type("Files", (), {"is_file": lambda self, path: False})())
    peak, lengths = peak_of(monkeypatch, lambda: yaml_catalog.whole_envelope(None, "", "entries"), UNCUT)
    assert lengths == [1] and peak < 10 * len(UNCUT)


def test_uncut_document_is_parsed_once(spark, tmp_path, monkeypatch):
    """Rows of a large document that cannot be cut are a table: using them again does not parse it again."""
    path = tmp_path / "registry.yml"
    path.write_bytes(UNCUT)
    want = yaml_catalog.read(spark, str(path)).orderBy("_pos").collect()
    monkeypatch.setattr(yaml_catalog, "WHOLE_BYTES", 1_000)
    rows = yaml_catalog.read(spark, str(path))
    path.unlink()
    assert rows.orderBy("_pos").collect() == want and rows.count() == len(want) == 601
