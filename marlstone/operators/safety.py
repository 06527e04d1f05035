"""Spans of texts that a safety screen quotes: remote code that is run, secrets that leave, destructive commands, and evasion.

Lines are cut into shell words and commands, which gives facts: a name that remote content or a secret was put into, a name that is run or
sent, or a whole span where both ends meet in one command line. Spark joins the facts of a text by name: what is run or sent is a span if
the last thing that was put into its name is tainted. A name is a file, by its path, or a variable.
"""

from __future__ import annotations

import re
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import ship_package

FETCHERS = {"curl", "wget", "aria2c", "fetch", "http", "iwr", "invoke-webrequest"}
RUNNERS = {"sh", "bash", "zsh", "dash", "ksh", "fish", "python", "python3", "perl", "ruby", "node", "php", "pwsh", "iex"}
SENDERS = FETCHERS | {"nc", "ncat", "netcat", "scp", "rsync", "sftp", "ftp"}
READERS = {"cat", "less", "head", "tail", "base64", "xxd", "gzip", "tar", "zip", "cp", "openssl", "grep", "awk", "sed"}
BEFORE = {"sudo", "exec", "nohup", "time", "then", "do", "&&", "env", "run", "command", "export", "local", "readonly", "declare", "$", "#"}
SECRET_PATH = re.compile(r"(^|/)(\.ssh(/|$)|id_(rsa|dsa|ecdsa|ed25519)$|\.aws/credentials|\.netrc$|\.env$|\.git-credentials$|\.npmrc$|\.pypirc$|\.kube/config$|\.docker/config\.json$)|^/etc/shadow$")
SECRET_NAME = re.compile(r"(?i)(^|_)(token|secret|passwd|password|credentials?|api_?key|access_?key|private_?key)s?(_|$)")
DATA_FLAGS = re.compile(r"^(-d|-F|-T|--data(-\w+)?|--form|--upload-file|--post-data|--post-file|--body-data|--body-file|--json)(=.*)?$")
URL = re.compile(r"^[\"']?(https?|ftp)://|^[\"']?\$\{?\w*(URL|url)\w*\}?[\"']?$")
PIECE = re.compile(r"'[^']*'|\"[^\"$`]*\"|\|\||&&|\$\(|[<>]\(|>>|[;|&()`<>]|(?:\$(?!\()|[^\s;|&()`<>\"'$])+")
ASSIGNED = re.compile(r"^(?:export )?([A-Za-z_]\w*)=(.*)$")
VARIABLE = re.compile(r"\$\{?([A-Za-z_]\w*)")
#: Lines without any of these cannot have a fact.
TRIGGER = r"(?i)\b(curl|wget|aria2c|fetch|http|iwr|invoke-webrequest|sh|bash|zsh|dash|ksh|fish|python3?|perl|ruby|node|php|pwsh|iex|eval|source|nc|ncat|netcat|scp|rsync|sftp|ftp|rm|mkfs|dd|cat|printenv|env|chmod|cp|tar|zip|base64|histfile|history|setenforce|csrutil|instructions?|credentials?|tokens?|keys?|secrets?|logging|sandbox|detection|auditd?)\b|\./|\w=|:\(\)|>\s*/dev/"
#: Phrases that are spans by themselves: rule and pattern.
PHRASES = (
    ("evasion", re.compile(r"(?i)\b(ignore|disregard|forget) (all |any |the )*(previous|prior|above|earlier) (instructions?|rules)\b")),
    ("evasion", re.compile(r"(?i)\b(disable|turn off|bypass|evade) (the |all |any )*(audit(ing|d)?( logs?| logging)?|logging|sandbox(ing)?|safety( checks?| filters?)?|(threat |malware |endpoint )?detection|antivirus)\b")),
    ("evasion", re.compile(r"\b(unset HISTFILE|HISTFILE=/dev/null|history -c|set \+o history|setenforce 0|csrutil disable)")),
    ("exfiltration", re.compile(r"(?i)\b(send|post|upload|email|exfiltrate|leak|forward) (me |us |all |any |the |your |their |user )*((ssh|api|access|private) keys?|credentials|(access |api |auth )?tokens|passwords|secrets|env(ironment)? variables) (to|at)\b")),
    ("destruction", re.compile(r":\(\)\s*\{\s*:\s*\|\s*:\s*&\s*\}\s*;\s*:")),
)
FACT = T.StructType([T.StructField("fact", T.StringType()), T.StructField("name", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("snippet", T.StringType())])
#: So many lines are taken out of a batch at a time.
LINES = 256


class Command:
    """Words (text, start, end) of one command; where its input comes from and its output goes."""

    def __init__(self, source=None, parent=None):
        self.words, self.source, self.parent = [], source, parent
        self.output, self.input, self.inner, self.ends = None, None, [], 0
        self.first = self if source is None else source.first

    @cached_property
    def places(self) -> dict[str, int]:
        """The first place of each word's last path part, once the command has all its words."""
        names = [plain(w).rsplit("/", 1)[-1].lower() for w, _, _ in self.words]
        return {n: i for i, n in zip(range(len(names) - 1, -1, -1), reversed(names), strict=True)}

    def verb(self, names: set[str]) -> int:
        """The place of the first word that is one of these programs, by its last path part."""
        return min((self.places[n] for n in self.places.keys() & names), default=-1)

    def runs(self) -> int:
        """The place of the word that is run, behind words such as sudo and assignments."""
        for i, (w, _, _) in enumerate(self.words):
            if w.rstrip(":").lower() not in BEFORE and not w.startswith("-") and not ASSIGNED.match(w):
                return i
        return -1

    @property
    def start(self) -> int:
        """Where the command begins, without the prose before it."""
        at = max(self.verb(FETCHERS) if fetches(self) else self.runs(), 0)
        while at and (plain(self.words[at - 1][0]) in ("sudo", "exec", "nohup", "env", "command") or ASSIGNED.match(self.words[at - 1][0])):
            at -= 1
        return self.words[at][1] if self.words else self.ends


def plain(word: str) -> str:
    return word.strip("\"'")


def path(word: str) -> str:
    """A file's name as facts compare it."""
    return plain(word).removeprefix("./")


def commands(line: str) -> list[Command]:
    out, stack = [Command()], []
    into = None
    quoted = False  # inside backquotes
    for m in PIECE.finditer(line):
        piece, here = m[0], out[-1] if not stack else stack[-1][1]
        if piece in (";", "&&", "||", "|", "&"):
            new = Command(here if piece == "|" else None, here.parent)
            out.append(new)
            if stack:
                stack[-1] = (stack[-1][0], new)
                if here.parent is not None and piece == "|":
                    here.parent.inner.append(new)
            into = None
        elif piece in ("$(", "<(", ">(") or (piece == "`" and not quoted):
            quoted |= piece == "`"
            new = Command(None, here)
            here.inner.append(new)
            out.append(new)
            stack.append((here, new))
        elif piece == ")" or piece == "`":
            quoted &= piece != "`"
            if stack:
                here, inner = stack.pop()
                if piece == ")":
                    inner.ends = here.ends = m.end()
                if not stack:  # the outer command goes on
                    out.remove(here)
                    out.append(here)
        elif piece in (">", ">>", "<"):
            into = piece
        elif piece == "(":
            pass
        elif into:
            if into == "<":
                here.input = path(piece)
            else:
                here.output = path(piece)
            into, here.ends = None, m.end()
        else:
            here.words.append((piece, m.start(), m.end()))
            here.ends = m.end()
    return sorted((c for c in out if c.words or c.inner), key=lambda c: c.start)


def fetches(c: Command) -> bool:
    at = c.verb(FETCHERS)
    return at >= 0 and any(URL.search(w) for w, _, _ in c.words[at + 1 :])


def fetched_file(c: Command) -> str | None:
    """The file that a fetching command writes, None for its output."""
    at = c.verb(FETCHERS)
    words = [w for w, _, _ in c.words[at:]]
    name = plain(words[0]).rsplit("/", 1)[-1].lower()
    for flag, value in zip(words, [*words[1:], ""], strict=True):
        if flag in ("--output", "--output-document", "-o") or (flag == "-O" and name != "curl") or flag.lower() == "-outfile":
            return path(value) if path(value) != "-" else None
        if m := re.match(r"--output(?:-document)?=(.+)", flag):
            return path(m[1])
        if name == "wget" and (m := re.match(r"-\w*O(\S+)$", flag)):
            return path(m[1]) if m[1] != "-" else None
        if name == "curl" and re.match(r"-[a-zA-Z]*o$", flag):
            return path(value)
    url = next((plain(w) for w in words if URL.search(w)), "")
    remote = re.split(r"[?#]", url)[0].rstrip("/").rsplit("/", 1)[-1]
    if name == "curl" and any(re.match(r"-[a-zA-Z]*O[a-zA-Z]*$|--remote-name", w) for w in words):
        return remote
    if name in ("wget", "aria2c") and c.output is None and not any(re.match(r"-\w*O-?$", w) for w in words):
        return remote
    return None


def is_secret(word: str) -> bool:
    text = plain(word)
    return bool(SECRET_PATH.search(text.removeprefix("@").rsplit("=@", 1)[-1].replace("$HOME", "~")) or any(SECRET_NAME.search(v) for v in VARIABLE.findall(word)))


def reads_secret(c: Command) -> bool:
    """A command whose output has a secret."""
    words = [plain(w) for w, _, _ in c.words]
    at = c.runs()
    if at >= 0 and words[at] in ("printenv", "env") and len(words) == at + 1:
        return True
    return c.verb(READERS | {"echo", "printf"}) >= 0 and (any(is_secret(w) for w, _, _ in c.words) or bool(c.input and is_secret(c.input)))


def sent(c: Command) -> list[str] | None:
    """The words that a sending command sends; None for one that sends nothing. Headers and passwords of a request are its own."""
    at = c.verb(SENDERS)
    if at < 0 or c.runs() < 0:
        return None
    name, words = plain(c.words[at][0]).rsplit("/", 1)[-1].lower(), [w for w, _, _ in c.words[at + 1 :]]
    if name in ("nc", "ncat", "netcat"):
        return [c.input or "-"] if len(words) >= 2 else None
    if name in ("scp", "rsync", "sftp", "ftp"):
        return words[:-1] if any(re.search(r"^[\w.@-]+:", w) for w in words[-1:]) else None
    if not any(URL.search(w) or "://" in w for w in words):
        return None
    out = [w for w in words if "://" in w and "?" in w]
    for flag, value in zip(words, [*words[1:], ""], strict=True):
        if m := DATA_FLAGS.match(flag):
            out.append(m[3][1:] if m[3] else value)
        elif re.match(r"-[dFT].+", flag):
            out.append(flag[2:])
    return out or None


def names_of(word: str) -> list[str]:
    """Variables and the file that a sent or run word stands for."""
    file = plain(word).rsplit("=@", 1)[-1].removeprefix("@")
    return [*(f"${v}" for v in VARIABLE.findall(word)), *([path(file)] if file not in ("", "-") and "$" not in file else [])]


def upstream(c: Command | None, test) -> bool:
    while c is not None:
        if test(c) or any(test(i) for i in c.inner):
            return True
        c = c.source
    return False


def facts(line: str) -> list[tuple[str, str | None, int, int]]:
    """(fact, name, start, end): puts (`remote`, `secret`, `other`), uses (`run`, `send`), and spans (a rule's name, no name)."""
    out: list[tuple[str, str | None, int, int]] = [(rule, None, m.start(), m.end()) for rule, pattern in PHRASES for m in pattern.finditer(line)]
    for c in commands(line):
        at = c.runs()
        word = plain(c.words[at][0]) if at >= 0 else ""
        program = word.rsplit("/", 1)[-1].lower()
        first = c.first
        span = (first.start, c.ends)
        arguments = [w for w, _, _ in c.words[at + 1 :]] if at >= 0 else []
        files = [w for w in arguments if not w.startswith("-")]
        inner_remote, inner_secret = any(fetches(i) for i in c.inner), any(reads_secret(i) for i in c.inner)

        # What is put where.
        for w, s, _ in c.words[: at if at >= 0 else None]:
            if m := ASSIGNED.match(w):
                of = "remote" if inner_remote else "secret" if inner_secret or is_secret(m[2]) else "other"
                out.append((of, f"${m[1]}", s, c.ends))
        if fetches(c) and (file := fetched_file(c) or c.output):
            out.append(("remote", file, *span))
        elif c.output and c.output not in ("/dev/null", "&1"):
            of = "remote" if upstream(c, fetches) else "secret" if upstream(c, reads_secret) else "other"
            out.append((of, c.output, *span))
        if program == "tee" and files:
            out.append(("remote" if upstream(c.source, fetches) else "secret" if upstream(c.source, reads_secret) else "other", path(files[0]), *span))
        if program in ("cp", "mv") and len(files) >= 2 and any(is_secret(w) for w in files[:-1]):
            out.append(("secret", path(files[-1]), *span))
        if program in ("tar", "zip") and any(is_secret(w) for w in files):
            out += [("secret", path(w), *span) for w in files if not is_secret(w) and not re.match(r"[cvzjJaf]+$", w)][:1]

        # What is run.
        if program in RUNNERS or program in ("eval", "source") or word == ".":
            if upstream(c.source, fetches) or (inner_remote and (program in ("eval", "source", "iex") or word == "." or program in RUNNERS)):
                out.append(("remote execution", None, *span) if not c.inner else ("remote execution", None, first.start, max(c.ends, *(i.ends for i in c.inner))))
            elif c.source is not None and (r := c.source).verb({"cat", "echo", "printf"}) >= 0:
                out += [("run", n, *span) for w, _, _ in r.words[1:] for n in names_of(w)]
            if c.input:
                out.append(("run", c.input, *span))
            for w in files[: 1 if program in RUNNERS | {"source"} or word == "." else None]:
                out += [("run", n, *span) for n in names_of(w)]
        elif word.startswith(("./", "/", "~/")) or word.startswith("$"):
            out += [("run", n, *span) for n in names_of(word)]

        # What is sent.
        if (words := sent(c)) is not None:
            if any(is_secret(w) for w in words) or upstream(c.source, reads_secret) or inner_secret:
                out.append(("exfiltration", None, *span))
            else:
                out += [("send", n, *span) for w in words for n in names_of(w)]

        # What is destroyed.
        flags = "".join(w[1:] for w in arguments if re.match(r"-[a-zA-Z]+$", w))
        force = "r" in flags.lower() and "f" in flags or {"--recursive", "--force"} <= {*arguments}
        if program == "rm" and force and any(plain(w) in ("/", "/*", "~", "~/", "$HOME", "${HOME}", "/home", "/etc", "/usr", "/var") for w in files):
            out.append(("destruction", None, *span))
        if program.startswith("mkfs") and any("/dev/" in w for w in files) or program == "dd" and any(re.match(r"of=/dev/(sd|nvme|hd|disk)", w) for w in arguments) or re.match(r"/dev/(sd|nvme|hd|disk)", c.output or ""):
            out.append(("destruction", None, *span))
    # A quote that opens in a span closes in it.
    return [(f, n, s, e + (line[s:e].count('"') % 2 == 1 and line[e : e + 1] == '"')) for f, n, s, e in out]


def line_facts(texts: DataFrame, text_col: str) -> DataFrame:
    """(other columns, line, fact, name, start, end, snippet): facts of every line; a line that ends in a backslash goes on in the next. The
    snippet is what stands from start to end; no span quotes what puts something else into a name, so that has none."""
    ship_package(texts.sparkSession)
    others = [c for c in texts.columns if c != text_col]
    whole = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "\r\n?", "\n"), r"\\\n", "  ")
    lines = texts.select(*others, F.posexplode(F.split(whole, "\n")).alias("line", "_text")).where(F.col("_text").rlike(TRIGGER))
    kept = [c for c in lines.columns if c != "_text"]
    schema = T.StructType([*(lines.schema[c] for c in kept), *FACT.fields])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, LINES):
                part = batch.slice(at, LINES)
                found = [[(f, n, s, e, None if f == "other" else t[s:e]) for f, n, s, e in facts(t)] for t in part.column("_text").to_pylist()]
                rows = [i for i, f in enumerate(found) for _ in f]
                columns = list(zip(*(x for f in found for x in f), strict=True)) or [()] * len(FACT)
                given = part.select(kept).take(pa.array(rows, pa.int32()))
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([*given.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

    return lines.mapInArrow(run, schema)


def unsafe_spans(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for a span: the other columns of texts, rule, line and start (from 0), the quoted snippet, and of a flow the line and the snippet
    where the name was filled (null for a span by itself).

    Rules: remote execution, exfiltration, destruction, evasion. Null and empty texts have no spans; rows that repeat have theirs each."""
    others = [c for c in texts.columns if c != text_col]
    found = line_facts(texts.withColumn("_row", F.monotonically_increasing_id()), text_col)
    # The last put before each use of a name, line by line and from left to right; a put in a use's own span comes first. Spans by themselves
    # have no name and go through the same window, so that texts are read once.
    place = Window.partitionBy("_row", "name").orderBy("line", "start", F.col("fact").isin("run", "send"), "end").rowsBetween(Window.unboundedPreceding, -1)
    put = F.when(F.col("fact").isin("remote", "secret", "other"), F.struct("fact", "line", "snippet"))
    placed = found.withColumn("_put", F.last(put, ignorenulls=True).over(place))
    rule = (
        F.when(F.col("name").isNull(), F.col("fact"))
        .when((F.col("fact") == "run") & (F.col("_put.fact") == "remote"), "remote execution")
        .when((F.col("fact") == "send") & (F.col("_put.fact") == "secret"), "exfiltration")
    )
    spans = placed.withColumn("rule", rule).where("rule is not null")
    return spans.select(*others, "rule", "line", "start", "snippet", F.col("_put.line").alias("source_line"), F.col("_put.snippet").alias("source_snippet")).distinct()


def screened(rows: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """rows with unsafe_snippet, the first span that a rejection quotes, or null; id_col tells rows apart."""
    spans = unsafe_spans(rows.select(id_col, text_col), text_col)
    first = spans.groupBy(id_col).agg(F.min_by("snippet", F.struct("line", "start", "rule")).alias("unsafe_snippet"))
    return rows.join(first, id_col, "left")
