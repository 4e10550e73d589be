"""Secret scan by assignment-aware lexing.

Three plain patterns give the base spans. Beyond them, source and configuration syntax is read into pairs of a name and the
value given to it: ``name = value``, ``name: value``, ``name := value``, ``"name": value``, ``name => value`` and
``<name>value</name>``; a value is a chain of quoted literals (with one or three quotes), words and names joined by ``+``, also
as arguments of a call, or an indented block after ``name: |``. A name given a value is a constant; where it is the value of
another name, its literals go along, over any number of steps; the definition next before a use counts, or else the first after it.
The value of a name is scored: how sensitive the words of the name are, plus how much the literals together look like a key
rather than a word or a placeholder. Literals of values that reach the threshold are spans of kind ``literal`` unless they lie in
a base span.

Every part of a text is read once: values are left behind as they are read, and a constant hands on a summary of its
characters, not its text, so the work is linear in the length of a text whatever it holds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from mailtax.llm.common import Batches, texts

Span = tuple[int, int, int, int, int]  # start, kind, end, start and end of the secret itself
KINDS = ("assign", "access", "hex", "literal")
# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are greedy, so this is every run of 24 or more
HEX_RUN = b"x" * 24
HEX_LETTERS = bytes(ord("x") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))
# Weights of words in names, and words that mean a placeholder.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.5, "access": 0.4, "auth": 0.6, "bearer": 0.8, "signing": 0.5,
    "encryption": 0.5, "api": 0.4, "client": 0.2, "key": 0.4, "pin": 0.4, "jwt": 0.8, "salt": 0.4, "session": 0.3,
}
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "xxxx", "dummy", "redacted", "none", "null", "true", "false")
THRESHOLD = 1.3
LEAST = 6

# Functions that look a value up by a name, so that their argument is no secret.
LOOKUPS = ("get", "getenv", "env", "environ", "getproperty", "lookup", "getpass", "input")

WORD_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
OPERATOR = re.compile(r":=|=>|:|=")
SPACE = re.compile(r"[ \t]*")
LONG = re.compile(r'"""(?P<a>(?:(?!""").)*)"""|\'\'\'(?P<b>(?:(?!\'\'\').)*)\'\'\'', re.DOTALL)
QUOTED = re.compile(r"""(?P<q>["'`])(?P<quoted>(?:\\.|(?!(?P=q))[^\\\n])*)(?P=q)""")
# A word holds = only as padding at its end, + only before another letter of a word, and & only where no other name begins.
BARE = re.compile(r"""(?:[A-Za-z0-9_$/.@%^*!~-]|\+(?=[A-Za-z0-9_$/.=])|&(?![\w.-]*=))+(?:={1,2}(?![^\s,;)}\]]))?""")
CALL = re.compile(r"([A-Za-z_][\w.]*)\([ \t]*", re.ASCII)
BLOCK = re.compile(r"[|>][+-]?[0-9]?[+-]?[ \t]*\r?\n")
LINE = re.compile(r"([ \t]*)([^\n]*)\n?")
NAME = re.compile(r"[A-Za-z_$][\w$.]*$", re.ASCII)
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)>([^<\n]+)</\1>", re.ASCII)
SCALE = 1e12  # counts of characters beyond that are scaled down; only their shares matter


@lru_cache(10_000)
def name_weight(name: str) -> float:
    """Up to 1: the sum over the distinct words of a name."""
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in {p.lower() for p in WORD_PARTS.findall(name)}))


@dataclass
class Summary:
    """What the score needs to know of a text: its characters, length, and both ends for what a join makes."""

    counts: Counter = field(default_factory=Counter)
    size: float = 0.0
    head: str = ""
    tail: str = ""
    placeholder: bool = False

    def add(self, other: Summary) -> None:
        """Append another text."""
        seam = (self.tail + other.head).lower()
        self.placeholder = self.placeholder or other.placeholder or any(p in seam for p in PLACEHOLDERS)
        self.head = (self.head + other.head)[:ENDS] if self.size < ENDS else self.head
        self.tail = (self.tail + other.tail)[-ENDS:]
        self.size += other.size
        self.counts.update(other.counts)
        if self.size > SCALE:
            self.size /= 2
            self.counts = Counter({c: n / 2 for c, n in self.counts.items()})

    def weight(self) -> float:
        """0 to 1: mixed kinds of characters and many different ones speak for a key."""
        if self.size < LEAST or self.placeholder or self.head.startswith(("$", "%", "{", "<")):
            return 0.0
        total = sum(self.counts.values())
        entropy = -sum(n / total * math.log2(n / total) for n in self.counts.values())
        letters = "".join(self.counts)
        kinds = sum(map(bool, (re.search(k, letters) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^a-zA-Z0-9]"))))
        return min(1.0, entropy / 5 * 0.7 + (kinds - 1) * 0.2)


ENDS = max(map(len, PLACEHOLDERS))


def summary(value: str) -> Summary:
    low = value.lower()
    return Summary(Counter(value), len(value), value[:ENDS], value[-ENDS:], any(p in low for p in PLACEHOLDERS))


def literal_weight(value: str) -> float:
    return summary(value).weight()


def _name_before(text: str, end: int) -> str:
    """The name that ends at ``end``, over spaces, a closing bracket and quotes."""
    while end and text[end - 1] in " \t":
        end -= 1
    while end and text[end - 1] in "\"'`]":
        end -= 1
    begin = end
    while begin and (text[begin - 1].isascii() and text[begin - 1].isalnum() or text[begin - 1] in "_$.-"):
        begin -= 1
    return text[begin:end].lstrip("-.0123456789")


Piece = tuple[int, int, bool]  # start, end, quoted


def _block(text: str, header: int, at: int) -> tuple[list[Piece], int]:
    """The lines from ``at`` on that are indented deeper than the line of ``header``, as one literal, and where they end."""
    line = text.rfind("\n", 0, header) + 1
    own = len(SPACE.match(text, line)[0])
    begin = end = None
    while at < len(text):
        match = LINE.match(text, at)
        if match[2].strip():
            if len(match[1]) <= own:
                break
            begin = match.start(2) if begin is None else begin
            end = match.start(2) + len(match[2].rstrip())
        at = match.end()
    return ([] if begin is None else [(begin, end, True)]), at


def _value(text: str, place: int) -> tuple[list[Piece], int]:
    """The chain of pieces that begins at ``place``, and where it ends."""
    pieces: list[Piece] = []
    depth = 0
    looked_up = False
    while True:
        if call := CALL.match(text, place):
            looked_up = call[1].rpartition(".")[2].lower() in LOOKUPS
            depth, place = depth + 1, call.end()
            continue
        if found := LONG.match(text, place):
            span = found.span("a" if found["a"] is not None else "b")
        elif found := QUOTED.match(text, place):
            span = found.span("quoted")
        elif found := BARE.match(text, place):
            span = None
            if not looked_up:
                pieces.append((*found.span(), False))
        else:
            break
        if span and not looked_up:
            pieces.append((*span, True))
        place = SPACE.match(text, found.end()).end()
        while depth and text[place:place + 1] == ")":
            depth, looked_up, place = depth - 1, False, SPACE.match(text, place + 1).end()
        if text[place:place + 1] != "+" and not (depth and text[place:place + 1] == ","):
            break
        place = SPACE.match(text, place + 1).end()
    return pieces, place


def _pairs(text: str) -> Iterator[tuple[str, list[Piece]]]:
    """(name, pieces of its value) in the order of the text."""
    found = []
    at = 0
    while match := OPERATOR.search(text, at):
        at = match.end()
        if text[at:at + 1] in ("=", ":") or text[at:at + 2] == "//":  # comparison, scope, address
            at += 1
            continue
        name = _name_before(text, match.start())
        if not name:
            continue
        place = SPACE.match(text, at).end()
        if match[0] == ":" and (header := BLOCK.match(text, place)):
            pieces, end = _block(text, match.start(), header.end())
        else:
            pieces, end = _value(text, place)
        if pieces:
            found.append((match.start(), name, pieces))
            at = max(at, pieces[-1][1], end if match[0] == ":" and header else 0)  # an operator inside a value begins no pair
    for match in ELEMENT.finditer(text) if "</" in text else ():
        found.append((match.start(), match[1], [(*match.span(2), True)]))
    for _, name, pieces in sorted(found):
        yield name, pieces


def literal_spans(text: str) -> set[tuple[int, int]]:
    """Start and end of the literals that reach the threshold."""
    if ":" not in text and "=" not in text and "</" not in text:
        return set()
    pairs = list(_pairs(text))
    defined: dict[str, list[int]] = {}
    for i, (name, _) in enumerate(pairs):
        defined.setdefault(name, []).append(i)

    def meant(name: str, at: int) -> int | None:
        """The definition that a use of the name in pair ``at`` stands for."""
        places = defined.get(name)
        if not places:
            return None
        before = bisect_right(places, at - 1)
        return places[before - 1] if before else next((p for p in places if p > at), None)

    known: dict[int, list[tuple[int, int] | int]] = {}

    def parts(i: int) -> list[tuple[int, int] | int]:
        """Literals of a pair's value, and pairs whose literals go along."""
        if i not in known:
            known[i] = own = []
            for start, end, quoted in pairs[i][1]:
                word = text[start:end]
                names = [] if quoted else [meant(w, i) if NAME.match(w) else None for w in word.split("+")]
                if names and None not in names:
                    own += names
                elif quoted or any(c.isdigit() for c in word):
                    own.append((start, end))
        return known[i]

    summaries: dict[int, Summary] = {}
    weights = {i: w for i, (name, _) in enumerate(pairs) if (w := name_weight(name))}
    for first in weights:  # parts before the whole, without recursion; a circle of names ends where it began
        todo, open_ = [first], set()
        while todo:
            i = todo[-1]
            if i in summaries:
                todo.pop()
                continue
            if i not in open_:
                open_.add(i)
                todo += [p for p in parts(i) if isinstance(p, int) and p not in summaries and p not in open_]
                if todo[-1] != i:
                    continue
            total = Summary()
            for p in parts(i):
                if not isinstance(p, int):
                    total.add(summary(text[p[0]:p[1]]))
                elif p in summaries:
                    total.add(summaries[p])
            summaries[i] = total
            todo.pop()
    out, reached, todo = set(), set(), []
    for i, weight in weights.items():
        if parts(i) and (whole := summaries[i].weight()) and weight + whole >= THRESHOLD:
            todo.append(i)
    while todo:
        i = todo.pop()
        if i not in reached:
            reached.add(i)
            out.update(p for p in parts(i) if not isinstance(p, int))
            todo += [p for p in parts(i) if isinstance(p, int)]
    return out


def _inside(spans: list[tuple[int, int]]):
    """A test whether a span lies in one of ``spans``."""
    starts, ends = [], []
    for start, end in sorted(spans):
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)
    return lambda s, e: bool(starts) and (k := bisect_right(starts, s)) > 0 and e <= ends[k - 1]


def find_spans(text: str) -> list[Span]:
    """All spans by start, then kind; the first three kinds are the base ones."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if HEX_RUN in text.encode("utf-8", "surrogatepass").translate(HEX_LETTERS):
        out += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    in_base = _inside([(s, e) for s, _, e, _, _ in out])
    out += [(s, 3, e, s, e) for s, e in literal_spans(text) if e > s and not in_base(s, e)]
    return sorted(out)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _, _ in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_assign, n_access, n_hex, base`` and ``spans`` (kind:start:end by start, then
    kind; code points, end exclusive; comma-joined, empty if none). Null and empty texts have no spans; repeated rows each get
    theirs; texts of any length are read whole, in linear time. Empty in, empty out."""
    rows = texts(df, id_col, text_col, key=False)

    def work(batches: Batches) -> Batches:
        for batch in batches:
            found = [find_spans(t) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in found], pa.int64()) for k in range(3)]
            base = pa.array([_written([s for s in spans if s[1] < 3]) for spans in found], pa.string())
            columns = [batch.column("doc_id"), *counts, base, pa.array([_written(s) for s in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string")


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with ``mark`` in place of every secret; of an assignment only the value goes."""
    out, at = [], 0
    for start, end in sorted((s, e) for *_, s, e in find_spans(text)):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with its secrets replaced; all rows and columns stay, a null text stays null."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            new = [t if t is None else redacted(t, mark) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return df.mapInArrow(work, df.schema)
