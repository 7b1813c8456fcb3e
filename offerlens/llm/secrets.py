"""Secrets in texts: literals that source or configuration syntax gives to sensitive names."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import id_and_text, ranges

CHARS = 1 << 22
LEAST_SCORE = 0.5
KINDS = ("assign", "access", "hex", "literal")
SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long, name: string, score: double>>"

# Fixed patterns: (kind, pattern, group whose length counts, least length). Matches that are too short are dropped after matching.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # a run of 16 or more, as the pattern without the count would take it
)

# Parts of names and how much they tell; two parts in a row may stand together.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passwort": 1.0, "contrasena": 1.0, "secret": 1.0, "apikey": 1.0,
    "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0, "signing key": 1.0, "encryption key": 1.0,
    "account key": 1.0, "token": 1.0, "credential": 1.0, "credentials": 1.0, "bearer": 0.9, "authorization": 0.9, "pass": 0.8,
    "auth": 0.7, "key": 0.6, "salt": 0.6, "pin": 0.5,
}
# Parts that say the value is about a secret and no secret itself.
ABOUT = frozenset("file path dir url uri host name user username id length len size count limit max min field label hint policy ttl "
                  "expiry expires timeout type format env var header regex pattern prompt message error public primary foreign".split())
PLACEHOLDER = re.compile(
    r"(?i)(.)\1*$|(?:x+|\*+|\.+)$|[<\[{%$].*[>\]}%]$|\$\w+$|.*(?:example|placeholder|change.?me|your[-_ ]|dummy|redacted|insert|todo|\bnone\b|\bnull\b)"
    r"|true$|false$|undefined$|nil$|string$|str$|required$")

_NAME = r"[A-Za-z_$@][\w$]*+(?:(?:\.|->|::|-|/)[A-Za-z_$][\w$]*+)*+"
# A name, quoted or not, perhaps closing an index, then a sign that assigns. It starts at no later part of a name.
_PAIR = re.compile(rf"""(?<![\w$])(?<![\w$][.\-/])(?<![\w$]->)(?<![\w$]::)(?P<q>["']?)(?P<name>{_NAME})(?P=q)[ \t]*+\]?[ \t]*+(?P<sign>:=|=>|\+=|\?=|=(?![=~>])|:(?![:/=]))""")
_FLAG = re.compile(r"(?<![\w-])--?(?P<name>[A-Za-z][\w-]*+)[ \t]++(?![-=:])")
_CALL = re.compile(r"""\(\s*+(?P<q>["'])(?P<name>[\w.-]++)(?P=q)\s*+,\s*+(?=["'])""")
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})(?:\s[^<>\n]*+)?>(?P<value>[^<>]++)</(?P=name)>")
_URL = re.compile(r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\s/:@\"'<>]*+:(?P<value>[^\s/@\"'<>]++)@")
_PEM = re.compile(r"-----BEGIN (?P<name>[A-Z0-9 ]*PRIVATE KEY)-----(?P<value>[^-]++)-----END (?P=name)-----")
_DEFINE = re.compile(rf"(?m)^[ \t]*+#[ \t]*+define[ \t]++(?P<name>{_NAME})[ \t]++(?=\S)")
_STRING = re.compile(r'''[bBrRfFuU@$]{0,2}(?:"""(?P<a>[\s\S]*?)"""|\'\'\'(?P<b>[\s\S]*?)\'\'\'|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>[^`]*+)`)''')
_WORD = re.compile(_NAME)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>|=]++(?:=++(?![^\s"'`,;(){}\[\]<>|]))?""")
_JOIN = re.compile(r"""\s*+(?:\+|\|\||\?\?|or\b|\.(?=\s*["']))\s*+|\s++(?=["'])""")
_WRAP = re.compile(r"(?:\(|new\b|await\b|const\b|(?:Bearer|Basic|Token)(?=[ \t]))[ \t]*+")
_BLOCK = re.compile(r"[|>][+-]?[ \t]*+\n(?P<value>(?P<indent>[ \t]++)\S.*(?:\n(?P=indent).*)*+)")
_BLANKS = re.compile(r"[ \t]*+")
_HOLE = re.compile(rf"\$?\{{\s*+({_NAME})\s*+\}}|%\(({_NAME})\)s|\$({_NAME})")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def name_weight(name: str) -> float:
    """How much a name says that its value is secret, 0 to 1."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if any(p in ABOUT for p in parts[-2:]):
        return 0.0
    terms = parts + [f"{a} {b}" for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(t, 0.0) for t in terms), default=0.0)


def literal_weight(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret, 0 to 1: by length, variety of characters and entropy."""
    if len(value) < 6 or PLACEHOLDER.match(value) or any(c.isspace() for c in value.strip()) and "\n" not in value:
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    kinds = sum(any(test(c) for c in counts) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    weight = min(1.0, entropy / 3.5) * (0.6 if kinds == 1 else 0.85 if kinds == 2 else 1.0) + min(len(value), 32) / 100
    if not quoted and not any(c.isdigit() for c in value):
        weight *= 0.4  # an unquoted word of prose
    return min(1.0, weight)


class _Flow:
    """Values of one text: which literals and earlier values every assignment takes."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.literals: list[list[tuple[int, int, bool]]] = []
        self.takes: list[list[int]] = []
        self.open: list[tuple[int, str]] = []
        self.first: dict[str, int] = {}
        self.last: dict[str, int] = {}

    def assign(self, name: str, literals: list[tuple[int, int, bool]], used: list[str]) -> None:
        this = len(self.names)
        self.names.append(name)
        self.literals.append(literals)
        self.takes.append([self.last[u] for u in used if u in self.last])
        self.open += [(this, u) for u in used if u not in self.last]
        short = re.split(r"\.|->|::", name)[-1]
        for known in {name, short}:
            self.first.setdefault(known, this)
            self.last[known] = this

    def weights(self) -> list[tuple[float, str]]:
        """Of every assignment, the most sensitive name its value reaches, with its weight."""
        for this, name in self.open:  # used before it is set
            if self.first.get(name, this) != this:
                self.takes[this].append(self.first[name])
        best = [(name_weight(n), n) for n in self.names]
        for start in sorted(range(len(best)), key=lambda i: -best[i][0]):
            todo = [start]
            while todo:
                this = todo.pop()
                for source in self.takes[this]:
                    if best[source][0] < best[start][0]:
                        best[source] = best[start]
                        todo.append(source)
        return best


def _value(text: str, at: int) -> tuple[list[tuple[int, int, bool]], list[str]]:
    """Literals (start, end, quoted) and names in the expression at a place."""
    literals, names = [], []
    while True:
        while wrap := _WRAP.match(text, at):
            at = wrap.end()
        if string := _STRING.match(text, at):
            span = string.span(string.lastgroup)
            literals.append((*span, True))
            names += [a or b or c for a, b, c in _HOLE.findall(text, *span)]
            at = string.end()
        elif (word := _WORD.match(text, at)) and text.startswith("(", word.end()):
            reads = re.search(r"(?i)env|get|read|load|fetch|input", word[0])
            inner = _CALL.match(text, word.end()) if reads else None
            if reads and not inner:  # a name looked up elsewhere, no literal
                return literals, names
            at = inner.end() if inner else word.end() + 1
            continue
        elif bare := _BARE.match(text, at):
            literals.append((*bare.span(), False))
            names += [a or b or c for a, b, c in _HOLE.findall(bare[0])]
            if word and word.end() == bare.end():
                names += [word[0], *re.split(r"\.|->|::", word[0])[-1:]]
            at = bare.end()
        else:
            return literals, names
        if more := _JOIN.match(text, at):
            at = more.end()
        else:
            return literals, names


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals that reach a sensitive name."""
    if not any(s in text for s in ("=", ":", "--", "</", "#")) and '("' not in text and "('" not in text:
        return []
    flow = _Flow()
    events = [(m.start(), m) for pattern in (_PAIR, _FLAG, _CALL, _DEFINE) for m in pattern.finditer(text)]
    events = sorted(events, key=lambda e: e[0]) + [(-1, None)]
    inside = 0  # up to here the text is the content of a block
    for (start, m), (following, _) in zip(events, events[1:]):
        at = _BLANKS.match(text, m.end()).end()
        if start >= inside and (block := _BLOCK.match(text, at)):
            inside = block.end()
            flow.assign(m["name"], [(*block.span("value"), True)], [])
        else:
            flow.assign(m["name"], *_value(text, at))
        if following == at:  # a = b = "...": the first name takes what the second is given
            flow.takes[-1].append(len(flow.names))
    for pattern in (_ELEMENT, _URL, _PEM):
        for m in pattern.finditer(text):
            flow.assign(m.groupdict().get("name") or "password", [(*m.span("value"), True)], [])
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for (weight, name), spans in zip(flow.weights(), flow.literals):
        for start, end, quoted in spans if weight else ():
            score = weight * literal_weight(text[start:end], quoted)
            if score >= LEAST_SCORE and (score, name) > best.get((start, end), (0.0, "")):
                best[start, end] = score, name
    return [(start, end, name, score) for (start, end), (score, name) in best.items()]


def spans_of(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) by start, then kind. A literal that lies within a base span is not repeated."""
    found = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end(), m[1] if kind == "assign" else None, 1.0))
    taken = sorted((s, e) for _, s, e, _, _ in found)
    reach, limits = 0, []
    for s, e in taken:
        reach = max(reach, e)
        limits.append((s, reach))
    at = -1
    for start, end, name, score in sorted(literals(text)):
        while at + 1 < len(limits) and limits[at + 1][0] <= start:
            at += 1
        if at < 0 or end > limits[at][1]:
            found.append(("literal", start, end, name, score))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end, name, score), in code points, end exclusive.

    The kinds assign, access and hex are matches of fixed patterns, with score 1.
    A ``literal`` is the content of a literal that reaches a sensitive name:
    assignments, keyword arguments, configuration lines, flags, attributes, elements,
    definitions, credentials in addresses and key blocks are read as pairs of name and value; a
    name used as a value stands for what was last given to it, or is given to it
    later if there is nothing before; the score is the weight of the most
    sensitive name reached times that of the literal, ``LEAST_SCORE`` at least.

    NULL and empty texts have no spans. Every row gives a row, repeated and NULL
    ids too; an empty table gives none. Other columns, whatever their names, are
    not looked at. A text is read whole, in time and memory in proportion to its length.
    """
    return id_and_text(docs).mapInArrow(_of_batches, SCHEMA)


def _of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ("kind", "start", "end", "name", "score")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
    for batch in batches:
        texts = batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for lo, hi in ranges(sizes, CHARS):
            spans = [[dict(zip(keys, s)) for s in spans_of(t or "")] for t in texts.slice(lo, hi - lo).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, the SHA-256 of their spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
