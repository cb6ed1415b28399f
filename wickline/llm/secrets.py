"""Secret scans by assignment-aware lexing.

Three plain patterns give the base spans. Beyond them the scan lexes source and
configuration syntax (``name = "x"``, ``"name": "x"``, ``name := x``,
``<name>x</name>``, keyword arguments, ``export NAME=x``) into pairs of a target
name and an expression of literals and names. Constants are propagated: a
literal bound to a harmless name answers for every name it is bound to later,
also through concatenation. Each literal is scored by the most sensitive target
it reaches and by how much the value there looks like a key; what reaches
``LEAST_SCORE`` is reported as kind ``named``, unless a base span already covers
it.

Bindings are a graph in the order of the text: a value refers to the values of
the names in it and is never written out, its look is added up from theirs, and
scores run backwards over the graph once. So a text takes time in proportion to
its length, however often it joins names to themselves.

Lines are lexed one by one, names live as long as their text and may be of any
length. Defined cases: null and empty texts have no spans; repeated rows and null
ids are answered each; a name bound twice has its last value; names bound in a
circle keep the literals they had; an element's text is a literal where it holds
no markup; letters beyond Latin-1 count as equal where their last bytes are; an
empty table gives an empty result; further columns are not touched.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from wickline.llm.common import outside, per_text

Span = tuple[str, int, int]

#: The base patterns and their order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so shorter ones cannot hide a longer
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Weights of the parts of a target name, and what it takes to be a sensitive target.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "pass": 2.0, "secret": 3.0, "token": 2.5,
    "credential": 3.0, "credentials": 3.0, "cred": 2.0, "creds": 2.0, "apikey": 3.0, "private": 1.5, "signing": 1.5,
    "encryption": 1.5, "auth": 1.5, "authorization": 2.0, "bearer": 2.5, "access": 1.0, "api": 1.0, "key": 1.5,
    "salt": 1.5, "webhook": 1.0, "client": 0.5, "session": 0.5, "dsn": 1.5,
}
HARMLESS = {
    "public": -2.0, "count": -2.0, "length": -2.0, "size": -2.0, "url": -1.5, "uri": -1.5, "path": -2.0, "file": -2.0,
    "dir": -2.0, "name": -2.0, "field": -2.0, "type": -2.0, "format": -2.0, "limit": -2.0, "max": -2.0, "min": -2.0,
    "ttl": -2.0, "timeout": -2.0, "expires": -2.0, "expiry": -2.0, "policy": -2.0, "label": -2.0, "hint": -2.0,
    "prompt": -2.0, "id": -1.0, "primary": -2.0, "foreign": -2.0, "sort": -2.0, "cache": -2.0,
}
LEAST_NAME, LEAST_SCORE, LEAST_LETTERS = 2.0, 5.0, 8
#: Characters of a value's beginning that its look remembers: longer than any word or mark looked for there.
HEAD = 16

#: Begins of values that stand for one; whole words that do.
_PLACEHOLDER = re.compile(r"(?i)<|\$|%|\{|your[_-]|change.?me|example|placeholder")
_NO_VALUE = frozenset(("none", "null", "true", "false", "undefined"))
#: A name is looked for where its run of letters begins, so that a run is read once.
_PAIR = re.compile(
    r"""(?:(?P<quote>["'])(?P<quoted>[A-Za-z_][\w.-]*+)(?P=quote)|(?<![\w.-])(?:[^\WA-Za-z_]|[.-])*+(?P<name>[A-Za-z_][\w.-]*+))"""
    r"""[\x20\t]*+(?::=|=>|=(?!=)|:(?!//))[\x20\t]*+|<(?P<tag>[A-Za-z_][\w.-]*+)>"""
)
_TERM = re.compile(r""""((?:[^"\\]|\\.)*+)"|'((?:[^'\\]|\\.)*+)'|`([^`]*+)`|([A-Za-z_][\w.]*+)(?![\w/+=-])""")
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>&]++""")
_PLUS = re.compile(r"[\x20\t]*[+.][\x20\t]*")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_HEX_BYTES = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * 32


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by start, then kind as listed; code points."""
    found = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_HEX_BYTES):
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PART.findall(name)]
    score = sum(SENSITIVE.get(p, 0.0) + HARMLESS.get(p, 0.0) for p in parts)
    whole = "".join(parts)
    return max(score, max((w for s, w in SENSITIVE.items() if w >= 3 and whole.endswith(s)), default=score))


class Look(NamedTuple):
    """What a literal looks like; looks add up as their literals are joined."""

    length: float = 0.0
    counts: dict[int, float] = {}
    #: Beginning and end, and the one character it consists of, if so.
    head: str = ""
    tail: str = ""
    same: str = ""
    #: Bits: lower, upper, digit, other, something not a letter, a letter that is neither lower nor upper.
    kinds: int = 0
    blanks: float = 0.0
    address: bool = False

    @classmethod
    def of(cls, value: str) -> Look:
        seen, counts, kinds = Counter(value), {}, 0
        for c, n in seen.items():
            counts[ord(c) & 255] = counts.get(ord(c) & 255, 0.0) + n
            kinds |= c.islower() | c.isupper() << 1 | c.isdigit() << 2 | (not c.isalnum()) << 3
            kinds |= (not c.isalpha()) << 4 | c.istitle() << 5 if not c.isupper() else 0
        low = value.lower()
        same = low[:1] if low and low.count(low[0]) == len(low) else ""
        return cls(float(len(value)), counts, value[:HEAD], value[-2:], same, kinds, float(seen[" "]), "://" in value)

    def __add__(self, other: Look) -> Look:
        if not self.length or not other.length:
            return self if self.length else other
        length, counts = self.length + other.length, dict(self.counts)
        for c, n in other.counts.items():
            counts[c] = counts.get(c, 0.0) + n
        if length > 1e15:  # joined to itself again and again: the shares are what counts
            length, counts = length * 1e-6, {c: n * 1e-6 for c, n in counts.items()}
        return Look(
            length,
            counts,
            (self.head + other.head)[:HEAD] if self.length < HEAD else self.head,
            (self.tail + other.tail)[-2:],
            self.same if self.same == other.same else "",
            self.kinds | other.kinds,
            self.blanks + other.blanks,
            self.address or other.address or "://" in self.tail + other.head[:2],
        )

    def score(self) -> float:
        """How much a literal looks like a key: length, spread of its characters, kinds of them."""
        if self.length < LEAST_LETTERS or self.same or _PLACEHOLDER.match(self.head):
            return -10.0
        if self.length < HEAD and self.head.lower() in _NO_VALUE:
            return -10.0
        spread = -sum(n / self.length * math.log2(n / self.length) for n in self.counts.values() if n)
        score = min(3.0, spread) - 0.5 + 0.5 * (self.kinds & 15).bit_count()
        if self.blanks > 2 or self.kinds == 1:
            score -= 2.0
        if self.address or self.head.startswith(("/", "./", "#")):
            score -= 1.5
        return score


def literal_score(value: str) -> float:
    return Look.of(value).score()


def _lexed(text: str) -> list[tuple[str, list[tuple[int, int] | str]]]:
    """(target name, terms) in order; a term is the place of a literal, or a name."""
    pairs, at = [], 0
    for line in text.splitlines(keepends=True):
        bare = 0  # where the last bare literal ends: one that begins within it ends there too
        if "=" in line or ":" in line or "<" in line:
            for m in _PAIR.finditer(line):
                terms: list[tuple[int, int] | str] = []
                here, tag = m.end(), m["tag"]
                if tag:
                    end = line.find("<", here)
                    if end > here and line.startswith(f"</{tag}>", end):
                        value = line[here:end]
                        pairs.append((tag, [(at + end - len(value.lstrip()), at + here + len(value.rstrip()))]))
                    continue
                while t := _TERM.match(line, here):
                    group = t.lastindex or 1
                    terms.append(t[4] if group == 4 else (at + t.start(group), at + t.end(group)))
                    here = t.end()
                    joined = _PLUS.match(line, here)
                    if not joined:
                        break
                    here = joined.end()
                else:
                    if here >= bare:
                        rest = _BARE.match(line, here)
                        bare = rest.end() if rest else 0
                    if here < bare:
                        terms.append((at + here, at + bare))
                if terms:
                    pairs.append((m["quoted"] or m["name"], terms))
        at += len(line)
    return pairs


def _looks(text: str, places: set[tuple[int, int]]) -> dict[tuple[int, int], Look]:
    """The look of each place. Places with one end lie in each other, so each adds to the next shorter one's."""
    looks: dict[tuple[int, int], Look] = {}
    shorter, look = (-1, -1), Look()
    for end, start in sorted(((end, -start) for start, end in places)):
        start = -start
        if shorter[1] != end:
            shorter, look = (end, end), Look()
        look = Look.of(text[start : shorter[0]]) + look
        shorter = (start, end)
        looks[start, end] = look
    return looks


def named_spans(text: str, base: list[Span]) -> list[Span]:
    """Literals that reach a sensitive name, outside the base spans."""
    pairs = _lexed(text)
    looks = _looks(text, {term for _, terms in pairs for term in terms if not isinstance(term, str)})
    bound: dict[str, int] = {}  # the value a name has now
    parts: list[list[tuple[int, int] | int]] = []  # of each value: places, and earlier values
    sums: list[Look] = []
    scores: list[float] = []
    for name, terms in pairs:
        # A name never bound is a bare word: a literal of configuration files, but without a place of its own.
        own = [bound[t] if isinstance(t, str) else t for t in terms if not isinstance(t, str) or t in bound]
        if not own:
            continue
        look = Look()
        for part in own:
            look += sums[part] if isinstance(part, int) else looks[part]
        weight = name_score(name)
        parts.append(own)
        sums.append(look)
        scores.append(weight + look.score() if weight >= LEAST_NAME else -10.0)
        bound[name] = len(parts) - 1
    reached: dict[tuple[int, int], float] = {}
    for value in range(len(parts) - 1, -1, -1):
        for part in parts[value]:
            if isinstance(part, int):
                scores[part] = max(scores[part], scores[value])
            else:
                reached[part] = max(reached.get(part, -10.0), scores[value])
    free = outside(base)
    return [("named", start, end) for (start, end), score in reached.items() if score >= LEAST_SCORE and end > start and free(start, end)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``added``, arrays of (kind, start, end) in code points, and their digests."""

    def make() -> Callable[[str], tuple]:
        kinds = (*KINDS, "named")

        def scanned(text: str) -> tuple:
            base = base_spans(text)
            added = named_spans(text, base)
            both = sorted(base + added, key=lambda s: (s[1], kinds.index(s[0])))
            counts = Counter(kind for kind, _, _ in base)
            found = [{"kind": k, "start": s, "end": e} for k, s, e in both]
            return *(counts[k] for k in KINDS), sha256(joined(base)), joined(both), found

        return scanned

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"
    return per_text(docs, ["doc_id"], make, fields)


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """doc_id and the text with every span replaced by ``mark``."""

    def make() -> Callable[[str], tuple]:
        def cleaned(text: str) -> tuple:
            base = base_spans(text)
            out, at = [], 0
            for _, start, end in sorted(base + named_spans(text, base), key=lambda s: s[1:]):
                if end > at:
                    out += [text[at:start] if start > at else "", mark]
                    at = end
            return ("".join([*out, text[at:]]),)

        return cleaned

    return per_text(docs, ["doc_id"], make, "text string")
