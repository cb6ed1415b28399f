"""Personal data by patterns and a linear-chain conditional random field.

Four patterns give the base spans. Beyond them a linear-chain CRF over
word-shape features labels tokens as part of an e-mail address, a telephone
number, an identity number or a person's name in forms the patterns miss
(``ann at host dot org``, ``(555) 123-4567``, ``123-45-6789``, ``Dr. Ann Lee``).
It is trained from ``LABELLED``, a small table, on the driver; the weights go to
the tasks, which decode batches of chains by Viterbi in numpy.

A token is a run without white space. Its features are its shape, its lower-cased
form where it is a cue word, and those of its neighbours. Chains are built where an
entity can be: around tokens that are not labelled O by themselves, around a cue
word close to another one or to a number, and around adjacent numbers. Plain words by themselves are O, which
is checked when the weights are trained.

Defined cases: null and empty texts have no spans; repeated rows and null ids are
answered each; where base and added spans overlap the base one stays and the
other goes; an empty table gives an empty result; further columns are not touched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from wickline.llm.common import outside, text_or_empty
from wickline.llm.secrets import joined, sha256

Span = tuple[str, int, int]

#: The base kinds and their order, and the kinds that the CRF adds.
KINDS = ("email", "ip", "card", "phone")
ADDED = ("id", "name")
LABELS = ("O", "email", "phone", "id", "name")

#: The labelled table. ``{kind words}`` marks an entity.
LABELLED = (
    "please write to {email ann at host dot org} for details",
    "reach me under {email bob (at) mail (dot) example (dot) com} any time",
    "his address is {email carl [at] site [dot] net} , he said",
    "mail: {email d.miller (at) firm.example.com} or come by",
    "e-mail {email eva at posteo dot example dot de} before noon",
    "send it to {email frank [at] shop.example.org}",
    "mail {email gina at port dot net} or wait",
    "my address {email h.long at web dot com} is new",
    "ask {email ivan at school dot edu} about it",
    "{email jo at lab dot org} knows more",
    "we met at the river and looked at the dot on the map",
    "she was at home when it happened at noon",
    "look at that dot over there , it is at the top",
    "call {phone (555) 123-4567} today",
    "phone: {phone 555-123-4567} or ask",
    "tel. {phone 030 1234567} in the morning",
    "his number is {phone 212-555-0199} , she said",
    "telephone {phone (212) 555 0143} please",
    "dial {phone 0171 5550123} for help",
    "fax: {phone (089) 555-7731}",
    "ring {phone 555.123.4567} now",
    "mobile {phone 0176-55501234} after six",
    "the ssn {id 123-45-6789} was leaked",
    "social security number {id 987-65-4321} on file",
    "SSN: {id 078-05-1120}",
    "passport {id C01X00T47} expires soon",
    "passport no. {id L8988901C} was found",
    "identity card {id T22000129} issued",
    "iban {id DE89370400440532013000} was used",
    "IBAN: {id FR7630006000011234567890189}",
    "yesterday {name Dr. Ann Lee} spoke",
    "ask {name Mr. Smith} about it",
    "with {name Mrs. Clara Stone} and others",
    "{name Prof. Jonas Weber} wrote this",
    "name: {name Maria Lopez} , aged ten",
    "contact {name Ms. Dana White} there",
    "then {name Dr. Omar Klein} came in",
    "as {name Mr. Peter Novak} said , it was late",
    "to {name Mrs. Rosa Keller} with thanks",
    "dear {name Ms. Tina Burke} , thank you",
    "by {name Prof. Ugo Conti} of the city",
    "name: {name Vera Holm} , at home",
    "call {phone 0171 5550188} or {phone 555-010-2233} again",
    "ssn {id 219-09-9999} and iban {id GB29NWBK60161331926819} were sold",
    "phone: {phone (030) 555-0142} , tel. {phone 040-5550177} and telephone {phone 555 0199 221}",
    "in 1999 there were 25 of them and 300 more in 2004",
    "it cost 12.50 or 1,200 in total on 12-05-2001",
    "version 1.2.3 of 2020-01-02 at 10:30",
    "see pages 12-15 and chapter 7 of part 3",
    "item 4567 and order 99812 came on 2021-11-30",
    "room 101 , floor 3 , 45 people and 7 dogs",
    "The End of it came. Then the Old man left the City",
    "A name is a thing. The phone rang. Call it a day",
    "He gave his passport to the man and took the card",
    "The number of people is 1234567 in the city",
    "hash 9f86d081884c7d659a2feaa0c55ad015 and code AB12",
    "token = \"269b1cea0846965f2d3ecb5cdb87c0edc7a7a587\" dropped",
    "address 10.0.0.1 and mask 255.255.255.0 were set",
    "written by ann.lee@host.example.org on Monday",
    "numbered 4913615156729033 and 7844238401328224 in the list",
    "dialled +1 (017) 555-7713 and +49 30 5550123 then",
    "total | 12 | 13 | 14 and so on",
    "100 200 300 400 500 600",
    "All rights reserved. Copyright 2021 by the Authors",
    "The Old City Council Of North River Met Today And Went Home",
    "Chapter One Begins Here And Ends There With Many Capital Words",
    "Open Letter To All Members Of This Club And Its Friends",
    "Great News For The Whole Town Came This Week From Far Away",
    "Terms And Conditions Apply To Every Order Placed On This Site",
    "words and words of prose that go on , and on . And on",
)

_EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A run of digits that fails from its first digit fails from every later one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", re.ASCII)
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)
_SPELLED = re.compile(
    r"(?i)[\w.+-]+\s+(?:@|[(\[]at[)\]]|at)\s+[\w-]+(?:\s+(?:dot|[(\[]dot[)\]])\s+[\w-]+|\.[\w-]+)+"
)
_TOKEN = re.compile(r"\S+")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their ``@``: linear in the text however long a run before it is."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _EMAIL_HOST.match(text, at) if start < at else None
        if host:
            done = host.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by start, then kind as listed; code points."""
    found = list(_emails(text)) if "@" in text else []
    if len(text.encode("utf-8", "surrogatepass").translate(None, _NO_DIGITS)) >= 4:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _shape(word: str) -> str:
    """``(555)`` is ``(d3)``, ``Ann`` is ``Xx``: runs are shortened, runs of digits keep their length up to 9."""
    parts = re.findall(r"[0-9]+|[A-Z]+|[^\W\d_]+?(?=[A-Z0-9\W_]|$)|.", word)
    return "".join(
        f"d{min(len(p), 9)}" if p[0] in "0123456789" else "X" if "A" <= p[0] <= "Z" else "x" if p[0].isalpha() else p[0]
        for p in parts
    )


def _plain(word: str) -> bool:
    """Letters only, but for one mark at the end."""
    return word.isalpha() or (word[-1] in ".,;:!?" and word[:-1].isalpha())


def _own(word: str, known: frozenset[str]) -> tuple[str, ...]:
    """The features of a token by itself."""
    cue = word.lower() in known
    if _plain(word):
        shape = "s=X" if word[0].isupper() else "s=x"
        return (shape, f"w={word.lower()}") if cue else (shape,)
    features = [f"s={_shape(word)}"]
    if cue:
        features.append(f"w={word.lower()}")
    if any("0" <= c <= "9" for c in word):
        features.append("digits")
    return tuple(features)


def _read(line: str) -> tuple[list[str], list[int]]:
    words, labels, kind = [], [], "O"
    for part in line.split():
        if part.startswith("{"):
            kind = part[1:]
            continue
        ends = part.endswith("}")
        words.append(part.rstrip("}"))
        labels.append(LABELS.index(kind))
        if ends:
            kind = "O"
    return words, labels


class Field:
    """Weights of a chain: per feature for the token itself, the one before and the one after, and of transitions."""

    PASSES, STEP, PENALTY = 250, 0.1, 0.02

    def __init__(self, labelled: tuple[str, ...] = LABELLED) -> None:
        lines = [_read(line) for line in labelled]
        #: Cue words: met twice or more in entities, or next to them and nowhere else. They have no digits.
        inside, beside, apart = Counter(), Counter(), Counter()
        for words, labels in lines:
            for k, word in enumerate(words):
                near = any(labels[j] for j in (k - 1, k + 1) if 0 <= j < len(labels))
                (inside if labels[k] else beside if near else apart)[word.lower()] += 1
        cues = {w for w, n in inside.items() if n > 1} | {w for w, n in beside.items() if n > 1 and w not in apart}
        self.known = frozenset(w for w in cues if not any(c.isdigit() for c in w) and any(map(str.isalpha, w)))
        self.index: dict[str, int] = {}
        for words, _ in lines:
            for word in words:
                for feature in _own(word, self.known):
                    self.index.setdefault(feature, len(self.index))
        count, size = len(self.index), len(LABELS)
        longest = max(len(words) for words, _ in lines)
        x = np.zeros((len(lines), longest, 3 * count + 1))
        y = np.zeros((len(lines), longest), int)
        mask = np.zeros((len(lines), longest), bool)
        for i, (words, labels) in enumerate(lines):
            mask[i, : len(words)] = True
            y[i, : len(words)] = labels
            x[i, : len(words), -1] = 1
            for k, word in enumerate(words):
                own = [self.index[f] for f in _own(word, self.known)]
                x[i, k, own] = 1
                if k + 1 < len(words):
                    x[i, k + 1, [count + f for f in own]] = 1
                if k:
                    x[i, k - 1, [2 * count + f for f in own]] = 1
        unary, moves = np.zeros((3 * count + 1, size)), np.zeros((size, size))
        self._fit(x, y, mask, unary, moves)
        self.tables = unary[:-1].reshape(3, count, size)
        self.bias, self.moves = unary[-1], moves
        self.plain = {shape: self.scores((f"s={shape}",)) for shape in "xX"}
        assert all(self.alone_is_o((f"s={shape}",)) for shape in self.plain)

    def _fit(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, unary: np.ndarray, moves: np.ndarray) -> None:
        """Adam on the penalised log likelihood, by forward and backward sums over all lines at once."""
        lines, longest, size = *y.shape, moves.shape[0]
        gold = np.eye(size)[y] * mask[..., None]
        both = mask[:, 1:] & mask[:, :-1]
        gold_moves = np.einsum("nta,ntb->ab", gold[:, :-1] * both[..., None], gold[:, 1:])
        state = [np.zeros_like(p) for p in (unary, unary, moves, moves)]
        for step in range(1, self.PASSES + 1):
            score = x @ unary
            ahead, back = np.zeros((lines, longest, size)), np.zeros((lines, longest, size))
            ahead[:, 0] = score[:, 0]
            for t in range(1, longest):
                moved = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + score[:, t]
                ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
            for t in range(longest - 2, -1, -1):
                moved = np.logaddexp.reduce(moves + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
                back[:, t] = np.where(mask[:, t + 1, None], moved, 0)
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)
            single = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
            pair = np.exp(
                ahead[:, :-1, :, None] + moves + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
            ) * both[..., None, None]
            slopes = (
                np.einsum("ntf,ntl->fl", x, single - gold) + self.PENALTY * unary,
                pair.sum((0, 1)) - gold_moves + self.PENALTY * moves,
            )
            for k, (weights, slope) in enumerate(zip((unary, moves), slopes, strict=True)):
                state[2 * k] = 0.9 * state[2 * k] + 0.1 * slope
                state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * slope * slope
                weights -= self.STEP * (state[2 * k] / (1 - 0.9**step)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**step)) + 1e-8)

    def scores(self, features: tuple[str, ...]) -> np.ndarray:
        """What a token adds to its own labels, to its successor's and to its predecessor's: (3, labels)."""
        rows = [self.index[f] for f in features if f in self.index]
        return self.tables[:, rows].sum(1) if rows else np.zeros(self.tables[:, 0].shape)

    def alone_is_o(self, features: tuple[str, ...]) -> bool:
        """Whether a token with these features, with nothing but plain words around it, is labelled O as they are."""
        own = self.scores(features)
        chains = []
        for before in self.plain.values():
            for after in self.plain.values():
                row = np.array([before, before, before, own, after, after, after])
                score = row[:, 0] + self.bias
                score[1:] += row[:-1, 1]
                score[:-1] += row[1:, 2]
                chains.append(score)
        return not any(path.any() for path in self.decode(chains))

    def decode(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each chain of unary scores; chains of like length are decoded together."""
        out: list[np.ndarray] = [np.empty(0, int)] * len(chains)
        order = sorted(range(len(chains)), key=lambda i: len(chains[i]))
        low = 0
        while low < len(order):
            most = len(chains[order[low]]) * 5 // 4 + 2
            group = [i for i in order[low : low + 512] if len(chains[i]) <= most]
            low += len(group)
            longest = len(chains[group[-1]])
            score = np.zeros((len(group), longest, len(LABELS)))
            sizes = np.array([len(chains[i]) for i in group])
            for row, i in enumerate(group):
                score[row, : sizes[row]] = chains[i]
            best, from_ = score[:, 0], np.zeros((len(group), longest, len(LABELS)), np.int8)
            for t in range(1, longest):
                ways = best[:, :, None] + self.moves
                from_[:, t] = ways.argmax(1)
                best = np.where((t < sizes)[:, None], ways.max(1) + score[:, t], best)
            label = best.argmax(1)
            path = np.zeros((len(group), longest), int)
            for t in range(longest - 1, -1, -1):
                path[:, t] = label
                label = np.where((t < sizes) & (t > 0), from_[np.arange(len(group)), t, label], label)
            for row, i in enumerate(group):
                out[i] = path[row, : sizes[row]]
        return out


@cache
def trained() -> Field:
    return Field()


class Tagger:
    """Chains of a text, and the spans of their decoded labels."""

    #: Words on either side that belong to a chain, and how close two cue words must be.
    AROUND = 3

    def __init__(self, field: Field) -> None:
        self.field = field
        self.kinds: list[np.ndarray] = [field.plain["x"], field.plain["X"]]
        self.by_features: dict[tuple[str, ...], int] = {("s=x",): 0, ("s=X",): 1}
        self.by_word: dict[str, int] = {}
        self.loud: list[bool] = [False, False]
        self.cue: list[int] = [0, 0]  # 2: cue word, 1: has digits

    def _kind(self, word: str) -> int:
        if _plain(word) and word.lower() not in self.field.known:
            kind = int(word[0].isupper())
            if len(self.by_word) < 400_000:
                self.by_word[word] = kind
            return kind
        features = _own(word, self.field.known)
        kind = self.by_features.get(features)
        if kind is None:
            kind = len(self.kinds)
            self.kinds.append(self.field.scores(features))
            self.loud.append(not self.field.alone_is_o(features))
            self.cue.append(2 if any(f.startswith("w=") for f in features) else int("digits" in features))
            self.by_features[features] = kind
        if len(self.by_word) < 400_000:
            self.by_word[word] = kind
        return kind

    def chains(self, text: str) -> list[tuple[int, np.ndarray]]:
        """(first token, unary scores) of each stretch where an entity can be."""
        get, kind = self.by_word.get, self._kind
        kinds = [k if (k := get(word)) is not None else kind(word) for word in text.split()]
        if not kinds or max(kinds) < 2:
            return []
        codes = np.array(kinds)
        marked = np.flatnonzero(codes >= 2)
        loud = np.array(self.loud)[codes[marked]]
        cue = np.array(self.cue)[codes[marked]]
        marked, cues, cue = marked[loud], marked[cue > 0], cue[cue > 0]
        gap = np.diff(cues)
        near = (gap <= self.AROUND) & (np.diff(codes[cues]) != 0) & (np.maximum(cue[1:], cue[:-1]) == 2) | (gap == 1)
        marked = np.unique(np.concatenate([marked, cues[1:][near], cues[:-1][near]]))
        if not len(marked):
            return []
        cuts = np.flatnonzero(np.diff(marked) > 2 * self.AROUND) + 1
        found = []
        for group in np.split(marked, cuts):
            low, high = max(0, group[0] - self.AROUND), min(len(codes), group[-1] + self.AROUND + 1)
            own = np.array([self.kinds[k] for k in codes[low:high]])
            score = own[:, 0] + self.field.bias
            score[1:] += own[:-1, 1]
            score[:-1] += own[1:, 2]
            if low:
                score[0] += self.kinds[codes[low - 1]][1]
            if high < len(codes):
                score[-1] += self.kinds[codes[high]][2]
            found.append((int(low), score))
        return found

    def spans(self, text: str, paths: list[tuple[int, np.ndarray]]) -> list[Span]:
        """Entities as (kind, start, end), without punctuation around them."""
        if not any(path.any() for _, path in paths):
            return []
        places = [m.span() for m in _TOKEN.finditer(text)]
        found = []
        for low, path in paths:
            at = 0
            while at < len(path):
                end = at + 1
                while end < len(path) and path[end] == path[at]:
                    end += 1
                if path[at]:
                    span = self._checked(LABELS[path[at]], text, places[low + at][0], places[low + end - 1][1])
                    found += [span] if span else []
                at = end
        return found

    def _checked(self, kind: str, text: str, start: int, end: int) -> Span | None:
        """The span trimmed, if it has what its kind needs."""
        while end > start and text[end - 1] in ".,;:!?\"'|":
            end -= 1
        while end > start and text[start] in ".,;:!?\"'|":
            start += 1
        part = text[start:end]
        digits = sum("0" <= c <= "9" for c in part)
        good = {
            "email": bool(_SPELLED.fullmatch(part)),
            "phone": 7 <= digits <= 15 and not re.search(r"[^\W\d_]", part),
            "id": digits >= 5 and " " not in part,
            "name": digits == 0 and part[:1].isupper() and len(part.split()) >= 2,
        }[kind]
        return (kind, start, end) if good and end > start else None


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts and digest of the base spans, and all spans as text and as ``found``."""
    field = trained()
    made = StructType.fromDDL(
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "found array<struct<kind:string,start:int,end:int>>"
    )
    schema = StructType([docs.schema["doc_id"], *made.fields])
    types = [to_arrow_type(f.dataType) for f in made.fields]
    kinds = (*KINDS, *ADDED)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not texts:
                continue
            chains = [tagger.chains(text) for text in texts]
            decoded = iter(field.decode([score for own in chains for _, score in own]))
            rows = []
            for text, own in zip(texts, chains, strict=True):
                base = base_spans(text)
                paths = [(low, next(decoded)) for low, _ in own]
                free = outside(base)
                added = [s for s in tagger.spans(text, paths) if free(s[1], s[2])]
                both = sorted(base + added, key=lambda s: (s[1], kinds.index(s[0])))
                counts = Counter(kind for kind, _, _ in base)
                found = [{"kind": k, "start": s, "end": e} for k, s, e in both]
                rows.append((*(counts[k] for k in KINDS), sha256(joined(base)), joined(both), found))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(apply, schema)
