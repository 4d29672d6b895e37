"""Secret scans through a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over
trigrams that every match must contain: runs of the pattern that stand for few
strings give an OR over those strings of the AND of their trigrams.  For each
block of texts an inverted index is built over the trigrams that some query asks
for (lower-cased in ASCII); postings are intersected and united per query, and
only the candidates are searched with the expression itself.  A rule without
mandatory trigrams searches every text.  Blocks are the Arrow batches of a scan,
so the index needs no shuffle and its size is bounded.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that one run of a pattern may stand for; beyond that the run ends.
MOST_STRINGS = 64
#: Bytes of text in a block, about, and of a block that are looked at together.
BLOCK_BYTES, INDEX_BYTES = 2 << 20, 1 << 20


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
#: kind, expression, least characters, of which group.  The first three are the base.  Each expression reads a text of any
#: length in proportional time: where a run could be entered at any of its characters, only its first is a start.
RULES = (
    ("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    ("access", r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", r"[0-9a-f]+", 16, 0),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("repo_token", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 0),
    ("signed_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
    ("url_password", r"://[A-Za-z0-9._~-]+:[A-Za-z0-9._~%!$&*+=-]+@[A-Za-z0-9.-]+", 0, 0),
)
BASE = ("assign", "access", "hex")

Query = list[list[frozenset[str]]]  # AND of ORs of ANDs of trigrams


def _runs(nodes) -> list[set[str] | None]:
    """What a parsed pattern's parts stand for in order: few strings, or None where any text may stand."""
    out: list[set[str] | None] = []
    for op, arg in nodes:
        if op is C.LITERAL:
            out.append({chr(arg).lower()})
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            out.append({chr(a).lower() for _, a in arg})
        elif op is C.SUBPATTERN:
            out += _runs(arg[3])
        elif op is C.BRANCH:
            each = [_whole(_runs(x)) for x in arg[1]]
            out.append(None if None in each else set().union(*each))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, inner = arg
            runs = _runs(inner)
            once = _whole(runs)
            if once is not None and (least, most) == (0, 1):
                out.append({""} | once)
            else:
                out += [*runs * min(least, 3), *([] if least == most and least <= 3 else [None])]
        elif op is C.AT:
            continue
        else:
            out.append(None)
    return out


def _whole(runs: list[set[str] | None]) -> set[str] | None:
    """The strings that consecutive parts stand for together; None if too many or any."""
    found = {""}
    for part in runs:
        if part is None or len(found) * len(part) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def trigram_query(pattern: str) -> Query:
    """Trigrams that every match of ``pattern`` contains, lower-cased; empty if there are none."""
    query: Query = []

    def end(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 and s.isascii() for s in strings):
            query.append(sorted({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}, key=sorted))

    found = {""}
    for part in _runs(_parser.parse(pattern)):
        if part is None:
            end(found)
            found = {""}
        elif len(found) * len(part) > MOST_STRINGS:
            end(found)
            found = set(part) if len(part) <= MOST_STRINGS else {""}
        else:
            found = {a + b for a in found for b in part}
    end(found)
    return query


class Scanner:
    """Rules with their queries; finds the spans of a block of texts."""

    _made: dict[tuple, Scanner] = {}

    def __init__(self, rules=RULES):
        self.rules = [(kind, re.compile(p), least, group, trigram_query(p)) for kind, p, least, group in rules]
        grams = sorted({g for *_, q in self.rules for some in q for every in some for g in every})
        self.number = {g: i + 1 for i, g in enumerate(grams)}
        self.wanted = np.zeros(1 << 24, np.uint8 if len(grams) < 256 else np.uint16)
        for g, i in self.number.items():
            a, b, c = g.encode()
            self.wanted[a << 16 | b << 8 | c] = i
        self.fold = np.arange(256, dtype=np.uint32)
        self.fold[65:91] += 32

    @classmethod
    def of(cls, rules) -> Scanner:
        rules = tuple(map(tuple, rules))
        if rules not in cls._made:
            cls._made[rules] = cls(rules)
        return cls._made[rules]

    def postings(self, texts: list[bytes]) -> dict[int, np.ndarray]:
        """Numbers of the texts that have each wanted trigram, ascending."""
        ends = np.cumsum([len(t) + 2 for t in texts])  # two zero bytes keep trigrams apart
        whole, pairs = np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8), np.empty(0, np.int64)
        for start in range(0, len(whole), INDEX_BYTES):
            folded = self.fold[whole[start : start + INDEX_BYTES + 2]]
            found = self.wanted[folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]]
            at = np.flatnonzero(found)
            pairs = np.union1d(pairs, found[at].astype(np.int64) << 40 | np.searchsorted(ends, at + start, "right"))
        grams, starts = np.unique(pairs >> 40, return_index=True)
        return dict(zip(grams.tolist(), np.split(pairs & ((1 << 40) - 1), starts[1:]), strict=False)) if len(grams) else {}

    def candidates(self, query: Query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
        """Numbers of the texts that satisfy ``query``; all ``n`` if it is empty."""
        none, out = np.empty(0, np.int64), np.arange(n)
        for some in query:
            hits = []
            for every in some:
                lists = sorted((postings.get(self.number[g], none) for g in every), key=len)
                hit = lists[0]
                for more in lists[1:]:
                    hit = np.intersect1d(hit, more, assume_unique=True)
                hits.append(hit)
            out = np.intersect1d(out, np.unique(np.concatenate(hits)), assume_unique=True)
        return out

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text by start, then in the rules' order; ends exclusive, in code points."""
        out: list[list] = [[] for _ in texts]
        postings = self.postings([t.encode() for t in texts])
        for order, (kind, expression, least, group, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, len(texts)).tolist():
                for m in expression.finditer(texts[i]):
                    if m.end(group) - m.start(group) >= least:
                        out[i].append((m.start(), order, kind, m.end()))
        return [[(kind, start, end) for start, _, kind, end in sorted(x)] for x in out]

    def blocks(self, texts: list[str]):
        """Spans of every text, indexed about ``BLOCK_BYTES`` at a time."""
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t)
            if size >= BLOCK_BYTES:
                yield from self.scan(block)
                block, size = [], 0
        if block:
            yield from self.scan(block)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(text: Column, rules=RULES) -> Column:
    """The spans of secrets in each text; none for a null or empty one.

    Matches of a kind are leftmost and do not overlap each other; those whose group is too short are dropped.
    """

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        found = Scanner.of(rules).blocks(texts.to_pylist())
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found], kind)

    return spans(F.coalesce(text, F.lit("")))


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules=RULES) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs``, spans by start, ties in the order of ``rules``.

    A null or empty text has no spans, a null ``doc_id`` stays null, repeated rows give repeated rows, no rows
    give no rows; other columns are not read.  A very long text is a block of its own, indexed ``INDEX_BYTES`` at a time and
    searched whole in time proportional to its length.
    """
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), secret_spans(F.col(f"`{text}`"), rules).alias("spans"))


def redact(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``[kind]``; overlapping spans count as one, of the first's kind.

    Texts without secrets, null ones included, stay as they are, as do all other columns and rows.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        out = []
        for t, spans in zip(texts, Scanner.of(rules).blocks([t or "" for t in texts]), strict=True):
            if t and spans:
                parts, at = [], 0
                for kind, start, end in spans:
                    if start >= at:
                        parts += [t[at:start], f"[{kind}]"]
                    at = max(at, end)
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return docs.withColumn(text, clean(F.col(f"`{text}`")))
