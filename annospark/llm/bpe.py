"""BPE encoding and decoding; long unsplit text by tree concatenation.

A tokenizer splits a normalised text into runs (words, digits, other signs), and BPE works on each run by itself.  Runs of
up to ``LONG`` characters are encoded where the text was read, through a worker's cache of words.  A longer
run is cut into leaves of up to ``LEAF`` characters, which are rows of their own and encoded in parallel.
Neighbours are then concatenated up a tree, all pairs of a level at once: a window of tokens around each join is encoded again,
and grows until it shares a token (same id, same characters) with the left side and one with the right.  A sequence of BPE
tokens is the encoding of its run exactly if each adjacent pair is that of its own text; with a shared token on both
sides, every pair comes from a real encoding.

Texts are normalised whole before they are cut, and leaves and windows are encoded without the normalizer, so a cut
may fall anywhere, between a letter and its combining mark too.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import cut

#: Runs of more characters are cut; characters in a leaf at most; tokens in the first window on each side.
LONG, LEAF, WINDOW = 8_192, 4_096, 16
#: Characters that normalising can make of one, at most.
GROWTH = 4
#: Entries of a worker's cache of words; when full it starts anew.  Longer words are not cached.
CACHE, CACHE_CHARS = 400_000, 64
#: Characters whose classes the tokenizers library and this module agree on (a test goes through them all):
#: printable ASCII, tab, line feed, carriage return, and the Latin letters and signs up to U+024F.
PLAIN = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250))]
LETTERS = "".join(c for c in PLAIN if unicodedata.category(c)[0] == "L")
DIGITS = "".join(c for c in PLAIN if unicodedata.category(c)[0] == "N")
NOT_PLAIN = re.compile(f"[^{re.escape(''.join(PLAIN))}]")
#: The word pattern over lower-cased plain characters; whitespace belongs to no word.
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^ \t\n\r{LETTERS}{DIGITS}]+")
#: Plain characters that lower-casing takes out of the plain ones, or makes longer.
UNEVEN = re.compile(f"[{''.join(c for c in PLAIN if c.lower() not in PLAIN)}]")


class WordBpe:
    """A tokenizers file with its caches; one a worker process."""

    _made: dict[str, WordBpe] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self.normalised = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.tokenizer, self.normalised):
            t.no_truncation()
            t.no_padding()
        self.normalised.normalizer = normalizers.Sequence([])  # takes normalised text as it is
        with open(path) as f:
            self.config = json.load(f)
        added = [t["content"] for t in self.config["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # The word pattern above is this normalizer's and pre-tokenizer's; any other file goes through the library.
        self.known = (self.config["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in json.dumps(self.config["normalizer"])
                      and "[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in json.dumps(self.config["pre_tokenizer"]))
        self.joins = self.config["decoder"] is None
        self.words: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordBpe:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def library(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def _word(self, word: str) -> bytes:
        ids = self.normalised.encode(word, add_special_tokens=False).ids
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= CACHE_CHARS:
            if len(self.words) >= CACHE:
                self.words.clear()
            self.words[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.known or NOT_PLAIN.search(text) or UNEVEN.search(text) or self.special and self.special.search(text):
            ids = self.library(text).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        get = self.words.get
        return b"".join([get(w) or self._word(w) for w in WORDS.findall(text.lower())])

    def parts(self, text: str, long: int = LONG) -> list[tuple[bytes | None, str | None]]:
        """The text as (ids, None) for what is short, and (None, run) for each normalised run of over ``long`` characters, in order."""
        if not self.known:
            return [(self.encode(text), None)]
        out, short, at = [], [], 0
        marks = [(m.start(), m.end()) for m in self.special.finditer(text)] if self.special else []
        for start, end in [*marks, (len(text), len(text))]:
            # Special strings are found before anything is normalised, and what is between them is normalised by itself.
            norm = self.tokenizer.normalizer.normalize_str(text[at:start])
            for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm):
                if b - a > long:
                    out += [(b"".join(short), None), (None, norm[a:b])]
                    short = []
                else:
                    short.append(self.words.get(norm[a:b]) or self._word(norm[a:b]))
            if end > start:
                short.append(struct.pack("<I", self.tokenizer.token_to_id(text[start:end])))
            at = end
        return [*out, (b"".join(short), None)]

    def decode(self, ids: bytes) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        ids = np.frombuffer(ids, "<u4").tolist()
        if self.joins:  # without a decoder the library puts spaces between the tokens
            tokens = self.tokens
            return " ".join([tokens[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def spans(self, text: str, at: int = 0) -> np.ndarray:
        """(id, start, end) of each token of normalised text, in characters of the text that begins at ``at``."""
        e = self.normalised.encode(text, add_special_tokens=False)
        out = np.empty((len(e.ids), 3), np.int64)
        if len(out):
            out[:, 0] = e.ids
            out[:, 1:] = np.asarray(e.offsets, np.int64) + at
        return out


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the (id, start, end) rows that ``a`` and ``b`` share once each, ascending."""

    def once(x: np.ndarray) -> dict[tuple, int]:
        # The bytes of one character may be several tokens with equal rows, which are no place to splice.
        rows = [tuple(r) for r in x.tolist()]
        count = Counter(rows)
        return {r: i for i, r in enumerate(rows) if count[r] == 1}

    p, q = once(a), once(b)
    both = sorted((p[k], q[k]) for k in p.keys() & q.keys())
    return np.array([x for x, _ in both], np.int64), np.array([y for _, y in both], np.int64)


def concatenate(bpe: WordBpe, text: str, left: np.ndarray, right: np.ndarray, start: int, seam: int, window: int = WINDOW) -> np.ndarray:
    """Tokens of ``left`` and ``right`` joined; ``text`` begins at ``start`` and ``right`` at ``seam``."""
    n = window
    while True:
        all_left, all_right = n >= len(left), n >= len(right)
        lo = start if all_left else int(left[-n, 1])
        hi = start + len(text) if all_right else int(right[n - 1, 2])
        mid = bpe.spans(text[lo - start : hi - start], lo)
        i, keep = (0, 0) if all_left else (None, None)
        if not all_left:
            base = len(left) - n
            a, b = _shared(left[base:], mid)
            if len(a):
                keep, i = base + int(a[0]), int(b[0])
        j, rest = (len(mid), len(right)) if all_right else (None, None)
        if not all_right:
            a, b = _shared(mid, right[:n])
            if len(a):
                j, rest = int(a[-1]) + 1, int(b[-1]) + 1
        if i is not None and j is not None and i <= j:
            return np.concatenate([left[:keep], mid[i:j], right[rest:]])
        n *= 2


def join_halves(bpe: WordBpe, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], window: int = WINDOW) -> tuple[str, np.ndarray]:
    """Text and tokens (offsets from its beginning) of two neighbours as one."""
    (a, x), (b, y) = left, right
    return a + b, concatenate(bpe, a + b, x, y + [0, len(a), len(a)], 0, len(a), window)


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids, decoded`` for each row of ``docs``.

    ``ids`` (binary) are those of the tokenizers file ``path`` without added special tokens, as little-endian
    unsigned 32-bit integers; ``decoded`` is what decoding them gives.  A null or empty text has no ids and
    decodes to an empty text; a null ``doc_id`` stays null, repeated rows give repeated rows, no rows give no
    rows; other columns are not read.  A run of more than ``long`` characters that the tokenizer doesn't split is encoded in
    leaves, whose cuts may fall anywhere, and its halves are joined level by level in tasks of their own; only its last join
    has it whole.  A very long text of short runs stays in the task that reads it.
    """

    @F.arrow_udf("struct<ids:binary,decoded:string>")
    def whole(texts: pa.Array) -> pa.Array:
        bpe = WordBpe.of(path)
        ids = [bpe.encode(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], ["ids", "decoded"])

    @F.arrow_udf("array<struct<ids:binary,run:string>>")
    def parts(texts: pa.Array) -> pa.Array:
        bpe = WordBpe.of(path)
        kind = pa.list_(pa.struct([("ids", pa.binary()), ("run", pa.string())]))
        return pa.array([[{"ids": i, "run": r} for i, r in bpe.parts(t, long)] for t in texts.to_pylist()], kind)

    @F.arrow_udf("binary")
    def leaf_spans(texts: pa.Array) -> pa.Array:
        bpe = WordBpe.of(path)
        return pa.array([bpe.spans(t).astype("<i4").tobytes() for t in texts.to_pylist()], pa.binary())

    @F.arrow_udf("binary")
    def ids_of(spans: pa.Array) -> pa.Array:
        return pa.array([np.ascontiguousarray(np.frombuffer(s, "<i4").reshape(-1, 3)[:, 0]).astype("<u4").tobytes() for s in spans.to_pylist()], pa.binary())

    @F.arrow_udf("struct<ids:binary,decoded:string>")
    def finished(pieces: pa.Array) -> pa.Array:
        bpe = WordBpe.of(path)
        ids = [b"".join(p) for p in pieces.to_pylist()]
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], ["ids", "decoded"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        bpe, rows = WordBpe.of(path), rows.sort_values("part")
        halves = [(t, np.frombuffer(s, "<i4").reshape(-1, 3)) for t, s in zip(rows["leaf"], rows["spans"], strict=True)]
        whole_text, spans = join_halves(bpe, *halves) if len(halves) == 2 else halves[0]
        first = rows.iloc[:1]
        return pd.DataFrame({"row": first["row"].array, "piece": first["piece"].array, "part": first["part"].array // 2, "leaf": [whole_text], "spans": [spans.astype("<i4").tobytes()]})

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # Whitespace ends a run, so only texts with a long stretch without any can have a long run.
    stretch = F.array_max(F.transform(F.split("text", r"\s+"), F.char_length))
    maybe = (F.char_length("text") > long // GROWTH) & (F.coalesce(stretch, F.lit(0)) > long // GROWTH)
    short = rows.where(~maybe).select("doc_id", whole("text").alias("x")).select("doc_id", "x.ids", "x.decoded")
    pieces = rows.where(maybe).withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", F.posexplode(parts("text")).alias("piece", "x"))
    pieces = cut(pieces.select("row", "doc_id", "piece", "x.ids", "x.run"), "pieces")
    cuts = F.expr(f"transform(sequence(0, cast(ceil(char_length(run) / {leaf}) as int) - 1), i -> substring(run, i * {leaf} + 1, {leaf}))")
    leaves = pieces.where("run is not null").select("row", "piece", F.posexplode(cuts).alias("part", "leaf"))
    width = (leaves.agg(F.max("part")).first()[0] or 0) + 1
    nodes = leaves.repartition("row", "piece", "part").select("row", "piece", "part", "leaf", leaf_spans("leaf").alias("spans"))
    while width > 1:
        nodes = nodes.groupBy("row", "piece", F.expr("part div 2")).applyInPandas(joined, "row long, piece int, part int, leaf string, spans binary")
        width = (width + 1) // 2
    ready = pieces.where("run is null").select("row", "doc_id", "piece", "ids")
    runs = nodes.select("row", F.lit(None).cast(dict(docs.dtypes)[doc_id]).alias("doc_id"), "piece", ids_of("spans").alias("ids"))
    # Every text has a last piece of ids, so its doc_id is there.
    own = F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda p: p["ids"])
    texts = ready.unionByName(runs).groupBy("row").agg(F.max("doc_id").alias("doc_id"), own.alias("pieces"))
    return short.unionByName(texts.select("doc_id", finished("pieces").alias("x")).select("doc_id", "x.ids", "x.decoded"))
