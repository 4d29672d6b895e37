"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is described by numbers (shares of characters,
of kinds of words, hashed three-letter shapes, hashed words) and encoded by a layer of tanh units.  Gated attention,
``w . (tanh(V h) * sigmoid(U h))``, gives each passage a weight among those of its document, and a linear classifier
scores the weighted mean of the encodings.  Encoder, attention and classifier are learnt together from the documents'
labels; no passage has one.

Training: a bounded sample of labelled rows.  Tasks describe the passages of the sample, at most ``TRAIN_PASSAGES`` evenly
spaced ones of a document; one task then fits the model by Adam in numpy.  Scoring: a narrow pass with the model broadcast
(its size is fixed) over all passages of whole texts.  Softmax over passages is summed up as a
text streams by, so a text of any length takes the memory of ``CHUNK`` characters.
"""

from __future__ import annotations

import io
import re
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words in a passage; characters of text that are worked on together (passages begin anew in each such part of a text).
PASSAGE, CHUNK = 32, 1 << 17
#: Buckets of hashed shapes and words.
SHAPES, WORDS = 128, 64
#: Units of the encoder and of the attention.
UNITS, GATES = 16, 8
#: Labelled rows in the training sample, at most, of each class (those of least hash), and passages of each.
LOW, HIGH, TRAIN_PASSAGES = 2000, 4000, 64
#: Passes over the sample, documents in a step, Adam's rate, weight decay, seed.
EPOCHS, BATCH, RATE, DECAY, SEED = 15, 64, 5e-3, 1e-3, 11
#: Rows of this remainder of crc32(doc_id as text) by 3 are held out.
FOLDS, HELD = 3, 1

#: Kinds of characters, in the order of their numbers.
KINDS = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "other")
SPACE, LOWER, UPPER, DIGIT, NEWLINE, STOP, SYMBOL = (KINDS.index(k) for k in ("space", "lower", "upper", "digit", "newline", "stop", "symbol"))
#: Numbers that describe a passage besides its hashed parts.
SINGLE = len(KINDS) + 12
SIZE = SINGLE + SHAPES + WORDS
GAP = re.compile(r"\s")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point its kind, what stands for it in a shape, and its lower case; made once a process."""
    if not _tables:
        kind, lower = np.full(0x110000, KINDS.index("other"), np.uint8), np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isspace():
                kind[c] = NEWLINE if x == "\n" else SPACE
            elif x.isalpha():
                kind[c] = UPPER if x.isupper() else LOWER
            elif x.isdigit():
                kind[c] = DIGIT
            elif x in ".,;:!?":
                kind[c] = STOP
            elif x in string.punctuation:
                kind[c] = SYMBOL
            if kind[c] == UPPER and len(x.lower()) == 1:
                lower[c] = ord(x.lower())
        shape = np.where(kind <= SPACE, kind, np.minimum(np.arange(0x110000), 1 << 16) + 8)
        _tables.append((kind, shape.astype(np.uint64), lower))
    return _tables[0]


def parts_of(text: str | None) -> list[str]:
    """The text in parts of about ``CHUNK`` characters, cut at whitespace where there is some; one part at least."""
    text, at, out = text or "", 0, []
    while len(text) - at > CHUNK:
        gap = GAP.search(text, at + CHUNK - CHUNK // 8, at + CHUNK)
        to = gap.start() if gap else at + CHUNK
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The passages of texts, one after the other, as rows of ``SIZE`` numbers, and each text's number of them."""
    kinds, shapes, lowers = _characters()
    whole = "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    kind = kinds[points]
    gap = (kind == SPACE) | (kind == NEWLINE)
    edge = np.diff(gap.astype(np.int8), prepend=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    words = np.diff(np.searchsorted(start, ends), prepend=0)
    passages = -(-words // PASSAGE)
    total = int(passages.sum())
    out = np.zeros((total, SIZE), np.float32)
    if not total:
        return out, passages
    # The passage of each word, and of each character from its first word to the end of its last.
    within = np.arange(len(start)) - np.repeat(np.cumsum(words) - words, words)
    owner = np.repeat(np.cumsum(passages) - passages, words) + within // PASSAGE
    n = np.bincount(owner, minlength=total).astype(np.float32)
    leads = np.flatnonzero(within % PASSAGE == 0)
    tails = end[np.append(leads[1:], len(end)) - 1]
    of, place = np.cumsum(np.bincount(start[leads], minlength=len(points))) - 1, np.arange(len(points))
    inside, shaped = (of >= 0) & (place < tails[of]), (of >= 0) & (place + 2 < tails[of])
    bag, of, kind_in = of[shaped], of[inside], kind[inside]
    chars = np.bincount(of, minlength=total).astype(np.float32)
    out[:, : len(KINDS)] = np.bincount(of * len(KINDS) + kind_in, minlength=total * len(KINDS)).reshape(total, -1) / chars[:, None]
    with np.errstate(over="ignore"):
        s = shapes[points]
        h = s * _MIX[0]
        for k in (1, 2):
            h = (h ^ h >> np.uint64(31)) * _MIX[1] + np.append(s[k:], s[:k]) * _MIX[0]
        bucket = ((h ^ h >> np.uint64(29)) * _MIX[2] >> np.uint64(65 - SHAPES.bit_length())).astype(np.int64)
        place = place.astype(np.uint64)
        place -= np.repeat(place[np.append(0, start)], np.diff(np.append(np.append(0, start), len(points))))
        letters = (lowers[points].astype(np.uint64) + _MIX[2] * (place + np.uint64(1))) * _MIX[0]
        letters = np.where(gap, np.uint64(0), (letters ^ letters >> np.uint64(32)) * _MIX[1])
        name = np.add.reduceat(letters, start)
        name = (name ^ name >> np.uint64(31)) * _MIX[2]
    out[:, SINGLE : SINGLE + SHAPES] = np.bincount(bag * SHAPES + bucket[shaped], minlength=total * SHAPES).reshape(total, -1) / chars[:, None]
    words_in = (name >> np.uint64(65 - WORDS.bit_length())).astype(np.int64)
    out[:, SINGLE + SHAPES :] = np.bincount(owner * WORDS + words_in, minlength=total * WORDS).reshape(total, -1) / n[:, None]
    # Kinds of words.
    size = (end - start).astype(np.float32)
    big = np.add.reduceat(kind == UPPER, start)
    low = np.add.reduceat(kind == LOWER, start)
    signs = np.add.reduceat((kind == SYMBOL) | (kind == STOP), start)
    last, first = kind[end - 1], kind[start]
    again = np.append(False, (name[1:] == name[:-1]) & (owner[1:] == owner[:-1]))
    order = np.lexsort((name, owner))
    fresh = np.append(True, (name[order][1:] != name[order][:-1]) | (owner[order][1:] != owner[order][:-1]))
    share = lambda x: np.bincount(owner, x.astype(np.float32), minlength=total) / n
    length = share(size)
    out[:, len(KINDS) : SINGLE] = np.stack([
        np.log1p(length), np.log1p(share(size**2) - length**2 + 1e-3), share(last == STOP), share(last == SYMBOL), share(first == UPPER), share((big > 0) & (low == 0)),
        share((big == 0) & (low == 0)), share(size == 1), share(size > 20), share(signs > 1), share(again), np.bincount(owner[order], fresh, minlength=total) / n,
    ], axis=1)
    return out, passages


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Scaling, encoder, attention and classifier."""

    NAMES = ("encode", "shift", "gate_v", "gate_u", "attend", "classify", "bias")

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.weights = mean.astype(np.float32), scale.astype(np.float32), {k: w.astype(np.float32) for k, w in weights.items()}

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, mean=self.mean, scale=self.scale, **self.weights)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as x:
            return cls(x["mean"], x["scale"], {k: x[k] for k in cls.NAMES})

    def scaled(self, passages: np.ndarray) -> np.ndarray:
        return np.clip((passages - self.mean) / self.scale, -4, 4)

    def encoded(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of passages, and their attention before it is weighed within the document."""
        w = self.weights
        h = np.tanh(self.scaled(passages) @ w["encode"] + w["shift"])
        return h, (np.tanh(h @ w["gate_v"]) * sigmoid(h @ w["gate_u"])) @ w["attend"]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of class 1 for each text, from all its passages; texts without words get that of no encoding."""
        top = np.full(len(texts), -np.inf)
        weight, mean = np.zeros(len(texts)), np.zeros((len(texts), UNITS))
        waiting, owners, have = [], [], 0

        def look():
            rows, count = describe(waiting)
            if len(rows):
                h, e = self.encoded(rows)
                own = np.repeat(np.array(owners), count)
                at = np.flatnonzero(np.diff(own, prepend=-1))
                ids, high = own[at], np.maximum.reduceat(e, at).astype(np.float64)
                new = np.maximum(top[ids], high)
                old = np.exp(top[ids] - new)
                part = np.exp(e - np.repeat(new, np.diff(np.append(at, len(own)))))
                weight[ids] = weight[ids] * old + np.add.reduceat(part, at)
                mean[ids] = mean[ids] * old[:, None] + np.add.reduceat(part[:, None] * h, at)
                top[ids] = new
            waiting.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for part in parts_of(text):
                waiting.append(part)
                owners.append(i)
                have += len(part)
                if have >= CHUNK:
                    look()
                    have = 0
        if waiting:
            look()
        z = mean / np.maximum(weight, 1e-300)[:, None]
        return sigmoid(z @ self.weights["classify"].astype(np.float64) + float(self.weights["bias"][0]))


def slopes(model: Model, x: np.ndarray, first: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of some documents (scaled passages ``x``, each document's from ``first`` on) and its slopes."""
    w, n = model.weights, np.diff(np.append(first, len(x)))
    h = np.tanh(x @ w["encode"] + w["shift"])
    v, u = np.tanh(h @ w["gate_v"]), sigmoid(h @ w["gate_u"])
    e = (v * u) @ w["attend"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), n))
    a = e / np.repeat(np.add.reduceat(e, first), n)
    z = np.add.reduceat(a[:, None] * h, first)
    p = sigmoid(z @ w["classify"] + w["bias"][0])
    loss = -np.mean(np.log(np.where(labels == 1, p, 1 - p) + 1e-12))
    # Back through classifier, attention and encoder.
    error = (p - labels) / len(labels)
    to_z = error[:, None] * w["classify"]
    to_a = (np.repeat(to_z, n, axis=0) * h).sum(axis=1)
    to_e = a * (to_a - np.repeat(np.add.reduceat(a * to_a, first), n))
    to_v, to_u = to_e[:, None] * w["attend"] * u * (1 - v**2), to_e[:, None] * w["attend"] * v * u * (1 - u)
    to_h = a[:, None] * np.repeat(to_z, n, axis=0) + to_v @ w["gate_v"].T + to_u @ w["gate_u"].T
    to_in = to_h * (1 - h**2)
    found = {"encode": x.T @ to_in, "shift": to_in.sum(axis=0), "gate_v": h.T @ to_v, "gate_u": h.T @ to_u, "attend": (v * u).T @ to_e, "classify": z.T @ error, "bias": error.sum(keepdims=True)}
    return float(loss), found


def train(documents: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model from each document's passages and label; without both labels it says what they all are, or 0."""
    rng = np.random.default_rng(SEED)
    normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    weights = {"encode": normal(SIZE, UNITS) * 0.5, "shift": np.zeros(UNITS), "gate_v": normal(UNITS, GATES), "gate_u": normal(UNITS, GATES), "attend": normal(GATES), "classify": normal(UNITS), "bias": np.zeros(1)}
    used = [k for k, d in enumerate(documents) if len(d)]
    if not len(labels) or labels.min() == labels.max() or not used:
        side = round(float(labels.mean())) if len(labels) else 0
        return Model(np.zeros(SIZE), np.ones(SIZE), weights | {"classify": np.zeros(UNITS), "bias": np.array([4.0 if side else -4.0])})
    sizes = np.array([len(documents[k]) for k in used])
    rows, labels, firsts = np.concatenate([documents[k] for k in used]).astype(np.float32), labels[used].astype(np.float32), np.cumsum(sizes) - sizes
    documents.clear()
    spread = rows.std(axis=0)
    model = Model(rows.mean(axis=0), np.where(spread > 1e-6, spread, 1.0), weights)
    rows = model.scaled(rows)
    share = labels.mean()
    model.weights["bias"][:] = np.log(share / (1 - share))
    steps, first, second = 0, {k: np.zeros_like(w) for k, w in model.weights.items()}, {k: np.zeros_like(w) for k, w in model.weights.items()}
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(len(used)), max(1, len(used) // BATCH)):
            n = sizes[batch]
            begin = np.cumsum(n) - n
            index = np.repeat(firsts[batch] - begin, n) + np.arange(n.sum())
            _, found = slopes(model, rows[index], begin, labels[batch])
            steps += 1
            for k, slope in found.items():
                w = model.weights[k]
                slope = slope + (DECAY * w if w.ndim > 1 else 0)
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.01 * (slope**2 - second[k])
                w -= (rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_id, label, passages`` of the bounded sample: labelled rows that are not held out, chosen by the hash of their id.

    An id with several labels has the largest, and with several texts the least.  ``passages``: rows of numbers as bytes.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label")).where("_id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("label").alias("label"))
    known = known.join(docs.select(F.col(f"`{doc_id}`").alias("_id")).distinct(), "_id", "left_semi")
    pick = lambda y, n: known.where(F.col("label") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = F.broadcast(pick(0, LOW).unionByName(pick(1, HIGH)))  # LOW + HIGH rows at most

    @F.arrow_udf("binary")
    def passages(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            rows = np.concatenate([describe([part])[0] for part in parts_of(t)])
            at = np.unique(np.linspace(0, max(0, len(rows) - 1), TRAIN_PASSAGES).astype(np.int64))[: len(rows)]
            out.append(rows[at].astype("<f2").tobytes())
        return pa.array(out, pa.binary())

    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(chosen, "_id")
    return rows.groupBy("_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("_id", "label", passages("text").alias("passages"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Train in one task on the bounded sample; the model comes back to the driver (its size is fixed)."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_id")
        documents = [np.frombuffer(bytes(b), "<f2").reshape(-1, SIZE).astype(np.float32) for b in rows["passages"]]
        return pd.DataFrame({"model": [train(documents, rows["label"].to_numpy(np.int64)).dump()]})

    found = training_rows(docs, labels, text, doc_id).groupBy().applyInPandas(one, "model binary").collect()
    return Model.load(bytes(found[0]["model"])) if found else train([], np.empty(0, np.int64))


def quality(spark: SparkSession, text: Column, model: Model) -> Column:
    """The quality of each whole text, 0 to 1; a null text counts as empty."""
    sent = spark.sparkContext.broadcast(model.dump())
    made: list[Model] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Model.load(sent.value))
        return pa.array(made[0].scores(texts.to_pylist()), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Labels (``doc_id, quality`` of ``labels``) are learnt only from rows whose crc32(doc_id as text) mod 3 is not 1.
    A null or empty text has no passages and scores what the classifier gives to none.  A null ``doc_id`` stays null and is not
    held out; repeated rows give repeated rows of one score; no rows give no rows; without labels, or with one label only, all
    texts score alike.  Very long texts are scored by all their passages, a part at a time.  Ids may be of any type; other columns are not read.
    """
    model = fit(docs, labels, text, doc_id)
    out = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"), quality(docs.sparkSession, F.col(f"`{text}`"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
