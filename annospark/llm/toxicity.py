"""Toxicity from subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of its character n-grams and of the
word itself, hashed into ``BUCKETS`` rows; a passage's vector is the mean over its
words; a linear softmax over it gives the class.  An unseen misspelling shares most
n-grams with the words it was made from.  A text is as toxic as its worst passage
of ``PASSAGE`` words, so a few words count as much in a long text as in a short one.
Passages begin at every word.  A run of more than ``LONGEST`` characters without a space is
cut into words of that length, which overlap so that no n-gram is lost.

Training: a bounded sample of labelled rows, in one task, by Adagrad over the
embeddings and the softmax together; each step's gradient goes through the worst
passage of each text.  Scoring: a narrow pass over whole texts with the model
broadcast (its size is fixed) and a cache of words in each worker process.
"""

from __future__ import annotations

import io
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The model: embedding rows and width, and the n-gram lengths.
BUCKETS, WIDTH, GRAMS = 1 << 16, 8, (3, 4, 5)
#: Words in a passage, and the least number of words that a passage counts as.
PASSAGE, LEAST = 2, 2
#: Characters in a word.
LONGEST = 64
#: Labelled rows in the training sample, at most, of each class (those of least hash); characters of a longer text that are
#: learnt from, and evenly spaced stretches that they are taken in.
POSITIVE, NEGATIVE, TRAIN_CHARS, STRETCHES = 2000, 4000, 32_768, 8
#: Passes over the sample, texts in a step, Adagrad's rate, seed.
EPOCHS, BATCH, RATE, SEED = 30, 100, 0.3, 7
#: Texts that a row is imagined to have been seen in, in the classes' proportion; first sum of squares of its slopes.
PRIOR, DAMPING = 30, 1e-3
#: Rows of these remainders of crc32(doc_id as text) by 5 give labels; those of 0 are held out.
FOLDS = 5

NOT_WORD = re.compile(r"\W")
#: Characters of texts worked on together, about.
CHUNK = 1 << 17
_STEP = LONGEST - max(GRAMS) + 1
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_PLACES = np.random.default_rng(SEED).integers(0, 1 << 63, LONGEST + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_word: list[np.ndarray] = []


def word_characters() -> np.ndarray:
    """Of every code point, whether it is a letter, a digit or an underscore; made once a process."""
    if not _word:
        _word.append(np.array([chr(c).isalnum() or c == 95 for c in range(0x110000)]))
    return _word[0]


def chunks(text: str | None) -> list[str]:
    """The lower-cased text in parts of about ``CHUNK`` characters that have the same words together, one part at least."""
    text, at, out = (text or "").lower(), 0, []
    while len(text) - at > CHUNK:
        to = at + CHUNK
        end = NOT_WORD.search(text, to, to + CHUNK)
        if end:
            out.append(text[at : end.start()])
            at = end.start()
            continue
        begin = to  # inside a long run, which is cut where its next piece begins
        while begin > at and not NOT_WORD.match(text, begin - 1):
            begin -= 1
        to = begin - (begin - to) // _STEP * _STEP
        out.append(text[at : to + LONGEST - _STEP])
        at = to
    return [*out, text[at:]]


class Words:
    """The words of some texts, in order, as embedding rows.

    ``rows``, ``first`` and ``count``: the rows of all words, one word after the other; ``name``, a 64-bit hash of each
    word; ``sizes``, the words of each text.
    """

    def __init__(self, texts: list[str]):
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        inside = np.zeros(len(points) + 1, np.int8)
        inside[1:] = word_characters()[points]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Long runs are several words that overlap, so that no n-gram is lost.
        pieces = np.where(end - start > LONGEST, -(-(end - start - LONGEST + _STEP) // _STEP), 1)
        if (pieces > 1).any():
            number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            last = np.repeat(pieces, pieces) == number + 1
            start, end = np.repeat(start, pieces) + number * _STEP, np.repeat(end, pieces)
            end = np.where(last, end, start + LONGEST)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.sizes = np.diff(np.searchsorted(start, ends), prepend=0)
        # All words between marks, one after the other.
        size = end - start + 2
        stop = np.cumsum(size)
        self.begin = begin = stop - size
        total = int(size.sum())
        place = np.arange(total) - np.repeat(begin, size)
        self.left = left = np.repeat(size, size) - place
        marked = points[np.minimum(np.repeat(start - 1, size) + place, len(points) - 1)].astype(np.uint64)
        marked[begin], marked[stop - 1] = 60, 62
        ahead = np.concatenate([marked, np.zeros(max(GRAMS), np.uint64)])
        self.count = 1 + sum(np.maximum(size - n + 1, 0) for n in GRAMS)
        with np.errstate(over="ignore"):
            self.name = np.add.reduceat(marked * _PLACES[place], begin) if total else np.empty(0, np.uint64)
            self.name = (self.name ^ self.name >> np.uint64(31)) * _MIX[2]
            h = marked * _MIX[0]
            self.grams = []  # the row of the n-gram that begins at each place, where one does
            for k in range(1, max(GRAMS)):
                h = (h ^ h >> np.uint64(32)) * _MIX[1] + ahead[k : k + total] * _MIX[0]
                if k + 1 in GRAMS:
                    self.grams.append(((h ^ h >> np.uint64(29)) * _MIX[2] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
        self.whole = (self.name >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)

    def rows(self) -> np.ndarray:
        """The rows of all words, one word after the other: ``count`` of each."""
        taken = np.stack([self.left >= n for n in GRAMS], axis=1)
        owner = np.repeat(np.arange(len(self.begin)), np.diff(np.append(self.begin, len(self.left))))
        grams, owners = np.stack(self.grams, axis=1)[taken], np.repeat(owner, taken.sum(axis=1))
        order = np.argsort(np.concatenate([np.arange(len(self.whole)), owners]), kind="stable")
        return np.concatenate([self.whole, grams])[order]

    def means(self, part: np.ndarray) -> np.ndarray:
        """The mean of ``part`` over each word's rows."""
        if not len(self.begin):
            return np.empty(0)
        at = np.zeros(len(self.left))
        for n, rows in zip(GRAMS, self.grams, strict=True):
            at += np.where(self.left >= n, part[rows], 0)
        return (np.add.reduceat(at, self.begin) + part[self.whole]) / self.count


def passages(parts: np.ndarray) -> np.ndarray:
    """The mean over each passage's words; there is a passage from every word on that has enough after it, one at least."""
    n = len(parts)
    if n < PASSAGE:
        return parts.sum(keepdims=True) / max(n, LEAST)
    return sum(parts[k : n - PASSAGE + 1 + k] for k in range(PASSAGE)) / max(PASSAGE, LEAST)


def worst(parts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The largest passage of each text of ``sizes`` words; 0 for no words."""
    out, ends = np.zeros(len(sizes)), np.cumsum(sizes)
    long = np.flatnonzero(sizes >= PASSAGE)
    if len(long):
        every = np.full(len(parts), -np.inf)
        every[: len(parts) - PASSAGE + 1] = passages(parts)
        for k in range(1, PASSAGE):  # those that would end in the next text
            every[ends[long] - k] = -np.inf
        for i in np.flatnonzero((sizes > 0) & (sizes < PASSAGE)):
            every[ends[i] - sizes[i] : ends[i]] = -np.inf
        out[long] = np.maximum.reduceat(every, (ends - sizes)[long])
    for i in np.flatnonzero((sizes > 0) & (sizes < PASSAGE)):
        out[i] = passages(parts[ends[i] - sizes[i] : ends[i]])[0]
    return out


class Model:
    def __init__(self, table: np.ndarray, weight: np.ndarray, bias: np.ndarray):
        self.table, self.weight, self.bias = table, weight, bias
        # The log-odds are linear in the embeddings, so each row stands for one number when scoring.
        self.part = (table @ (weight[1] - weight[0])).astype(np.float64)
        self.offset = float(bias[1] - bias[0])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, table=self.table, weight=self.weight, bias=self.bias)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as x:
            return cls(x["table"], x["weight"], x["bias"])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of class 1 for the worst passage of each text."""
        found, waiting, owners = [np.empty(0)], [], []
        parts, sizes = [], np.zeros(len(texts), np.int64)

        def look():
            words = Words(waiting)
            parts.append(words.means(self.part))
            np.add.at(sizes, owners, words.sizes)
            waiting.clear()
            owners.clear()

        first = have = 0
        for i, text in enumerate(texts):
            for chunk in chunks(text):
                waiting.append(chunk)
                owners.append(i)
                have += len(chunk)
                if have >= CHUNK:
                    look()
                    have = 0
            if not waiting or i == len(texts) - 1:  # whole texts only
                if waiting:
                    look()
                found.append(worst(np.concatenate(parts or [np.empty(0)]), sizes[first : i + 1]))
                parts.clear()
                first = i + 1
        return 1 / (1 + np.exp(-np.clip(self.offset + np.concatenate(found), -60, 60)))


def distinct_words(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The words of each text by number, and of each number's word the rows, one after the other, and their count."""
    rows, counts, known = [], [], np.empty(0, np.uint64)
    names: list[list[np.ndarray]] = [[] for _ in texts]
    waiting = [(i, chunk) for i, text in enumerate(texts) for chunk in chunks(text)]
    while waiting:
        n = max(1, int(np.searchsorted(np.cumsum([len(c) for _, c in waiting[:4096]]), CHUNK)))
        now, waiting = waiting[:n], waiting[n:]
        words = Words([c for _, c in now])
        for (i, _), own in zip(now, np.split(words.name, np.cumsum(words.sizes)[:-1]), strict=True):
            names[i].append(own)
        _, at = np.unique(words.name, return_index=True)
        at = at[~np.isin(words.name[at], known)]
        if len(at):
            first = np.cumsum(words.count) - words.count
            rows.append(words.rows()[_ranges(first, words.count, at)])
            counts.append(words.count[at])
            known = np.concatenate([known, words.name[at]])
    order = np.argsort(known)
    bags = [order[np.searchsorted(known, np.concatenate(n), sorter=order)].astype(np.int32) for n in names]
    return bags, np.concatenate(rows or [np.empty(0, np.int32)]), np.concatenate(counts or [np.empty(0, np.int64)])


def _ranges(first: np.ndarray, count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in the flat array of all rows of ``words``, one word after the other."""
    n = count[words]
    return np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def train(texts: list[str], labels: np.ndarray) -> Model:
    """A model from texts and their labels 0 and 1; without both labels it says what they all are, or 0."""
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    weight = rng.normal(0, 0.5, (2, WIDTH)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if not len(labels) or labels.min() == labels.max():
        bias[int(labels[0]) if len(labels) else 0] = 3
        return Model(np.zeros_like(table), weight, bias)
    bags, flat, count = distinct_words(texts)
    texts.clear()  # the words are all that is needed
    first = np.cumsum(count) - count
    used = np.flatnonzero([len(b) > 0 for b in bags])

    # Embeddings start along the softmax's direction, by how much likelier the row is in texts of class 1.
    have = np.zeros((2, BUCKETS))
    for i in used:
        have[labels[i], np.unique(flat[_ranges(first, count, np.unique(bags[i]))])] += 1
    share = np.bincount(labels, minlength=2) / len(labels)
    lean = np.log((have[1] + PRIOR * share[1]) / (have[0] + PRIOR * share[0]) * share[0] / share[1])
    across = weight[1] - weight[0]
    table += np.outer(lean, across / (across @ across)).astype(np.float32)

    table_sum, weight_sum, bias_sum = np.full(BUCKETS, DAMPING, np.float32), np.full((2, WIDTH), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        # The worst passage of each text, by the log-odds of the model as it stands.
        odds = np.add.reduceat((table @ (weight[1] - weight[0]))[flat], first) / count
        at = {i: int(passages(odds[bags[i]]).argmax()) for i in used.tolist()}
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
            # Forward through those passages: rows to words, words to passages, passages to classes.
            chosen = [bags[i][at[i] :][:PASSAGE] for i in batch.tolist()]
            n = np.array([len(c) for c in chosen])
            words, size = np.concatenate(chosen), np.maximum(n, LEAST)
            grams = count[words]
            begin = np.cumsum(grams) - grams
            index = flat[_ranges(first, count, words)]
            vectors = np.add.reduceat(table[index], begin) / grams[:, None]
            mean = np.add.reduceat(vectors, np.cumsum(n) - n) / size[:, None]
            logits = mean @ weight.T + bias
            error = np.exp(logits - logits.max(axis=1, keepdims=True))
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            # Backward into the softmax and the embeddings at once.
            to_word = np.repeat(error @ weight / size[:, None], n, axis=0) / grams[:, None]
            to_row = np.repeat(to_word, grams, axis=0)
            touched, back = np.unique(index, return_inverse=True)
            to_table = np.stack([np.bincount(back, to_row[:, k]) for k in range(WIDTH)], axis=1).astype(np.float32)
            to_weight, to_bias = error.T @ mean, error.sum(axis=0)
            table_sum[touched] += (to_table**2).sum(axis=1)
            table[touched] -= rate * to_table / np.sqrt(table_sum[touched])[:, None]
            for value, total, slope in ((weight, weight_sum, to_weight), (bias, bias_sum, to_bias)):
                total += slope**2
                value -= (rate * slope / np.sqrt(total)).astype(np.float32)
    return Model(table, weight, bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def stretches(text: Column) -> Column:
    """A text of up to ``TRAIN_CHARS`` characters whole, else evenly spaced parts of it from its beginning to its end."""
    part, n = TRAIN_CHARS // STRETCHES, F.char_length(text)
    at = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda i: F.substring(text, F.floor(i * (n - part) / (STRETCHES - 1)).cast("int") + 1, F.lit(part)))
    return F.when(n > TRAIN_CHARS, F.array_join(at, " ")).otherwise(text)


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_id, text, label`` of the bounded sample: labelled rows that are not held out, chosen by the hash of their id.

    Texts of any length are taken, very long ones in ``stretches``.  An id with several labels has the largest, and with several texts the least.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label")).where("_id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("label").alias("label"))
    pick = lambda y, n: known.where(F.col("label") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = F.broadcast(pick(1, POSITIVE).unionByName(pick(0, NEGATIVE)))  # POSITIVE + NEGATIVE rows at most
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.join(chosen, "_id").groupBy("_id").agg(F.min(stretches(F.col("text"))).alias("text"), F.first("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Train in one task on the bounded sample; the model comes back to the driver (its size is fixed)."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "text"])
        return pd.DataFrame({"model": [train(rows["text"].tolist(), rows["label"].to_numpy(np.int64)).dump()]})

    found = training_rows(docs, labels, text, doc_id).groupBy().applyInPandas(one, "model binary").collect()
    return Model.load(bytes(found[0]["model"])) if found else train([], np.empty(0, np.int64))


def toxicity(spark: SparkSession, text: Column, model: Model) -> Column:
    """The toxicity of each whole text, 0 to 1; a null text counts as empty."""
    sent = spark.sparkContext.broadcast(model.dump())
    made: list[Model] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Model.load(sent.value))
        return pa.array(made[0].scores(texts.to_pylist()), pa.float64())

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Labels (``doc_id, toxic`` of ``labels``) are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0.
    A null or empty text scores what the softmax gives to no words at all.  A null ``doc_id`` stays null and is not
    held out; repeated rows give repeated rows of one score; no rows give no rows; without labels, or with one
    label only, all texts score alike.  Very long texts are scored by all their passages, ``CHUNK`` characters at a time.  Ids may be of any type;
    other columns are not read.
    """
    model = fit(docs, labels, text, doc_id)
    out = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"), toxicity(docs.sparkSession, F.col(f"`{text}`"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
