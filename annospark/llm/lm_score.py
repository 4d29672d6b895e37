"""Masked pseudo-likelihood from a bidirectional window network.

Every token of a text is predicted from the ``SIDE`` tokens on each side of it,
never from itself, and the conditional log-probabilities are summed.  Tokens are those
of a byte-level BPE, so each text is named whole and nothing is out of vocabulary.  The
network adds an embedding for each place of the window, applies tanh, and has a softmax in two steps: the token's class, then the token in its class.  Tokens
are numbered by their counts in the corpus; classes are runs of these numbers, long for rare
tokens, so that both steps are short on average.

Texts are encoded once, into a written table that is dealt into ``ROUNDS``.  Training is
local SGD in rounds: each task trains on every token of its own texts of a round, from
the same start, and the parameters are averaged before the next round.  They are averaged
piece by piece: a group has one run of rows of the tables, so no task gets whole models of
all others; a row weighs as much as its token was seen in a task.  The model that reaches the
driver has a fixed size.  Which texts train together depends on how Spark deals them, so
scores may differ slightly between runs with other partitions; for given ones they are the same.
"""

from __future__ import annotations

import io
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.lineage import cut

from .pieces import OWN_SLOTS, SENT_SLOTS, Pieces, Table, character_classes, frequent_pieces
from .tokens import FREQUENT, sample_texts

#: Classes of the softmax; tokens seen on each side; width of the hidden layer, its constant included.
CLASSES, SIDE, WIDTH = 32, 2, 12
PLACES = [p for p in range(-SIDE, SIDE + 1) if p]
#: Rounds of training; tokens in a step; Adagrad's rate; seed; first sum of squares.
ROUNDS, STEP, RATE, SEED, DAMPING = 3, 8192, 0.1, 11, 1e-4
#: Tokens that a task trains on at least; tasks for each core at most.
TASK_TOKENS, TASKS_A_CORE = 1 << 24, 4
#: The least exponent that has a logarithm.
TINY = np.float32(1e-45)
#: Rows of a table that are averaged together, and models; weight of a row whose token a task has not seen.
RUN, FAN_IN, UNSEEN = 4096, 32, 1e-3
#: Tokens that a worker's encoder keeps; when there are more it starts anew.
KEPT = 1 << 22


class Encoder(Pieces):
    """The tokens of texts; one a worker process.  A pre-token's number is where its tokens are kept, and how many."""

    _made: Encoder | None = None

    def __init__(self, path: str, classes: np.ndarray, frequent: Table | None = None, tokens: np.ndarray | None = None):
        super().__init__(path, classes, frequent)
        self.sent = np.empty(0, np.int32) if tokens is None else tokens
        self.kept, self.used = np.concatenate([self.sent, np.empty(1 << 16, np.int32)]), len(self.sent)

    @classmethod
    def of(cls, path: str, parts: tuple) -> Encoder:
        """The worker's encoder, made anew when other ``encoder_parts`` come."""
        if cls._made is None or cls._made.classes is not parts[0]:
            cls._made = cls(path, *parts)
        return cls._made

    def work_out(self, pieces: list[bytes]) -> np.ndarray:
        found = self.encoded(pieces)
        n = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.fromiter((t.id for f in found for t in f), np.int32, int(n.sum()))
        if self.used + len(tokens) > len(self.kept):
            self.kept = np.concatenate([self.kept[: self.used], np.empty(self.used + len(tokens), np.int32)])
        self.kept[self.used : self.used + len(tokens)] = tokens
        at = self.used + np.cumsum(n) - n
        self.used += len(tokens)
        return at << 32 | n  # a pre-token has fewer tokens than a text can have bytes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of each text, as the library's ``encode`` without added special tokens has them."""
        if self.special and any(map(self.special.search, texts)):
            return [self._with_added(t) if self.special.search(t) else self.encode([t])[0] for t in texts]
        out = []
        for values, pieces in self.blocks(texts):
            at, n = values >> 32, values & 0xFFFFFFFF
            ends = np.cumsum(n)
            tokens = self.kept[np.repeat(at - (ends - n), n) + np.arange(n.sum())]
            last = np.concatenate([[0], ends])[np.cumsum(pieces)]
            out += np.split(tokens, last[:-1])
            if self.used - len(self.sent) > KEPT:
                self.own, self.longer, self.used = Table(OWN_SLOTS), {}, len(self.sent)
        return out

    def _with_added(self, text: str) -> np.ndarray:
        parts, added = self.special.split(text), self.special.findall(text)
        tokens = self.encode(parts)
        for i, token in enumerate(added):
            tokens[i] = np.append(tokens[i], np.int32(self.tokenizer.token_to_id(token)))
        return np.concatenate(tokens)


def encoder_parts(docs: DataFrame, path: str, text: str = "text") -> tuple[np.ndarray, Table, np.ndarray]:
    """The classes of characters, and the table of some rows' most frequent pre-tokens with their tokens."""
    encoder = Encoder(path, character_classes(path))
    *key, pieces = frequent_pieces(encoder, sample_texts(docs, text), FREQUENT)
    table = Table(SENT_SLOTS)
    table.put(*key, encoder.work_out(pieces))
    return encoder.classes, table, encoder.kept[: encoder.used].copy()


def stored_as(vocabulary: int) -> str:
    """How tokens are stored: unsigned little-endian numbers of 16 bits if they fit, else of 32."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def vocabulary_of(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encoded(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, tokens, round``: the tokens (binary, as ``stored_as`` has it) of each row of ``docs``, a null text's as of an empty one."""
    kind = stored_as(vocabulary_of(path))
    sent = docs.sparkSession.sparkContext.broadcast(encoder_parts(docs, path, text))

    @F.arrow_udf("binary")
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array([t.astype(kind).tobytes() for t in Encoder.of(path, sent.value).encode(texts.to_pylist())], pa.binary())

    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), tokens(column).alias("tokens"), F.pmod(F.xxhash64(column), F.lit(rounds)).cast("int").alias("round"))


def token_counts(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each token of the vocabulary occurs in ``tokens``."""

    kind = stored_as(vocabulary)

    def partial(batches):
        found = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for t in batch.column(0):
                found += np.bincount(np.frombuffer(t.as_buffer(), kind), minlength=vocabulary)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], ["token", "count"])

    out = np.zeros(vocabulary, np.int64)
    found = rows.select("tokens").mapInArrow(partial, "token long, count long").groupBy("token").agg(F.sum("count").alias("count")).toArrow()
    out[found["token"].to_numpy()] = found["count"].to_numpy()  # a row for each token of the vocabulary at most
    return out


class Network:
    """Parameters by name, each a table of rows, with a sum of squares for each row in ``sums``.

    ``near0`` ... (a place of the window each; tokens and the edge), ``own`` (token), ``kind`` (class) and ``shift`` (one
    row), each ``WIDTH`` wide; the hidden layer's last place is constant, for biases.  Tokens are numbered by rank.
    """

    def __init__(self, rank: np.ndarray, first: np.ndarray, tables: dict[str, np.ndarray], sums: dict[str, np.ndarray]):
        self.rank, self.first, self.tables, self.sums = rank, first, tables, sums
        self.edge = len(rank)
        self.kind_of = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint8)
        self.touched = {k: np.zeros(len(v)) for k, v in tables.items()}

    @classmethod
    def start(cls, counts: np.ndarray, classes: int = CLASSES) -> Network:
        """A network that gives each token its share of the corpus, whatever stands around it."""
        order = np.lexsort((np.arange(len(counts)), -counts))
        rank = np.empty(len(counts), np.int32)
        rank[order] = np.arange(len(counts))
        have = counts[order] + 1.0
        # A class's part of the cost is its share times its length, so lengths go by the root of the share.
        # Tokens that don't occur are a class by themselves, so that no softmax over occurring ones holds them.
        root = np.sqrt(counts[order])
        number = np.minimum((np.cumsum(root) - root) * (classes - 1) / max(root.sum(), 1), classes - 2).astype(int)
        number[counts[order] == 0] = classes - 1
        first = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(counts))
        kinds = np.add.reduceat(have, first[:-1])
        rng, f = np.random.default_rng(SEED), np.float32
        biased = lambda values, bias: np.concatenate([values[:, 1:], bias[:, None]], axis=1).astype(f)
        tables = {f"near{k}": rng.normal(0, 0.1, (len(counts) + 1, WIDTH)).astype(f) for k in range(len(PLACES))}
        tables["own"] = biased(np.zeros((len(counts), WIDTH)), np.log(have / np.repeat(kinds, np.diff(first))))
        tables["kind"] = biased(rng.normal(0, 0.1, (len(kinds), WIDTH)), np.log(kinds / kinds.sum()))
        tables["shift"] = np.zeros((1, WIDTH), f)
        return cls(rank, first, tables, {k: np.full(len(v), DAMPING, f) for k, v in tables.items()})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, rank=self.rank, first=self.first, **self.tables, **{f"sums_{k}": v for k, v in self.sums.items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as x:
            tables = {k: x[k] for k in x.files if k not in ("rank", "first") and not k.startswith("sums_")}
            return cls(x["rank"], x["first"], tables, {k: x[f"sums_{k}"] for k in tables})

    def stream(self, texts: list[np.ndarray]) -> np.ndarray:
        """Ranks of the texts' tokens, with ``SIDE`` edges around each text."""
        edge = np.full(SIDE, self.edge, np.int32)
        parts = [edge]
        for t in texts:
            parts += [self.rank[t], edge]
        return np.concatenate(parts)

    def hidden(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The hidden layer at the places ``at`` of ``stream``, counted behind its first ``SIDE``."""
        total = np.repeat(self.tables["shift"], len(at), axis=0)
        for k, place in enumerate(PLACES):
            total += self.tables[f"near{k}"].take(stream.take(at + (SIDE + place)), axis=0)
        np.tanh(total, out=total)
        total[:, -1] = 1  # for the biases
        return total

    @staticmethod
    def _exponents(h: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the rows of a softmax: exponents and their sums; the largest logit is taken off first where they would overflow."""
        logits = h @ table.T
        out, ones = np.exp(logits), np.ones(len(table), np.float32)
        total = out @ ones
        if np.isfinite(total).all():
            return out, total
        np.exp(logits - logits.max(axis=1, keepdims=True), out=out)
        return out, out @ ones

    def _sorted(self, stream: np.ndarray):
        """Of the places that are no edges, by class: places, tokens, classes, and where each class that occurs begins and ends."""
        at = np.flatnonzero(stream[SIDE:-SIDE] != self.edge)
        want = stream[SIDE:-SIDE].take(at)
        order = np.argsort(self.kind_of.take(want), kind="stable")
        at, want = at.take(order), want.take(order)
        kind = self.kind_of.take(want)
        ends = np.searchsorted(kind, np.arange(len(self.first)))
        return at, want, kind, [(c, ends[c], ends[c + 1]) for c in np.flatnonzero(np.diff(ends)).tolist()]

    def log_probabilities(self, stream: np.ndarray) -> np.ndarray:
        """Of each token of ``stream`` but the first and last ``SIDE``, given those around it; 0 for edges."""
        at, want, kind, runs = self._sorted(stream)
        h, rows = self.hidden(stream, at), np.arange(len(at))
        out, each = np.zeros(len(stream) - 2 * SIDE), np.zeros(len(at))

        with np.errstate(over="ignore"):
            exps, total = self._exponents(h, self.tables["kind"])
            each += np.log(np.maximum(exps[rows, kind], TINY)) - np.log(total)
            for c, a, b in runs:
                if self.first[c + 1] - self.first[c] > 1:
                    exps, total = self._exponents(h[a:b], self.tables["own"][self.first[c] : self.first[c + 1]])
                    each[a:b] += np.log(np.maximum(exps[rows[: b - a], want[a:b] - self.first[c]], TINY)) - np.log(total)
        out[at] = each
        return out

    def _down(self, name: str, slope: np.ndarray, rows=slice(None), seen=1.0) -> None:
        """Adagrad with one sum of squares a row."""
        sums = self.sums[name][rows] + np.einsum("ij,ij->i", slope, slope) * np.float32(1 / WIDTH)
        self.sums[name][rows] = sums
        self.tables[name][rows] -= slope * (np.float32(RATE) / np.sqrt(sums))[:, None]
        self.touched[name][rows] += seen

    def step(self, stream: np.ndarray) -> None:
        """One step down the mean loss of the tokens of ``stream``, but the first and last ``SIDE``."""
        at, want, kind, runs = self._sorted(stream)
        n = len(at)
        if not n:
            return
        h, rows, part = self.hidden(stream, at), np.arange(n), np.float32(1 / n)

        def error_of(h, table, place):
            error, total = self._exponents(h, table)
            error *= (part / total)[:, None]
            error[rows[: len(place)], place] -= part
            return error

        with np.errstate(over="ignore"):
            error = error_of(h, self.tables["kind"], kind)
            kinds, back = error.T @ h, error @ self.tables["kind"]
            to_own = np.zeros((int(self.first[runs[-1][0] + 1]), WIDTH), np.float32)
            for c, a, b in runs:
                run = slice(self.first[c], self.first[c + 1])
                if run.stop - run.start > 1:
                    error = error_of(h[a:b], self.tables["own"][run], want[a:b] - run.start)
                    back[a:b] += error @ self.tables["own"][run]
                    np.matmul(error.T, h[a:b], out=to_own[run])
        self._down("own", to_own, slice(0, len(to_own)), np.bincount(want, minlength=len(to_own)))
        self._down("kind", kinds, seen=n)
        np.multiply(h, h, out=h)
        np.subtract(1, h, out=h)  # 0 for the constant
        back *= h
        self._down("shift", back.sum(axis=0)[None], seen=n)
        for k, place in enumerate(PLACES):
            tokens = stream.take(at + (SIDE + place))
            order = np.argsort(tokens.astype(np.uint16) if self.edge < 1 << 16 else tokens, kind="stable")
            tokens = tokens.take(order)
            begins = np.flatnonzero(np.diff(tokens, prepend=-1))
            self._down(f"near{k}", np.add.reduceat(back.take(order, axis=0), begins), tokens[begins], np.diff(np.append(begins, n)))


def segments(network: Network, batches, column: int = 0):
    """Streams of about ``STEP`` tokens over the texts of ``batches``; a long text is several, which overlap by what a window sees."""
    waiting, have, kind = [], 0, stored_as(network.edge)
    for batch in batches:
        for t in batch.column(column):
            tokens = np.frombuffer(t.as_buffer(), kind)
            waiting.append(tokens)
            have += len(tokens)
            if have >= STEP:
                yield from _cut(network.stream(waiting))
                waiting, have = [], 0
    if have:
        yield from _cut(network.stream(waiting))


def _cut(stream: np.ndarray, step: int | None = None):
    n, step = len(stream) - 2 * SIDE, step or STEP
    parts = max(1, round(n / step))
    ends = np.linspace(0, n, parts + 1).astype(int).tolist()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield stream[a : b + 2 * SIDE]


def train(rows: DataFrame, network: Network, tasks: int) -> Network:
    """``network`` after one round over ``tokens``: every task trains on its own texts, then rows are averaged."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(network.dump())

    def local(batches):
        model, seen = Network.load(sent.value), False
        for part in segments(model, batches):
            model.step(part)
            seen = True
        part = TaskContext.get().partitionId()
        for name, table in model.tables.items() if seen else ():
            table = np.concatenate([table, model.sums[name][:, None]], axis=1)
            for k, first in enumerate(range(0, len(table), RUN)):
                some, weight = table[first : first + RUN], UNSEEN + model.touched[name][first : first + RUN]
                yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "run": [k], "weight": [weight.astype("<f4").tobytes()], "rows": [some.astype("<f4").tobytes()]})

    def average(parts: pd.DataFrame) -> pd.DataFrame:
        total = weights = 0.0
        for weight, some in zip(parts["weight"], parts["rows"], strict=True):
            weight = np.frombuffer(weight, "<f4").astype(np.float64)
            total, weights = total + np.frombuffer(some, "<f4").reshape(len(weight), -1) * weight[:, None], weights + weight
        mean = (total / weights[:, None]).astype("<f4")
        out = {"part": int(parts["part"].min()) // FAN_IN, "name": parts["name"].iloc[0], "run": int(parts["run"].iloc[0])}
        return pd.DataFrame([out | {"weight": weights.astype("<f4").tobytes(), "rows": mean.tobytes()}])

    kind = "part long, name string, run long, weight binary, rows binary"
    models = rows.select("tokens").coalesce(tasks).mapInArrow(local, kind)
    while tasks > 1:
        models = models.groupBy("name", "run", F.expr(f"part div {FAN_IN}")).applyInPandas(average, kind)
        tasks = -(-tasks // FAN_IN)
    tables, sums = ({k: v.copy() for k, v in of.items()} for of in (network.tables, network.sums))
    for r in models.collect():  # one model's rows
        some, first = np.frombuffer(r["rows"], "<f4").reshape(-1, WIDTH + 1), r["run"] * RUN
        tables[r["name"]][first : first + len(some)], sums[r["name"]][first : first + len(some)] = some[:, :-1], some[:, -1]
    return Network(network.rank, network.first, tables, sums)


def fit(rows: DataFrame, vocabulary: int, rounds: int = ROUNDS) -> Network:
    """A network trained on every token of ``tokens`` once, round by round."""
    counts = token_counts(rows, vocabulary)
    network = Network.start(counts)
    wanted = max(1, int(counts.sum()) // rounds // TASK_TOKENS)
    tasks = min(max(wanted, 1), TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    for k in range(rounds):
        network = train(rows.where(F.col("round") == k), network, tasks)
    return network


def log_likelihood(rows: DataFrame, network: Network) -> DataFrame:
    """``doc_id, n_tokens, log_prob`` of the whole texts of ``doc_id, tokens``."""
    sent, made = rows.sparkSession.sparkContext.broadcast(network.dump()), []

    @F.arrow_udf("double")
    def score(tokens: pa.Array) -> pa.Array:
        if not made:
            made.append(Network.load(sent.value))
        model, out, queue, kind = made[0], [], deque(), stored_as(made[0].edge)

        def flush():
            texts = list(queue)
            queue.clear()
            each = np.concatenate([model.log_probabilities(part) for part in _cut(model.stream(texts))])
            ends = np.concatenate([[0.0], np.cumsum(each)])
            sizes = np.array([len(t) for t in texts])
            begins = np.cumsum(sizes + SIDE) - sizes - SIDE
            out.extend((ends[begins + sizes] - ends[begins]).tolist())

        have = 0
        for t in tokens:
            queue.append(np.frombuffer(t.as_buffer(), kind))
            have += len(queue[-1])
            if have >= STEP:
                flush()
                have = 0
        if queue:
            flush()
        return pa.array(out, pa.float64())

    return rows.select("doc_id", F.expr(f"cast(octet_length(tokens) div {np.dtype(stored_as(network.edge)).itemsize} as long)").alias("n_tokens"), score("tokens").alias("log_prob"))


def score_documents(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` for each row of ``docs``, by a network trained on all its texts.

    ``path``: a byte-level BPE of the tokenizers library.  ``log_prob`` sums the log-probability of every token of the whole text given both sides.
    A null or empty text has 0 tokens, ``log_prob`` 0 and a null mean.  A null ``doc_id`` stays null, repeated rows give
    repeated rows of one score but for the rounding of 32-bit sums, no rows give no rows; other columns are not read.  A text of
    any length is trained on and scored in parts of about ``STEP`` tokens that overlap by a window.
    """
    rows = cut(encoded(docs, path, text, doc_id), "tokens", "round")
    network = fit(rows, vocabulary_of(path))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return log_likelihood(rows, network).withColumn("mean_log_prob", mean)
