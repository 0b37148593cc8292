"""Scoring texts with a log-bilinear neural model that is trained by noise-contrastive estimation.

The model predicts classes of tokens: the most frequent words and the end mark are classes of their own, all
other words share classes by a rule on their first and last bytes.  The representation of the next token is the sum of
the vectors of the tokens before it, each turned by a matrix of its place; a class's score is the product with
its own vector plus a bias.  Inside a shared class a word has its add-one share, with one place for words never
seen.  So every token has a normalised probability, whatever the vocabulary's size, and counts cover all of it.

Training is numpy inside Spark tasks: each round, every task starts from the shared parameters, runs over its own
documents with noise classes shared by a batch, and the parameters are averaged by tokens in a grouped
sum.  Each training document is used in one round.  Only the parameters and the ``head`` most frequent
words reach the driver; the counts stay a table, and words outside the head are joined with it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import remainder
from millrace.session import staged

#: The end mark in count tables: no word is empty.
END = b""
#: Longest word of the head, which bounds its size in bytes.
HEAD_BYTES = 64


@dataclass(frozen=True)
class Shape:
    """Sizes of the model; ``head`` x ``HEAD_BYTES`` bounds what is sent to every task."""

    own: int = 60
    shared: int = 195
    dim: int = 16
    context: int = 4
    head: int = 200_000
    noise: int = 64
    rate: float = 0.3
    #: Part of the training documents that each round uses, and the tokens of one step in it.
    rounds: tuple[float, ...] = (0.1, 0.2, 0.3, 0.4)
    batches: tuple[int, ...] = (256, 256, 256, 256)

    @property
    def classes(self) -> int:
        return self.own + 1 + self.shared


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shared_class(word: bytes, shared: int) -> int:
    return zlib.crc32(word[:2] + word[-1:]) % shared


def is_training(column: str = "doc_id") -> Column:
    return remainder(column, 7) != 2


def token_counts(docs: DataFrame, most_held: int = 400_000) -> DataFrame:
    """``word, c``: tokens of all texts, the end mark once for each text.  Counted in tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in batch.column("text"):
                held.update(tokens(text.as_py()))
                held[END] += 1
                if len(held) > most_held:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Ids(dict):
    """Number of each head word; other words get their shared class behind the head, remembered up to a bound."""

    def __init__(self, head: list[bytes], shared: int, most: int = 200_000) -> None:
        super().__init__({w: i for i, w in enumerate(head)})
        self.size, self.shared, self.room = len(head), shared, most

    def __missing__(self, word: bytes) -> int:
        found = self.size + shared_class(word, self.shared)
        if self.room:
            self.room -= 1
            self[word] = found
        return found


@dataclass
class Vocabulary:
    """The head (end mark first), its counts, and the totals of the shared classes."""

    head: list[bytes]
    counts: np.ndarray
    own: int
    shared: int
    total: int
    distinct: int
    shared_total: np.ndarray  # tokens + words + 1 of each shared class

    def classes(self) -> np.ndarray:
        """Class of each number: own ones, then shared ones of the rest of the head, then those of other words."""
        rest = [self.own + 1 + shared_class(w, self.shared) for w in self.head[self.own + 1 :]]
        first = list(range(min(self.own + 1, len(self.head))))
        return np.array(first + rest + [self.own + 1 + k for k in range(self.shared)], np.int64)

    def class_shares(self) -> np.ndarray:
        """Add-one shares of the classes."""
        share = np.zeros(self.own + 1 + self.shared)
        share[: min(self.own + 1, len(self.head))] = self.counts[: self.own + 1] + 1
        share[self.own + 1 :] = self.shared_total
        return np.maximum(share, 1) / np.maximum(share, 1).sum()


def bucket_of(shared: int) -> Column:
    edge = F.concat(F.substring("word", 1, 2), F.substring("word", -1, 1))
    return F.pmod(F.crc32(edge), F.lit(shared)).cast("int")


def vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """Reads the head, at most ``shape.head`` words, and sums; ``counts`` is only aggregated."""
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.octet_length("word") == 0, F.col("c"))).alias("e")).first()
    worded = counts.where(F.octet_length("word") > 0)
    top = worded.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.col("c").desc(), "word").limit(shape.head).collect()
    head = [END, *(bytes(r["word"]) for r in top)]
    own = [r["word"] for r in top[: shape.own]]
    rest = worded.where(~F.col("word").isin([bytes(w) for w in own])) if own else worded
    per_class = np.ones(shape.shared)
    for r in rest.groupBy(bucket_of(shape.shared).alias("b")).agg((F.sum("c") + F.count(F.lit(1))).alias("s")).collect():
        per_class[r["b"]] += r["s"]
    return Vocabulary(head, np.array([sums["e"] or 0, *(r["c"] for r in top)], float), len(own), shape.shared, sums["n"] or 0, sums["v"], per_class)


def start(vocabulary: Vocabulary, shape: Shape, seed: int = 11) -> dict[str, np.ndarray]:
    rng, k = np.random.default_rng(seed), vocabulary.own + 1 + vocabulary.shared
    return {
        "seen": rng.normal(0, 0.1, (k, shape.dim)).astype(np.float32),
        "turn": np.stack([np.eye(shape.dim)] * shape.context).astype(np.float32) / shape.context,
        "next": rng.normal(0, 0.1, (k, shape.dim)).astype(np.float32),
        "bias": np.log(vocabulary.class_shares()).astype(np.float32),
    }


def contexts(rows: list[np.ndarray], end: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes before each token (nearest first), its class, and where each text begins; texts do not see each other."""
    pad = np.full(width, end)
    flat = np.concatenate([x for row in rows for x in (pad, row)])
    sizes = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(1, len(rows) + 1) * width, sizes) + np.arange(sizes.sum())
    return np.stack([flat[at - k - 1] for k in range(width)], 1), flat[at], np.cumsum(sizes) - sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


#: Order of the parameters where they are one row of numbers.
PARTS = ("seen", "turn", "next", "bias")


class Trainer:
    """Noise-contrastive estimation with Adagrad; the noise classes are drawn once for each batch.

    Parameters, scales and gradients are one row of numbers each, with a view for each part; sums by class are counts
    with weights.  Steps are small, so their cost is that of the calls.
    """

    def __init__(self, parameters: dict[str, np.ndarray], shares: np.ndarray, shape: Shape, seed: int) -> None:
        self.values = flat(parameters).astype(np.float32)
        self.p = shaped(self.values, parameters)
        self.scale = np.full(self.values.shape, 0.1, np.float32)
        self.gradient = np.empty_like(self.values)
        self.g = shaped(self.gradient, parameters)
        self.shape, self.rng = shape, np.random.default_rng(seed)
        self.cumulated, self.log_noise = np.cumsum(shares), np.log(shape.noise * shares).astype(np.float32)
        #: Where the numbers of a class stand in a table of class vectors.
        self.cells = np.arange(parameters["seen"].size).reshape(parameters["seen"].shape)
        self.tokens = 0

    def learn(self, before: np.ndarray, target: np.ndarray, size: int) -> None:
        """Steps of ``size`` tokens each."""
        drawn = self.rng.random((-(-len(target) // size), self.shape.noise))
        noise = np.minimum(np.searchsorted(self.cumulated, drawn), len(self.cumulated) - 1)
        for i, at in enumerate(range(0, len(target), size)):
            self.step(before[at : at + size], target[at : at + size], noise[i])

    def step(self, before: np.ndarray, target: np.ndarray, noise: np.ndarray) -> None:
        p, g, cells, n, m = self.p, self.g, self.cells, len(target), len(noise)
        turn = p["turn"].reshape(-1, self.shape.dim)
        seen = p["seen"].take(before, 0).reshape(n, -1)
        said = seen @ turn
        right, wrong = p["next"].take(target, 0), p["next"].take(noise, 0)
        above = p["bias"] - self.log_noise
        g_true = sigmoid(np.einsum("ij,ij->i", said, right) + above[target])
        g_true -= 1
        g_true /= n
        g_false = said @ wrong.T
        g_false += above[noise]
        sigmoid(g_false)
        g_false /= n
        g_said = g_false @ wrong
        right *= g_true[:, None]
        g_said += right
        both = np.concatenate((target, noise))
        pulls = np.empty((n + m, self.shape.dim), np.float32)
        np.multiply(said, g_true[:, None], out=pulls[:n])
        np.matmul(g_false.T, said, out=pulls[n:])
        g["next"][:] = np.bincount(cells.take(both, 0).ravel(), pulls.ravel(), cells.size).reshape(cells.shape)
        g["bias"][:] = np.bincount(both, np.concatenate((g_true, g_false.sum(0))), len(cells))
        g["turn"].reshape(turn.shape)[:] = seen.T @ g_said
        g["seen"][:] = np.bincount(cells.take(before, 0).ravel(), (g_said @ turn.T).ravel(), cells.size).reshape(cells.shape)
        step = self.gradient * self.gradient
        self.scale += step
        np.sqrt(self.scale, out=step)
        np.divide(self.gradient, step, out=step)
        step *= self.shape.rate
        self.values -= step
        self.tokens += n


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in PARTS])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Views of a row of numbers as the parts of ``like``."""
    out, at = {}, 0
    for k in PARTS:
        out[k] = values[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def train(docs: DataFrame, known: Vocabulary, shape: Shape) -> dict[str, np.ndarray]:
    """Parameters after all rounds over ``docs``; each document takes part in one round, by a hash of its text and id."""
    parameters, low = start(known, shape), 0.0
    place = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    held = docs.sparkSession.sparkContext.broadcast((known.head, known.classes(), known.class_shares()))
    for part, size in zip(shape.rounds, shape.batches, strict=True):
        rows = docs.where((place >= low) & (place < low + part)).select("text")
        low += part
        begin = parameters

        def run(batches: Iterator[pa.RecordBatch], begin: dict[str, np.ndarray] = begin, seed: float = low, size: int = size) -> Iterator[pa.RecordBatch]:
            head, classes, shares = held.value
            ids, trainer, rest = Ids(head, known.shared), Trainer(begin, shares, shape, int(seed * 1000)), []
            waiting = 0

            def learn() -> None:
                before, target, _ = contexts(rest, 0, shape.context)
                trainer.learn(before, target, size)
                rest.clear()

            for batch in batches:
                for text in batch.column("text"):
                    found = tokens(text.as_py())
                    rest.append(classes[np.fromiter((*map(ids.__getitem__, found), 0), np.int64, len(found) + 1)])
                    waiting += len(found) + 1
                    if waiting > 1 << 16:
                        learn()
                        waiting = 0
            if rest:
                learn()
            if trainer.tokens:
                values = flat(trainer.p).astype(np.float64)
                arrays = [pa.array(np.arange(len(values))), pa.array(values * trainer.tokens), pa.array(np.full(len(values), trainer.tokens))]
                yield pa.RecordBatch.from_arrays(arrays, names=["at", "total", "tokens"])

        sums = rows.mapInArrow(run, "at long, total double, tokens long").groupBy("at").agg((F.sum("total") / F.sum("tokens")).alias("mean")).collect()
        if sums:
            values = np.zeros(len(sums))
            values[[r["at"] for r in sums]] = [r["mean"] for r in sums]
            parameters = shaped(values.astype(np.float32), parameters)
    return parameters


def class_log10(parameters: dict[str, np.ndarray], before: np.ndarray, target: np.ndarray, most: int = 1 << 18, stack: int = 16) -> np.ndarray:
    """Normalised log10 probabilities of the target classes, by stacks of matrix products.

    Each product has ``most`` multiplications, so few that the matrix library does it in one thread: threads that wait for
    each other would only burn time, as tasks fill the cores.  The bias is one more dimension.
    """
    turned = [parameters["seen"] @ t for t in parameters["turn"]]
    following = np.concatenate((parameters["next"].T, parameters["bias"][None]))
    out, rows = np.empty(len(target)), max(1, most // following.size)
    said = np.ones((stack, rows, len(following)), np.float32)
    score = np.empty((stack, rows, following.shape[1]), np.float32)
    flat_said, flat_score = said.reshape(stack * rows, -1), score.reshape(stack * rows, -1)
    for at in range(0, len(target), stack * rows):
        near, of = before[at : at + stack * rows], target[at : at + stack * rows]
        flat_said[: len(of), :-1] = sum(t.take(near[:, k], 0) for k, t in enumerate(turned))
        np.matmul(said, following, out=score)
        some = flat_score[: len(of)]
        some -= some.max(1)[:, None]
        hit = some[np.arange(len(of)), of]
        out[at : at + stack * rows] = hit - np.log(np.exp(some, out=some).sum(1))
    return out / np.log(10)


def score(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Learns from rows whose id (as text, crc32 modulo 7) does not leave 2; null ids count as empty text.  Null and empty texts are one
    end mark.  Equal rows are scored once and given back as often as they occur.  Without training rows the counts are zero
    and the model is even over its classes.
    """
    training = docs.where(is_training()).select("doc_id", "text")
    counts = staged(token_counts(training), "token-counts")
    known = vocabulary(counts, shape)
    parameters = train(training, known, shape)
    held = docs.sparkSession.sparkContext.broadcast((known.head, known.classes(), known.counts, parameters))
    base_total, own = float(known.total + known.distinct + 1), known.own
    inside, size = known.shared_total, len(known.head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, classes, counted, learned = held.value
        ids = Ids(head, known.shared)
        base_of = np.log10((counted + 1) / base_total)
        inner = np.zeros(size + known.shared)
        inner[own + 1 : size] = np.log10((counted[own + 1 :] + 1) / inside[classes[own + 1 : size] - own - 1])
        base_of = np.concatenate((base_of, np.zeros(known.shared)))
        sure = np.concatenate((counted > 0, np.zeros(known.shared, bool)))
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                found = [tokens(t.as_py()) for t in batch.column("text")]
                numbers = [np.fromiter((*map(ids.__getitem__, w), 0), np.int64, len(w) + 1) for w in found]
                every = np.concatenate(numbers)
                sizes = np.array([len(n) for n in numbers])
                first = np.cumsum(sizes) - sizes
                before, target, _ = contexts([classes[n] for n in numbers], 0, shape.context)
                model = class_log10(learned, before, target) + inner[every]
                rest = [Counter(w[i] for i in np.flatnonzero(n[:-1] >= size)) for w, n in zip(found, numbers, strict=True)]
                extra = [len(c) for c in rest]
                n_rows, n_extra = len(found), sum(extra)
                copies = np.repeat(np.arange(n_rows), extra)
                take = pa.array(np.concatenate((np.arange(n_rows), copies)))
                zeros, dashes = np.zeros(n_extra), np.zeros(n_extra, np.int64)
                columns = [
                    batch.column("doc_id").take(take),
                    batch.column("k1").take(take),
                    batch.column("held_out").take(take),
                    pa.array([None] * n_rows + [w for c in rest for w in c], pa.binary()),
                    pa.array([1] * n_rows + [v for c in rest for v in c.values()], pa.int64()),
                    pa.array(np.concatenate((sizes, dashes))),
                    pa.array(np.concatenate((np.add.reduceat(sure[every].astype(np.int64), first), dashes))),
                    pa.array(np.concatenate((np.add.reduceat(base_of[every], first), zeros))),
                    pa.array(np.concatenate((np.add.reduceat(model, first), zeros))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), (~is_training()).alias("held_out"), "text")
    schema = T.StructType([*keyed.schema.fields[:-1]])
    for name, kind in (("word", "binary"), ("n", "long"), ("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("model", "double")):
        schema = schema.add(name, kind)
    names = schema.names
    parts = keyed.mapInArrow(run, schema).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0)) + 1
    tail = F.col("word").isNotNull()
    room = F.element_at(F.array(*[F.lit(float(x)) for x in inside]), bucket_of(known.shared) + 1)
    sums = parts.groupBy("doc_id", "k1", "held_out").agg(
        F.count(F.when(~tail, 1)).alias("rows"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(tail & F.col("c").isNotNull(), F.col("n")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(tail, F.col("n") * F.log10(c / F.lit(base_total))).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(tail, F.col("n") * F.log10(c / room)).otherwise(F.col("model"))).alias("score"),
    )
    each = sums.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
    )
