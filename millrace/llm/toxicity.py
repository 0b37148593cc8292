"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of three fixed word lists and of a learned one, insults near the second
person, shares of capitals and punctuation, and rates of obfuscation (signs or digits inside words, listed
words that appear only after signs are read as letters, stretched letters).  The learned list holds words and
word beginnings that are far more frequent in toxic documents, so other languages need no list of their own;
it comes from one half of the sample, trees and calibration from the other, so neither sees its own rows.
Scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.boosting import Boosted, Isotonic, fit_boosted, fit_isotonic, unseen_raw
from millrace.llm.common import remainder, unit_hash
from millrace.session import staged

# Word lists: fixed values, plain English.
INSULTS = frozenset(
    b"idiot idiots moron morons loser losers scum clown clowns fool fools jerk jerks creep freak imbecile halfwit coward liar pig vermin parasite "
    b"scumbag dumbass asshole bastard bitch".split()
)
SLIGHTS = frozenset(
    b"pathetic worthless disgusting stupid trash garbage dumb ugly useless filthy brainless clueless despicable repulsive vile lousy ridiculous hopeless "
    b"revolting spineless".split()
)
ATTACKS = frozenset(b"hate hates kill destroy hurt punch shut damn hell crap fuck fucking shit suck sucks".split())
SECOND_PERSON = frozenset(b"you your yours yourself u ur youre".split())
LISTED = INSULTS | SLIGHTS | ATTACKS
NEAR = 4

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c == 39 else 32 for c in range(256))
_READ_AS = {ord(a): ord(b) for a, b in zip("@4301!$5+7", "aaeoiisstt", strict=True)}
_PLAIN = bytes(_READ_AS.get(c, _LETTERS[c]) for c in range(256))
_DROPPED = b".*-_'"
_INSIDE = re.compile(rb"[A-Za-z][@$!*0-9.#%&_-]+[A-Za-z]")
_STRETCHED = re.compile(rb"([A-Za-z])\1\1")
_PUNCTUATION = np.array([33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in range(256)])
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_LETTER = np.array([65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])

#: Byte lengths of word beginnings that the learned list may hold.
STEMS = (4, 5, 6, 7)
#: What a term needs: toxic documents that have it, and how much likelier it is there.
LEAST_DOCS, LEAST_RATIO = 3, 6.0

FEATURES = (
    "learned learned_rate learned_kinds learned_sum learned_sum_rate learned_most insults slights attacks insult_rate slight_rate attack_rate near_you near_rate second_person upper punctuation exclaims questions "
    "digits inside stretched hidden hidden_rate shouted words"
).split()


def terms(word: bytes) -> list[bytes]:
    """The word itself, marked as whole, and its beginnings."""
    return [word + b" ", *(word[:k] for k in STEMS if len(word) >= k)]


class Lexicon(dict):
    """Weight of each word seen, 0 if none of its terms is listed; forgets what it has seen when it grows."""

    def __init__(self, weights: dict[bytes, float], most_seen: int = 300_000) -> None:
        super().__init__()
        self.weights, self.most_seen = weights, most_seen

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most_seen:
            self.clear()
        found = self[word] = max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0)
        return found

    def __reduce__(self) -> tuple:
        return Lexicon, (self.weights, self.most_seen)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The feature row of one whole text; null counts as empty."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    plain = raw.translate(_LETTERS).split()
    n, letters, size = max(len(plain), 1), max(int(counts[_LETTER].sum()), 1), max(len(raw), 1)
    hits = [i for i, w in enumerate(plain) if w in LISTED]
    insults = sum(plain[i] in INSULTS for i in hits)
    slights = sum(plain[i] in SLIGHTS for i in hits)
    near = sum(any(w in SECOND_PERSON for w in plain[max(i - NEAR, 0) : i + NEAR + 1]) for i in hits)
    read = raw.translate(_PLAIN, _DROPPED).split()
    hidden = max(sum(w in LISTED for w in read) - len(hits), 0)
    second = sum(w in SECOND_PERSON for w in plain)
    learned = {w: lexicon[w] for w in set(plain)}
    listed = [learned[w] for w in plain if learned[w]]
    return [
        len(listed),
        len(listed) / n,
        sum(v > 0 for v in learned.values()),
        sum(listed),
        sum(listed) / n,
        max(listed, default=0.0),
        insults,
        slights,
        len(hits) - insults - slights,
        insults / n,
        slights / n,
        (len(hits) - insults - slights) / n,
        near,
        near / n,
        second / n,
        int(counts[_UPPER].sum()) / letters,
        int(counts[_PUNCTUATION].sum()) / size,
        int(counts[33]) / size,
        int(counts[63]) / size,
        int(counts[48:58].sum()) / size,
        len(_INSIDE.findall(raw)) / n,
        len(_STRETCHED.findall(raw)) / n,
        hidden,
        hidden / n,
        sum(w.isupper() and len(w) > 2 for w in raw.split()) / n,
        float(np.log1p(len(plain))),
    ]


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted
    chance: Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.chance(self.trees.raw(x)), 0.0, 1.0) if len(x) else np.zeros(0)


def learn_lexicon(rows: DataFrame, most_terms: int = 20_000) -> Lexicon:
    """Terms by how much likelier they are in toxic documents: at most ``most_terms``, the strongest."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                plain = set((text or "").encode().translate(_LETTERS).split())
                seen[int(toxic > 0)].update({t for w in plain for t in terms(w)} | {b""})
            both = [*set(seen[0]) | set(seen[1])]
            yield pd.DataFrame({"term": both, "clean": [seen[0][t] for t in both], "toxic": [seen[1][t] for t in both]})

    counts = rows.mapInPandas(count, "term binary, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = staged(counts, "terms")
    everyone = counts.where(F.octet_length("term") == 0).first()  # the empty term stands for all documents
    if everyone is None or not everyone["clean"] or not everyone["toxic"]:
        return Lexicon({})
    ratio = (F.col("toxic") / float(everyone["toxic"])) / ((F.col("clean") + 0.5) / float(everyone["clean"]))
    best = counts.where((F.octet_length("term") > 0) & (F.col("toxic") >= LEAST_DOCS)).select("term", ratio.alias("ratio")).where(F.col("ratio") >= LEAST_RATIO)
    best = best.orderBy(F.col("ratio").desc(), "term").limit(most_terms)
    return Lexicon({bytes(r["term"]): math.log(r["ratio"]) for r in best.collect()})


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 40_000, calibration: int = 4) -> Model:
    """Fits on about ``most_rows`` labelled documents, chosen by a hash of their id: the bound of the sample.

    Rows whose id falls into the held-out fifth (crc32 modulo 5 is 0), null ids and null labels are not used.  Half of
    the sample gives the word list, the rest the trees.  What calibrates are the rest's scores by trees that did not see
    them, in ``calibration`` folds, at every size.  Only the sample of ids is broadcast, which ``most_rows`` bounds.
    With no labelled row every score is 0; with one class every score is near that class.  A class of a single row has no
    fold that could learn it without seeing it; then the scores of the trees themselves calibrate.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0)).select("doc_id", "toxic")
    rate = most_rows / max(usable.count(), 1)
    sample = usable.where(unit_hash("doc_id") < rate) if rate < 1 else usable
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("toxic").cast("double").alias("toxic"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    lexicon = learn_lexicon(chosen.where(half).select("text", "toxic"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "x": [features(t, lexicon) for t in batch["text"]]})

    rows = chosen.where(~half).mapInPandas(measure, "doc_id long, toxic double, x array<double>").toPandas()
    if not len(rows):
        return Model(lexicon, Boosted(-50.0), Isotonic(np.zeros(1), np.zeros(1)))
    rows = rows.sort_values("doc_id", kind="stable")
    x, y = np.array(rows["x"].tolist()), rows["toxic"].to_numpy()
    trees, alone = fit_boosted(x, y), min((y > 0).sum(), (y <= 0).sum()) == 1
    return Model(lexicon, trees, fit_isotonic(trees.raw(x) if alone else unseen_raw(x, y, calibration), y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if score >= 0.5); columns of these names are replaced.

    A null or empty text has the score of its all-zero features.  Repeated rows get equal scores.
    """
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t, model.lexicon) for t in batch.column("text").to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            chance = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chance, pa.float64()), pa.array((chance >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return kept.mapInArrow(run, schema)
