"""Language identification in two levels: the family first, then one-versus-one linear SVMs inside it.

Features of a whole text: square roots of the shares of hashed byte bigrams and trigrams (letters in lower
case, everything else one separator).  The family is decided by one linear machine per family; inside it each
pair of languages has its own machine and the most duels decide, margins breaking ties.  All machines are
linear, with squared hinge loss, fitted in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import remainder, row_key, unit_hash
from millrace.session import staged

#: Families of common language codes: fixed values.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi bn mr gu pa ur ne si",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
WIDTH = 2048

_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode's category L is in the text; digits such as ``²``, ``½`` or ``Ⅷ`` are none."""
    return any(map(str.isalpha, text or ""))


def features(text: str | None, piece: int = 1 << 22) -> np.ndarray:
    """Square roots of n-gram shares over the whole text, which is counted piece by piece to bound memory."""
    raw, counts = (" " + (text or "") + " ").encode(), np.zeros(WIDTH)
    for begin in range(0, len(raw), piece):
        b = _FOLD[np.frombuffer(raw[begin : begin + piece + 2], np.uint8)]
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        for grams in (two, three):
            counts += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(21), minlength=WIDTH)
    return np.sqrt(counts / max(counts.sum(), 1.0))


def fit_machine(x: np.ndarray, sign: np.ndarray, cost: float = 20.0, steps: int = 150) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss (last one: bias), by accelerated gradient steps.

    Both classes weigh the same in total.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)) * cost
    step = 1 / (1e-2 + 2 * (weight * (x**2).sum(1)).sum())
    w, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for k in range(steps):
        short = np.maximum(1 - sign * (x @ ahead), 0)
        new = ahead - step * (1e-2 * ahead - 2 * x.T @ (weight * sign * short))
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class Model:
    families: list[str]
    members: dict[str, list[str]]
    family_weights: np.ndarray
    duels: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each feature row; the score is the family's share times the weakest duel won."""
        x = np.hstack([x, np.ones((len(x), 1))])
        margin = x @ self.family_weights.T
        share = np.exp(3 * (margin - margin.max(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        first, out, score = margin.argmax(1), np.empty(len(x), object), np.zeros(len(x))
        for i, family in enumerate(self.families):
            rows, langs = np.flatnonzero(first == i), self.members[family]
            won = np.zeros((len(rows), len(langs)))
            weakest = np.ones((len(rows), len(langs)))
            for (a, b), w in self.duels.items():
                if a in langs:
                    j, k = langs.index(a), langs.index(b)
                    m = x[rows] @ w
                    chance = 1 / (1 + np.exp(-3 * m))
                    won[:, j] += (m > 0) + 1e-3 * np.tanh(m)
                    won[:, k] += (m <= 0) - 1e-3 * np.tanh(m)
                    weakest[:, j] = np.minimum(weakest[:, j], chance)
                    weakest[:, k] = np.minimum(weakest[:, k], 1 - chance)
            if len(rows):
                best = won.argmax(1)
                out[rows] = [langs[b] for b in best]
                score[rows] = share[rows, i] * weakest[np.arange(len(rows)), best]
        return out.tolist(), np.clip(score, 0.0, 1.0)


def train(docs: DataFrame, per_language: int = 800) -> Model | None:
    """Fits on about ``per_language`` rows of each language, chosen by a hash of id and text: the bound of the sample.

    Only rows with a language, a letter in the text and an id outside the held-out third (crc32 modulo 3 is 1) are used.
    Returns None if there are none.  The counts of all rows per language set the sampling rates.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", 3) != 1))
    keyed = usable.select(*row_key(docs), F.xxhash64("lang").alias("lang_hash"))
    counts = keyed.groupBy("lang_hash").agg(F.count(F.lit(1)).alias("rows"))
    picked = keyed.join(counts, "lang_hash").where(unit_hash("k1", "k2") < F.lit(float(per_language)) / F.col("rows"))
    picked = staged(picked.select("k1", "k2").distinct(), "language-sample")  # keys only: texts are not shuffled by language
    chosen = usable.select("lang", "text", *row_key(docs)).join(picked, ["k1", "k2"], "left_semi")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            yield pd.DataFrame({"lang": batch["lang"], "x": [features(t).astype(np.float32).tobytes() for t in batch["text"]]})

    rows = chosen.select("lang", "text").mapInPandas(measure, "lang string, x binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "x"], kind="stable")  # the order of tasks leaves no trace
    x = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]]).astype(float)
    lang = rows["lang"].to_numpy()
    kin = np.array([family_of(v) for v in lang])
    families = sorted(set(kin))
    members = {f: sorted(set(lang[kin == f])) for f in families}
    outer = [fit_machine(x, np.where(kin == f, 1.0, -1.0)) for f in families]
    duels = {}
    for f in families:
        for a, b in combinations(members[f], 2):
            of = (lang == a) | (lang == b)
            duels[a, b] = fit_machine(x[of], np.where(lang[of] == a, 1.0, -1.0))
    return Model(families, members, np.stack(outer), duels)


def identify(docs: DataFrame, model: Model | None, rows: int = 512) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.  One pass, no shuffle.

    ``und`` with score 0 for texts that are null or have no letter, and for all if nothing was learned.
    """
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, rows):
                batch = whole.slice(begin, rows)
                texts = batch.column("text").to_pylist()
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                if known:
                    said, sure = model.predict(np.stack([features(texts[i]) for i in known]))
                    score[known] = sure
                    for i, v in zip(known, said, strict=True):
                        lang[i] = v
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
                )

    return kept.mapInArrow(run, schema)
