"""Substring deduplication by repeated-phrase automata.

Words covered by a window of ``window`` words that also starts in a document with a smaller id are removed.  Windows meet by
anchors (see ``repeats``), so every occurrence of a passage streams to the shard of its anchor.  There the
recurring windows are confirmed, a shard's Aho-Corasick automaton is compiled from them over word numbers, and all
of the shard's stretches stream through it to find every occurrence with the smallest id that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import words
from millrace.llm.repeats import Kind, joined_spans, repeated_windows

#: Stands for a null id: nothing is smaller than it by way of it.
LAST_ID = (1 << 63) - 1


class WordCodes(dict):
    """Code of each word seen; forgets when it grows."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 9)
        return found


_SEEN = WordCodes()


def word_codes(text: str) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(_SEEN.__getitem__, found), np.uint64, len(found))


def word_slices(text: str, spans: list[tuple[int, int]]) -> list[bytes]:
    found = words(text)
    return [b" ".join(found[b:e]) for b, e in spans]


def word_split(units: bytes, begin: int, end: int) -> bytes:
    return b" ".join(units.split(b" ")[begin:end])


def found_earlier(pieces: pd.DataFrame, window: int) -> list[list[tuple[int, int]]]:
    """For each piece the runs of its windows (first, end) that a piece of a smaller ``least`` holds too."""
    numbers: dict[bytes, int] = {}
    texts = [np.array([numbers.setdefault(w, len(numbers)) for w in u.split(b" ")], np.uint32) for u in pieces["units"]]
    leasts = pieces["least"].tolist()
    owner: dict[bytes, int] = {}
    recurring: set[bytes] = set()
    for text, n, least in zip(texts, pieces["n"], leasts, strict=True):
        for p in range(n):
            phrase = text[p : p + window].tobytes()
            held = owner.get(phrase)
            if held is None:
                owner[phrase] = least
            elif held != least:
                recurring.add(phrase)
                owner[phrase] = min(held, least)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase in recurring:
        automaton.add_word(tuple(np.frombuffer(phrase, np.uint32).tolist()), owner[phrase])
    del owner
    if not recurring:
        return [[] for _ in texts]
    automaton.make_automaton()
    out = []
    for text, least in zip(texts, leasts, strict=True):
        starts = [(end - window + 1, end - window + 2) for end, smallest in automaton.iter(tuple(text.tolist())) if smallest < least]
        out.append(joined_spans(starts))
    return out


def kind(window: int, most: int = 400) -> Kind:
    return Kind(window, max(window // 5, 1), most, most, True, word_codes, word_slices, word_split, lambda rows: found_earlier(rows, window))


def without_repeats(docs: DataFrame, window: int = 50, most: int = 400, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``: the kept words, joined by spaces) for every row.

    A null text has no words.  A null id counts as larger than any other, and documents of equal id do not remove from each other.
    Texts of fewer than ``window`` words stay as they are.  An empty table gives no rows.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"))
    spans = repeated_windows(keyed, kind(window, most))
    rows = keyed.join(spans, "k1", "left").select("doc_id", "text", "spans")
    schema = T.StructType(
        [
            *rows.schema.fields[:1],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept", T.StringType())] if keep_text else []),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema.names[1:]]
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                held, gone = words(text.as_py()), joined_spans([(s["b"], s["e"]) for s in found.as_py() or []])
                ends = [0, *[x for span in gone for x in span], len(held)]
                kept = [w for b, e in zip(ends[::2], ends[1::2], strict=True) for w in held[b:e]]
                joined = b" ".join(kept)
                values = [len(held), len(held) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()]
                for column, value in zip(out, values[: len(out)], strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(out, types[: len(out)], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    return rows.mapInArrow(cut, schema)
