import contextlib
import hashlib
import math
import os
import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import common, decontamination, embeddings, phrases, repeats, simhash, suffixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def roots(nodes, linked):
    """Smallest node reachable, by comparing all pairs."""
    out = {n: n for n in nodes}

    def find(n):
        while out[n] != n:
            n = out[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                out[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [[(9, 8), (8, 7), (7, 6), (6, 5), (5, 1)], [(1, 1)], [(i, i + 1) for i in range(0, 200)] + [(500, 400), (400, 300)], []])
def test_components(spark, edges):
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert {r["node"]: r["root"] for r in found.collect()} == roots(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)


def test_running(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.randint(0, 9), rng.randint(0, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    got = common.running(df, ["k"], [__import__("pyspark").sql.functions.col("o")], ["v"]).collect()
    for key in ("a", "b", None):
        mine = sorted((r["place"], r["before_v"], r["v"], r["o"]) for r in got if r["k"] == key)
        assert [m[0] for m in mine] == list(range(len(mine))) and [m[3] for m in mine] == sorted(m[3] for m in mine)
        assert [m[1] for m in mine] == [sum(x[2] for x in mine[:i]) for i in range(len(mine))]


# -- simhash -----------------------------------------------------------------------------------------


def slow_fingerprint(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode())
    shingles = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) > 2 else [b" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_rows):
    texts = [r[1] for r in odd_rows] + ["A b", "É É É a A a", "x" * 10_000, "a b c d"]
    assert [simhash.fingerprint(t) % (1 << 64) for t in texts] == [slow_fingerprint(t) for t in texts]
    assert simhash.fingerprint(odd_rows[6][1], piece=1000) == simhash.fingerprint(odd_rows[6][1])


@pytest.mark.parametrize("bits", [1, 2])
def test_links_lose_nothing(spark, bits):
    rng, fps = random.Random(4), set()
    for _ in range(12):  # chains, stars and dense clusters around random values, and pairs just too far apart
        fp = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 60])):
            fps.add(fp)
            fp ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) if rng.random() < 0.7 else 7 << rng.randrange(60)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits)
    found = {r["node"]: r["root"] for r in common.components(edges).collect()}
    wanted = roots(signed, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= bits)
    assert {n: found.get(n, n) for n in signed} == wanted


def test_near_duplicates_of_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 12
    by_text = {}
    for r in rows:
        by_text.setdefault(r["fp"], set()).add(r["component_id"])
    assert all(len(ids) == 1 for ids in by_text.values()) and by_text[0] == {3}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 3, 6, 7, 8, 9] and kept.count() == 7
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


# -- benchmark items ---------------------------------------------------------------------------------


def slow_pairs(docs, items, least):
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    out = set()
    for item, text in items:
        words = cut(text)
        width = min(5, len(words))
        if item is None or not words:
            continue
        own = grams(words, width)
        for doc, body in docs:
            shared = len(own & grams(cut(body), width))
            if shared >= math.ceil(least * len(own) - 1e-9):
                out.add((doc, item, len(own), shared))
    return out


def test_contaminated(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 8, 9, 17, 33, 60]))) for i in range(30)] + [(100, None), (101, "!!"), (102, "w1"), (None, text(9)), (103, "W1, w2 W3 w4 w5")]
    docs = []
    for i in range(150):
        words = text(rng.choice([0, 3, 20, 400])).split()
        if i % 3 == 0:
            planted = (items[i % 30][1] or "").split()
            for _ in range(rng.randint(0, 2)):
                planted[rng.randrange(len(planted))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = planted
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    docs += [(200, None), (None, items[3][1]), (5, docs[5][1])]
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == slow_pairs(docs, items, 0.8) and len(got) > 40


def test_clean_keeps_the_rest(spark, odd, none):
    items = spark.createDataFrame([(1, "dog lay on the rug by the fire"), (2, "nowhere to be found in any of these")], "item_id long, text string")
    rest = decontamination.clean(odd, items)
    assert rest.columns == odd.columns and rest.count() == 9 and rest.where("doc_id IN (1, 2)").count() == 0
    assert decontamination.clean(odd, items.limit(0)).count() == 12 and decontamination.clean(none, items).count() == 0


def test_decontamination_is_native(spark, odd):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    plan = decontamination.contaminated(odd, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# -- repeated strings --------------------------------------------------------------------------------


def slow_bytes(rows, window):
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in raw:
        for p in range(len(b) - window + 1):
            seen[b[p : p + window]] = seen.get(b[p : p + window], 0) + 1
    out = []
    for (i, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def slow_words(rows, window):
    cut, least = [WORD.findall((t or "").encode()) for _, t in rows], {}
    order = lambda i: math.inf if i is None else i
    for (i, _), w in zip(rows, cut, strict=True):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            least[key] = min(least.get(key, math.inf), order(i))
    out = []
    for (i, _), w in zip(rows, cut, strict=True):
        gone = bytearray(len(w))
        for p in range(len(w) - window + 1):
            if least[tuple(w[p : p + window])] < order(i):
                gone[p : p + window] = b"\1" * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def nulls_last(row):
    return tuple((x is None, x) for x in row)


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 2))) for _ in range(n))
    base, passage = [text(rng.randint(5, 120)) for _ in range(40)], text(60)
    rows = []
    for i in range(150):
        if i % 7 == 0:
            rows.append((i, base[i % 40]))
        elif i % 3 == 0:
            rows.append((i, f"{text(rng.randint(0, 60))} {passage[rng.randint(0, 20):]} {text(rng.randint(0, 60))}"))
        else:
            rows.append((i, text(rng.randint(0, 150))))
    return rows + [
        (200, None), (201, ""), (None, base[0]), (None, base[1] + passage), (5, base[2]), (5, base[2]), (7, passage + passage),
        (300, "a" * 500), (301, "é" * 200), (302, " ".join(["x"] * 200)),
    ]


@pytest.mark.parametrize("most,window", [(2000, 40), (3, 13), (1, 22)])
def test_removed_bytes(spark, repeated, most, window):
    """``most`` small: groups are halved again and again; large: suffix arrays decide."""
    docs = spark.createDataFrame(repeated, "doc_id long, text string").repartition(4)
    got = suffixes.without_repeats(docs, window=window, most=most).collect()
    assert sorted(map(tuple, got), key=nulls_last) == sorted(slow_bytes(repeated, window), key=nulls_last)


@pytest.mark.parametrize("most,window", [(400, 13), (3, 4), (1, 7)])
def test_removed_words(spark, repeated, most, window):
    docs = spark.createDataFrame(repeated, "doc_id long, text string").repartition(4)
    got = phrases.without_repeats(docs, window=window, most=most).collect()
    assert sorted(map(tuple, got), key=nulls_last) == sorted(slow_words(repeated, window), key=nulls_last)


def test_repeats_of_odd_rows(odd, none):
    rows = suffixes.without_repeats(odd, window=20, keep_text=True).collect()
    assert len(rows) == 12 and {r["n_removed"] for r in rows if r["doc_id"] in (1, 2)} == {len("the cat sat on the mat and the dog lay on the rug by the fire")}
    assert all(r["n_bytes"] == r["n_removed"] + len(r["kept"]) for r in rows)
    rows = phrases.without_repeats(odd, window=6, keep_text=True).collect()
    assert len(rows) == 12 and [r["n_removed"] for r in rows if r["doc_id"] == 1] == [0]
    assert all(r["n_words"] == r["n_removed"] + len(r["kept"].split()) for r in rows)
    assert suffixes.without_repeats(none).count() == phrases.without_repeats(none).count() == 0


@pytest.mark.parametrize("text", [b"banana", b"mississippi", b"aaaaaaa", b"a", b"", bytes(range(256)) * 3, b"\0\0a\0\0", b"ab" * 50])
def test_suffix_array(text):
    got = suffixes.suffix_array(np.frombuffer(text, np.uint8), 600)
    padded = text + b"\0" * 600
    wanted = sorted(range(len(text)), key=lambda i: padded[i : i + 600])
    assert [padded[i : i + 600] for i in got] == [padded[i : i + 600] for i in wanted] and sorted(got) == list(range(len(text)))
    if b"\0" not in text:
        assert list(got) == sorted(range(len(text)), key=lambda i: text[i:])


def test_runs_follow_content():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    one, two = (np.concatenate((rng.integers(0, 1 << 62, k).astype(np.uint64), shared)) for k in (37, 90))
    hashes = [set(repeats.runs(x, 50, 10)[4].tolist()) for x in (one, two)]
    begin, n, *_ = repeats.runs(one, 50, 10)
    assert (begin[1:] == begin[:-1] + n[:-1]).all() and begin[-1] + n[-1] == len(one) - 49 and len(hashes[0] & hashes[1]) >= 8


# -- vectors -----------------------------------------------------------------------------------------


def slow_vectors(rows, least):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def close(a, b):
        (_, x, p), (_, y, q) = rows[a], rows[b]
        if p != q or not usable(x, p) or not usable(y, q) or len(x) != len(y):
            return False
        x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least

    n = len(rows)
    root = roots(range(n), close)
    ids = {}
    for i in range(n):
        if rows[i][0] is not None:
            ids[root[i]] = min(ids.get(root[i], math.inf), rows[i][0])
    out = []
    for i in range(n):
        component = ids.get(root[i])
        out.append((rows[i][0], sum(close(min(i, j), max(i, j)) for j in range(n) if i != j), component, component is None or rows[i][0] == component))
    return out


@pytest.mark.parametrize("tile,blocks", [(1024, 4), (9, 4), (16, 1), (20, 3)])
def test_linked_vectors(spark, tile, blocks):
    rng, rows = np.random.default_rng(8), []
    for i in range(140):
        if i % 4 == 0:
            centre, spread = rng.normal(size=8), rng.choice([0.0, 0.1, 0.3])
        rows.append((i, [float(np.float32(x)) for x in centre + spread * rng.normal(size=8)], int(rng.integers(0, 3)) if i % 9 else 1))
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [math.nan] + [1.0] * 7, 1), (203, [None] + [1.0] * 7, 1), (204, rows[0][1], None), (205, [], 1)]
    rows += [(206, [1.0, 0.0], 1), (207, [2.0, 0.0], 1), (208, [math.inf] * 8, 2), (3, rows[3][1], rows[3][2]), (None, rows[4][1], rows[4][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = embeddings.near_duplicates(df, tile=tile, blocks=blocks).collect()
    assert sorted(map(tuple, got), key=nulls_last) == sorted(slow_vectors(rows, 0.93), key=nulls_last)
    assert sum(r["n_links"] for r in got) > 50


def written(spark):
    """Bytes of each file below the shared folder and of each shuffle file."""
    local = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    found = {}
    for top in (spark.conf.get("spark.checkpoint.dir"), *(d.getPath() for d in local)):
        for at, _, names in os.walk(top):
            for name in names:
                with contextlib.suppress(OSError):  # Spark deletes shuffles that nothing refers to
                    found[f"{at}/{name}"] = os.path.getsize(f"{at}/{name}")
    return found


def test_vectors_are_not_written_for_each_tile(spark):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.random.default_rng(3).normal(size=(4000, 64)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    before = written(spark)
    assert embeddings.near_duplicates(df).where("n_links = 0 AND kept").count() == 4000
    new = sum(size for name, size in written(spark).items() if name not in before)
    assert new < 4 * 4000 * 64 * 4


@pytest.mark.parametrize("kind,label,run,group,tile", [("float", "string", 1 << 11, 1 << 13, 1024), ("double", "double", 1 << 12, 1, 5), ("float", "int", 1, 1 << 10, 3)])
def test_every_two_runs_meet_once(spark, kind, label, run, group, tile):
    rng, rows = np.random.default_rng(21), []
    names = {"string": ["b", "a", ""], "double": [math.nan, -1.0, 0.0], "int": [7, 3, 5]}[label]
    centres = rng.normal(size=(5, 32))
    for i in range(150):  # a crowd of one label, a chain of links, vectors without any, and other lengths
        dim, near = (32, centres[i % 5]) if i % 10 else (20, centres[i % 5][:20])
        vector = near + rng.choice([0.02, 0.2, 1.0]) * rng.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in vector], names[0] if i % 3 else names[i % 2 + 1]))
    rows += [(i + 300, *rows[i][1:]) for i in range(0, 150, 7)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label {label}").repartition(3)
    got = embeddings.near_duplicates(df, run=run, group=group, tile=tile).collect()
    known = [(i, v, str(x)) for i, v, x in rows]  # not-a-number is a label like others
    assert sorted(map(tuple, got)) == sorted(slow_vectors(known, 0.93))
    assert max(r["n_links"] for r in got) > 10


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, extra string")
    assert embeddings.near_duplicates(none).count() == 0


def test_clean_uses_items_without_an_id(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"before it {item} and after"), (2, "something else that is clean as it stands here")], "doc_id long, text string")
    for i in (None, 5):
        benchmark = spark.createDataFrame([(i, item), (None, None)], "item_id long, text string")
        assert [r["doc_id"] for r in decontamination.clean(docs, benchmark).collect()] == [2]
