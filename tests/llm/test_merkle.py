import hashlib
import zlib

from pyspark.sql import functions as F

from millrace.llm import merkle
from millrace.llm.queries import QUERIES


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tampered(row):
    name = "" if row["doc_id"] is None else str(row["doc_id"])
    return row["text"].replace("\n", "") if row["text"] is not None and zlib.crc32(name.encode()) % 2 == 0 else row["text"]


def tree(nodes, arity):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % arity
            paths[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + arity])))
            at[k] = i // arity
        nodes = [digest("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity=3):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, tampered(r))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    lower = {s: tree([x[2] for x in sorted(groups[s])], arity) for s in names}
    root, upper = tree([lower[s][0] for s in names], arity)
    out = []
    for s, above in zip(names, upper, strict=True):
        for (known, key, own, given), path in zip(sorted(groups[s]), lower[s][1], strict=True):
            for before, behind in path + above:
                given = digest(before + given + behind)
            out.append((key if known else None, own, lower[s][0], root, digest("".join(a + b for a, b in path + above)), given, given == root))
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, x) for x in r])


def found(docs, **settings):
    text = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    given = merkle.leaf(*[F.col(c) for c in merkle.FIELDS[:-1]], F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0, text).otherwise(F.col("text")))
    out = merkle.manifest(docs, given, **settings)
    return ordered(out.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")), "folded", F.col("folded") == F.col("root")).collect())


def test_manifest_equals_whole_trees(spark):
    """A hot source over several superblocks and stages; sources of one row; newlines in half of the texts."""
    rows = [(i * 7 % 400 - 5, f"text {i % 9}\nof {i}" if i % 2 else f"text {i}", "en", "hot" if i % 3 else f"s{i % 11}", i) for i in range(150)]
    rows += [(900, "alone", None, "Ω", None), (901, None, "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = found(docs, height=2)
    assert got == brute(docs.collect())
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark, odd, none):
    assert found(odd, height=1) == brute(odd.collect())
    assert found(none) == []


def test_one_row_and_other_arity(spark):
    docs = spark.createDataFrame([(1, "a\nb", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert found(docs) == brute(docs.collect())
    many = spark.createDataFrame([(i, str(i), None, "s", None) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    assert found(many, arity=2, height=2) == brute(many.collect(), 2)


def test_columns_named_like_the_operators_own(spark):
    docs = spark.createDataFrame([(i, str(i), "en", "s", 1, "x", "y", "z") for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long, hash string, grp string, place string")
    assert found(docs, height=1) == brute(docs.collect())


def test_proofs_verify_without_the_table(spark, data):
    out = merkle.manifest(spark.read.parquet(f"{data}/documents.parquet"))
    fold = merkle.fold(F.col("leaf"), F.col("proof"))
    assert {tuple(r) for r in out.select(fold == F.col("root"), F.col("folded") == F.col("root")).distinct().collect()} == {(True, True)}


def test_query(spark, data):
    df = QUERIES["op11_merkle_manifest"](spark, data)
    assert dict(df.dtypes) == {"doc_id": "bigint", "verified": "boolean"} | {c: "string" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")}
    rows = ordered(df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())
    assert rows == brute(spark.read.parquet(f"{data}/documents.parquet").collect())
