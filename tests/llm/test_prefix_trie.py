import hashlib
import math
import random
import zlib

from millrace.llm import prefix_trie, radix
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = ((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest())
            convs.setdefault(conv, []).append((order, (role, text)))
    return {c: tuple(t for _, t in sorted(v)) for c, v in convs.items()}


def rebuilt(rows):
    own, out = sequences(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), ())[:h] + turns[h:]
    return out


def brute(convs):
    members, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    end = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if convs[c] == p).encode()).hexdigest() for p, m in members.items()}
    rows = [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], end[p])
        for p, m in members.items()
    ]
    return ordered(rows)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: r[:2])


def made(seed, n, deep, alphabet):
    rnd, rows = random.Random(seed), []
    for c in rnd.sample(range(-150, 1500), n):
        for t in range(rnd.choice([1, 2, 3, rnd.randint(1, deep)])):
            rows.append((c, rnd.choice([t, t, None]), rnd.choice(["u", None]), "x" * rnd.randint(0, alphabet)))
    return rows


def test_trie_equals_brute_force(spark):
    """Runs of three keys put most nodes on edges; long conversations go on alone, or are equal to the end."""
    rows = made(1, 120, 14, 1)
    rows += [(7, t, "u", "a") for t in range(90)] + [(8, t, "u", "a") for t in range(90)] + [(9, t, "u", "a" if t < 70 else "b") for t in range(100)]
    rows += [(c, t, "u", "same") for c in range(1000, 1060) for t in range(7)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ordered(prefix_trie.conversation_trie(df, size=3).collect()) == brute(rebuilt(rows))


def test_conversations_as_they_are(spark):
    rows = made(2, 80, 9, 2)
    placed = prefix_trie.ordered(spark.createDataFrame(rows, SCHEMA))
    assert ordered(prefix_trie.trie(placed, prefix_trie.facts_of(placed), 5).collect()) == brute(sequences(rows))


def test_odd_rows(spark):
    """Nulls everywhere, repeated turns, turnless rebuilds, a very long text, clashing columns, an empty table."""
    rows = [(None, 1, "u", "a"), (1, None, None, None), (1, None, None, None), (2, 3, "u", ""), (2, 3, "u", ""), (3, 0, None, "é" * 50_000), (100, 0, "", "x"), (101, 5, "u", "x")]
    rows += [(c, 0, "u", "one") for c in range(300, 330)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], f"{SCHEMA}, place string, n int")
    assert ordered(prefix_trie.conversation_trie(df).collect()) == brute(rebuilt(rows))
    assert prefix_trie.conversation_trie(df.limit(0)).collect() == []


def test_query(spark, data):
    df = QUERIES["op13_conversation_trie"](spark, data)
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ordered(df.collect()) == brute(rebuilt(rows))
    assert {k for _, k in df.dtypes[:-1]} == {"bigint"} and df.dtypes[-1] == ("ends_sha256", "string")


def walk(node, begin=b""):
    whole = begin + node.path
    if node.value is not None:
        yield whole, node.value
    byte = [b for b in range(256) if node.find(b) is not None]
    assert [node.find(b) for b in byte] == list(node.children())
    for b in byte:
        yield from walk(node.find(b), whole + bytes([b]))


def test_radix_tree_keeps_keys_in_order_through_all_layouts():
    rnd, rooms = random.Random(4), set()
    for fan in (3, 12, 40, 256):
        keys = list({bytes([rnd.randrange(fan)]) + rnd.randbytes(rnd.randrange(3)) for _ in range(800)} | {b"", b"\x00" * 30, b"\x00" * 25 + b"\x01"})
        rnd.shuffle(keys)
        root = radix.tree(keys)
        assert [(k, keys.index(k)) for k in sorted(keys)] == list(walk(root))
        stack = [root]
        while stack:
            node = stack.pop()
            rooms.add(node.room)
            stack += list(node.children())
    assert rooms == {4, 16, 48, 256}
