"""The prefix trie against a trie of tuples."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from proofmill.llm import prefix_trie as pt

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KINDS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * words
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if built[c] == node)
        out.append(
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in pt.prefix_trie(frame).collect()), key=repr)


def conversations(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        for turn in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", " c\td ", "e f g"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_in_shards_of_any_size(make, seed, monkeypatch):
    rows = conversations(seed)
    assert found(make(rows, KINDS)) == brute(rows)
    for name, size in (("SHARD", 5), ("SEGMENT", 2), ("PART", 2)):
        monkeypatch.setattr(pt, name, size)
    # Workers import the module anew, so shards and segments are also cut here, in the driver.
    segments = pt.rebuild(make(rows, KINDS)).collect()
    writer = pt._Writer()
    cut = []
    for r in segments:
        writer.open(r["conv_id"], [])
        for k, w in enumerate(r["words"]):
            writer.add((bytes(r["turns"][16 * k : 16 * k + 16]), w))
        writer.close()
        cut += writer.take().to_pylist()
    whole = {(n[0], n[1]): (n[4], n[5]) for n in _merge(pt.Shard([r.asDict() for r in segments]).nodes())}
    parts = defaultdict(lambda: [0, []])
    for i in range(0, len(cut), 5):
        for depth, node, _, _, bits, ends in pt.Shard(cut[i : i + 5]).nodes():
            parts[depth, node][0] += bits.bit_count()
            parts[depth, node][1] += ends
    assert {k: (n, sorted(e)) for k, (n, e) in parts.items()} == whole
    assert max(r["depth"] for r in cut) > 0


def _merge(nodes):
    return [(d, n, p, w, bits.bit_count(), sorted(ends)) for d, n, p, w, bits, ends in nodes]


def test_long_conversations_and_copies(make):
    long = [(c, i, "user", f"t{i % 7}") for c in (20, 21, 25) for i in range(1300 + c % 2)]
    copies = [(c, i, "user", "same words here") for c in range(1000, 1400) for i in range(2)]
    rows = long + copies + [(c, 0, None, None) for c in (3, 5)]
    assert found(make(rows, KINDS)) == brute(rows)


def test_odd_rows(make):
    rows = [
        (None, 0, "user", "no id"), (1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "second"), (1, 0, None, ""), (2, 5, None, None),
        (-7, 0, "user", "negative"), (4, 0, "", "x" * 200_000), (4, 1, "ab", "c"), (6, 0, "a", "bc"), (40, 1, "user", "z"), (41, 1, "user", "z"),
    ]
    clash = make([(*r, 1, 2, "x") for r in rows], KINDS + ", base long, node long, digest string")
    assert found(clash) == brute(rows)
    assert found(make([], KINDS)) == [] and found(make([(None, 0, "a", "b")], KINDS)) == []


def test_equals_its_sql(make):
    rows = conversations(7) + [(1, None, None, None), (2, None, "user", "a"), (None, 1, "a", "b")]
    conversations_table = make(rows, KINDS).toPandas()  # noqa: F841  (read by name)
    connection = duckdb.connect()
    connection.register("conversations", conversations_table)
    connection.execute("CREATE VIEW c AS SELECT conv_id::BIGINT conv_id, turn::BIGINT turn, role, text FROM conversations")
    sql = connection.execute(pt.ORACLE.replace("FROM conversations", "FROM c"))
    names = [d[0] for d in sql.description]
    expected = sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in sql.fetchall()), key=repr)
    assert found(make(rows, KINDS)) == expected
