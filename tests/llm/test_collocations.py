"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from proofmill.llm import collocations as co

DOCS = "doc_id long, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, longest=5):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    return f, n


def brute(rows, at_least, percent=100, top=2000):
    f, n = counts(rows)
    wanted = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= at_least}
    dropped = set()
    for (lang, long), b in wanted.items():
        for size in range(2, len(long)):
            for i in range(len(long) - size + 1):
                inner = (lang, long[i : i + size])
                if 100 * b >= percent * wanted[inner]:
                    dropped.add(inner)
    out = []
    for (lang, p), a in wanted.items():
        if (lang, p) not in dropped:
            best = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, -best[0], -a, " ".join(p).encode(), f[lang, p[: best[1]]], f[lang, p[best[1] :]]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def found(frame, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in co.collocations(frame, **options).collect())


def documents(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "ünï", "A-b", "中文", "x y", "it", "is", "what"]
    passage = "it is what it is and so the city of New York sleeps"
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        parts = [w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "!\n", "\x0b"]) for w in words]
        rows.append((i, "".join(parts) + (passage if i % 3 == 0 else ""), rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("options", [{"at_least": 5}, {"at_least": 2, "percent": 60, "top": 40}, {"at_least": 30, "bits": 8}])
def test_equals_plain_counting(make, options):
    rows = documents(1)
    expected = brute(rows, options["at_least"], options.get("percent", 100), options.get("top", 2000))
    assert found(make(rows, DOCS).repartition(3), **options) == expected
    assert len(expected) >= 5


@pytest.mark.parametrize("divisor", [1, 3, 16, 1000])
def test_chunks_hold_every_phrase_once(divisor):
    rows = documents(2, 40)
    seen = Counter()
    for row, lead, chunk in zip(*co.parse(pa.array([text.encode() for _, text, _ in rows]), divisor=divisor), strict=True):
        lang = rows[row][2] or "und"
        words = chunk.decode().split(" ")
        assert lead in (0, 4) and len(words) > lead
        for k in range(1, 6):
            for end in range(max(lead, k - 1), len(words)):
                seen[lang, tuple(words[end + 1 - k : end + 1])] += 1
    assert seen == counts(rows)[0]


def test_shared_passages_share_chunks():
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(1000)}" for _ in range(400))
    apart = [set(co.parse(pa.array([f"{before} {passage}".encode()]))[2]) for before in ("a b c", "quite another beginning of more words than the first")]
    assert len(apart[0] & apart[1]) >= len(apart[0]) - 2 > 10


def test_words_of_a_block():
    texts = ["", "A b.c", "  ", "", "\td  ünï,", "e", "f" * 3000, "g h"]
    for column in (pa.array([t.encode() for t in texts]), pa.array([b"z z"] + [t.encode() for t in texts]).slice(1)):
        words = co.Words(column, fold=True)
        every = np.arange(len(words.row))
        assert list(zip(words.row.tolist(), words.place.tolist(), words.cut(every, every), strict=True)) == [
            (1, 0, b"a"), (1, 1, b"b"), (1, 0, b"c"), (4, 0, b"d"), (4, 1, "ünï".encode()), (5, 0, b"e"), (6, 0, b"f" * 3000), (7, 0, b"g"), (7, 1, b"h"),
        ]
        assert len(set(words.hash.tolist())) == 9 and words.hash[0] == co.Words(pa.array([b"x a"])).hash[1]
    assert len(co.Words(pa.array([], pa.binary())).hash) == 0


def test_odd_rows(make):
    rows = [(1, None, "en"), (2, "", None), (3, " \t.,", "en"), (4, "one two " * 50_000, "en"), (5, "B b\x0cB", None), (5, "B b\x0cB", None), (None, "B b", "und")]
    clash = make([(*r, 1, "p", 2) for r in rows], DOCS + ", lead int, phrase string, n long")
    assert found(clash, at_least=3) == brute(rows, 3)
    assert found(clash, at_least=1000) == brute(rows, 1000)
    assert found(make([], DOCS)) == [] and found(make(rows[:3], DOCS)) == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_001
    chunks = spark.createDataFrame([("en", 0, "a b", big), ("en", 0, "a", 7), ("en", 0, "b c", big - 1)], "lang string, lead int, chunk string, freq long")
    monkeypatch.setattr(co, "dictionary", lambda *a, **k: chunks)
    n = 2 * big + 7 + 2 * (big - 1)
    expected = sorted(
        ("en", a, left, right, n, 1000 * a * n // (left * right)) for a, left, right in ((big, big + 7, 2 * big - 1), (big - 1, 2 * big - 1, big - 1))
    )
    assert sorted((r[0], *r[3:]) for r in found(chunks)) == expected


def test_equals_its_sql(make):
    rows = documents(3, 700)
    table = make(rows, DOCS).toPandas()
    connection = duckdb.connect()
    connection.register("documents", table)
    sql = connection.execute(co.ORACLE)
    names = [d[0] for d in sql.description]
    expected = sorted(tuple(r[names.index(c)] for c in COLUMNS) for r in sql.fetchall())
    assert found(make(rows, DOCS)) == expected and expected
