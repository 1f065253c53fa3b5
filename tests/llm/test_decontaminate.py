import hashlib
import random
import re

import pytest

from proofmill.llm import decontaminate as d
from proofmill.llm.common import folded_words

ITEMS = "item_id long, text string"


def brute(text, items, window):
    words = folded_words((text or "").encode())
    hit, ids = set(), set()
    for item, t in items:
        w = folded_words((t or "").encode())
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


def test_words_are_those_of_the_pattern():
    text = "Ab-c É\x00d1_e ﬁ… x"
    expected = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    assert [w.decode() for w in folded_words(text.encode())] == expected


@pytest.mark.parametrize("window", [1, 3, 5])
def test_automaton_equals_brute_force(window):
    rng = random.Random(window)
    for _ in range(40):
        items = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 12)))) for i in range(4)] + [(9, "")]
        automaton = d.SuffixAutomaton([(str(i), folded_words(t.encode())) for i, t in items], window)
        text = " ".join(rng.choices("abcd", k=40))
        spans, ids, _ = automaton.match(folded_words(text.encode()))
        assert (40, sum(e - s for s, e in spans), sorted(ids)) == brute(text, items, window)


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 4])
def test_blocks_of_items_give_the_same_result(make, odd_docs, block_words):
    items = [(10, "quick brown fox jumps over"), (11, "the LAZY dog"), (12, None), (13, "..."), (14, "quick brown fox jumps over"), (15, "中文 字")]
    found = d.leak_digest(d.find_leaks(odd_docs, make(items, ITEMS), window=4, block_words=block_words))
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found.collect()), key=repr)
    want = []
    for r in odd_docs.collect():
        n, hit, ids = brute(r["text"], items, 4) if r["doc_id"] != 5 else (30_001, 0, [])
        want.append((r["doc_id"], n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=repr)


def test_spans_are_cut_and_covered_documents_rejected(make):
    docs = make([(1, "one two three. ALPHA beta, gamma delta! four five six seven eight", 1), (2, "alpha beta gamma delta", 2), (3, None, 3)], "doc_id long, text string, leak int")
    found = d.find_leaks(docs, make([(1, "alpha beta gamma delta")], ITEMS))
    rows = {r["doc_id"]: r for r in d.remove_leaks(found, max_coverage=0.5).collect()}
    assert rows[1]["clean_text"] == "one two three." + d.MARK + "! four five six seven eight"
    assert not rows[1]["rejected"] and rows[1]["leak"]["longest"] == 4
    assert rows[2]["rejected"] and rows[2]["clean_text"] == ""
    assert rows[3]["clean_text"] is None and not rows[3]["rejected"]


def test_empty_tables(make):
    assert d.find_leaks(make([], "doc_id long, text string"), make([(1, "a b")], ITEMS)).count() == 0
    assert d.find_leaks(make([(1, "a b")], "doc_id long, text string"), make([], ITEMS)).first()["leak"]["n_hit"] == 0


@pytest.mark.parametrize("block_words", [5, 40])
def test_items_longer_than_a_block(make, block_words):
    """Long items are cut into overlapping pieces; every window stays whole, also across the cuts, and each item is named once."""
    rng = random.Random(block_words)
    items = [(i, " ".join(rng.choices("abcde", k=n))) for i, n in enumerate((300, 120, 41, 6, 5, 4, 1, 0))] + [(None, "a b c d e a b c d e " * 20), (9, None)]
    whole = items[0][1].split()
    texts = [" ".join(whole[at : at + 60]) for at in range(0, 240, 20)] + [" ".join(rng.choices("abcde", k=80)) for _ in range(10)] + [None, ""]
    docs = make([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, block int")
    rows = d.leak_digest(d.find_leaks(docs, make(items, ITEMS), window=6, block_words=block_words)).collect()
    for r in rows:
        n, hit, ids = brute(texts[r["doc_id"]], items, 6)
        ids = [x for x in ids if x != "None"]
        assert (r["n_words"], r["n_hit"], r["items_sha256"]) == (n, hit, hashlib.sha256(",".join(ids).encode()).hexdigest())
    assert len(rows) == len(texts)
