"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items go into one suffix automaton. The words of each
document stream through it; at every word the automaton knows the longest piece of any
item that ends there. A match of at least ``window`` words (or of a whole item that is
shorter) makes its words *hit*. Hit spans are cut out of the text, and documents whose
hit words exceed ``max_coverage`` are rejected.

Scale. Documents are never shuffled: each task streams its rows through the automaton. The
items are split by hash into blocks of about ``BLOCK_WORDS`` words, so one automaton stays
within about 1 GB whatever the number and length of items; documents meet one block per pass. Up
to 200,000 item words (the usual case) there is one block and one pass. Matches are followed up to the length of a
block, which ``longest`` shows; windows, hits and items do not depend on it.

Defined results. A null or word-free text has no words and no hits. An item without words is
never found. Repeated rows each get their own result. Items with the same text are
reported each. ``items`` with null ids keep their windows (hits count) but name no id. An
empty table gives an empty result; without items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import WORD_BYTES, folded_words, sliced, text_bytes, without
from proofmill.llm.pretokens import claim
from proofmill.session import ship_code, stored, work_path

#: Item words of one automaton; it takes some 0.5 kB a word.
BLOCK_WORDS = 200_000

LEAK_TYPE = (
    "struct<n_words:bigint,n_hit:bigint,longest:bigint,item_ids:array<string>,word_spans:array<struct<start:int,end:int>>>"
)
_LEAK_ARROW = pa.struct(
    [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("item_ids", pa.list_(pa.string())),
        ("word_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the windows of each state.

    ``found[s]``: items that hold the window-long suffix of state s; ``short[s]``: (words, item)
    of items shorter than a window that are a suffix of s; ``alert[s]``: the match length from
    which a visit to s means a hit.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._windows(items)

    def _new(self, length: int, step: dict[bytes, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state for the part of q that continues p; q keeps its longer strings."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.step[last].get(word)
        if q is not None:  # an earlier item already has this string
            return self._split(last, q, word)
        new, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.step[p][word], word)
        return new

    def _windows(self, items: list[tuple[str | None, list[bytes]]]) -> None:
        n, window = len(self.length), self.window
        holders: list[set] = [set() for _ in range(n)]  # items whose window ends in this state
        shorts: list[list] = [[] for _ in range(n)]
        for item, words in items:
            s = 0
            for i, word in enumerate(words):
                s = self.step[s][word]
                if i + 1 >= window:
                    t = s
                    while self.length[self.link[t]] >= window:
                        t = self.link[t]
                    holders[t].add(item)
            if 0 < len(words) < window:
                shorts[s].append((len(words), item))
        order = sorted(range(n), key=self.length.__getitem__)
        self.found: list[frozenset | None] = [None] * n
        self.short: list[tuple] = [()] * n
        self.alert = [1 << 60] * n
        for s in order[1:]:
            up = self.link[s]
            self.short[s] = self.short[up] + tuple(shorts[s])
            if self.length[s] >= window:
                self.found[s] = self.found[up] if self.length[up] >= window else frozenset(holders[s])
                self.alert[s] = window
            if self.short[s]:
                self.alert[s] = min(k for k, _ in self.short[s])

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Merged [start, end) word spans of all windows in ``words``, the items found, and the longest match of any length."""
        step, link, length, alert = self.step, self.link, self.length, self.alert
        spans: list[list[int]] = []
        items: set = set()
        s = run = longest = 0
        for i, word in enumerate(words):
            t = step[s].get(word)
            if t is None:
                while s and t is None:
                    s = link[s]
                    t = step[s].get(word)
                if t is None:
                    run = 0
                    continue
                run = length[s] + 1
            else:
                run += 1
            s = t
            if run > longest:
                longest = run
            if run >= alert[s]:
                back = 0
                if run >= self.window:
                    items |= self.found[s]
                    back = self.window
                for k, item in self.short[s]:
                    if k <= run:
                        items.add(item)
                        back = max(back, k)
                start = i + 1 - back
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return spans, items, longest


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items dealt to blocks of bounded size, one block on the driver at a time. An item that is longer than a block is cut into
    pieces that overlap by all but one word of a window, so each of its windows is in a piece."""
    spark = items.sparkSession
    source = items.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("words"))
    total, longest = source.select(F.sum(F.octet_length("words")), F.max(F.octet_length("words"))).first()
    n = max(1, -(-(total or 0) // (block_words * 6)))  # a word and its space take six bytes or more in most texts
    if n > 1 or (longest or 0) > block_words * 6:

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                ids, pieces = [], []
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    words = folded_words(text)
                    for at in range(0, max(1, len(words) - window + 1), block_words):
                        ids.append(item)
                        pieces.append(b" ".join(words[at : at + block_words + window - 1]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, pa.binary())], names=["id", "words"])

        dealt = source.mapInArrow(cut, "id string, words binary").withColumn("block", F.pmod(F.xxhash64("id", "words"), F.lit(n)))
        path = work_path(spark, "items")
        dealt.repartition("block").write.partitionBy("block").parquet(path)  # read once; each pass then reads its own block
        source = spark.read.schema(dealt.schema).parquet(path)
    for k in range(n):
        rows = (source.where(F.col("block") == k) if "block" in source.columns else source).collect()
        yield sorted(((r["id"], folded_words(bytes(r["words"]))) for r in rows), key=lambda x: (x[0] is not None, x[0], x[1]))


def _matcher(shared, leak: bool):
    """An Arrow UDF (its kind is read from the type hints) over texts, or over texts and what earlier blocks found."""

    def run(batches):
        claim("leaks")
        automaton = shared.value
        for batch in sliced(batches):
            column, before = batch if leak else (batch, None)
            out = []
            old = before.to_pylist() if leak else None
            for i, data in enumerate(column.to_pylist()):
                words = data.translate(WORD_BYTES).split() if data else []
                spans, ids, longest = automaton.match(words) if words else ([], set(), 0)
                if leak:  # join what earlier blocks of items found
                    was = old[i]
                    spans = _union(spans + [[s["start"], s["end"]] for s in was["word_spans"]])
                    ids, longest = ids | set(was["item_ids"]), max(longest, was["longest"])
                out.append(
                    {
                        "n_words": len(words), "n_hit": sum(e - s for s, e in spans), "longest": longest,
                        "item_ids": sorted(x for x in ids if x is not None),
                        "word_spans": [{"start": s, "end": e} for s, e in spans],
                    }
                )
            yield pa.array(out, type=_LEAK_ARROW)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]] if leak else Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _union(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    return merged


def find_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, block_words: int = BLOCK_WORDS, name: str = "leak",
) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_hit, longest (words of the longest match), item_ids, word_spans."""
    spark = docs.sparkSession
    ship_code(spark)
    out = without(docs, name)
    first = True
    for block in _blocks(items, item_id_col, item_text_col, window, block_words):
        if not first:
            out = stored(out, "leaks")  # one pass of the documents per block of items
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        find = F.arrow_udf(_matcher(shared, not first), LEAK_TYPE).asNondeterministic()
        out = out.withColumn(name, find(text_bytes(text_col)) if first else find(text_bytes(text_col), F.col(name)))
        first = False
    return out


#: Stands where a span was cut out. It counts as a word that items rarely have, so what stood around the span makes no new window.
MARK = "\n…\n"


def _cut(text: str, spans: list[dict], min_words: int) -> str:
    """The text without the given word spans of at least ``min_words`` words."""
    data = text.encode()
    ends = [m.span() for m in _WORD.finditer(data.lower())]
    parts, at = [], 0
    for s in spans:
        if s["end"] - s["start"] < min_words:
            continue
        parts.append(data[at : ends[s["start"]][0]])
        at = ends[s["end"] - 1][1]
    parts.append(data[at:])
    return MARK.encode().join(p for p in (x.strip() for x in parts) if p).decode()


def remove_leaks(
    found: DataFrame, text_col: str = "text", min_words: int = 1, max_coverage: float = 0.5, name: str = "leak", rejected: str = "rejected",
    clean_text: str = "clean_text",
) -> DataFrame:
    """Act on the struct ``name``: ``rejected`` (coverage above the limit) and ``clean_text`` (without hit spans of at least ``min_words`` words)."""

    def clean(texts: pa.Array, leaks: pa.Array) -> pa.Array:
        return pa.array(
            [t if t is None or not k["word_spans"] else _cut(t, k["word_spans"], min_words) for t, k in zip(texts.to_pylist(), leaks.to_pylist(), strict=True)],
            type=pa.string(),
        )

    clean.__annotations__ = {"texts": pa.Array, "leaks": pa.Array, "return": pa.Array}
    cut = F.arrow_udf(clean, "string")
    return without(found, rejected, clean_text).select(
        "*", (F.col(f"{name}.n_hit") > F.col(f"{name}.n_words") * max_coverage).alias(rejected), cut(F.col(text_col), F.col(name)).alias(clean_text)
    )


def leak_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    ids: Column = F.col("leak.item_ids")
    return found.select(
        F.col(id_col).alias("doc_id"), F.col("leak.n_words").alias("n_words"), F.col("leak.n_hit").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH folded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT row_number() OVER () AS r, doc_id, w FROM folded),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)),
hits AS (SELECT r, i, grams.k, item_id FROM grams JOIN windows ON grams.k = windows.k AND grams.g = windows.g),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
