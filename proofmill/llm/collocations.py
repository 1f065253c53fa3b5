"""Collocations by prefix-free parsing.

Words run within pieces (parts between punctuation). A window of four words whose hash is divisible by ``DIVISOR`` triggers:
it ends a chunk, and the next chunk of the piece begins with the same four words. Where chunks are cut depends on
content only, so a passage that many documents share gives the same chunks wherever it stands, and the dictionary holds
each distinct chunk once, with its frequency in the parse. Phrases are counted inside distinct chunks, weighted by
that frequency. A phrase of up to five words lies whole in the chunk that has its last word behind the chunk's leading four; there
alone it is counted, so what chunks share is counted once.

Counting goes by length, in the passes of ``PASSES``. A phrase can be frequent only if the shorter ones in it are, so each pass
asks a bitmap of the longest frequent phrases before. The bitmap has a fixed size and no false negatives; a false
positive is counted and then falls to the threshold, so counts are exact at every size.

Scale. Documents are read once; the dictionary is written and scanned once per length. Tasks count before they shuffle, sums are
combined before and after, and only phrases that can be frequent are shuffled. Cuts and containment are joins among frequent phrases.
The largest broadcast is the bitmap (8 MB).

Defined results. Null texts are empty, a null lang is ``und``. Repeated rows count each. Words are compared by code points, only
A-Z are lower-cased. A table without frequent phrases gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofmill.llm.common import stored
from proofmill.session import ship_code

#: Words of a trigger window: what consecutive chunks share, and one less than the longest phrase.
WINDOW = 4
LONGEST = WINDOW + 1
#: One window in so many triggers.
DIVISOR = 16
#: Lengths that are counted in one scan of the dictionary.
PASSES = ((1,), (2,), (3,), (4, 5))
#: Distinct chunks and phrases that a task holds before it emits them.
HELD_CHUNKS, HELD_PHRASES = 200_000, 500_000
#: Bytes of text that are worked on at once (a row is never split).
BLOCK = 1 << 20
#: Bits of the bitmap, as a power of two.
BITS = 26

# Folds A-Z; punctuation and line ends become line feeds, tabs become spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))
# Odd multipliers of the hashes of words and of windows.
_BYTE, _SPREAD = 0x100000001B3, 0x9E3779B97F4A7C15


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the texts of a column begin and end in its data."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


class Words:
    """The words of some rows of text: bytes between spaces and line feeds; all places are in ``data``."""

    def __init__(self, column: pa.Array, fold: bool = False) -> None:
        offsets = _offsets(column)
        buffer = column.buffers()[2]
        data = b"" if buffer is None else buffer[int(offsets[0]) : int(offsets[-1])].to_pybytes()
        self.data = data.translate(_FOLD) if fold else data
        offsets = offsets - offsets[0]
        codes = np.frombuffer(self.data, np.uint8)
        line = codes == 10
        inside = ~(line | (codes == 32))
        edge = np.zeros(len(codes) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(codes) else inside
        after = np.concatenate((inside[1:], [False])) if len(codes) else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        lines = np.cumsum(line)[self.starts] if len(codes) else self.starts
        opens = np.ones(len(self.starts), bool)
        opens[1:] = (self.row[1:] != self.row[:-1]) | (lines[1:] != lines[:-1])
        self.opens = np.flatnonzero(opens)
        #: place of each word in its piece
        self.place = np.arange(len(opens)) - np.repeat(self.opens, np.diff(np.append(self.opens, len(opens))))
        self.hash = self._hash(codes[inside])

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0, np.uint64)
        sizes = self.ends - self.starts
        first = np.cumsum(sizes) - sizes
        powers = np.cumprod(np.full(int(sizes.max()), _BYTE, np.uint64))
        return np.add.reduceat((codes + np.uint64(1)) * powers[np.arange(len(codes)) - np.repeat(first, sizes)], first)

    def cut(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The text from each first word to each last one."""
        data = self.data
        return [data[i:j] for i, j in zip(self.starts[first].tolist(), self.ends[last].tolist(), strict=True)]


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with some ``BLOCK`` bytes in the given column."""
    offsets, at = _offsets(batch.column(column)), 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(offsets, int(offsets[at]) + BLOCK, side="right")) - 1, at + 1)
        yield batch.slice(at, end - at)
        at = end


def _windows(words: np.ndarray, k: int, seed: np.ndarray | np.uint64) -> np.ndarray:
    """A hash of the k words that end at each place (of the seed and all that precedes, at the first k - 1 places)."""
    total = np.zeros(len(words), np.uint64) + seed
    for t in range(k):
        total[t:] += words[: max(len(words) - t, 0)] * np.uint64(pow(_SPREAD, 2 * t + 1, 1 << 64))
    total ^= total >> np.uint64(29)
    total *= np.uint64(_SPREAD)
    return total ^ (total >> np.uint64(32))


def parse(texts: pa.Array, window: int = WINDOW, divisor: int = DIVISOR) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row, number of leading words and chunk, for every chunk of the texts, in order."""
    words = Words(texts, fold=True)
    size = len(words.starts)
    if not size:
        return words.row, words.row, []
    trigger = (words.place >= window - 1) & (_windows(words.hash, window, np.uint64(0)) % np.uint64(divisor) == 0)
    cuts = np.union1d(np.flatnonzero(trigger) + 1, np.append(words.opens[1:], size))
    begins = np.concatenate(([0], cuts[:-1]))
    lead = np.where(words.place[begins] == 0, 0, window)
    chunks = words.cut(begins - lead, cuts - 1)
    if b"  " in words.data:
        chunks = [b" ".join(c.split()) if b"  " in c else c for c in chunks]
    return words.row[begins], lead, chunks


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """(lang, lead, chunk, freq): every distinct chunk and how often the parse has it."""
    ship_code(docs.sparkSession)

    def emit(held: dict[tuple[str, int], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, lead), found in held.items():
            chunks = pa.array(found.keys(), pa.binary()).cast(pa.string())
            columns = [pa.array([lang] * len(found), pa.string()), pa.array([lead] * len(found), pa.int32()), chunks, pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "lead", "chunk", "freq"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], Counter] = {}
        for batch in batches:
            for part in _blocks(batch, 1):
                row, lead, chunks = parse(part.column(1), divisor=divisor)
                langs, lang, _ = _langs(part)
                group = lang[row] * 2 + (lead > 0)
                for g in np.unique(group).tolist():
                    of = np.flatnonzero(group == g).tolist()
                    held.setdefault((langs[g // 2], WINDOW * (g % 2)), Counter()).update([chunks[i] for i in of])
                if sum(map(len, held.values())) > HELD_CHUNKS:
                    yield from emit(held)
        yield from emit(held)

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    seen = rows.mapInArrow(run, "lang string, lead int, chunk string, freq long")
    return seen.groupBy("lang", "lead", "chunk").agg(F.sum("freq").alias("freq"))


def _langs(part: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The rows' langs, the number of each row's lang, and a seed for each lang."""
    coded = part.column("lang").dictionary_encode()
    langs = coded.dictionary.to_pylist()
    return langs, coded.indices.to_numpy(), np.array([crc32(lang.encode()) for lang in langs], np.uint64)


def _bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def count_phrases(chunks: DataFrame, sizes: tuple[int, ...], shorter=None, bits: int = BITS) -> DataFrame:
    """(lang, phrase, freq) of the phrases of these lengths; all shorter ones in them, of one word less than the least length, are in the bitmap."""
    within = min(sizes) - 1

    def emit(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            phrases = pa.array(found.keys(), pa.binary()).cast(pa.string())
            columns = [pa.array([lang] * len(found), pa.string()), phrases, pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "freq"])
        held.clear()

    def count(words: Words, last: np.ndarray, k: int, langs: list[str], lang: np.ndarray, freq: np.ndarray, held: dict[str, Counter]) -> None:
        row = words.row[last]
        for number, name in enumerate(langs):
            own = lang[row] == number
            counter = held.setdefault(name, Counter())
            once = last[own & (freq[row] == 1)]
            counter.update(words.cut(once + 1 - k, once))
            often = own & (freq[row] != 1)
            for phrase, n in zip(words.cut(last[often] + 1 - k, last[often]), freq[row[often]].tolist(), strict=True):
                counter[phrase] += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shorter is None else np.frombuffer(shorter.value, np.uint8)
        held: dict[str, Counter] = {}
        for batch in batches:
            for part in _blocks(batch, 2):
                words = Words(part.column("chunk"))
                langs, lang, seeds = _langs(part)
                lead, freq = part.column("lead").to_numpy(), part.column("freq").to_numpy()
                own = words.place >= lead[words.row]
                if bitmap is not None:
                    bit = _bit(_windows(words.hash, within, seeds[lang[words.row]]), bits)
                    there = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                for k in sizes:
                    wanted = own & (words.place >= k - 1)
                    for back in range(k - within + 1) if bitmap is not None else ():
                        wanted[back:] &= there[: len(there) - back] if back < len(there) else False
                    count(words, np.flatnonzero(wanted), k, langs, lang, freq, held)
                if sum(map(len, held.values())) > HELD_PHRASES:
                    yield from emit(held)
        yield from emit(held)

    seen = chunks.select("lang", "lead", "chunk", "freq").mapInArrow(run, "lang string, phrase string, freq long")
    return seen.groupBy("lang", "phrase").agg(F.sum("freq").alias("freq"))


def bitmap_of(phrases: DataFrame, k: int, bits: int = BITS) -> bytes | None:
    """The bits of all phrases (lang, phrase) of k words; None if there are none. At most 2^(bits - 6) small rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, 1):
                words = Words(part.column("chunk"))
                _, lang, seeds = _langs(part)
                bit = _bit(_windows(words.hash, k, seeds[lang[words.row]])[words.place == k - 1], bits)
                mask = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bit >> 6, pa.int64()), pa.array(mask, pa.int64())], names=["slot", "mask"])

    rows = phrases.select("lang", F.col("phrase").alias("chunk")).mapInArrow(run, "slot long, mask long")
    slots = rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    if slots.empty:
        return None
    out = np.zeros(1 << (bits - 6), np.int64)
    out[slots["slot"].to_numpy()] = slots["mask"].to_numpy()
    return out.tobytes()


def frequent_phrases(chunks: DataFrame, at_least: int, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """(lang, phrase, k, freq) of every phrase of up to ``longest`` words that occurs so often."""
    spark, found, shorter = chunks.sparkSession, [], None
    passes = [tuple(k for k in sizes if k <= longest) for sizes in PASSES if sizes[0] <= longest]
    for sizes in passes:
        counted = count_phrases(chunks, sizes, shorter, bits).where(F.col("freq") >= at_least)
        found.append(stored(counted.withColumn("k", F.size(F.split("phrase", " "))), f"phrases-{sizes[0]}"))
        if sizes != passes[-1]:
            packed = bitmap_of(found[-1], sizes[0], bits)
            if packed is None:
                break
            shorter = spark.sparkContext.broadcast(packed)
    return reduce(DataFrame.unionByName, found)


def collocations(
    docs: DataFrame, at_least: int = 100, percent: int = 100, top: int = 2000, longest: int = LONGEST, divisor: int = DIVISOR, bits: int = BITS
) -> DataFrame:
    """Each lang's best phrases: lang, rank, phrase, a, l, r, n, score."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    chunks = stored(dictionary(docs, divisor=divisor), "chunks")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("freq") * (F.length("chunk") - F.length(F.replace("chunk", F.lit(" "), F.lit(""))) + 1 - F.col("lead"))).alias("n"))
    frequent = frequent_phrases(chunks, at_least, longest, bits)
    words = F.split("phrase", " ")
    phrases = frequent.where("k > 1").select("lang", "phrase", "k", F.col("freq").alias("a"), words.alias("words"))
    within = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")),
        )
    )
    covers = phrases.where("k > 2").select("lang", F.explode(within).alias("phrase"), F.col("a").alias("cover")).groupBy("lang", "phrase").agg(F.max("cover").alias("cover"))
    kept = phrases.join(covers, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("cover") < percent * F.col("a"), F.lit(True)))
    # Every cut of a phrase has two parts; both are looked up in one join.
    sides = kept.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("part")),
                F.struct(F.lit(1).alias("side"), F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ").alias("part")),
            )
        ).alias("part"),
    ).select("lang", "phrase", "a", "cut", "part.side", "part.part")
    parts = sides.join(frequent.select("lang", F.col("phrase").alias("part"), "freq"), ["lang", "part"])
    cuts = parts.groupBy("lang", "phrase", "a", "cut").agg(F.max(F.when(F.col("side") == 0, F.col("freq"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("freq"))).alias("r"))
    # Up to 10^15 for a, l and r and 10^18 for n: the products stay exact.
    score = F.expr("(CAST(a AS DECIMAL(15, 0)) * CAST(n AS DECIMAL(18, 0)) * CAST(1000 AS DECIMAL(4, 0))) DIV (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))")
    scored = cuts.join(totals, "lang")
    best = scored.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    flat = best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    return flat.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
f AS (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM starts, range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
longer AS (
    SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + size - 1], ' ') AS phrase, max(f) AS cover
    FROM f, range(2, 5) AS sizes(size), range(1, 5) AS places(i) WHERE size < k AND i + size - 1 <= k GROUP BY 1, 2),
kept AS (SELECT f.* FROM f LEFT JOIN longer USING (lang, phrase) WHERE k > 1 AND coalesce(100 * cover < 100 * f, true)),
cuts AS (
    SELECT x.lang, x.phrase, x.f AS a, l.f AS l, r.f AS r, n, cut, 1000::HUGEINT * x.f * n // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) x
    JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(string_split(x.phrase, ' ')[1:cut], ' ')
    JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(string_split(x.phrase, ' ')[cut + 1:], ' ')
    JOIN totals t ON t.lang = x.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
