"""Token counts from pre-token frequencies, without making ids.

1. Vocabulary: every text gives its distinct pre-tokens; a grouped sum makes one row per distinct
   pre-token with its frequency, and the tokenizer's merges count the pieces of each row once.
2. Join: the ``FREQUENT`` commonest pre-tokens (a bounded broadcast) are summed while a document's
   frequencies are counted; the frequencies of all others are joined by shuffle on the pre-token.
3. Sum: known part plus joined part per document row.

Scale. The first shuffle holds the distinct pre-tokens of each task's share, the second only
rare pre-tokens, so neither follows the number of tokens. A rare pre-token occurs less often than every broadcast
one, so its join partition stays small. No document is gathered in one place.

Special strings inside texts are single tokens, as is the library's default. Defined results: null
and empty texts have 0 tokens and 0 bytes; repeated rows (also with equal ids) get a
row each; null ids stay null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm import pretokens
from proofmill.llm.common import sliced
from proofmill.session import ship_code, stored

#: Most frequent pre-tokens that are broadcast (some 10 MB).
FREQUENT = 150_000
#: Distinct parts that a task collects before it emits them.
HELD = 200_000
#: Marks a part that holds a rare pre-token; far above any count of one document.
_RARE = 1 << 40


def _parts(text: str, path: str) -> tuple[list[str], int]:
    """White-space parts of the text and the number of special strings in it."""
    pattern, _ = pretokens.specials(path)
    if pattern is None or not pattern.search(text):
        return pretokens.word_chunks(text, path), 0
    split = pattern.split(text)
    return [c for part in split[::2] if part for c in pretokens.word_chunks(part, path)], len(split) // 2


def vocabulary(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(pre, freq, pieces) of every distinct pre-token in the texts."""
    ship_code(docs.sparkSession)

    def emit(parts: Counter) -> pa.RecordBatch:
        found: Counter = Counter()
        for part, n in parts.items():
            for pre in pretokens.word_pretokens(part, tokenizer_path):
                found[pre] += n
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["pre", "freq"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    held.update(_parts(text, tokenizer_path)[0])
                if len(held) > HELD:
                    yield emit(held)
                    held = Counter()
        yield emit(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pretokens.load(tokenizer_path).model
        for batch in batches:
            pieces = [len(model.tokenize(pretokens.byte_level(pre))) for pre in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], names=["pre", "freq", "pieces"])

    seen = docs.select(F.col(text_col).alias("text")).mapInArrow(distinct, "pre string, freq long")
    return seen.groupBy("pre").agg(F.sum("freq").alias("freq")).mapInArrow(count, "pre string, freq long, pieces long")


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row of ``docs``."""
    spark = docs.sparkSession
    vocab = stored(vocabulary(docs, tokenizer_path, text_col), "pretokens")
    # Steps of an eighth of a power of two: a histogram of a few hundred rows says from which frequency on the commonest fit.
    step = F.floor(F.log2(F.col("freq").cast("double")) * 8).cast("int")
    sizes = vocab.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    cut, held = 1 << 30, 0
    for size in sizes:
        held += size["count"]
        if held > frequent:
            break
        cut = size["step"]
    top = vocab.where(step >= cut).select("pre", "pieces").toPandas()
    shared = spark.sparkContext.broadcast(dict(zip(top["pre"], top["pieces"].astype(int).tolist(), strict=True)))
    del top

    class Known(dict):
        """Tokens of a part; a part with a rare pre-token also carries the mark."""

        def __init__(self, common: dict[str, int]) -> None:
            self.common = common

        def __missing__(self, part: str) -> int:
            total = 0
            for pre in pretokens.word_pretokens(part, tokenizer_path):
                n = self.common.get(pre)
                total += _RARE if n is None else n
            if len(self) > HELD:
                self.clear()
            self[part] = total
            return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        known = Known(common)
        for batch in sliced(batches):
            places, pres, counts = [], [], []
            for place, text in enumerate(batch.column("text").to_pylist()):
                parts, total = _parts(text, tokenizer_path) if text else ([], 0)
                total += sum(map(known.__getitem__, parts))
                places.append(place)
                pres.append(None)
                counts.append(total % _RARE)
                if total >= _RARE:
                    rare: Counter = Counter()
                    for part in parts:
                        if known[part] >= _RARE:
                            rare.update(p for p in pretokens.word_pretokens(part, tokenizer_path) if p not in common)
                    places += [place] * len(rare)
                    pres += rare.keys()
                    counts += rare.values()
            rows = batch.select(["row", "doc_id", "n_bytes"]).take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(pres, pa.string()), pa.array(counts, pa.int64())], names=["row", "doc_id", "n_bytes", "pre", "n"]
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), F.col(text_col).alias("text"),
    )
    parts = stored(rows.mapInArrow(run, "row long, doc_id long, n_bytes long, pre string, n long"), "frequencies")
    joined = parts.where("pre IS NOT NULL").join(vocab.select("pre", "pieces"), "pre")
    return (
        parts.where("pre IS NULL")
        .select("row", "doc_id", "n_bytes", "n")
        .unionByName(joined.select("row", "doc_id", "n_bytes", (F.col("n") * F.col("pieces")).alias("n")))
        .groupBy("row", "doc_id", "n_bytes")
        .agg(F.sum("n").alias("n_tokens"))
        .drop("row")
    )
