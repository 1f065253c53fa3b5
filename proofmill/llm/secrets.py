"""Secret scans in DataFrame functions only: pattern matches, and sliding-window entropy of long strings.

Pattern kinds (fixed values, see ``PATTERNS``): ``assign``, ``access``, ``hex``. The method's own kind ``entropy``:
a candidate is a run of 20 or more characters of base64, URL or hex alphabets with two of lower-case letters, capitals and
digits. A window of 20 characters slides over it; counts per character are kept up step by step, so
a step costs the same at any length, and the window's Shannon entropy follows from two changed counts.
Windows at or above the limit of the candidate's character class (hex or mixed) make a span from the
first such window to the last. Candidates on the allow-list are left out: what is made of words, numbers, dates or an identifier
(``ALLOWED``), and runs that are too short without the parts that say ``example``. It never touches the pattern kinds.

Entropy is held in whole numbers (the sum of c*log2(c) in millionths), so every engine finds the same windows.

Scale. Two pattern tests per text tell the rows that may have a match from those that have none, which are never shuffled, and no
text is copied. Entropy is worked out on the scan; only matches are exploded, and a match's position is a running sum of lengths
within its row. Rows are known by their place in their file. Nothing depends on a key of the input, so no source can be hot. Offsets count
code points, ends are exclusive.

Defined results. Null and empty texts have no spans; repeated rows get a row each; null ids stay
null; an empty table gives an empty result. Results come as one struct column (``secrets`` if not named otherwise), replacing one
of that name; all other columns stay, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proofmill.llm.common import identified

# The base patterns as they are defined, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
KINDS = list(PATTERNS)
ASSIGN_LEAST = 6

_WORD = "(?:[A-Z]?[a-z]{1,30}|[A-Z]{1,30}|[0-9]{1,8})"
#: Strings that look random and are none: identifiers, dates and times, separators, words and numbers in groups, words written together.
ALLOWED = [
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^[0-9TZ+/_=-]+$",
    rf"^[/_=-]*{_WORD}(?:[/_=-]+{_WORD})+[/_=-]*$",
    r"^[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*[0-9]{0,4}$",
]
#: Parts of a run with such a word do not count.
EXAMPLE = "EXAMPLE|[Ee]xample"
#: A run has two of these.
CLASSES = ["[a-z]", "[A-Z]", "[0-9]"]
WINDOW = 20
#: Least entropy (bits per character) of a window, by character class.
LEAST = {"hex": 2.9, "mixed": 3.8}
SCALE = 1_000_000


def weight(count: int) -> int:
    """c * log2(c) in millionths."""
    return round(count * math.log2(count) * SCALE) if count else 0


_WINDOW_TYPE = "struct<first:int,last:int>"


def most(bits: float, window: int) -> int:
    """The largest sum of weights with which a window still has ``bits`` of entropy."""
    return math.floor(window * (math.log2(window) - bits) * SCALE)


def _matches(text: Column, kind: str, allowed: list[str]) -> Column:
    """Per match: kind, place, length of the gap before it, its length, the length that counts, and the span of enough entropy in a candidate."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else whole
    k = KINDS.index(kind)
    both = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), counted.alias("counted"))
    rows = F.transform(
        F.slice(both, F.lit(1), F.size(whole)),
        lambda m, i: F.struct(
            F.lit(k).alias("kind"), i.alias("place"), F.char_length(m["gap"]).alias("gap"), F.char_length(m["whole"]).alias("length"),
            F.char_length(m["counted"]).alias("counted"),
            (F.when(_wanted(m["whole"], allowed), entropy_span(m["whole"])) if kind == "entropy" else F.lit(None).cast(_WINDOW_TYPE)).alias("w"),
        ),
    )
    return F.when(text.rlike(PATTERNS[kind]), rows)


def entropy_span(candidate: Column, window: int = WINDOW, least: dict[str, float] | None = None) -> Column:
    """struct(first, last): where windows of enough entropy begin and end in the candidate; last is 0 if there is none.

    The class is hex (one case) or mixed. Characters are counted by their code; a step adds the entering and takes off the leaving one.
    """
    least = least or LEAST
    g = F.array(*[F.lit(weight(c)) for c in range(window + 2)])
    limit = F.when(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(most(least["hex"], window))).otherwise(F.lit(most(least["mixed"], window)))
    codes = F.transform(F.split(candidate, "", -1), lambda x: F.ascii(x))
    codes = F.slice(codes, F.lit(1), F.char_length(candidate))
    start = F.struct(
        F.array_repeat(F.lit(0), 123).alias("counts"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("first"),
        F.lit(0).alias("last"), codes.alias("codes"),
    )

    def step(state: Column, code: Column) -> Column:
        old = F.when(state["at"] >= window, F.get(state["codes"], state["at"] - window)).otherwise(F.lit(-1))
        n_in = F.get(state["counts"], code)
        n_out = F.when(old < 0, F.lit(0)).otherwise(F.get(state["counts"], old) + F.when(old == code, 1).otherwise(0))
        total = (
            state["sum"] + F.get(g, n_in + 1) - F.get(g, n_in) + F.when(n_out > 0, F.get(g, n_out - 1) - F.get(g, n_out)).otherwise(F.lit(0))
        ).cast("bigint")
        hit = (state["at"] >= window - 1) & (total <= limit)
        counts = F.transform(
            state["counts"], lambda c, i: c + F.when(i == code, 1).otherwise(0) - F.when(i == old, 1).otherwise(0)
        )
        return F.struct(
            counts.alias("counts"), (state["at"] + 1).alias("at"), total.alias("sum"),
            F.when((state["first"] < 0) & hit, state["at"] - (window - 1)).otherwise(state["first"]).alias("first"),
            F.when(hit, state["at"] + 1).otherwise(state["last"]).alias("last"), state["codes"].alias("codes"),
        )

    return F.aggregate(codes, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _wanted(candidate: Column, allowed: list[str]) -> Column:
    classes = sum((candidate.rlike(c).cast("int") for c in CLASSES[1:]), candidate.rlike(CLASSES[0]).cast("int"))
    kept = F.filter(F.split(candidate, "[/_=-]+"), lambda part: ~part.rlike(EXAMPLE))
    wanted = (classes >= 2) & (~candidate.rlike(EXAMPLE) | (F.char_length(F.array_join(kept, "/")) >= WINDOW))
    for pattern in allowed:
        wanted = wanted & ~candidate.rlike(pattern)
    return wanted


def find_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, allowed: list[str] | None = None, name: str = "secrets") -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) and the struct ``name``: n_assign, n_access, n_hex, n_entropy, spans (start, kind, end)."""
    allowed = ALLOWED if allowed is None else allowed
    kept = [c for c in (keep or docs.columns) if c.lower() != name.lower()]
    needed = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_col])])
    rows, file, at = identified(needed, "secret-rows")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Every match of the other kinds is a candidate or holds one.
    dirty = text.rlike(ASSIGN) | text.rlike(CANDIDATE)
    none = F.expr("array()").cast(f"array<struct<kind:int,place:int,gap:int,length:int,counted:int,w:{_WINDOW_TYPE}>>")
    found = [F.coalesce(_matches(text, k, allowed), none) for k in KINDS]
    hits = rows.where(dirty).select(F.col(file).alias("f"), F.col(at).alias("p"), F.explode(F.concat(*found)).alias("h")).select("f", "p", "h.*")
    order = Window.partitionBy("f", "p", "kind").orderBy("place")
    placed = hits.withColumn("start", F.sum(F.col("gap") + F.col("length")).over(order) - F.col("length"))
    pattern = (F.col("kind") < 3) & ((F.col("kind") > 0) | (F.col("counted") >= ASSIGN_LEAST))
    entropy = (F.col("kind") == 3) & (F.col("w.last") > 0)
    span = F.struct(
        (F.col("start") + F.when(entropy, F.col("w.first")).otherwise(0)).alias("start"), "kind",
        (F.col("start") + F.when(entropy, F.col("w.last")).otherwise(F.col("length"))).alias("end"),
    )
    spans = placed.where(pattern | entropy).groupBy("f", "p").agg(F.sort_array(F.collect_list(span)).alias("s"))
    empty = F.expr("array()").cast("array<struct<start:bigint,kind:int,end:bigint>>")
    spans = spans.select(F.col("f").alias(file), F.col("p").alias(at), F.struct("s").alias(name))
    both = rows.where(dirty).join(spans, [file, at], "left").unionByName(rows.where(~dirty).withColumn(name, F.struct(empty.alias("s"))))
    told = F.coalesce(F.col(f"`{name}`.s"), empty)

    def count(kind: str) -> Column:
        return F.size(F.filter(told, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return both.select(*[F.col(f"`{c}`") for c in kept], F.struct(*map(count, KINDS), told.alias("spans")).alias(name))


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    spans = F.col("secrets.spans")
    return found.select(
        F.col(id_col).alias("doc_id"), "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.sha2(_named(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"), _named(spans).alias("spans"),
    )


def redact(found: DataFrame, text_col: str = "text", mark: str = "[SECRET]", name: str = "secrets") -> Column:
    """The text with every span (overlaps joined) replaced by ``mark``; texts without spans stay as they are, null included."""
    text, spans = F.col(f"`{text_col}`"), F.col(f"`{name}`.spans")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]  # spans come by start; one that begins inside the last is part of it
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    rebuilt = F.aggregate(
        spans, start, step,
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text))),
    )
    return F.when(F.size(spans) > 0, rebuilt).otherwise(text)


def _sql_matches(kind: str) -> str:
    k, p = KINDS.index(kind), PATTERNS[kind].replace("'", "''")
    part = f"regexp_extract_all(t, '{p}', 2)" if kind == "assign" else f"regexp_extract_all(t, '{p}')"
    return f"""SELECT r, {k} AS kind, unnest(range(1, len(m) + 1)) AS place, unnest(m) AS whole, unnest(g2) AS counted, unnest(g[1:len(m)]) AS gap
    FROM (SELECT r, regexp_extract_all(t, '{p}') AS m, {part} AS g2, string_split_regex(t, '{p}') AS g FROM docs) WHERE len(m) > 0"""


_WEIGHTS = "[" + ", ".join(str(weight(c)) for c in range(WINDOW + 1)) + "]"
_WANTED = " AND ".join(
    [
        f"({' + '.join(f"regexp_matches(c, '{p}')::INTEGER" for p in CLASSES)}) >= 2",
        f"(NOT regexp_matches(c, '{EXAMPLE}') OR length(array_to_string(list_filter(regexp_split_to_array(c, '[/_=-]+'), lambda x: NOT regexp_matches(x, '{EXAMPLE}')), '/')) >= {WINDOW})",
        *[f"NOT regexp_matches(c, '{p}')" for p in ALLOWED],
    ]
)
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({" UNION ALL ".join(map(_sql_matches, KINDS))}),
placed AS (
  SELECT r, kind, whole AS c, length(counted) AS counted, length(whole) AS n,
         sum(length(gap) + length(whole)) OVER (PARTITION BY r, kind ORDER BY place)::BIGINT - length(whole) AS s FROM matches),
windows AS (
  SELECT r, s, c, i, substr(c, i, {WINDOW}) AS w FROM (SELECT r, s, c, unnest(range(1, n - {WINDOW} + 2)) AS i FROM placed WHERE kind = 3 AND {_WANTED})),
weights AS (
  SELECT r, s, c, i, sum(({_WEIGHTS})[n + 1]) AS g FROM (
    SELECT r, s, c, i, ch, count(*) AS n FROM (SELECT r, s, c, i, unnest(string_split(w, '')) AS ch FROM windows) GROUP BY ALL) GROUP BY r, s, c, i),
entropy AS (
  SELECT r, 3 AS kind, s + min(i) - 1 AS s, s + max(i) - 1 + {WINDOW} AS e FROM weights
  WHERE g <= CASE WHEN regexp_matches(c, '^([0-9a-f]+|[0-9A-F]+)$') THEN {most(LEAST["hex"], WINDOW)} ELSE {most(LEAST["mixed"], WINDOW)} END GROUP BY r, weights.s, c),
spans AS (
  SELECT r, kind, s, s + n AS e FROM placed WHERE kind < 3 AND (kind > 0 OR counted >= {ASSIGN_LEAST}) UNION ALL SELECT r, kind, s, e FROM entropy),
named AS (SELECT r, kind, s, (['assign', 'access', 'hex', 'entropy'])[kind + 1] || ':' || s || ':' || e AS x FROM spans),
told AS (
  SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
         string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(x, ',' ORDER BY s, kind) AS x FROM named GROUP BY r)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(x, '') AS spans
FROM docs LEFT JOIN told USING (r)
"""
