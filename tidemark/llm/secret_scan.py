"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

Patterns find assigned secrets, access keys and long hexadecimal strings. Their values are the
labelled sample of random strings; words of letters and underscores, and numbers, of
eight characters or more, are the labelled sample of ordinary identifiers. Both train a first-order Markov model
of characters over all documents. Any other unbroken token of sixteen characters or more is
compared by the two models: if its log-likelihood ratio exceeds ``threshold`` it is a secret,
too. Pattern spans always stay; a token that touches one is not judged again.

Everything is built from DataFrame expressions. A document is searched once; what it holds is
written as a narrow table, from which the random model is trained and the tokens are judged.
The model has one number for each pair of characters and is all that reaches the driver.

Positions are code points, the end exclusive. Defined cases: null text is empty; a text without
findings has empty lists; without any sample a model is uniform; rows are judged one by one,
so equal ids or rows do no harm; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import cut

#: Kind, pattern, group that holds the value, least length of the value.
PATTERNS = [
    (
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
]
KINDS = [kind for kind, *_ in PATTERNS] + ["random"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
IDENTIFIER = r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z_]{8,}|[0-9]{8,})(?![A-Za-z0-9+/_-])"
#: Log-likelihood ratio from which a token is random: e**10 to one.
THRESHOLD = 10.0
PRIOR = 20
#: Matches of a text in a piece, a piece of that, and so on: lists that grow stay short in a text
#: of any length.
PIECES = [1 << 16, 1 << 12, 1 << 8, 1 << 4]
_CODES = len(ALPHABET) + 1
_SPANS = "array<struct<start:int,end:int,value:string>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once and not at each use inside of inner functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(items: Column, size: int) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(size))
    return F.transform(starts, lambda at: F.slice(items, at + 1, size))


def _state(kind: str) -> Column:
    return F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))


def _folded(matches: Column) -> Column:
    """(at, spans) of a few matches: their length with the gaps before them, and where they are."""

    def step(state: Column, x: Column) -> Column:
        start = (state["at"] + F.length(x["_gap"])).cast("int")
        end = (start + F.length(x["_all"])).cast("int")
        span = F.struct(start.alias("start"), end.alias("end"), x["_value"].alias("value"))
        more = F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        return F.when(x["_all"].isNull(), state).otherwise(more)

    return F.aggregate(matches, _state(_SPANS), step)


def _joined(pieces: Column) -> Column:
    """(at, spans) of consecutive pieces that each have their own."""

    def step(state: Column, piece: Column) -> Column:
        moved = F.transform(piece["spans"], lambda s: F.struct(
            (s["start"] + state["at"]).cast("int").alias("start"),
            (s["end"] + state["at"]).cast("int").alias("end"), s["value"].alias("value"),
        ))
        return F.struct(
            (state["at"] + piece["at"]).cast("int").alias("at"),
            F.concat(state["spans"], F.array(moved)).alias("spans"),
        )

    return F.aggregate(pieces, _state(f"array<{_SPANS}>"), step, lambda s: F.struct(
        s["at"].alias("at"), F.flatten(s["spans"]).alias("spans")
    ))


def _placed(matches: Column, sizes: list[int]) -> Column:
    if not sizes:
        return _folded(matches)
    return _joined(F.transform(_pieces(matches, sizes[0]), lambda piece: _placed(piece, sizes[1:])))


def _apart(tokens: Column, spans: Column, sizes: list[int]) -> Column:
    """Tokens that touch no span; a piece of the tokens meets the spans of its own stretch only."""

    def touching(piece: Column) -> Column:
        first, last = F.get(piece, F.lit(0))["start"], F.element_at(piece, -1)["end"]
        near = F.filter(spans, lambda s: (s["start"] < last) & (first < s["end"]))
        return _bound(near, lambda near: _apart(piece, near, sizes[1:]))

    if not sizes:
        return F.filter(tokens, lambda t: ~F.exists(
            spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])
        ))
    return F.flatten(F.transform(_pieces(tokens, sizes[0]), touching))


def _free(tokens: Column, spans: Column) -> Column:
    def either(both: Column) -> Column:
        few = (F.size(both["tokens"]) <= PIECES[-1]) | (F.size(both["spans"]) == 0)
        return F.when(few, _apart(both["tokens"], both["spans"], [])).otherwise(
            _apart(both["tokens"], both["spans"], PIECES)
        )

    return _bound(F.struct(tokens.alias("tokens"), spans.alias("spans")), either)


def _find(rows: DataFrame, name: str, pattern: str, group: int, least: int) -> DataFrame:
    """rows with ``name``: spans of the leftmost non-overlapping matches of ``text`` whose value
    has ``least`` characters, placed by the lengths of the texts between the matches."""
    here = F.col("text").rlike(pattern)
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        "_gap": F.when(here, F.split("text", pattern, -1)).otherwise(none),
        "_all": F.when(here, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
        "_value": F.when(here, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none),
    })

    found = F.arrays_zip("_gap", "_all", "_value")
    spans = _bound(found, lambda found: F.when(
        F.size(found) <= PIECES[-1], _folded(found)["spans"]
    ).otherwise(_placed(found, PIECES)["spans"]))
    kept = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return rows.withColumn(name, kept).drop("_gap", "_all", "_value")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, token): spans of the patterns, and tokens to judge."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern, group, least in PATTERNS:
        rows = _find(rows, kind, pattern, group, least)
    return _find(rows, "token", TOKEN, 0, 16).drop("text")


def _pairs(values: DataFrame) -> DataFrame:
    """(pair, n): how many values hold each pair of neighbouring characters, so that a long value
    says no more than others."""
    return values.where(F.length("value") > 1).select(
        F.explode(F.array_distinct(_pair_codes(F.col("value")))).alias("pair")
    ).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _pair_codes(value: Column) -> Column:
    def code(i: Column) -> Column:
        return F.call_function("instr", F.lit(ALPHABET), F.substr(value, i, F.lit(1)))

    return F.transform(
        F.sequence(F.lit(1), F.length(value) - 1), lambda i: code(i) * _CODES + code(i + 1)
    )


def _conditional(counts: dict[int, int]) -> list[float]:
    """log P(second | first), smoothed by ``PRIOR`` characters of the model's own frequencies."""
    table = [[counts.get(a * _CODES + b, 0) for b in range(_CODES)] for a in range(_CODES)]
    single = [sum(column) + 1 for column in zip(*table, strict=True)]
    total = sum(single)
    return [
        math.log((n + PRIOR * single[b] / total) / (sum(row) + PRIOR))
        for row in table for b, n in enumerate(row)
    ]


def train(found: DataFrame, docs: DataFrame) -> list[float]:
    """Log-likelihood ratio, random to ordinary, of each pair of characters."""
    values = found.select(F.explode(F.concat("assign", "access", "hex")).alias("s")).select("s.value").distinct()
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    both = [_conditional({r.pair: r.n for r in _pairs(x).collect()}) for x in (values, words)]
    return [a - b for a, b in zip(*both, strict=True)]


def _numbered(spans: str, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")
    ))


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans): all spans (start, kind, end) of each document, in order."""
    found = cut(find(docs), "secrets")
    ratio = F.split(F.lit(",".join(map(repr, train(found, docs)))), ",").cast("array<double>")

    def score(value: Column) -> Column:
        return F.aggregate(
            _pair_codes(value), F.lit(0.0), lambda total, pair: total + F.element_at(ratio, pair + 1)
        )

    base = F.concat("assign", "access", "hex")
    rows = found.withColumn("_base", base).withColumn("_free", _free(F.col("token"), F.col("_base"))).withColumn(
        "random", F.filter("_free", lambda t: score(t["value"]) > threshold)
    )
    numbered = [_numbered(kind, k) for k, kind in enumerate(KINDS)]
    return rows.select("doc_id", F.array_sort(F.concat(*numbered)).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        )), ",",
    )


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every document."""
    rows = scan(docs, threshold)
    n = [_count(kind) for kind in range(len(KINDS))]
    base = F.filter("spans", lambda s: s["kind"] < len(PATTERNS))
    return rows.select(
        "doc_id", *n[:-1], F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"), n[-1],
    )
