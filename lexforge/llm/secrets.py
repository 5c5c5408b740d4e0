"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens with control of false discoveries.

A token of 20 or more characters whose alphabet is that of an encoding (hexadecimal, base32, base62, base64) is tested for
what a random string of that alphabet satisfies: equal use of symbols (chi-squared), runs above and below the middle
of the alphabet, and correlation of neighbours. The three p-values are combined by Bonferroni. Over the whole corpus, tokens of one
encoding and length class (a power of two) form one family, and the Benjamini-Hochberg rule at rate ``RATE``
decides which are not random. The others are secrets.

Defined cases: a null or empty text has no spans; positions are code points, ends exclusive; rows are treated one by one, so repeated
rows and null ids give rows of their own; an empty table gives an empty result; a column of the input named
like a result column is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = 0.01
KINDS = ("assign", "access", "hex", "random")
MASK = "[secret]"
#: p-values are kept as steps of a hundredth of a power of ten, at most so many
STEPS = 30_000

# The patterns of the three base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")

_LONG = re.compile("[A-Za-z0-9+/_-]{20,}")
_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
#: encoding: its alphabet in the order of its values, and the classes of characters of which a token must hold one each
ENCODINGS = {
    "hex": (_DIGITS + "abcdef", (_DIGITS, "abcdef")),
    "hex_upper": (_DIGITS + "ABCDEF", (_DIGITS, "ABCDEF")),
    "base32": (_UPPER + "234567", (_UPPER, "234567")),
    "base36": (_DIGITS + _LOWER, (_DIGITS, _LOWER)),
    "base36_upper": (_DIGITS + _UPPER, (_DIGITS, _UPPER)),
    "base62": (_DIGITS + _UPPER + _LOWER, (_DIGITS, _UPPER, _LOWER)),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", (_UPPER, _LOWER, _DIGITS)),
    "base64url": (_UPPER + _LOWER + _DIGITS + "-_", (_UPPER, _LOWER, _DIGITS)),
}
_VALUES = {name: ({c: i for i, c in enumerate(alphabet)}, frozenset(alphabet), [frozenset(x) for x in must])
           for name, (alphabet, must) in ENCODINGS.items()}


class Candidate(NamedTuple):
    start: int
    end: int
    family: str
    step: int


def encoding_of(token: str) -> str | None:
    """The smallest encoding whose alphabet holds the token and each of whose classes the token uses."""
    used = frozenset(token)
    for name, (_, alphabet, must) in _VALUES.items():
        if used <= alphabet and all(used & x for x in must):
            return name
    return None


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(values: list[int], size: int) -> float:
    """Chance that random symbols are used as unevenly: Wilson-Hilferty, with the variance of short strings."""
    n = len(values)
    if n < 2:
        return 1.0
    x = sum(c * c for c in Counter(values).values()) * size / n - n
    # the gamma law with the statistic's own mean and variance is a scaled chi-squared law
    scale = 1 - 1 / n
    free = (size - 1) / scale
    third = 2 / (9 * free)
    return _upper_tail((max(x / scale / free, 0.0) ** (1 / 3) - (1 - third)) / math.sqrt(third))


def runs_p(values: list[int], size: int) -> float:
    """Chance of so few or many runs above and below the middle of the alphabet, given how many lie on each side."""
    high = [v >= size / 2 for v in values]
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return min(1.0, 2 * 0.5**n)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    mean = 2 * a * b / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 1.0 if variance <= 0 else 2 * _upper_tail(max(0.0, abs(runs - mean) - 0.5) / math.sqrt(variance))


def serial_p(values: list[int]) -> float:
    """Chance of so strong a correlation between neighbours."""
    n = len(values)
    mean = sum(values) / n
    about = [v - mean for v in values]
    power = sum(v * v for v in about)
    if n < 3 or not power:
        return 0.0
    r = sum(x * y for x, y in zip(about, about[1:])) / power
    return 2 * _upper_tail(abs(r + 1 / n) * math.sqrt(n))


def battery(token: str) -> tuple[str, int] | None:
    """(family, step) of a token: its encoding and length class, and its combined p-value as -100 log10, rounded down."""
    name = encoding_of(token)
    if name is None:
        return None
    place, alphabet, _ = _VALUES[name]
    values = [place[c] for c in token]
    p = min(1.0, 3 * min(chi_squared_p(values, len(alphabet)), runs_p(values, len(alphabet)), serial_p(values)))
    step = STEPS if p <= 0 else min(STEPS, int(-100 * math.log10(p)))
    return f"{name}/{len(token).bit_length()}", step


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and without overlap inside a kind, by start and then kind."""
    found = []
    small = text.lower()
    if any(w in small for w in WORDS_OF_ASSIGN):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    # a run of the two other kinds lies inside one long token, and ends where the run ends in the text
    for m in _LONG.finditer(text):
        token, at = m[0], m.start()
        found += [("access", at + x.start(), at + x.end()) for x in ACCESS.finditer(token) if x.end() - x.start() >= 20]
        found += [("hex", at + x.start(), at + x.end()) for x in HEX.finditer(token) if x.end() - x.start() >= 24]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[Candidate]:
    """Long tokens of an encoding that touch no base span, with their test results."""
    out = []
    for m in _LONG.finditer(text):
        if any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        if (tested := battery(m[0])) is not None:
            out.append(Candidate(m.start(), m.end(), *tested))
    return out


_FOUND = T.StructType([T.StructField("family", T.StringType()), T.StructField("step", T.IntegerType()), T.StructField("n", T.LongType())])


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0):
            text = text.as_py() or ""
            counts.update((c.family, c.step) for c in candidates(text, base_spans(text)))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array([counts[k] for k in keys], pa.int64())], names=["family", "step", "n"])


def cut_steps(docs: DataFrame, text: str = "text", rate: float = RATE) -> dict[str, int]:
    """{family: first step that is not random} by the Benjamini-Hochberg rule over all tokens of the table.

    Tokens are counted per family and step, so what comes to the driver is one row for each of the few families, whatever the
    size of the table.
    """
    counts = docs.select(text).mapInArrow(_tested, _FOUND).groupBy("family", "step").agg(F.sum("n").alias("n"))
    per_family = counts.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("step", "n")), asc=False).alias("steps"))
    cuts = {}
    for family, steps in per_family.collect():
        total = sum(n for _, n in steps)
        seen = 0
        for step, n in steps:
            seen += n
            if 10 ** (-step / 100) <= rate * seen / total:
                cuts[family] = step
    return cuts


def scan(text: str, cuts: dict[str, int]) -> list[tuple[str, int, int]]:
    """All spans of a text: the base ones, and random tokens, by start and then kind."""
    base = base_spans(text)
    added = [("random", c.start, c.end) for c in candidates(text, base) if c.step < cuts.get(c.family, STEPS + 1)]
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, or run of spans that overlap, replaced by MASK."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame, text: str = "text", rate: float = RATE, mask: bool = False) -> DataFrame:
    """Add ``spans`` (kind, start, end) to every row; with ``mask`` the text has them replaced.

    The table is read twice: once for the counts of the tests, once for the spans.
    """
    cuts = cut_steps(docs, text, rate)
    kept = docs.drop("spans")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            spans = [scan(t or "", cuts) for t in texts]
            columns = batch.columns
            if mask:
                columns[at] = pa.array([t if not s else masked(t, s) for t, s in zip(texts, spans)], batch.schema.field(at).type)
            items = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(items, pa.list_(_SPAN))], names=[*batch.schema.names, "spans"])

    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return kept.mapInArrow(found, T.StructType([*kept.schema.fields, T.StructField("spans", T.ArrayType(span))]))


def secret_digests(found: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans as text."""
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
