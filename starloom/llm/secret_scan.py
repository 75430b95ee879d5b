"""Secrets in texts: an Aho-Corasick prefilter, anchored expressions near its hits, embedded checksums.

One automaton finds every keyword of all kinds in a text with its ASCII capitals lowered, a second
one runs of hexadecimal digits in the text reduced to digit or not. An expression is tried
only where a keyword starts, never searched for, so texts without hits cost no expression.
Tokens that carry a checksum of their own are kept only if it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The kinds in the order that sorts spans of one start.
BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm")
KINDS = BASE_KINDS + CHECKED_KINDS
#: The keywords of each kind, in lower case.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
HEX_RUN = 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

EXPRESSIONS = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]+)"),
    "npm": re.compile(r"npm_([0-9A-Za-z]+)"),
}


def base62_crc32(text: str) -> str:
    """The checksum that such tokens end with: crc32 in six base-62 digits."""
    value, digits = zlib.crc32(text.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _sealed(m: re.Match) -> bool:
    """Thirty characters and their checksum."""
    return len(m[1]) == 36 and m[1][30:] == base62_crc32(m[1][:30])


#: Which matches count; the others still use up their text.
VALID: dict[str, Callable[[re.Match], bool]] = {
    "assign": lambda m: len(m[1]) >= 6,
    "access": lambda m: m.end() - m.start() >= 20,
    "hex": lambda m: m.end() - m.start() >= HEX_RUN,
    "github": _sealed,
    "npm": _sealed,
}

#: One character for each code point: ASCII with capitals lowered, and hexadecimal digits as x; all else is one filler.
LOWERED = np.array([*range(65), *range(97, 123), *range(91, 128), 1], dtype=np.uint8)
DIGITS = np.array([ord("x") if chr(c) in "0123456789abcdef" else 46 for c in range(129)], dtype=np.uint8)


@lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    words, digits = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for word in keywords:
            words.add_word(word, (kind, len(word)))
    digits.add_word("x" * HEX_RUN, HEX_RUN)
    words.make_automaton()
    digits.make_automaton()
    return words, digits


def _starts(text: str) -> dict[str, list[int]]:
    """Where keywords of each kind start, ascending."""
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)
    words, digits = _automata()
    found: dict[str, list[int]] = {}
    for end, (kind, n) in words.iter(LOWERED[codes].tobytes().decode("ascii")):
        found.setdefault(kind, []).append(end - n + 1)
    for starts in found.values():
        starts.sort()
    last = -2
    for end, n in digits.iter(DIGITS[codes].tobytes().decode("ascii")):
        if end != last + 1:  # else the same run goes on
            found.setdefault("hex", []).append(end - n + 1)
        last = end
    return found


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets in code points, ordered by start, then kind as listed.

    Matches of a kind are the leftmost that do not overlap: each starts with a keyword, so trying
    the keywords' places in order, from the end of the last match, finds what a search would.
    """
    out = []
    for kind, starts in _starts(text).items():
        free = 0
        for at in starts:
            if at >= free and (m := EXPRESSIONS[kind].match(text, at)):
                free = m.end()
                if VALID[kind](m):
                    out.append((at, free, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def find_secrets(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row of ``docs`` (text, more columns) and spans: array of (kind, start, end).

    Whole texts are scanned; start and end (exclusive) are code points. Kinds: ``assign``, a value of
    six characters or more assigned to a telling name; ``access``, access key ids; ``hex``, runs of 24
    or more lower-case hexadecimal digits; ``github`` and ``npm``, tokens whose last six characters are
    the checksum of the thirty before. Spans of different kinds may overlap.

    Null and empty texts: no spans. Rows are independent, so null and repeated ids, ties and empty
    tables need no rule. A text of any length is scanned in one piece, in some 25 bytes a
    character. A column to carry must not be called spans, which raises. One pass, no shuffle.
    """
    if "spans" in carry:
        raise ValueError("columns to carry clash with the result: spans")
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("spans", T.ArrayType(span, False))])
    kind = pa.list_(pa.field("element", pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(t.as_py())] if t.is_valid else [] for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(found, kind)], [*carry, "spans"])

    return docs.select(*carry, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)
