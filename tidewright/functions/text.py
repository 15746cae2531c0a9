"""Text functions as column expressions. All regular expressions name their Unicode classes explicitly."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

#: Blanks in the sense of Unicode, in a form that Java reads.
BLANK = r"\s\x0B\p{Z}\x{1C}-\x{1F}\x{85}"
#: One word; one token (a word, or a single character that is neither a word nor blank).
WORD = r"[\p{L}\p{N}_]+"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{BLANK}]"
#: Marks that are neither words nor blanks.
MARK = rf"[^\p{{L}}\p{{N}}_{BLANK}]"


def squash(text: Column) -> Column:
    """Every run of blanks one space, none at the ends; null becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{BLANK}]+", " "))


def squashed_or_null(text: Column) -> Column:
    """:func:`squash`, with null for blank text."""
    return F.nullif(squash(text), F.lit(""))


def first_filled(columns: list[Column]) -> Column:
    """The first column that is not blank, squashed; null if all are."""
    return F.coalesce(*[squashed_or_null(c) for c in columns], F.lit(None).cast("string")) if columns else F.lit(None).cast("string")


def token_count(text: Column) -> Column:
    """Words and single marks in ``text``; null counts as empty."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)))


def words(text: Column, lower: bool = True, strip_marks: bool = True) -> Column:
    """The words of ``text`` in order. Marks end a word whether or not they are stripped, so ``strip_marks`` changes nothing."""
    source = F.coalesce(text, F.lit(""))
    source = F.lower(source) if lower else source
    return F.regexp_extract_all(source, F.lit(WORD), F.lit(0))


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


def distinct_runs(hashed: np.ndarray, length: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the distinct hashes of all runs of ``size`` tokens of each row, and how many each row has.

    ``hashed`` holds the token hashes of all rows one after the other, ``length`` their numbers. Fewer tokens have no run,
    or are one run with ``short``.
    """
    if short:  # rows that are too short are filled up with a mark that stands for no token
        lacking = np.where((length > 0) & (length < size), size - length, 0)
        if lacking.any():
            at = np.repeat(np.cumsum(length), lacking)
            hashed = np.insert(hashed, at, np.uint64(0x5851F42D4C957F2D))
            length = length + lacking
    rows = len(length)
    count = len(hashed) - size + 1
    owner = np.repeat(np.arange(rows), length)
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    found = _mixed(hashed[:count])
    for k in range(1, size):
        found = _mixed(found + hashed[k : k + count])
    inside = owner[:count] == owner[size - 1 :]
    found, owner = found[inside], owner[:count][inside]
    # one sort key of row and upper bits; neighbours are compared in full
    bits = np.uint64(max(1, int(rows).bit_length()))
    order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (found >> bits))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.bincount(owner[new], minlength=rows)


def token_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def ngram_hashes(tokens: Column, size: int, short: bool = False) -> Column:
    """Distinct 64-bit hashes of the runs of ``size`` tokens; fewer tokens have none, or are one run with ``short``.

    Each token is hashed once in the JVM, the runs of hashes in Arrow batches, so no strings are joined.
    """

    def runs(lists: pa.Array) -> pa.Array:
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        found, count = distinct_runs(values, np.diff(lists.offsets.to_numpy()).astype(np.int64), size, short)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(found.view(np.int64)))

    return F.arrow_udf(runs, ArrayType(LongType()))(token_hashes(tokens))


def alphanumeric_ratio(text: Column) -> Column:
    """Share of letters and digits among all characters; 0 for empty and null text."""
    source = F.coalesce(text, F.lit(""))
    kept = F.length(F.regexp_replace(source, r"[^\p{L}\p{N}]", ""))
    return F.when(F.length(source) > 0, kept / F.length(source)).otherwise(F.lit(0.0))


def _sorted_json(values: pa.Array) -> pa.Array:
    def render(value: str | None) -> str | None:
        if value is None:
            return None
        try:
            return json.dumps(json.loads(value), ensure_ascii=False, sort_keys=True)
        except ValueError:
            return value

    return pa.array([render(v) for v in values.to_pylist()], pa.string())


def sorted_json(text: Column) -> Column:
    """JSON with sorted keys and a space after commas and colons, non-ASCII kept; text that is no JSON as it is.

    Runs in Python (Arrow batches), because the JVM's writer keeps the order of the schema; call it on rows that have
    such values only.
    """
    return F.arrow_udf(_sorted_json, StringType())(text)


def stable_id(source: Column, position: Column, text: Column) -> Column:
    """``source-position-digest`` with the position in eight digits and twelve digits of the text's SHA-1."""
    return F.format_string("%s-%08d-%s", source, position, F.substring(F.sha1(text), 1, 12))
