"""Words, folds and digests shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What stands between words, after ``lower_ascii``: ASCII characters but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in texts as they are, and the words there.
BETWEEN_ANY, WORD_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null reads as empty.

    Where all characters are ASCII, ``lower`` does the same and is much faster.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of a text, in order. Splitting takes a third of the time that extracting them does."""
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def fold(doc_id: Column) -> Column:
    """0, 1 or 2 by the document's number; null without one."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without a number is not held out, nor learnt from."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def joined_digest(values: Column) -> Column:
    """SHA-256 of an array's values as sorted strings with commas between."""
    texts = F.array_sort(F.transform(values, lambda v: v.cast("string")))
    return F.sha2(F.array_join(texts, ",").cast("binary"), 256)


def unused(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the table has it, in either case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
