"""Arrow functions for what no built-in expresses: compatibility form, all match positions, option rows."""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility form."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


SPANS = T.ArrayType(T.StructType([T.StructField("ix", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("groups", T.ArrayType(T.StringType()))]))


def regex_spans(pattern: str):
    """A column function: all matches of a Python pattern with their positions in code points."""
    compiled = re.compile(pattern)

    @F.arrow_udf(SPANS)
    def spans(text: pa.Array) -> pa.Array:
        # Columns of plain numbers and one of texts: a Python object for each match of a batch would need many times that.
        offsets, number, start, end, words, groups = [0], array("i"), array("i"), array("i"), [], []
        nulls = []
        for x in text:
            i = 0
            for i, m in enumerate(compiled.finditer(x.as_py()) if x.is_valid else (), 1):
                number.append(i - 1)
                start.append(m.start())
                end.append(m.end())
                words.append(m[0])
                groups.extend(m.groups())
            offsets.append(offsets[-1] + i)
            nulls.append(not x.is_valid)
        ints = lambda values: pa.array(values, pa.int32())
        groups_ = pa.ListArray.from_arrays(ints(range(0, (len(words) + 1) * compiled.groups, compiled.groups) if compiled.groups else [0] * (len(words) + 1)), pa.array(groups, pa.string()))
        found = pa.StructArray.from_arrays([ints(number), ints(start), ints(end), pa.array(words, pa.string()), groups_], names=["ix", "start", "end", "text", "groups"])
        return pa.ListArray.from_arrays(ints(offsets), found, mask=pa.array(nulls, pa.bool_()))

    return spans


OPTIONS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("recovered", T.BooleanType())]))


@lru_cache
def _markers(chars: str, separators: str) -> re.Pattern:
    """A label before a separator; not the end of a word, though a letter alone may stand before it."""
    return re.compile(rf"(?<![A-Za-z0-9][A-Za-z])([{re.escape(chars)}])[{re.escape(separators)}]")


def option_row(text: str, chars: str = "ABCDEFGH", separators: str = ".．、:：") -> list[dict]:
    """The options of a line, from all its markers in one pass.

    The least label that stands there begins; after it every next label of the alphabet counts where it first
    comes, and one that does not come ends the row. Text before the first marker, if labels are missing before
    it, is the option of the label just before, whose marker was lost.
    """
    marks = list(_markers(chars, separators).finditer(text))
    if not marks:
        return []
    due = min(chars.index(m[1]) for m in marks)
    taken: list[re.Match] = []
    for m in marks:
        if due < len(chars) and m[1] == chars[due]:
            taken.append(m)
            due += 1
    first = chars.index(taken[0][1])
    edges = [m.start() for m in taken] + [len(text)]
    out = [{"label": m[1], "start": m.start(), "end": end, "text": text[m.end() : end].strip(), "recovered": False} for m, end in zip(taken, edges[1:])]
    if first:
        lost = chars[first - 1]
        head = text[: edges[0]].strip().removeprefix(lost).lstrip(separators).strip()
        if head:
            out.insert(0, {"label": lost, "start": 0, "end": edges[0], "text": head, "recovered": True})
    return out


def split_options(chars: str = "ABCDEFGH", separators: str = ".．、:："):
    """A column function: the options of a line of text."""

    @F.pandas_udf(OPTIONS)
    def options(text: pd.Series) -> pd.Series:
        return text.map(lambda x: None if x is None else option_row(x, chars, separators))

    return options
