"""Spaces that one extraction lost, put back from a second tokenisation of the same page.

The letters of the page's words are joined to one string with a bar for every
word that has none. A merged run is repaired where it occurs in that string
from the start of a word to the end of a word; the first such place wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import MERGED_RUN

_RUN = re.compile(r"\b[A-Z]{8,}\b")
_NOT_LETTER = re.compile(r"[^A-Za-z]")


class PageWords:
    """A page's words, searched by their letters."""

    def __init__(self, words: list[str]):
        self.words = words
        self.begins: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        parts, at = [], 0
        for k, word in enumerate(words):
            letters = _NOT_LETTER.sub("", word).upper()
            if letters:
                self.begins[at] = k
                self.ends[at + len(letters)] = k + 1
            parts.append(letters or "|")
            at += len(parts[-1])
        self.letters = "".join(parts)

    def spaced(self, run: str) -> str:
        """The words that spell ``run``, or ``run`` itself."""
        at = self.letters.find(run)
        while at >= 0:
            if at in self.begins and at + len(run) in self.ends:
                return " ".join(self.words[self.begins[at] : self.ends[at + len(run)]])
            at = self.letters.find(run, at + 1)
        return run

    def repair(self, text: str) -> str:
        return _RUN.sub(lambda m: self.spaced(m.group()), text)


def repair(pages: DataFrame, column: str = "text", words: str = "words") -> DataFrame:
    """``pages`` with ``column`` repaired from the array in ``words``; a null in either leaves the text as it is.

    Only rows with a merged run go through Python, in Arrow batches; the
    others pass by in the JVM. The search has no form in SQL functions that
    isn't quadratic in the page.
    """
    names = pages.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(column).to_pylist(), batch.column(words).to_pylist()
            out = [t if w is None else PageWords([x or "" for x in w]).repair(t) for t, w in zip(texts, lists, strict=True)]
            yield batch.set_column(batch.schema.get_field_index(column), column, pa.array(out, pa.string()))

    suspect = F.coalesce(F.col(column).rlike(MERGED_RUN), F.lit(False))
    return pages.where(~suspect).unionByName(pages.where(suspect).mapInArrow(each, pages.schema)).select(*names)
