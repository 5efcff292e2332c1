"""Readers of workbooks and word-processor files, from their zipped XML.

Files come as binary rows and are parsed in Arrow batches, one file at a time;
cached values and formulas are read in one pass. A file that can't be read,
for whatever reason, gives one row in ``errors`` and nothing else, and never
fails a batch. What a batch of files holds is parsed once and written as one
nested table, from which cells, merges and errors are read.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import extension, stem
from leafmill.sources import scratch

CELLS = (
    "doc_id string, sheet_ix int, sheet string, row int, col int, kind string, num double, text string, "
    "ts timestamp_ntz, bool boolean, number_format string, formula string"
)
MERGES = "doc_id string, sheet_ix int, min_row int, min_col int, max_row int, max_col int"
ITEMS = "doc_id string, seq int, kind string, text string, style string, rows array<array<string>>"
PARTS = "doc_id string, section_ix int, label string, linked boolean, text string"
ERRORS = "doc_id string, error string"

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Files go back to Spark as soon as they hold so many rows and KB, or the last of a batch is read.
_TOGETHER = 5_000
# Fixed values of the file format: built-in number formats that hold a comma or a date.
_BUILT_IN = {3: "#,##0", 4: "#,##0.00", 37: "#,##0 ;(#,##0)", 38: "#,##0 ;[Red](#,##0)", 39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;[Red](#,##0.00)"}
_BUILT_IN |= {14: "mm-dd-yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 22: "m/d/yy h:mm"}
_BUILT_IN |= {18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0"}


def files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files as path, modificationTime, length, content, with doc_id (the path), ext and stem."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).withColumns({"doc_id": F.col("path"), "ext": extension("path"), "stem": stem("path")})


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Targets of a part's relations, by id."""
    folder, name = posixpath.split(part)
    try:
        root = ET.fromstring(z.read(f"{folder}/_rels/{name}.rels"))
    except KeyError:
        return {}
    return {x.get("Id"): posixpath.normpath(posixpath.join("/", folder, x.get("Target", ""))).lstrip("/") for x in root}


def _position(ref: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", ref).groups()
    col = 0
    for c in letters:
        col = col * 26 + ord(c) - 64
    return int(digits), col


def _formats(z: zipfile.ZipFile) -> list[str]:
    """Number format of every cell style."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(x.get("numFmtId")): x.get("formatCode", "") for x in root.iter(f"{_MAIN}numFmt")}
    return [own.get(n) or _BUILT_IN.get(n, "General") for n in (int(x.get("numFmtId", 0)) for xs in root.iter(f"{_MAIN}cellXfs") for x in xs)]


def _shows(number_format: str) -> str | None:
    """moment, elapsed or None: what a number of this format is. Quoted and escaped letters, colours and locales don't count."""
    first = re.sub(r'"[^"]*"|[\\_].', "", number_format.split(";")[0])
    if re.search(r"\[(?:hh?|mm?|ss?)\]", first, re.IGNORECASE):
        return "elapsed"
    return "moment" if re.search("[dmhys]", re.sub(r"\[[^\]]*\]", "", first), re.IGNORECASE) else None


def _moment(serial: float, from_1904: bool) -> dt.datetime | dt.time | None:
    """A serial number of days to the millisecond: a time of day below 1, else a moment; below 60 it counts without the day that never was."""
    span = dt.timedelta(milliseconds=round(serial * 86_400_000)) if abs(serial) < 3_000_000 else None
    if span is None:
        return None
    if 0 <= serial < 1 and not span.days:
        return (dt.datetime.min + span).time()
    try:
        return (dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30) + dt.timedelta(days=0 < serial < 60)) + span
    except OverflowError:
        return None


def _texts(node: ET.Element, tag: str) -> str:
    return "".join(x.text or "" for x in node.iter(tag))


def workbook(content: bytes) -> tuple[list[tuple], list[tuple]]:
    """Cells and merged ranges of a workbook, without doc_id, in the columns of CELLS and MERGES."""
    cells, merges = [], []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
        targets, formats = _relations(z, "xl/workbook.xml"), _formats(z)
        from_1904 = any(x.get("date1904") in ("1", "true") for x in book.iter(f"{_MAIN}workbookPr"))
        strings = []
        if "xl/sharedStrings.xml" in z.namelist():
            strings = [_texts(x, f"{_MAIN}t") for x in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        for ix, sheet in enumerate(book.iter(f"{_MAIN}sheet")):
            root = ET.fromstring(z.read(targets[sheet.get(f"{_REL}id")]))
            row = 0
            for line in root.iter(f"{_MAIN}row"):
                row, col = int(line.get("r") or row + 1), 0
                for c in line.iter(f"{_MAIN}c"):
                    at_row, col = _position(c.get("r")) if c.get("r") else (row, col + 1)
                    style = int(c.get("s") or 0)
                    shown = formats[style] if style < len(formats) else "General"
                    cells.append((ix, sheet.get("name"), at_row, col, *_value(c, shown, strings, from_1904)))
            for m in root.iter(f"{_MAIN}mergeCell"):
                first, _, last = m.get("ref").partition(":")
                merges.append((ix, *_position(first), *_position(last or first)))
    return cells, merges


def _value(c: ET.Element, shown: str, strings: list[str], from_1904: bool) -> tuple:
    """kind, num, text, ts, bool, number_format, formula of a cell element."""
    kind, v, f = c.get("t", "n"), c.find(f"{_MAIN}v"), c.find(f"{_MAIN}f")
    formula = None if f is None else f"={f.text or ''}"
    raw = None if v is None else v.text
    if kind == "inlineStr":
        return "text", None, _texts(c, f"{_MAIN}t"), None, None, shown, formula
    if raw is None:
        return "null", None, None, None, None, shown, formula
    if kind == "s":
        return "text", None, strings[int(raw)], None, None, shown, formula
    if kind == "b":
        return "bool", None, None, None, raw == "1", shown, formula
    if kind == "d":
        return "date", None, None, dt.datetime.fromisoformat(raw.replace("Z", "")), None, shown, formula
    if kind == "n":
        number, how = float(raw), _shows(shown)
        if how == "elapsed":
            return "text", None, str(dt.timedelta(milliseconds=round(number * 86_400_000))), None, None, shown, formula
        at = _moment(number, from_1904) if how else None
        if isinstance(at, dt.time):
            return "text", None, str(at), None, None, shown, formula
        if at is not None:
            return "date", None, None, at, None, shown, formula
        return "num", number, None, None, None, shown, formula
    return "text", None, raw, None, None, shown, formula


def _paragraph_text(p: ET.Element) -> str:
    out = []
    for x in p.iter():
        if x.tag == f"{_WORD}t":
            out.append(x.text or "")
        elif x.tag == f"{_WORD}tab":
            out.append("\t")
        elif x.tag in (f"{_WORD}br", f"{_WORD}cr"):
            out.append("\n")
    return "".join(out)


def _rows(table: ET.Element) -> list[list[str]]:
    """A table's cells; a cell over several columns comes as often, one continued from above repeats that one's value."""
    rows: list[list[str]] = []
    for tr in table.findall(f"{_WORD}tr"):
        row: list[str] = []
        for tc in tr.findall(f"{_WORD}tc"):
            props = tc.find(f"{_WORD}tcPr")
            span, merge = (None, None) if props is None else (props.find(f"{_WORD}gridSpan"), props.find(f"{_WORD}vMerge"))
            text = " ".join(_paragraph_text(p) for p in tc.findall(f"{_WORD}p"))
            text = text.strip().replace("|", "\\|")
            if merge is not None and merge.get(f"{_WORD}val", "continue") == "continue" and rows and len(row) < len(rows[-1]):
                text = rows[-1][len(row)]
            row += [text] * (1 if span is None else max(1, int(span.get(f"{_WORD}val", 1))))
        rows.append(row)
    return rows


def document(content: bytes) -> tuple[list[tuple], list[tuple]]:
    """Body items and section headers and footers of a word-processor file, without doc_id, in the columns of ITEMS and PARTS."""
    items, parts = [], []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root, targets = ET.fromstring(z.read("word/document.xml")), _relations(z, "word/document.xml")
        names = {}
        if "word/styles.xml" in z.namelist():
            for s in ET.fromstring(z.read("word/styles.xml")).iter(f"{_WORD}style"):
                name = s.find(f"{_WORD}name")
                names[s.get(f"{_WORD}styleId")] = s.get(f"{_WORD}styleId") if name is None else name.get(f"{_WORD}val")

        def style(p: ET.Element) -> str | None:
            at = p.find(f"{_WORD}pPr/{_WORD}pStyle")
            return None if at is None else names.get(at.get(f"{_WORD}val"), at.get(f"{_WORD}val"))

        for seq, x in enumerate(root.find(f"{_WORD}body")):
            if x.tag == f"{_WORD}p":
                items.append((seq, "paragraph", _paragraph_text(x), style(x), None))
            elif x.tag == f"{_WORD}tbl":
                items.append((seq, "table", None, None, _rows(x)))
        for ix, section in enumerate(root.iter(f"{_WORD}sectPr")):
            for label, tag in (("Header", "headerReference"), ("Footer", "footerReference")):
                found = [x for x in section.findall(f"{_WORD}{tag}") if x.get(f"{_WORD}type", "default") == "default"]
                text = None
                if found:
                    part = ET.fromstring(z.read(targets[found[0].get(f"{_REL}id")]))
                    text = "\n".join(t for t in (_paragraph_text(p).strip() for p in part.iter(f"{_WORD}p")) if t)
                parts.append((ix, label, not found, text))
    return items, parts


def _parsed(binary: DataFrame, parse: Callable, schemas: tuple[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two tables of a parser and the files that it can't read. Files are parsed once, and the result is written.

    Whatever goes wrong in a file (a broken or encrypted archive, an unknown
    compression, markup that ends early) is that file's row in ``errors``.
    """
    spark = binary.sparkSession
    kinds = [spark.createDataFrame([], s).schema for s in schemas]
    rows = [f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in k.fields[1:])}>>" for k in kinds]
    schema = spark.createDataFrame([], f"doc_id string, first {rows[0]}, second {rows[1]}, error string").schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def nested(lists: list[list[tuple]], kind: pa.DataType) -> pa.Array:
            fields, flat = list(kind.value_type), [r for rows in lists for r in rows]
            columns = zip(*flat, strict=True) if flat else ((),) * len(fields)
            values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)
            ends = pa.array(itertools.accumulate(map(len, lists), initial=0), pa.int32())
            return pa.ListArray.from_arrays(ends, values, type=kind)

        def table(found: list[tuple]) -> pa.RecordBatch:
            docs, first, second, errors = (list(c) for c in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), nested(first, arrow.field(1).type), nested(second, arrow.field(2).type), pa.array(errors, pa.string())], schema=arrow)

        def tables(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Files together, or each alone where one holds what a table can't."""
            try:
                made = [table(found)]
            except Exception as e:  # no file may end a batch
                made = [x for f in found for x in tables([f])] if len(found) > 1 else [table([(found[0][0], [], [], failure(e))])]
            yield from made

        def failure(e: Exception) -> str:
            return f"{type(e).__name__}: {e}"[:500].encode("utf-8", "replace").decode()

        for batch in batches:
            found, held = [], 0
            for doc, content in zip(*batch.columns[:2], strict=True):
                content = content.as_py() or b""
                try:
                    first, second = parse(content)
                    found.append((doc.as_py(), first, second, None))
                except Exception as e:  # no file may end a batch
                    found.append((doc.as_py(), [], [], failure(e)))
                held += 1 + len(found[-1][1]) + len(found[-1][2]) + len(content) // 1024
                if held >= _TOGETHER:
                    yield from tables(found)
                    found, held = [], 0
            if found:
                yield from tables(found)

    once = scratch.written(binary.select(F.col("doc_id").cast("string").alias("doc_id"), "content").mapInArrow(each, schema), "parsed")
    one, two = (once.select("doc_id", F.inline(c)) for c in ("first", "second"))
    return one, two, once.where("error IS NOT NULL").select("doc_id", "error")


def read_workbooks(binary: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cells, merges and errors of workbooks (doc_id, content)."""
    return _parsed(binary, workbook, (CELLS, MERGES))


def read_documents(binary: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """items, headers and footers, and errors of word-processor files (doc_id, content)."""
    return _parsed(binary, document, (ITEMS, PARTS))
