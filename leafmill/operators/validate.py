"""Checks of extracted tables. They are extensions: the fidelity rules call for them, nothing else depends on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from leafmill.functions.text import strip


#: Largest spans of a cell in HTML (fixed values of the format).
MOST_ROWS, MOST_COLUMNS = 65_534, 1_000
#: Cells go back to Spark as soon as the texts read hold so many characters, so what a worker holds doesn't grow with a batch.
TOGETHER = 1_000_000


def refoot(items: DataFrame, totals: DataFrame, keys: list[str], tolerance: float = 0.005) -> DataFrame:
    """keys, stated, footed and agrees: the sum of ``items.amount`` against ``totals.stated``; no items sum to 0."""
    footed = items.groupBy(*keys).agg(F.sum("amount").alias("footed"))
    both = totals.select(*keys, "stated").join(footed, keys, "left").withColumn("footed", F.round(F.coalesce("footed", F.lit(0.0)), 4))
    return both.withColumn("agrees", F.abs(F.col("stated") - F.col("footed")) <= tolerance)


def is_nil(value: Column) -> Column:
    """Whether a cell shows nothing: null, blank or a dash."""
    return F.coalesce(strip(value).isin("", "-", "–", "—"), F.lit(True))


def nil_audit(source: DataFrame, extracted: DataFrame, keys: list[str]) -> DataFrame:
    """keys and finding (fabricated, lost, kept_nil, kept) of the cells (keys, value) of either side."""
    a = source.select(*keys, F.col("value").alias("was"))
    b = extracted.select(*keys, F.col("value").alias("now"))
    was, now = is_nil(F.col("was")), is_nil(F.col("now"))
    finding = F.when(was & ~now, "fabricated").when(~was & now, "lost").when(was, "kept_nil").otherwise("kept")
    return a.join(b, keys, "full_outer").select(*keys, finding.alias("finding"))


def spacer_split(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, row, cells array) without blank rows, with table_no: the blank rows before it, runs of them one."""
    whole = Window.partitionBy(*keys).orderBy("row")
    blank = F.forall("cells", lambda c: is_nil(c))
    begins = (F.col("_blank") & ~F.coalesce(F.lag("_blank").over(whole), F.lit(True))).cast("int")
    marked = rows.withColumn("_blank", blank).withColumn("_begins", begins)
    numbered = marked.withColumn("table_no", F.sum("_begins").over(whole.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return numbered.where(~F.col("_blank")).drop("_blank", "_begins")


def complete(tables: DataFrame, keys: list[str], periods: int = 2) -> DataFrame:
    """keys, n_periods and complete: whether as many distinct periods are there as there must be."""
    n = tables.groupBy(*keys).agg(F.count_distinct("period").alias("n_periods"))
    return n.withColumn("complete", F.col("n_periods") == periods)


def rolls_forward(balances: DataFrame, keys: list[str], tolerance: float = 0.005) -> DataFrame:
    """``balances`` (keys, period, opening, closing) with agrees: opening is the closing before; null for the first."""
    before = F.lag("closing").over(Window.partitionBy(*keys).orderBy("period"))
    return balances.withColumn("agrees", F.abs(F.col("opening") - before) <= tolerance)


def footnote_between_tables(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, seq, kind) that are a footnote with a table on either side: where a second table may be lost.

    Where blocks know their page's ``rotation``, only turned pages count; a null
    one is taken for turned, as it isn't known to be upright.
    """
    order = Window.partitionBy("doc_id").orderBy("seq")
    sides = blocks.withColumns({"_before": F.lag("kind").over(order), "_after": F.lead("kind").over(order)})
    found = sides.where("kind = 'footnote' AND _before = 'table' AND _after = 'table'").drop("_before", "_after")
    return found.where(F.coalesce(F.col("rotation") % 360 != 0, F.lit(True))) if "rotation" in blocks.columns else found


def heading_levels(headings: DataFrame) -> DataFrame:
    """``headings`` (doc_id, line_no, level, text) with depth: levels counted without holes, from 1, in each document."""
    return headings.withColumn("depth", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("level")))


def split_headings(headings: DataFrame) -> DataFrame:
    """``headings`` (doc_id, line_no, level, text) with one row for each heading of a line that joins several, and part (from 0).

    Headings are joined where hashes stand inside the text between spaces; the
    level of a later one is the number of its hashes, its text may be several
    words, and what has no text goes.
    """
    parts = F.split(F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "text"), r"(?U)(?:^|\s+)(?=#{1,6}\s)")
    level, text = F.length(F.regexp_extract("_part", "^(#+)", 1)), strip(F.regexp_replace("_part", "^#+", ""))
    split = headings.select("*", F.posexplode(F.filter(parts, lambda p: p.rlike(r"(?sU)^#{1,6}\s+[^\s#]"))).alias("_nth", "_part"))
    return split.withColumns({"level": level, "text": text, "part": F.col("_nth")}).drop("_nth", "_part")


def scorecard(findings: DataFrame, kinds: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """doc_id and the number of findings (doc_id, kind) of each kind."""
    return findings.groupBy("doc_id").pivot("kind", list(kinds)).count().na.fill(0)


@dataclass
class _Table:
    """A table that is being read: its number, the next place, and how far down each column is covered by cells above."""

    number: int
    row: int = -1
    col: int = 0
    cell: list | None = None
    covered: dict[int, int] = field(default_factory=dict)


class _Rows(HTMLParser):
    """Rows of the tables of an HTML text, as (table, row, col, rowspan, colspan, text). A table inside a cell is one of its own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[int, int, int, int, int, str]] = []
        self.open: list[_Table] = []
        self.tables = 0

    def begin(self) -> None:
        self.open.append(_Table(self.tables))
        self.tables += 1

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.begin()
        elif tag in ("tr", "td", "th"):
            if not self.open:
                self.begin()
            t = self.open[-1]
            self.close_cell(t)
            if tag == "tr" or t.row < 0:
                t.row, t.col = t.row + 1, 0
            if tag != "tr":
                span = lambda name, most: min(max(1, next((int(v) for k, v in attrs if k == name and v and v.isdecimal()), 1)), most)
                while t.covered.get(t.col, 0) > t.row:
                    t.col += 1
                t.cell = [span("rowspan", MOST_ROWS), span("colspan", MOST_COLUMNS), []]

    def handle_data(self, data):
        if self.open and self.open[-1].cell:
            self.open[-1].cell[2].append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table") and self.open:
            self.close_cell(self.open[-1])
            if tag == "table":
                self.open.pop()

    def close_cell(self, t: _Table) -> None:
        if t.cell:
            down, across, parts = t.cell
            self.out.append((t.number, t.row, t.col, down, across, "".join(parts).strip()))
            t.covered |= {t.col + j: t.row + down for j in range(across)}
            t.col, t.cell = t.col + across, None


def html_cells(text: str | None) -> list[tuple[int, int, int, int, int, str]]:
    """(table_no, row, col, rowspan, colspan, text) of every cell of an HTML text; broken markup gives what can be read.

    Tables are numbered as they begin, nested ones too, whose text is no part
    of the cell around them. Spans go up to what HTML itself allows, 65,534
    rows and 1,000 columns; larger ones count as that, and 0 or no number as 1.
    """
    parser = _Rows()
    parser.feed(text or "")
    parser.close()
    while parser.open:
        parser.close_cell(parser.open.pop())
    return parser.out


def html_tables(blocks: DataFrame, column: str = "table_body") -> DataFrame:
    """doc_id (of any type), seq, table_no, row, col, rowspan, colspan, text of the tables in HTML of ``blocks``, in Arrow batches."""
    import pyarrow as pa

    wanted = blocks.where(F.col(column).isNotNull()).select("doc_id", F.col("seq").cast("int"), F.col(column).alias("html"))
    numbers = ("table_no", "row", "col", "rowspan", "colspan")
    schema = StructType([wanted.schema["doc_id"], wanted.schema["seq"], *(StructField(n, IntegerType()) for n in numbers), StructField("text", StringType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch, at: list[int], cells: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*cells, strict=True)) or [()] * 6
            arrays = [pa.array(v, t) for v, t in zip(columns, [*[pa.int32()] * 5, pa.string()], strict=True)]
            places = pa.array(at, pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(places), batch.column("seq").take(places), *arrays], ["doc_id", "seq", *numbers, "text"])

        for batch in batches:
            at, cells, held = [], [], 0
            for k, text in enumerate(batch.column("html")):
                found = html_cells(text := text.as_py())
                at += [k] * len(found)
                cells += found
                held += len(text)
                if held >= TOGETHER:
                    yield rows(batch, at, cells)
                    at, cells, held = [], [], 0
            if at:
                yield rows(batch, at, cells)

    return wanted.mapInArrow(each, schema)
