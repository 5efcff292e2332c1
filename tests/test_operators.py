"""Operators on small inputs: thresholds, ties, gaps, and plain-Python versions of the ordered searches."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.functions import text
from leafmill.operators import anchor, assemble, classify, index, reconcile, rotate, route, sheet, spacing, validate, wordproc
from leafmill.plans import convert
from leafmill.sources import office, sinks
from leafmill.streaming import inbox


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]


def test_strip_and_sql_functions(spark):
    names = text.register(spark)
    assert "leaf_strip" in names
    odd = "  \t\x1cab c\n\x0b"
    assert one(spark, text.strip(F.lit(odd))) == "ab c"
    row = spark.sql("SELECT leaf_strip(:t) AS a, leaf_letters('a-B 1c') AS b, leaf_page_marker(3) AS c, leaf_extension('/x/y.tar.GZ') AS d, leaf_control_ratio('') AS e", args={"t": odd}).first()
    assert tuple(row) == ("ab c", "ABC", "<!-- page 3 -->", "gz", 0.0)


def test_page_limits_are_strict(spark):
    pages = spark.createDataFrame(
        [(1, 1, "x" * 19, None), (1, 2, "x" * 20, None), (1, 3, "\x01" + "x" * 19, None), (1, 4, "\x01\x02" + "x" * 19, None), (1, 5, None, None), (1, 6, "y" * 30, [(0.0, 0.0, 10.0, 6.0)]), (1, 7, "y" * 30, [(-5.0, 0.0, 10.0, 5.0)])],
        "doc_id long, page_number int, text string, images array<struct<x0:double,y0:double,x1:double,y1:double>>",
    ).withColumns({"page_w": F.lit(10.0), "page_h": F.lit(10.0)})
    reasons = [r["reason"] for r in classify.page_reasons(pages).orderBy("page_number").collect()]
    assert reasons == ["image_only", None, None, "garbage", "image_only", "image_heavy", None]
    row = classify.verdict(classify.classify(pages)).first()
    assert (row["page_count"], row["needs_ocr"], row["garbage"], row["image"], row["verdict"]) == (7, [1, 4, 5, 6], [4], [6], "scan")


def test_ratio_of_exactly_the_threshold_is_digital(spark):
    pages = spark.createDataFrame([(1, k, "" if k == 1 else "z" * 40) for k in range(1, 6)], "doc_id long, page_number int, text string")
    assert classify.verdict(classify.classify(pages)).first()["verdict"] == "digital"
    assert one(spark, classify.ocr_ratio(F.lit(0), F.lit(0))) == 1.0


def test_rotation(spark):
    seen = spark.createDataFrame([(1, 1, 0, 90, 5.0), (1, 2, 0, 90, 5.0), (1, 3, 0, 180, 5.0), (1, 4, 0, 90, 0.5), (1, 5, 0, None, None), (1, 6, 90, 0, 9.0)], "doc_id long, page_number int, applied_rotation int, rotate int, conf double")
    again = spark.createDataFrame([(1, 1, 270, 0), (1, 1, 90, 0), (1, 2, 90, 90), (1, 2, 270, None), (1, 3, 180, 0), (1, 4, 90, 0)], "doc_id long, page_number int, applied_rotation int, rotate int")
    got = values(rotate.resolve(seen, again), "page_number", "status", "degrees")
    assert got == [(1, "fixed", 90), (2, "unresolved", None), (3, "fixed", 180), (4, "untouched", None), (5, "untouched", None), (6, "untouched", None)]


def spelled(run: str, words: list[str]) -> str:
    """All stretches of words, the first start first."""
    bare = ["".join(c for c in w if c.isascii() and c.isalpha()).upper() for w in words]
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            if all(bare[i:j]) and "".join(bare[i:j]) == run:
                return " ".join(words[i:j])
    return run


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["A", "AB", "ABA", "b,", "12", "", "é", "BAAB"]), max_size=14), st.text("AB", min_size=8, max_size=12))
def test_spacing_equals_all_stretches(words, run):
    assert spacing.PageWords(words).spaced(run) == spelled(run, words)
    assert text_letters(spacing.PageWords(words).repair(f"x {run}.")) == text_letters(f"x {run}.")


def text_letters(s: str) -> str:
    return re.sub("[^A-Za-z]", "", s).upper()


def test_spacing_rows(spark):
    rows = [(1, "see GRANDTOTAL now", ["GRAND", "TOTAL"]), (2, "GRANDTOTAL", ["GRAND", "7", "TOTAL"]), (3, "GRANDTO", ["GRAND", "TO"]), (4, "STATEMENT", ["Statement,"]), (5, None, None), (6, "ÉGRANDTOTAL", ["GRAND", "TOTAL"])]
    got = values(spacing.repair(spark.createDataFrame(rows, "doc_id long, text string, words array<string>")), "doc_id", "text")
    assert [x[1] for x in got] == ["see GRAND TOTAL now", "GRANDTOTAL", "GRANDTO", "Statement,", None, "ÉGRANDTOTAL"]


def test_assembly_and_boxes(spark):
    rows = [(1, 0, 1, "ab", [("t", [0.0], [0, 1]), ("p", [0.0], None)]), (1, 1, None, "cdé", [("t", [0.0], [1, 3])]), (2, 0, 5, None, [])]
    chunks = spark.createDataFrame(rows, "doc_id long, seq int, page_number int, text string, boxes array<struct<class:string,bbox:array<double>,pos:array<int>>>")
    whole = dict(values(assemble.body(chunks), "doc_id", "md"))
    assert whole == {1: "ab\n\n<!-- page 2 -->\n\ncdé", 2: ""}
    found = assemble.boxes(chunks, assemble.offsets(chunks)).orderBy("seq", "box_no").collect()
    assert [r["text"] for r in found] == ["a", None, "dé"] and found[1]["doc_pos"] is None
    a, b = found[2]["doc_pos"]
    assert whole[1][a:b] == "dé"


def test_index(spark):
    md = "# **Bank**\n## One\n# X y\n####### no\n# **\n<!-- page 2 --> tail\n# Bank\n<!-- page 3 -->\n# Bank\n## Two\n# Bank"
    docs = spark.createDataFrame([(1, md), (2, "plain"), (3, "")], "doc_id long, md string")
    entries = index.title_index(docs)
    assert values(entries, "line_no", "level", "text", "page") == [(1, 2, "One", 1), (2, 1, "X y", 1), (9, 2, "Two", 3)]
    assert [x[2] for x in values(index.title_index(docs, strict=True), "line_no", "level", "text")] == ["One", "X y", "Two", "Bank"]
    assert values(index.rendered(entries), "doc_id", "index_text") == [(1, "\n\n<!-- document index\n  - One (page 1)\n- X y (page 1)\n  - Two (page 3)\n-->\n")]
    assert {r["page"] for r in index.tagged_lines(docs).collect()} == {1, 2, 3}


def marked(md: str, blocks: list[tuple]) -> tuple[str, int]:
    """Anchoring in plain Python: (seq, text, table_body, page_idx) blocks in order."""
    keys = [((t or b or "")).strip() for _, t, b, _ in blocks]
    at, page, out, last, n = 0, None, [], 0, 0
    for (_, t, b, number), key in zip(blocks, keys, strict=True):
        needle = (t or "").strip()[:40] or (b or "").strip()[:120]
        if number is None or (key and keys.count(key) >= 3) or len(needle) < 10 or (pos := md.find(needle, at)) < 0:
            continue
        if page is not None and number != page:
            out, last, n = [*out, md[last:pos], f"\n\n<!-- page {number + 1} -->\n\n"], pos, n + 1
        page, at = number, pos + len(needle)
    return "".join([*out, md[last:]]), n


def test_anchoring_equals_plain_python(spark):
    import random

    rng = random.Random(3)
    lines = [f"the line of é text number {k} and some more of it" for k in range(12)] + ["short", "123456789", "1234567890", "<table><tr>" + "x" * 130, "", " padded line of text "]
    docs, blocks = [], []
    for d in range(40):
        picked = [rng.choice(lines) for _ in range(rng.randrange(14))]
        docs.append((d, "\n".join(x for x in picked if rng.random() < 0.9)))
        blocks += [(d, k, None if x.startswith("<") else x, x if x.startswith("<") else None, None if rng.random() < 0.1 else rng.randrange(4)) for k, x in enumerate(picked)]
    got = values(anchor.with_markers(spark.createDataFrame(docs, "doc_id long, md string"), spark.createDataFrame(blocks, "doc_id long, seq int, text string, table_body string, page_idx int")), "doc_id", "md", "n_markers")
    want = [(d, *marked(md, [b[1:] for b in blocks if b[0] == d])) for d, md in docs]
    assert got == want
    assert sum(x[2] for x in want) > 20
    assert [re.sub(r"\n\n<!-- page \d+ -->\n\n", "", x[1]) for x in got] == [x[1] for x in docs]


def test_block_lists_round_trip_and_malformed_json(spark):
    blocks = spark.createDataFrame([(1, 0, "é a", None, 0, [1.0]), (1, 1, None, "<t>", 1, None)], "doc_id long, seq int, text string, table_body string, page_idx int, bbox array<double>")
    assert anchor.from_json(sinks.block_lists(blocks)).orderBy("seq").collect() == blocks.orderBy("seq").collect()
    broken = spark.createDataFrame([(1, "{no"), (2, None), (3, "[]")], "doc_id long, content_list string")
    assert anchor.from_json(broken).count() == 0


def test_reconciliation(spark):
    words = spark.createDataFrame([("carbon",), ("expense",), ("border",)], "word string")
    primary = spark.createDataFrame([(1, "Karvon Karvon Carbon Carbon. Carbons"), (2, "Karvon Karvon Carbon Carbon"), (3, "Bordar Bordex Bordar Bordex Border Border"), (4, "Expensed Expensed Expense Expense"), (5, "")], "doc_id long, md string")
    second = spark.createDataFrame([(1, "Karvon"), (2, "Karvon Carbon"), (3, "Bordex Bordar"), (4, "Expensed")], "doc_id long, md string")
    got = values(reconcile.reconcile(primary, second, words), "doc_id", "md", "n_replaced")
    assert got == [(1, "Karvon Karvon Karvon Karvon. Carbons", 2), (2, "Karvon Karvon Carbon Carbon", 0), (3, "Bordar Bordex Bordar Bordex Bordar Bordar", 2), (4, "Expensed Expensed Expense Expense", 0), (5, "", 0)]
    assert reconcile.reconcile(primary, second, None).where("n_replaced > 0").count() == 0


CELL = "doc_id long, sheet_ix int, sheet string, row int, col int, kind string, num double, text string, ts timestamp, bool boolean, number_format string, formula string"


def test_cell_formats(spark):
    def cell(kind, num=None, t=None, ts=None, flag=None, number_format="General", formula=None):
        return (1, 0, "S", 1, 1, kind, num, t, ts, flag, number_format, formula)

    rows = [cell("null"), cell("bool", flag=True), cell("num", 2022.0), cell("num", 1234567.0, number_format="#,##0"), cell("num", -5.5), cell("num", 0.125), cell("num", 2.675), cell("num", -0.001), cell("date", ts=dt.datetime(2024, 2, 3, 23, 5)), cell("text", t=" a|b "), cell("null", formula="=A1")]
    want = ["", "TRUE", "2022", "1,234,567", "(5.50)", "0.12", "2.67", "(0.00)", "2024-02-03", "a\\|b", "[unresolved formula]"]
    for row, shown in zip(rows, want, strict=True):
        assert sheet.displayed(spark.createDataFrame([row], CELL)).first()["value"] == shown


def test_sheets_with_gaps_merges_and_trailing_blanks(spark):
    def cell(sheet_ix, row, col, t):
        return (1, sheet_ix, f"S{sheet_ix}", row, col, "text" if t else "null", None, t, None, None, None, None)

    cells = spark.createDataFrame([cell(0, 2, 2, "b"), cell(0, 2, 3, "c"), cell(0, 5, 1, "a"), cell(0, 9, 4, None), cell(1, 1, 1, None), cell(2, 1, 1, "x" * 12)], CELL)
    merges = spark.createDataFrame([(1, 0, 2, 2, 2, 3)], "doc_id long, sheet_ix int, min_row int, min_col int, max_row int, max_col int")
    got = values(sheet.sheets(cells, merges), "sheet_ix", "table")
    blank = "|  |  |  |  |"
    assert got == [(0, "\n".join([blank, "|---|---|---|---|", "|  | b |  |  |", blank, blank, "| a |  |  |  |"])), (2, f"| {'x' * 12} |\n|---|")]
    whole = sheet.workbooks(cells, merges).first()
    assert whole["md"].startswith("## S0\n\n|  ") and whole["error"] is None and "S1" not in whole["md"]
    assert sheet.workbooks(cells.where("sheet_ix = 1")).first()["error"] is not None


def test_word_tables_and_styles(spark):
    rows = F.from_json(F.lit('[["a","b"],["1"],["1","2","3"]]'), "array<array<string>>")
    assert one(spark, wordproc.table(rows)) == "| a | b |\n|---|---|\n| 1 |  |\n| 1 | 2 |"
    assert one(spark, wordproc.table(F.array().cast("array<array<string>>"))) == ""
    shown = [one(spark, wordproc.paragraph(F.lit(" t "), F.lit(s))) for s in ("Title", "Heading 1", "Heading 2", "Heading 3", "Heading 4", "Heading 10", "Normal", None)]
    assert shown == ["# t", "# t", "## t", "### t", "#### t", "# t", "t", "t"]
    parts = spark.createDataFrame([(1, 0, "Header", False, "Bank"), (1, 0, "Footer", False, "Bank"), (1, 1, "Header", True, "X"), (1, 1, "Footer", False, "p")], "doc_id long, section_ix int, label string, linked boolean, text string")
    assert values(wordproc.headers_footers(parts), "nth", "md") == [(1, "*Header: Bank*"), (2, "*Footer: p*")]


def test_routes(spark):
    files = spark.createDataFrame([("/a/B.PDF", "scan", None), ("x.pdf", None, None), ("x.pdf", "odd", None), ("x.pdf", "scan", "text"), ("x.pdf", None, "best"), ("y.docx", None, None), ("y.xlsx", None, "text"), ("r.x.doc", None, None), ("n", None, None)], "path string, verdict string, engine string")
    got = [(r["engine"], r["error"], r["next_name"]) for r in route.route(files).collect()]
    assert got == [("ocr", None, None), ("classify", None, None), (None, "unexpected verdict", None), ("text", None, None), (None, "unknown engine", None), ("docx", None, None), (None, "engine applies to pdf only", None), ("legacy", None, "r.x.fromdoc.pdf"), (None, "unsupported extension", None)]
    assert [one(spark, route.supported(F.lit(p))) for p in ("a.PDF", "a.derotated.pdf", "a.fromXLS.pdf", "a.md", "a.xls")] == [True, False, False, False, True]
    assert one(spark, route.output_inside(F.lit("/a/bc/x"), F.lit("/a/b/"))) is False
    assert one(spark, route.model_available(F.array(F.lit("m:7b")), F.lit("m:latest"))) is True
    artefacts = spark.createDataFrame([(1, "r", "/o/x.md", 9), (1, "r", "/o/r.md", 1), (2, "r", "/o/a.md", 5), (2, "r", "/o/b.md", 5)], "doc_id long, stem string, path string, size long")
    assert values(route.pick_artefact(artefacts), "doc_id", "path", "size") == [(1, "/o/r.md", 1), (2, "/o/b.md", 5)]


def test_validators(spark):
    cells = validate.html_cells("<table><tr><td rowspan=2>a<td colspan='2'>b &lt;</tr><tr><th>c</th></tr></table><table><tr><td>d")
    assert cells == [(0, 0, 0, 2, 1, "a"), (0, 0, 1, 1, 2, "b <"), (0, 1, 1, 1, 1, "c"), (1, 0, 0, 1, 1, "d")]
    rows = spark.createDataFrame([(1, k, c) for k, c in enumerate([["a"], ["", "-"], [" "], ["b"], ["c"], [""]])], "doc_id long, row int, cells array<string>")
    assert values(validate.spacer_split(rows, ["doc_id"]), "row", "table_no") == [(0, 0), (3, 1), (4, 1)]


def xlsx() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="Main" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Na</t><r><t>me</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="4"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" s="1"><v>-1234.5</v></c><c r="C1" s="2"><v>45000</v></c></row><row r="3"><c r="A3" t="b"><v>1</v></c><c r="B3"><f>A1+1</f></c><c r="AA3" t="inlineStr"><is><t>far</t></is></c></row></sheetData><mergeCells><mergeCell ref="A1:B2"/></mergeCells></worksheet>')
    return out.getvalue()


def docx() -> bytes:
    word = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    p = lambda t, s="": f'<w:p>{s and f"<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>"}<w:r><w:t>{t}</w:t></w:r></w:p>'
    cell = lambda t, pr="": f"<w:tc><w:tcPr>{pr}</w:tcPr>{p(t)}</w:tc>"
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        table = f'<w:tbl><w:tr>{cell("a")}{cell("b|c")}</w:tr><w:tr>{cell("wide", "<w:gridSpan w:val=%s2%s/>" % (chr(34), chr(34)))}</w:tr></w:tbl>'
        z.writestr("word/document.xml", f'<w:document {word}><w:body>{p("Top", "h1")}{table}{p("end")}<w:sectPr><w:headerReference r:id="h" w:type="default"/></w:sectPr></w:body></w:document>')
        z.writestr("word/styles.xml", f'<w:styles {word}><w:style w:styleId="h1"><w:name w:val="heading 1"/></w:style></w:styles>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="x"><Relationship Id="h" Target="header1.xml"/></Relationships>')
        z.writestr("word/header1.xml", f"<w:hdr {word}>{p('Bank')}</w:hdr>")
    return out.getvalue()


def test_office_readers(spark):
    binary = spark.createDataFrame([("a.xlsx", bytearray(xlsx())), ("bad.xlsx", bytearray(b"PK")), ("empty.xlsx", bytearray())], "doc_id string, content binary")
    cells, merges, errors = office.read_workbooks(binary)
    shown = {(r["row"], r["col"]): r["value"] for r in sheet.displayed(cells).collect()}
    assert shown == {(1, 1): "Name", (1, 2): "(1,234.50)", (1, 3): "2023-03-15", (3, 1): "TRUE", (3, 2): "[unresolved formula]", (3, 27): "far"}
    assert [tuple(r)[1:] for r in merges.collect()] == [(0, 1, 1, 2, 2)]
    assert {r["doc_id"] for r in errors.collect()} == {"bad.xlsx", "empty.xlsx"}
    done = {r["doc_id"]: r for r in convert.workbooks(binary).collect()}
    assert done["a.xlsx"]["md"].startswith("## Main\n\n| Name |  | 2023-03-15 |") and done["bad.xlsx"]["error"]
    words = spark.createDataFrame([("d.docx", bytearray(docx()))], "doc_id string, content binary")
    assert convert.documents(words).first()["md"] == "*Header: Bank*\n\n---\n\n# Top\n\n| a | b\\|c |\n|---|---|\n| wide | wide |\n\nend"


def damaged(content: bytes, name: str) -> dict[str, bytes]:
    """Files that fail in ways that only show when a part is read."""
    at = content.index(b"PK\x01\x02")
    with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, "<a>" + "some text " * 200 + "</a>")
    packed = out.getvalue()
    encrypted, unknown = bytearray(content), bytearray(content)
    for k in range(at, len(content) - 4):
        if content[k : k + 4] == b"PK\x01\x02":
            encrypted[k + 8] |= 1  # the flag of encryption
            unknown[k + 10] = 99  # a compression that isn't known
    return {"deflate": packed[:60] + b"\xff" * 20 + packed[80:], "encrypted": bytes(encrypted), "unknown": bytes(unknown), "cut": content[: len(content) // 2], "null": None}


def test_no_file_ends_a_batch(spark):
    for read, good, part in ((office.read_workbooks, xlsx(), "xl/workbook.xml"), (office.read_documents, docx(), "word/document.xml")):
        bad = damaged(good, part)
        rows = [("good", bytearray(good)), *((k, v and bytearray(v)) for k, v in bad.items())]
        first, _, errors = read(spark.createDataFrame(rows, "doc_id string, content binary"))
        assert {r["doc_id"] for r in errors.collect()} == set(bad) and {r["doc_id"] for r in first.collect()} == {"good"}


def test_serial_numbers_as_openers_show_them():
    shown = lambda v, f, old=False: office._value(ET.fromstring(f'<c xmlns="{office._MAIN[1:-1]}"><v>{v}</v></c>'), f, [], old)[:4]
    assert shown(0.5, "h:mm") == ("text", None, "12:00:00", None)
    assert shown(0.000011574, "mm:ss.0") == ("text", None, "00:00:01", None)
    assert shown(1.25, "[h]:mm:ss") == ("text", None, "1 day, 6:00:00", None)
    assert shown(45000.75, "m/d/yy h:mm") == ("date", None, None, dt.datetime(2023, 3, 15, 18))
    assert shown(1, "yyyy") == ("date", None, None, dt.datetime(1900, 1, 1)) and shown(0, "yyyy-mm-dd")[2] == "00:00:00"
    assert shown(1, "yyyy", True) == ("date", None, None, dt.datetime(1904, 1, 2))
    for other in ("General", "0.00", '"days" 0', "[Red]0.0", "\\d0"):
        assert shown(3, other) == ("num", 3.0, None, None)


def test_sheets_are_as_wide_as_their_merged_ranges(spark):
    cells = spark.createDataFrame([(1, 0, "S", 1, 1, "text", None, "a", None, None, None, None)], CELL)
    merges = spark.createDataFrame([(1, 0, 1, 2, 3, 4), (1, 7, 1, 1, 1, 9)], "doc_id long, sheet_ix int, min_row int, min_col int, max_row int, max_col int")
    assert values(sheet.sheets(cells, merges), "sheet_ix", "table") == [(0, "| a |  |  |  |\n|---|---|---|---|")]


def test_nested_and_broken_html_tables(spark):
    cells = validate.html_cells("<table><tr><td>A<table><tr><td>x</td></tr></table>a</td><td>B</td></tr><tr><td rowspan='70000' colspan=0>C</table>after<td>D")
    assert sorted(cells) == [(0, 0, 0, 1, 1, "Aa"), (0, 0, 1, 1, 1, "B"), (0, 1, 0, validate.MOST_ROWS, 1, "C"), (1, 0, 0, 1, 1, "x"), (2, 0, 0, 1, 1, "D")]
    tall = validate.html_cells("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d")
    assert [(r, c, t) for _, r, c, _, _, t in tall] == [(0, 0, "a"), (0, 2, "b"), (1, 2, "c"), (2, 0, "d")]
    blocks = spark.createDataFrame([("p/x.docx", 0, "<table><tr><td>1</table>"), ("y", 1, None), ("z", 2, "")], "doc_id string, seq int, table_body string")
    assert [tuple(r) for r in validate.html_tables(blocks).collect()] == [("p/x.docx", 0, 0, 0, 0, 1, 1, "1")]


def test_audits_and_logs(spark):
    blocks = spark.createDataFrame([(1, 0, 0), (1, 1, 4), (2, 0, None)], "doc_id long, seq int, page_idx int")
    marked = spark.createDataFrame([(1, "x", 1), (2, "y", 0), (3, "z", 0)], "doc_id long, md string, n_markers int")
    assert values(anchor.marker_audit(marked, blocks), "doc_id", "pages", "missing") == [(1, 5, 3), (2, 1, 0), (3, 1, 0)]
    pages = spark.createDataFrame([(1, 1, "fixed"), (1, 3, "unresolved"), (1, 2, "unresolved"), (2, 1, "untouched")], "doc_id long, page_number int, status string")
    assert values(rotate.summary(pages), "doc_id", "n_fixed", "n_unresolved", "unresolved") == [(1, 1, 2, [2, 3]), (2, 0, 0, [])]
    words = spark.createDataFrame([("carbon",)], "word string")
    primary = spark.createDataFrame([(1, "Karvon Karvon Carbon Carbon. Carbons")], "doc_id long, md string")
    second = spark.createDataFrame([(1, "Karvon Karvon Karvon")], "doc_id long, md string")
    assert values(reconcile.change_log(primary, second, words), "dict_token", "rare_token", "n_replaced", "n_reference") == [("Carbon", "Karvon", 2, 3)]


def test_joined_headings_and_turned_pages(spark):
    found = spark.createDataFrame([(1, 0, 2, "One two ## Three #### four"), (1, 1, 1, "C# and # "), (1, 2, 3, "plain")], "doc_id long, line_no int, level int, text string")
    assert values(validate.split_headings(found), "line_no", "part", "level", "text") == [(0, 0, 2, "One two"), (0, 1, 2, "Three"), (0, 2, 4, "four"), (1, 0, 1, "C# and"), (2, 0, 3, "plain")]
    blocks = spark.createDataFrame([(d, k, kind, r) for d, r in ((1, 90), (2, 0), (3, None)) for k, kind in enumerate(["table", "footnote", "table"])], "doc_id long, seq int, kind string, rotation int")
    assert values(validate.footnote_between_tables(blocks), "doc_id") == [(1,), (3,)]
    assert validate.footnote_between_tables(blocks.drop("rotation")).count() == 3


def test_diff_of_rows_on_one_side_and_repeated_headers(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, v string")
    right = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "doc_id long, v string")
    assert values(route.diff(left, right, "doc_id", "v"), "doc_id", "outcome") == [(1, "left_only"), (2, "changed"), (3, "same"), (4, "right_only")]
    parts = spark.createDataFrame([(1, s, "Header", False, t) for s, t in enumerate(["ab c", "ab d", " ab c", ""])], "doc_id long, section_ix int, label string, linked boolean, text string")
    assert values(wordproc.headers_footers(parts), "nth", "md") == [(1, "*Header: ab c*"), (2, "*Header: ab d*")]


def test_markdown_files(spark, tmp_path):
    results = spark.createDataFrame([("/in/a.docx", "é text"), ("/in/b.xlsx", None)], "doc_id string, md string")
    assert [(r["path"], r["length"]) for r in sinks.write_markdown_files(results, str(tmp_path / "md")).collect()] == [(f"{tmp_path}/md/a.md", 7)]
    assert [p.name for p in (tmp_path / "md").iterdir()] == ["a.md"] and (tmp_path / "md/a.md").read_text(encoding="utf-8") == "é text"


def test_a_failed_move_loses_nothing(spark, tmp_path):
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "a").write_text("old")
    (tmp_path / "a").write_text("new")
    inbox.move(spark, str(tmp_path / "a"), str(tmp_path / "done"))
    inbox.move(spark, str(tmp_path / "a"), str(tmp_path / "done"))
    assert (tmp_path / "done" / "a").read_text() == "new" and [p.name for p in (tmp_path / "done").glob("[!.]*")] == ["a"]


def test_whole_conversions(spark):
    chunks = spark.createDataFrame([(1, 0, 1, "# A\nGRANDTOTAL of everything that is here"), (1, 1, 2, "## B\nmore text of the second page")], "doc_id long, seq int, page_number int, text string")
    words = spark.createDataFrame([(1, 1, 0, "GRAND"), (1, 1, 1, "TOTAL")], "doc_id long, page_number int, seq int, word string")
    row = convert.conversion("text")(chunks, words).first()
    assert "GRAND TOTAL of" in row["md"] and row["md"].endswith("- A (page 1)\n  - B (page 2)\n-->\n") and row["warning"] is None
    primary = spark.createDataFrame([(1, "first words of the page\n# Head of the next page")], "doc_id long, md string")
    blocks = spark.createDataFrame([(1, 0, "first words of the page", None, 0), (1, 1, "# Head of the next page", None, 1)], "doc_id long, seq int, text string, table_body string, page_idx int")
    assert "<!-- page 2 -->\n\n# Head" in convert.conversion("ocr")(primary, blocks).first()["md"]


def test_inbox(spark, tmp_path):
    box, out = tmp_path / "in", tmp_path / "out"
    box.mkdir()
    (box / "a.DOCX").write_bytes(docx())
    (box / "b.xlsx").write_bytes(b"broken")
    (box / "c.derotated.pdf").write_bytes(b"own")
    (box / "d.pdf").write_bytes(b"%PDF")
    for _ in range(2):
        inbox.watch(spark, str(box), str(out), once=True).awaitTermination()
    assert values(inbox.ledger(spark, str(out)), "file", "outcome") == [("a.DOCX", "processed"), ("b.xlsx", "failed"), ("d.pdf", "failed")]
    assert sorted(p.name for p in (box / "processed").iterdir()) == ["a.DOCX"] and (box / "c.derotated.pdf").exists()
    (box / "e.docx").write_bytes(docx())
    inbox.watch(spark, str(box), str(out), once=True).awaitTermination()
    assert values(inbox.markdown(spark, str(out)), "name") == [("a.md",), ("e.md",)]
