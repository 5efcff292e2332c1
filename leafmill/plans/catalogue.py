"""One query for each operator, over the driver's tables. ``oracles`` has the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text
from leafmill.operators import anchor, assemble, classify, index, reconcile, rotate, route, sheet, spacing, validate, wordproc
from leafmill.plans import adapters as a
from leafmill.plans import convert
from leafmill.sources import office, scratch, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def page_reason(spark, sf_dir):
    return classify.page_reasons(a.document_pages(spark, sf_dir)).select("doc_id", "page_number", "chars", "reason")


@query
def page_reason_by_count(spark, sf_dir):
    return classify.page_reasons(a.document_pages(spark, sf_dir), by_count_only=True).select("doc_id", "page_number", "reason")


@query
def doc_verdict(spark, sf_dir):
    judged = classify.verdict(classify.classify(a.conversation_pages(spark, sf_dir)))
    pages = {c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("needs_ocr", "garbage", "image")}
    return judged.select("doc_id", "page_count", "total_chars", *pages.values(), F.round("ratio", 6).alias("ratio"), "verdict")


@query
def ocr_ratio_by_source(spark, sf_dir):
    pages = classify.page_reasons(a.document_pages(spark, sf_dir))
    counted = pages.groupBy("source").agg(F.count("*").alias("pages"), F.count("reason").alias("needing"), F.bool_or(F.coalesce(F.col("reason") == "garbage", F.lit(False))).alias("any_garbage"))
    return counted.withColumn("ratio", F.round(classify.ocr_ratio(F.col("needing"), F.col("pages")), 6))


@query
def image_coverage(spark, sf_dir):
    left, top = (F.col("l_partkey") % 600).cast("double"), (F.col("l_suppkey") % 700).cast("double")
    rect = F.struct(left.alias("x0"), top.alias("y0"), (left + F.col("l_quantity") * 10).alias("x1"), (top + F.col("l_quantity") * 8).alias("y1"))
    images = a.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(rect).alias("images"))
    share = classify.image_coverage(F.col("images"), F.lit(612.0), F.lit(792.0))
    return images.select(F.col("l_orderkey").alias("doc_id"), F.round(share, 6).alias("coverage"), (share > 0.5).alias("heavy"))


@query
def rotation_resolve(spark, sf_dir):
    p = a.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))
    page = [F.floor(F.col("k") / 20).cast("long").alias("doc_id"), (F.col("k") % 20 + 1).cast("int").alias("page_number")]
    turn = F.when(F.col("k") % 5 < 4, (F.col("k") % 5 * 90).cast("int"))
    observed = p.select(*page, (F.col("size") % 4 * 90).cast("int").alias("applied_rotation"), turn.alias("rotate"), (F.col("size") / 10.0).cast("double").alias("conf"))
    tried = p.withColumn("r", F.explode(F.array(*map(F.lit, (0, 90, 180, 270)))))
    seen = F.when((F.col("k") + F.col("r")) % 11 != 0, ((F.col("r") + F.col("k") % 7 * 90) % 360).cast("int"))
    return rotate.resolve(observed, tried.select(*page, F.col("r").cast("int").alias("applied_rotation"), seen.alias("rotate"))).drop("rotate", "conf")


@query
def merged_run_scan(spark, sf_dir):
    runs = F.regexp_extract_all("text", F.lit(text.MERGED_RUN), 0)
    docs = a.table(spark, sf_dir, "documents").where(F.col("text").rlike(text.MERGED_RUN))
    return docs.select("doc_id", F.size(runs).alias("n_runs"), F.array_join(runs, " ").alias("runs"))


@query
def spacing_repair(spark, sf_dir):
    pages = a.table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.split(F.regexp_replace("text", r"([A-Z]{4})(?=[A-Z]{4})", "$1 "), r"\s+")
    return spacing.repair(pages.withColumn("words", words)).select("doc_id", "text")


@query
def assemble_pages(spark, sf_dir):
    return assemble.body(a.conversation_chunks(spark, sf_dir))


@query
def assemble_document(spark, sf_dir):
    return assemble.document(a.conversation_chunks(spark, sf_dir))


@query
def chunk_offsets(spark, sf_dir):
    placed = assemble.offsets(a.conversation_chunks(spark, sf_dir))
    return placed.select("doc_id", "seq", "page_number", F.col("start").cast("long"), F.col("stop").cast("long"))


@query
def chunk_boxes(spark, sf_dir):
    chunks = a.conversation_chunks(spark, sf_dir)
    whole = F.struct(F.lit("text").alias("class"), F.array(F.lit(0.0)).alias("bbox"), F.array(F.lit(0), F.length("text")).alias("pos"))
    nowhere = F.struct(F.lit("picture").alias("class"), F.array(F.lit(1.0)).alias("bbox"), F.lit(None).cast("array<int>").alias("pos"))
    found = assemble.boxes(chunks.withColumn("boxes", F.array(whole, nowhere)), assemble.offsets(chunks))
    at = [F.get("doc_pos", k).cast("long").alias(n) for k, n in enumerate(("start", "stop"))]
    return found.select("doc_id", "seq", "box_no", "class", "text", "page_number", *at)


@query
def tag_lines_with_page(spark, sf_dir):
    return index.tagged_lines(assemble.body(a.conversation_chunks(spark, sf_dir))).select("doc_id", "line_no", "line", "page")


@query
def title_index(spark, sf_dir):
    return index.title_index(assemble.body(a.conversation_chunks(spark, sf_dir)))


@query
def title_index_text(spark, sf_dir):
    return index.rendered(index.title_index(assemble.body(a.conversation_chunks(spark, sf_dir))))


@query
def running_headers(spark, sf_dir):
    return index.banners(index.headings(assemble.body(a.conversation_chunks(spark, sf_dir))))


@query
def boilerplate_blocks(spark, sf_dir):
    return anchor.boilerplate(a.document_blocks(spark, sf_dir))


@query
def anchor_blocks(spark, sf_dir):
    return anchor.needles(a.document_blocks(spark, sf_dir))


@query
def page_markers(spark, sf_dir):
    return anchor.with_markers(a.document_markdown(spark, sf_dir), a.document_blocks(spark, sf_dir))


@query
def json_blocks(spark, sf_dir):
    listed = sinks.block_lists(a.document_blocks(spark, sf_dir).withColumn("bbox", F.array(F.lit(0.0))))
    return anchor.from_json(listed).select("doc_id", "seq", "text", "page_idx")


@query
def rare_tokens(spark, sf_dir):
    counts = reconcile.repeated_counts(a.document_markdown(spark, sf_dir))
    return reconcile.rare_tokens(counts, a.benchmark_words(spark, sf_dir)).select("doc_id", "token", "n")


@query
def dictionary_tokens(spark, sf_dir):
    counts = reconcile.repeated_counts(a.document_markdown(spark, sf_dir))
    return reconcile.dictionary_tokens(counts, a.benchmark_words(spark, sf_dir)).select("doc_id", "token", "n")


@query
def spelling_twins(spark, sf_dir):
    repeated = reconcile.repeated_tokens(a.document_markdown(spark, sf_dir))
    return reconcile.twins(repeated, a.benchmark_words(spark, sf_dir)).select("doc_id", "rare_token", "dict_token")


@query
def spelling_reconciled(spark, sf_dir):
    return reconcile.confirmed(a.document_markdown(spark, sf_dir), a.reference_markdown(spark, sf_dir), a.benchmark_words(spark, sf_dir))


@query
def spelling_text(spark, sf_dir):
    return reconcile.reconcile(a.document_markdown(spark, sf_dir), a.reference_markdown(spark, sf_dir), a.benchmark_words(spark, sf_dir))


@query
def format_cells(spark, sf_dir):
    return sheet.displayed(a.customer_cells(spark, sf_dir)).select("doc_id", "sheet_ix", "row", "col", "value")


@query
def merged_cells(spark, sf_dir):
    return sheet.merged_blanks(a.sheet_merges(spark, sf_dir))


@query
def sheet_markdown(spark, sf_dir):
    return sheet.sheets(a.customer_cells(spark, sf_dir), a.sheet_merges(spark, sf_dir)).select("doc_id", "sheet_ix", "table")


@query
def workbook_markdown(spark, sf_dir):
    return sheet.workbooks(a.customer_cells(spark, sf_dir)).select("doc_id", "md", "error")


@query
def trim_trailing_rows(spark, sf_dir):
    cells = a.customer_cells(spark, sf_dir).withColumn("kind", F.when(F.col("row") + F.col("sheet_ix") > 45, "null").otherwise(F.col("kind")))
    return sheet.last_rows(sheet.displayed(cells.withColumn("formula", F.lit(None).cast("string"))))


@query
def ragged_table(spark, sf_dir):
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_count(x, F.lit(r"\|")) >= 2)
    docs = a.table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).where(F.size("lines") > 0)
    cell = lambda c: wordproc.cell_text(F.array(c))
    rows = F.transform("lines", lambda x: F.transform(F.split(x, r"\|"), cell))
    return docs.select("doc_id", wordproc.table(rows).alias("table"))


@query
def style_headings(spark, sf_dir):
    styles = F.array(*map(F.lit, ("Title", "Heading 1", "heading 2", "Heading 3", "Heading 4", "Heading 10", "Normal")))
    style = F.get(styles, F.length("source") % 7)
    return a.table(spark, sf_dir, "documents").select("doc_id", wordproc.paragraph(F.col("text"), style).alias("md"))


@query
def ordered_items(spark, sf_dir):
    return wordproc.item_markdown(a.page_items(spark, sf_dir)).select("doc_id", "seq", "md")


@query
def page_documents(spark, sf_dir):
    return wordproc.documents(a.page_items(spark, sf_dir))


@query
def dedupe_headers(spark, sf_dir):
    turns = a.table(spark, sf_dir, "conversations")
    label = F.when(F.col("turn") % 2 == 0, "Header").otherwise("Footer")
    linked = F.col("turn") % 5 == 4
    parts = turns.select(F.col("conv_id").alias("doc_id"), F.floor(F.col("turn") / 2).alias("section_ix"), label.alias("label"), linked.alias("linked"), "text")
    return wordproc.headers_footers(parts).select("doc_id", "nth", "md")


@query
def route_files(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, (".PDF", ".docx", ".xlsx", ".doc", ".XLS", ".txt", ".derotated.pdf", ""))), (F.col("page_id") % 8).cast("int"))
    path = F.concat(F.lit("/in/"), F.col("page_id").cast("string"), kind)
    verdict = F.when(F.col("page_id") % 3 == 0, "digital").when(F.col("page_id") % 3 == 1, "scan")
    engine = F.when(F.col("page_id") % 13 == 0, "ocr").when(F.col("page_id") % 17 == 0, "other")
    files = a.table(spark, sf_dir, "pages").select("page_id", path.alias("path"), verdict.alias("verdict"), engine.alias("forced"))
    routed = route.route(files.withColumnRenamed("forced", "engine"))
    return routed.select("page_id", "ext", "stem", "next_name", "engine", "error", route.supported(F.col("path")).alias("supported"))


@query
def pick_artifact(spark, sf_dir):
    p = a.table(spark, sf_dir, "part").select((F.col("p_partkey") % 500).alias("doc_id"), "p_partkey", F.col("p_size").cast("long").alias("size"))
    path = F.concat(F.lit("/out/"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("d"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("x"), F.col("p_partkey").cast("string"))), F.lit(".md"))
    return route.pick_artefact(p.select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("stem"), path.alias("path"), "size"))


@query
def image_links(spark, sf_dir):
    md = F.concat(F.lit("![a](images/a.png) "), F.col("text"), F.lit(" ![b](images/b.png)"))
    return a.table(spark, sf_dir, "documents").select("doc_id", route.image_links(md, F.concat(F.lit("doc"), F.col("doc_id").cast("string"))).alias("md"))


@query
def engine_diff(spark, sf_dir):
    docs = a.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    other = F.when(F.col("doc_id") % 5 == 0, F.lit("changed")).otherwise(F.col("digest"))
    return route.diff(docs, docs.withColumn("digest", other), "doc_id", "digest")


@query
def refoot_totals(spark, sf_dir):
    items = a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.round("l_extendedprice", 2).alias("amount"))
    totals = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("stated"))
    return validate.refoot(items, totals, ["doc_id"]).select("doc_id", F.round("footed", 2).alias("footed"), "agrees")


@query
def nil_audit(spark, sf_dir):
    cells = a.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.when(F.col("c_custkey") % 4 == 0, "-").otherwise(F.col("c_name")).alias("value"))
    kept = F.when(F.col("doc_id") % 6 == 0, "0").when(F.col("doc_id") % 5 == 0, " ").otherwise(F.col("value"))
    return validate.nil_audit(cells, cells.withColumn("value", kept).where("doc_id % 9 != 0"), ["doc_id"])


@query
def spacer_split(spark, sf_dir):
    lines = a.order_lines(spark, sf_dir).select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("row"), F.col("l_partkey").cast("string").alias("cell"))
    cell = F.when(F.length("cell") % 2 == 0, F.lit("-")).otherwise(F.col("cell"))
    rows = validate.spacer_split(lines.select("doc_id", "row", F.array(cell, F.lit(" ")).alias("cells")), ["doc_id"])
    return rows.select("doc_id", "row", F.get("cells", 0).alias("cell"), "table_no")


@query
def complete_periods(spark, sf_dir):
    orders = a.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.year("o_orderdate").alias("period"))
    return validate.complete(orders, ["doc_id"])


@query
def rolls_forward(spark, sf_dir):
    orders = a.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("period"), F.col("o_totalprice").alias("closing"))
    return validate.rolls_forward(orders.withColumn("opening", F.col("closing")), ["doc_id"]).select("doc_id", "period", "agrees")


@query
def footnote_between_tables(spark, sf_dir):
    kind = F.when(F.col("l_linenumber") % 2 == 0, "footnote").when(F.col("l_suppkey") % 3 == 0, "text").otherwise("table")
    blocks = a.order_lines(spark, sf_dir).select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), kind.alias("kind"))
    return validate.footnote_between_tables(blocks)


@query
def heading_depth(spark, sf_dir):
    found = index.headings(assemble.body(a.conversation_chunks(spark, sf_dir)))
    return validate.heading_levels(found.withColumn("level", F.col("level") * 2)).select("doc_id", "line_no", "level", "depth")


@query
def finding_scorecard(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, "ABC")), (F.col("l_partkey") % 3).cast("int"))
    return validate.scorecard(a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), kind.alias("kind")))


@query
def html_tables(spark, sf_dir):
    """Pages as a table: the url over two columns and rows with the page's number in a table of its own, then each paragraph."""
    head = F.concat(F.lit("<table><tr><td rowspan=2 colspan=2>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<table><tr><td>"), F.col("page_id").cast("string"), F.lit("</table> end</tr>"))
    rows = F.replace(F.replace("html", F.lit("<p>"), F.lit("<tr><td>")), F.lit("</p>"), F.lit("</td>"))
    pages = a.table(spark, sf_dir, "pages")
    return validate.html_tables(pages.select(F.col("page_id").cast("string").alias("doc_id"), F.lit(0).alias("seq"), F.concat(head, rows, F.lit("</table>")).alias("table_body")))


@query
def image_heavy_pages(spark, sf_dir):
    """Order lines as pages with one image each: the reason by coverage, and the documents' verdict."""
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_partkey") % 100).cast("double").alias("x1"), F.lit(100.0).alias("y1"))
    pages = a.order_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_number"), F.repeat(F.lit("text "), 5).alias("text"),
        F.array(box).alias("images"), F.lit(100.0).alias("page_w"), F.lit(100.0).alias("page_h"),
    )
    judged = classify.verdict(classify.classify(pages))
    return judged.select("doc_id", F.array_join(F.transform("image", lambda x: x.cast("string")), ",").alias("image"), "verdict")


@query
def letters_only(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").select("doc_id", text.letters_only("text").alias("letters"))


@query
def wordlist(spark, sf_dir):
    """The benchmark's texts as files of lines, read as a wordlist."""
    path = f"{scratch.folder(spark)}/words-{uuid.uuid4().hex}"
    tokens = F.explode(F.regexp_extract_all("text", F.lit(text.TOKEN), F.lit(0)))
    a.table(spark, sf_dir, "benchmark").select(tokens.alias("w")).select(F.concat(F.lit(" "), "w").alias("value")).write.text(path)
    return reconcile.wordlist(spark, path)


@query
def model_available(spark, sf_dir):
    tags = F.array(F.concat(F.lit("m"), (F.col("p_partkey") % 7).cast("string"), F.lit(":"), (F.col("p_size") % 3).cast("string")), F.lit("other"))
    wanted = F.concat(F.lit("m"), (F.col("p_size") % 7).cast("string"), F.when(F.col("p_partkey") % 2 == 0, ":latest").otherwise(""))
    return a.table(spark, sf_dir, "part").select("p_partkey", route.model_available(tags, wanted).alias("available"))


@query
def output_inside(spark, sf_dir):
    out = F.concat(F.lit("/in/"), F.col("c_nationkey").cast("string"), F.lit("/x"))
    folder = F.concat(F.lit("/in/"), (F.col("c_custkey") % 5).cast("string"), F.when(F.col("c_custkey") % 2 == 0, "/").otherwise(""))
    return a.table(spark, sf_dir, "customer").select("c_custkey", route.output_inside(out, folder).alias("inside"))


@query
def too_little(spark, sf_dir):
    pages = (F.col("doc_id") % 200).cast("int")
    return a.table(spark, sf_dir, "documents").select("doc_id", classify.too_little(F.col("text"), pages).alias("little"))


@query
def sql_functions(spark, sf_dir):
    """The functions that are registered for SQL."""
    text.register(spark)
    docs = a.table(spark, sf_dir, "documents")
    return docs.selectExpr("doc_id", "leaf_strip(text) AS stripped", "length(leaf_letters(text)) AS letters", "leaf_page_marker(doc_id) AS marker", "leaf_control_ratio(text) AS ratio", "leaf_extension(concat('/x/', source, '.T', doc_id)) AS ext")


@query
def convert_digital(spark, sf_dir):
    """Chunks whose last words have lost their space, which the pages' words give back."""
    chunks = a.conversation_chunks(spark, sf_dir)
    merged = chunks.withColumn("text", F.concat("text", F.lit("\nGRANDTOTAL "), F.col("seq").cast("string")))
    words = chunks.select("doc_id", "page_number", F.posexplode(F.array(*map(F.lit, ("So", "GRAND", "TOTAL")))).alias("seq", "word"))
    return convert.conversion("text")(merged, words)


@query
def convert_scanned(spark, sf_dir):
    """Documents as recognised texts under two headings; a second pass has nothing to correct."""
    docs = a.document_markdown(spark, sf_dir).withColumn("md", F.concat(F.lit("# Part\n"), "md", F.lit("\n## End")))
    return convert.conversion("ocr")(docs, a.document_blocks(spark, sf_dir))


@query
def spelling_log(spark, sf_dir):
    return reconcile.change_log(a.document_markdown(spark, sf_dir), a.reference_markdown(spark, sf_dir), a.benchmark_words(spark, sf_dir))


@query
def marker_audit(spark, sf_dir):
    blocks = a.document_blocks(spark, sf_dir)
    return anchor.marker_audit(anchor.with_markers(a.document_markdown(spark, sf_dir), blocks), blocks)


@query
def rotation_summary(spark, sf_dir):
    found = rotate.summary(rotation_resolve(spark, sf_dir))
    return found.withColumn("unresolved", F.array_join(F.transform("unresolved", lambda x: x.cast("string")), ","))


@query
def split_headings(spark, sf_dir):
    """Headings of conversations, a second one joined to those of users' turns."""
    found = index.headings(assemble.body(a.conversation_chunks(spark, sf_dir)))
    joined = found.withColumn("text", F.when(F.col("level") == 1, F.concat("text", F.lit(" ### of  "), F.col("page").cast("string"))).otherwise(F.col("text")))
    return validate.split_headings(joined).select("doc_id", "line_no", "part", "level", "text")


def _dealt(rows: DataFrame) -> DataFrame:
    """Small rows that make long work, over all cores, however few files they come from."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def _zipped(parts: Callable[[tuple], dict[str, str]], broken: Callable[[tuple], bool]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of columns (doc_id, ...) as zipped files of the parts that ``parts`` makes; a broken file's packed bytes are overwritten."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import zipfile

        for batch in batches:
            files = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
                    for name, body in parts(row).items():
                        z.writestr(name, body)
                content = out.getvalue()
                files.append(content[:60] + b"\xff" * 40 + content[100:] if broken(row) else content)
            ids = pa.array([str(x) for x in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([ids, pa.array(files, pa.binary())], ["doc_id", "content"])

    return each


_OFFICE = "http://schemas.openxmlformats.org/"


@query
def xlsx_cells(spark, sf_dir):
    """Customers as workbooks, every tenth one damaged: what their cells show, and one row for each that can't be read."""
    from xml.sax.saxutils import escape

    main = f'xmlns="{_OFFICE}spreadsheetml/2006/main"'

    def parts(row: tuple) -> dict[str, str]:
        k, name, balance = row
        cells = [
            f'<c r="A1" t="inlineStr"><is><t>{escape(name)}</t></is></c>', f'<c r="B1" s="1"><v>{balance!r}</v></c>', f'<c r="C1" s="2"><v>{40000 + k % 5000}.75</v></c>',
            f'<c r="D1" s="3"><v>{k % 1440 / 1440!r}</v></c>', f'<c r="E1" s="4"><v>{k % 60 / 24!r}</v></c>', f'<c r="F1" t="b"><v>{k % 2}</v></c>', '<c r="G1"><f>A1*2</f></c>',
        ]
        return {
            "xl/workbook.xml": f'<workbook {main} xmlns:r="{_OFFICE}officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="a"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>',
            "xl/styles.xml": f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="4"/><xf numFmtId="22"/><xf numFmtId="20"/><xf numFmtId="46"/></cellXfs></styleSheet>',
            "xl/worksheets/s.xml": f'<worksheet {main}><sheetData><row r="1">{"".join(cells)}</row></sheetData></worksheet>',
        }

    customers = a.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    cells, _, errors = office.read_workbooks(_dealt(customers).mapInArrow(_zipped(parts, lambda row: row[0] % 10 == 0), "doc_id string, content binary"))
    failed = errors.select("doc_id", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("error").alias("value"))
    return sheet.displayed(cells).select("doc_id", "row", "col", "value").unionByName(failed)


@query
def docx_items(spark, sf_dir):
    """Pages as word-processor files, every tenth one damaged: their items as Markdown, and one row for each that can't be read."""
    from xml.sax.saxutils import escape

    def parts(row: tuple) -> dict[str, str]:
        page, url = row
        p = lambda t, style="": f"<w:p>{style}<w:r><w:t>{escape(t)}</w:t></w:r></w:p>"
        table = f"<w:tbl><w:tr><w:tc>{p('page')}</w:tc><w:tc>{p('a|b')}</w:tc></w:tr><w:tr><w:tc>{p(str(page))}</w:tc></w:tr></w:tbl>"
        return {"word/document.xml": f'<w:document xmlns:w="{_OFFICE}wordprocessingml/2006/main"><w:body>{p("Page", "<w:pPr><w:pStyle w:val=%sTitle%s/></w:pPr>" % (chr(34), chr(34)))}{p(url or "")}{table}</w:body></w:document>'}

    pages = a.table(spark, sf_dir, "pages").select("page_id", "url")
    items, _, errors = office.read_documents(_dealt(pages).mapInArrow(_zipped(parts, lambda row: row[0] % 10 == 0), "doc_id string, content binary"))
    failed = errors.select("doc_id", F.lit(-1).alias("seq"), F.lit("error").alias("md"))
    return wordproc.item_markdown(items).select("doc_id", "seq", "md").unionByName(failed)


def _as_files(pages: DataFrame, folder: str, broken: int) -> DataFrame:
    """Pages (page_id, url) as word-processor files of a folder: folder, name, content; of ``broken`` pages one is no zip file."""
    from xml.sax.saxutils import escape

    def parts(row: tuple) -> dict[str, str]:
        page, url = row
        return {"word/document.xml": f'<w:document xmlns:w="{_OFFICE}wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>{escape(url or "")} is page {page}</w:t></w:r></w:p></w:body></w:document>'}

    made = _dealt(pages).mapInArrow(_zipped(parts, lambda row: False), "doc_id string, content binary")
    content = F.when(F.col("doc_id").cast("long") % broken == 0, F.lit("not a zip file").cast("binary")).otherwise(F.col("content"))
    return made.select(F.lit(folder).alias("folder"), F.concat("doc_id", F.lit(".docx")).alias("name"), content.alias("content"))


@query
def inbox_once(spark, sf_dir):
    """The stream works the folder off twice, files having come in between, some in a folder below: how often each was taken."""
    from leafmill.streaming import inbox

    root = f"{scratch.folder(spark)}/inbox-{uuid.uuid4().hex}"
    pages = a.table(spark, sf_dir, "pages").select("page_id", "url")
    for part, folder in ((0, "in"), (1, "in"), (2, "in/below")):
        sinks.write_files(_as_files(pages.where(F.col("page_id") % 3 == part), folder, 7), root).count()
        inbox.watch(spark, f"{root}/in", f"{root}/out", once=True).awaitTermination()
    return inbox.ledger(spark, f"{root}/out").groupBy("file").agg(F.count("*").alias("taken"), F.max("outcome").alias("outcome"))


@query
def files_below(spark, sf_dir):
    """Pages' files in two folders, listed from the folder above both: name, kind and folder."""
    root = f"{scratch.folder(spark)}/files-{uuid.uuid4().hex}"
    folder = F.concat(F.lit("out/"), (F.col("page_id") % 2).cast("string"))
    kind = F.when(F.col("page_id") % 3 == 0, ".PNG").otherwise(".md")
    rows = a.table(spark, sf_dir, "pages").select(folder.alias("folder"), F.concat(F.col("page_id").cast("string"), kind).alias("name"), F.col("html").cast("binary").alias("content"))
    sinks.write_files(rows, root).count()
    return office.files(spark, f"{root}/out", recursive=True).select("stem", "ext", "length", F.regexp_extract("path", "/([01])/[^/]*$", 1).alias("folder"))


@query
def markdown_files(spark, sf_dir):
    """Documents written as .md files and read again."""
    root = f"{scratch.folder(spark)}/md-{uuid.uuid4().hex}"
    sinks.write_markdown_files(a.document_markdown(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string")), root).count()
    return office.files(spark, root).select("stem", F.col("content").cast("string").alias("md"))


@query
def block_list_files(spark, sf_dir):
    """Blocks of documents written as JSON lists and read again."""
    path = f"{scratch.folder(spark)}/blocks-{uuid.uuid4().hex}"
    sinks.write_block_lists(a.document_blocks(spark, sf_dir).withColumn("bbox", F.array(F.lit(0.0))), path)
    return anchor.from_json(spark.read.parquet(path)).select("doc_id", "seq", "text", "page_idx")


@query
def inbox_replay(spark, sf_dir):
    """Pages as word-processor files, every tenth broken, dropped in a folder that the stream works off."""
    from leafmill.streaming import inbox

    root = f"{scratch.folder(spark)}/inbox-{uuid.uuid4().hex}"
    pages = a.table(spark, sf_dir, "pages").select("page_id", "url")
    sinks.write_files(_as_files(pages, "in", 10), root).count()
    inbox.watch(spark, f"{root}/in", f"{root}/out", once=True).awaitTermination()
    return inbox.ledger(spark, f"{root}/out").select("file", "outcome")
