"""What must not grow with the input: batches, tasks and what a task holds."""

from __future__ import annotations

import io
import zipfile

import pytest
from test_operators import docx, values, xlsx

from leafmill.operators import reconcile
from leafmill.plans import catalogue
from leafmill.sources import office, sinks
from leafmill.streaming import inbox


def test_what_is_there_is_worked_off_in_one_batch(spark, tmp_path):
    box, out = tmp_path / "in", tmp_path / "out"
    (box / "processed").mkdir(parents=True)
    (box / "processed" / "a 7.docx").write_text("old")
    for k in range(130):
        (box / f"a {k}.docx").write_bytes(docx() if k % 2 else b"broken")
    inbox.watch(spark, str(box), str(out), once=True).awaitTermination()
    done = inbox.ledger(spark, str(out))
    assert done.count() == 130 and [r["batch"] for r in done.select("batch").distinct().collect()] == [0]
    assert sum(1 for _ in (box / "processed").iterdir()) == sum(1 for _ in (box / "failed").iterdir()) == 65
    assert (box / "processed" / "a 7.docx").read_bytes() != b"old" and not list(box.glob("*.docx"))


def test_executors_move_files_with_their_checksums(spark, tmp_path):
    (tmp_path / "in" / "done").mkdir(parents=True)
    for name, body in (("a", "new"), (".a.crc", "new"), ("b", "new"), ("done/a", "old"), ("done/b", "old"), ("done/.b.crc", "old")):
        (tmp_path / "in" / name).write_text(body)
    rows = spark.createDataFrame([(f"file:{tmp_path}/in/{n}", "done") for n in "abc"], "doc_id string, outcome string")
    for _ in range(2):
        inbox.move_all(rows, str(tmp_path / "in"))
    left = sorted((str(p.relative_to(tmp_path / "in")), p.read_text()) for p in (tmp_path / "in").rglob("*") if p.is_file())
    assert left == [("done/.a.crc", "new"), ("done/a", "new"), ("done/b", "new")]


def test_workbooks_come_back_together_and_from_all_cores(spark, monkeypatch):
    seen = {}
    read = office.read_workbooks
    monkeypatch.setattr(office, "read_workbooks", lambda binary: seen.update(parts=binary.rdd.getNumPartitions()) or read(binary))
    catalogue.queries()["xlsx_cells"](spark, "/root/testdata/sf0.001")
    assert seen["parts"] >= spark.sparkContext.defaultParallelism
    far = xlsx().replace(b'"AA3"', b'"A%d"' % 10**10)  # stored, so the part's checksum fails too; a row beyond 32 bits is the table's failure
    with zipfile.ZipFile(io.BytesIO(xlsx())) as z, zipfile.ZipFile(out := io.BytesIO(), "w") as made:
        for name in z.namelist():
            made.writestr(name, z.read(name).replace(b'"AA3"', b'"A%d"' % 10**10))
    rows = [("a", bytearray(xlsx())), ("b", bytearray(out.getvalue())), ("c", bytearray(xlsx())), ("d", bytearray(far))]
    cells, _, errors = read(spark.createDataFrame(rows, "doc_id string, content binary").coalesce(1))
    assert values(cells.groupBy("doc_id").count(), "doc_id", "count") == [("a", 6), ("c", 6)]
    assert values(errors, "doc_id") == [("b",), ("d",)]


def test_cells_of_html_come_back_in_parts(spark, monkeypatch):
    import pyarrow as pa

    from leafmill.operators import validate

    kept = {}

    class Frame:
        schema = spark.createDataFrame([], "doc_id string, seq int").schema

        def __getattr__(self, name):
            return lambda *a: self

        def mapInArrow(self, each, schema):
            kept["each"] = each

    validate.html_tables(Frame())
    page = "<table><tr><td>" + "x" * 400_000 + "<td>y</table>"
    batch = pa.RecordBatch.from_pydict({"doc_id": [str(k) for k in range(10)], "seq": pa.array([0] * 10, pa.int32()), "html": [page] * 9 + ["none"]})
    parts = list(kept["each"]([batch]))
    assert [p.num_rows for p in parts] == [6, 6, 6]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [str(k) for k in range(9) for _ in range(2)]


def test_a_write_that_fails_leaves_nothing_to_read(spark, tmp_path):
    (tmp_path / "b.md").mkdir()
    rows = spark.createDataFrame([("", "a.md", bytearray(b"a")), ("", "b.md", bytearray(b"b"))], "folder string, name string, content binary").coalesce(1)
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_files(rows, str(tmp_path)).count()
    assert values(office.files(spark, str(tmp_path)), "stem") == [("a",)]


def test_tokens_are_counted_in_their_own_row(spark):
    plan = catalogue.queries()["rare_tokens"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan
    md = spark.createDataFrame([(1, "words Words words other"), (1, "Words"), (2, "other"), (3, None), (4, "")], "doc_id long, md string")
    assert values(reconcile.token_counts(md), "doc_id", "token", "n", "first") == [(1, "Words", 2, 0), (1, "other", 1, 3), (1, "words", 2, 0), (2, "other", 1, 0)]
    assert values(reconcile.token_counts(md.where("doc_id > 1")), "doc_id", "token", "n", "first") == [(2, "other", 1, 0)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_corrections_pass_texts_by_unsorted(spark):
    plan = plan_of(catalogue.queries()["spelling_log"](spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" not in plan and "lambdafunction" not in plan and plan.count("ShuffledHashJoin") == 2
    frame = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, md string")
    words = spark.createDataFrame([("carbon",), ("planet",)], "word string")
    text = "Karvon Carbon Karvon Carbon (Carbon) Carbon7 éCarbon Carbons planit planet planet planit"
    primary = frame((1, text), (2, text), (3, text), (4, None), (None, text))
    second = frame((1, "Karvon Karvon"), (1, "Karvon planit planet"), (1, None), (2, "Karvon"), (2, "Carbon planit"), (4, text), (None, "Karvon"))
    got = values(reconcile.change_log(primary, second, words), "doc_id", "dict_token", "rare_token", "n_replaced", "n_reference")
    assert got == [(1, "Carbon", "Karvon", 3, 3), (2, "planet", "planit", 2, 1)]
    glued = frame((1, "Karvon Carbon1 Karvon Carbon2"))  # twice a token, never a whole word
    assert reconcile.change_log(glued, frame((1, "Karvon")), words).count() == 0


def test_repeated_tokens_come_in_the_order_of_their_texts(spark):
    long = "omega " * 300_000 + "alpha Alpha alphas alpha Alpha"
    md = spark.createDataFrame([(1, "zeta omega alpha omega omegas alpha alphas omega"), (2, long), (3, None), (4, ""), (5, "omega"), (None, "alpha alpha")], "doc_id long, md string")
    for rows in (md, md.union(spark.createDataFrame([(5, "alpha omega")], "doc_id long, md string"))):
        ours = [(r["doc_id"], r["token"]) for r in reconcile.repeated_tokens(rows).orderBy("doc_id", "first").collect()]
        theirs = reconcile.token_counts(rows).where("n > 1").orderBy("doc_id", "first").collect()
        assert ours == [(r["doc_id"], r["token"]) for r in theirs]
    assert ours[:3] == [(None, "alpha"), (1, "omega"), (1, "alpha")] and ours[-1] == (5, "omega")


def test_corrected_texts_are_not_sorted(spark):
    assert "SortMergeJoin" not in plan_of(catalogue.queries()["spelling_text"](spark, "/root/testdata/sf0.001"))
    frame = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, md string")
    words = spark.createDataFrame([("carbon",)], "word string")
    text = "Karvon Carbon Karvon Carbon (Carbon) Carbon7 éCarbon Carbons"
    got = reconcile.reconcile(frame((1, text), (2, text), (None, text), (3, None)), frame((1, "Karvon")), words)
    changed = "Karvon Karvon Karvon Karvon (Karvon) Carbon7 éCarbon Carbons"
    assert {r["doc_id"]: (r["md"], r["n_replaced"]) for r in got.collect()} == {1: (changed, 3), 2: (text, 0), None: (text, 0), 3: (None, 0)}


def test_repeated_tokens_are_counted_without_interpreted_functions(spark):
    for name in ("rare_tokens", "dictionary_tokens", "spelling_twins"):
        plan = plan_of(catalogue.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "lambdafunction" not in plan and plan.count("regexp_extract_all(text") == 2  # documents and benchmark, each once
    md = spark.createDataFrame([(1, "words Words words other"), (2, "omega " * 300_000 + "alpha alphas alpha"), (3, None), (4, ""), (5, "omega")], "doc_id long, md string")
    got = values(reconcile.repeated_counts(md), "doc_id", "token", "n")
    assert got == [(1, "words", 2), (2, "alpha", 2), (2, "omega", 300_000)]
    again = md.union(spark.createDataFrame([(5, "alpha omega")], "doc_id long, md string"))
    assert values(reconcile.repeated_counts(again), "doc_id", "token", "n") == [*got, (5, "omega", 2)]
