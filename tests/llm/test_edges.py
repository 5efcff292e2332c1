"""Rows without an id, large and repeated ids, clashing names and empty tables, for every operator and the pipeline."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import class_lm, exact_dedup, language_id, packing, piece_codec, pii, quality_rules, shared, simhash_trie, toxicity

BIG = 2**53 + 1
CLASH = "lang string, source string, n_chars int, row_number_ string, _row_number_ int, digest_ string, votes_ int, __digest string, fp string, row int, `a.b` int, mask int"


def text(k):
    rng = random.Random(k)
    return " ".join("".join(rng.choices("aeiounrst", k=rng.randint(3, 8))) + ("." if j % 9 == 8 else "") for j in range(90))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, ids above 2**53, repeated ids with one text, rows that repeat whole, null and empty texts, columns that clash."""
    rows = [(None, text(0)), (BIG, text(1)), (BIG, text(1)), (BIG + 1, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (None, text(3))]
    rows += [(None, None), (None, ""), (8, None), (9, "x" * 70_000), (BIG + 2, text(4)), (BIG + 2, text(5))]
    rest = ("en", "s", 1, "r", 2, "d", 3, "dd", "f", 4, 5, 6)
    return spark.createDataFrame([(*r, *rest) for r in rows], f"doc_id long, text string, {CLASH}").repartition(3)


def ids(df):
    return Counter(r["doc_id"] for r in df.collect())


def every(spark, docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.coalesce("doc_id", F.lit(0)) % 2).cast("int").alias("toxic"))
    yield quality_rules.assess(docs)
    yield packing.pack(docs).where("piece = 0")
    yield toxicity.score(docs, toxicity.fit(docs, labels))
    yield simhash_trie.near_duplicates(docs)
    yield piece_codec.encode(docs)
    yield pii.find(docs, pii.fit(docs))
    yield class_lm.score(docs)
    yield exact_dedup.groups(docs, exact_dedup.new_index(spark))
    yield language_id.predict(docs, language_id.fit(docs))


def test_a_row_for_every_row(spark, odd):
    want = ids(odd)
    for got in every(spark, odd):
        assert ids(got) == want
    for got in every(spark, odd.where("false")):
        assert got.count() == 0


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_one_row_of_each_group_stays(spark, odd, batches):
    index = exact_dedup.new_index(spark)
    got = exact_dedup.groups(odd, index, batches)
    assert index.rows().count() == index.rows().select("digest").distinct().count() == got.select("text_sha256").distinct().count()
    index.drop()
    rows = got.collect()
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept) == {r["text_sha256"] for r in rows} and set(kept.values()) == {1}
    for r in rows:
        known = [x["doc_id"] for x in rows if x["text_sha256"] == r["text_sha256"] and x["doc_id"] is not None]
        assert r["keep_id"] == min(known, default=None) and r["group_size"] == sum(x["text_sha256"] == r["text_sha256"] for x in rows)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]


def test_filters_keep_rows_without_ids_and_columns_that_clash(spark, odd):
    texts = {r["text"] or "" for r in odd.collect()}
    index = exact_dedup.new_index(spark)
    first = exact_dedup.keep_first(odd, index, 2)
    index.drop()
    near = simhash_trie.keep_one(odd)
    good = quality_rules.keep_good(odd)
    clean = pii.redacted(odd, pii.fit(odd))
    assert sorted((r["text"] or "") for r in first.collect()) == sorted(texts)
    fps = {simhash_trie.fingerprint(simhash_trie.shingle_hashes(t.lower().encode().split())) for t in texts}
    assert len(near.collect()) == len(fps)
    kept = quality_rules.assess(odd).where("kept")
    assert ids(good) == ids(kept) and None in ids(kept)
    assert clean.count() == odd.count()
    for got in (first, near, good, clean):
        assert got.columns == odd.columns and [f.dataType for f in got.schema] == [f.dataType for f in odd.schema]
        assert {tuple(r)[2:] for r in got.collect()} == {("en", "s", 1, "r", 2, "d", 3, "dd", "f", 4, 5, 6)}


def test_earlier_data_stays(spark, odd):
    """What the index knows from another document drops all copies; the same batch run again gives the same."""
    index = exact_dedup.new_index(spark)
    one = exact_dedup.keep_first(odd.where("doc_id IS NOT NULL"), index).collect()
    again = exact_dedup.keep_first(odd.where("doc_id IS NOT NULL"), index).collect()
    later = exact_dedup.keep_first(odd.where("doc_id IS NULL"), index).collect()
    index.drop()
    assert sorted(map(repr, one)) == sorted(map(repr, again))
    assert sorted((r["text"] or "") for r in later) == sorted([text(0), text(2)])


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/some/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    expected = quality_rules.assess(odd).where("kept").select("doc_id").collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in expected if r["doc_id"] != BIG + 1}
    odd.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_keep_columns_and_delete_what_they_leave(spark, odd, tmp_path):
    docs = odd
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == odd.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    with shared.scope("pipeline"):
        shared.sweep(spark)
    assert not [p for s, p in shared._MADE if s == "pipeline"]


def test_shared_folder_is_named_on_a_cluster(spark, monkeypatch):
    class Sc:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

        def getConf(self):
            return {}

    class Session:
        sparkContext = Sc()

    class Empty:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isEmpty(self):
            return True

    monkeypatch.setattr(Sc, "_jsc", Empty())
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_no_operator_reads_a_local_checkpoint():
    from pathlib import Path

    for p in Path(shared.__file__).parent.glob("*.py"):
        assert not re.search(r"localCheckpoint|crossJoin", p.read_text())
