from collections import Counter
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plateful.llm import quality, queries
from plateful.plans.staging import folders, shared_folder
from tests.llm.cases import SCHEMA, WORDS, clashing, documents, frame, stored
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_topk import vectors

COLUMNS = {
    "op1_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op2_simhash_near_duplicates": ["doc_id", "fingerprint", "component_id"],
    "op3_pseudonyms": ["doc_id", "text"],
    "op4_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_shard_documents": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op6_top_k": ["query_id", "rank", "vec_id", "score"],
    "op7_pack_documents": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_language": ["page_id", "language", "probability"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op13_fill_windows": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    stored(frame(spark), "documents", folder)
    stored(spark.createDataFrame(vectors(250, 5), "vec_id long, embedding array<float>, label int"), "embeddings", folder)
    stored(spark.createDataFrame([(i, 1, i % 2) for i in range(1, 30)], "doc_id long, quality int, toxic int"), "labels", folder)
    stored(spark.createDataFrame([(1, "https://a.com/", "<html lang='en'><p>on the of to</p></html>"), (2, None, None)],
                                 "page_id long, url string, html string"), "pages", folder)
    return folder


def test_every_operator_is_registered():
    assert {q.__name__ for q in queries.QUERIES} == set(COLUMNS) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", COLUMNS)
def test_result_columns(spark, tables, name):
    found = entry.queries()[name](spark, tables)
    assert found.columns[:len(COLUMNS[name])] == COLUMNS[name]
    found.write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_rows_match_sql(spark, tables, name):
    found = entry.queries()[name](spark, tables)
    engine = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        engine.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    expected = engine.sql(f"SELECT {', '.join(found.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_pipeline_stages_keep_columns_and_rows(spark, tables):
    docs = clashing(frame(spark), "kept", "fingerprint", "takes", "_row")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns, name
        folder = stored(after, "documents")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        seen.append(docs.count())
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] == seen[2] and seen[4] > seen[3]
    assert docs.filter("n_chars != length(text)").count() == 0


def test_pipeline_equals_its_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.read.parquet(stored(stage(spark, docs, tables), "documents") + "/documents.parquet")
    drop = ["sequence_id", "offset"]        # numbers of sequences may differ
    assert sorted(map(str, corpus_pipeline.run(spark, tables).drop(*drop).collect())) == sorted(map(str, docs.drop(*drop).collect()))


def _with_personal_data(spark):
    """Good documents, some with a mail address, in which that is the only text with an @ sign."""
    docs = [(d[0], f"{d[1]} mail jane.doe{d[0]}@mail.example.com now", *d[2:]) for d in documents() if d[0] is not None and 1 <= d[0] <= 40]
    return frame(spark, docs)


def _files_with(folder, word):
    found = []
    for path in Path(folder.removeprefix("file:")).rglob("*"):
        if path.is_file() and path.suffix == ".parquet":
            table = pq.read_table(path)
            found += [str(path) for c in table.columns if any(word in str(v) for v in c.to_pylist())]
    return found


def test_pipeline_leaves_its_last_stage_only(spark, tmp_path):
    folder = stored(_with_personal_data(spark), "documents")
    shared = shared_folder(spark)
    before = set(folders(spark, shared))
    result = corpus_pipeline.run(spark, folder)
    new = [f for f in folders(spark, shared) if f not in before and f.startswith("corpus-")]
    assert len(new) == 1 and folders(spark, f"{shared}/{new[0]}") == ["packed"] and result.count() > 0
    assert not _files_with(f"{shared}/{new[0]}", "jane.doe")
    kept = corpus_pipeline.run(spark, folder, f"{tmp_path}/result")
    assert kept.count() == result.count() and kept.inputFiles()[0].startswith(f"file://{tmp_path}/result")
    more = [f for f in folders(spark, shared) if f.startswith("corpus-") and f not in {*before, *new}]
    assert not any(folders(spark, f"{shared}/{f}") for f in more)


def test_pipeline_that_fails_leaves_nothing(spark, monkeypatch):
    folder = stored(_with_personal_data(spark), "documents")
    before = set(folders(spark, shared_folder(spark)))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("PII", broken)])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, folder)
    assert not [f for f in folders(spark, shared_folder(spark)) if f.startswith("corpus-") and f not in before]


def test_each_stage_against_plain_python(spark, tables):
    """What each stage may do to a document, told from its own input alone."""
    docs = frame(spark).unionByName(_with_personal_data(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    good, near, personal, mixed = corpus_pipeline.STAGES[0][1], *[f for _, f in corpus_pipeline.STAGES[1:4]]
    given = Counter(map(tuple, docs.collect()))
    kept = Counter(map(tuple, good(spark, docs, tables).collect()))
    assert not kept - given
    for row in given - kept:            # what goes fails the base rule, or the rules' vote in the report
        assert row[0] is None or row[0] in {r["doc_id"] for r in quality.quality_report(docs).filter("NOT kept").collect()}
    after = Counter(map(tuple, near(spark, docs, tables).collect()))
    prints = {}
    for row in given:
        prints.setdefault(plain_fingerprint(row[1]), []).append(row)
    component = plain_components(sorted(prints))
    groups = {}
    for p, rows_ in prints.items():
        groups.setdefault(component[p], []).extend(rows_)
    assert sum(after.values()) == len(groups) and not after - given
    first = {min((r[0] is None, r[0] or 0) for r in g) for g in groups.values()}
    assert {(r[0] is None, r[0] or 0) for r in after} == first
    hidden = personal(spark, docs, tables).collect()
    assert len(hidden) == sum(given.values()) and not any("jane.doe" in (r["text"] or "") for r in hidden)
    unchanged = Counter(r["doc_id"] for r in hidden if (r["text"] or "").find("@") < 0)
    assert unchanged == Counter(d[0] for d in given.elements() if (d[1] or "").find("@") < 0)
    assert all(r["n_chars"] == len(r["text"]) for r in hidden if r["text"] is not None)
    copies = Counter(map(tuple, mixed(spark, docs, tables).collect()))
    assert not set(copies) - set(given) and all(n <= 2 * given[r] for r, n in copies.items())
    words = sum(len(WORDS.findall(r[1] or "")) * n for r, n in given.items())
    taken = sum(len(WORDS.findall(r[1] or "")) * n for r, n in copies.items())
    assert abs(taken - 1.5 * words) <= 5 * max(len(WORDS.findall(r[1] or "")) for r in given)


def test_pipeline_on_an_empty_table(spark):
    folder = stored(frame(spark, [], SCHEMA), "documents")
    assert corpus_pipeline.run(spark, folder).count() == 0
    assert len(documents()) > 60
