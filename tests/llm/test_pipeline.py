"""The pipeline against a brute-force version, stage by stage, and the registered queries against their SQL."""

import sys
from pathlib import Path

import brute
import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402
from check_oracles import TABLES, rows_of  # noqa: E402

from tallyframe.llm import bpe, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given():
    if not Path(SF_DIR).exists():
        pytest.skip("given tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, given, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    assert rows_of(queries.QUERIES[name](spark, SF_DIR).toArrow()) == rows_of(connection.sql(queries.ORACLES[name]).to_arrow_table())


def documents(spark):
    return {row.doc_id: row.text for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_queries_equal_brute_force(spark, given):
    texts = documents(spark)
    rows = queries.QUERIES["op5_suffix_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute.repeats(texts.items())
    rows = queries.QUERIES["op3_pii"](spark, SF_DIR).collect()
    assert {r.doc_id: r.base_sha256 for r in rows} == {d: brute.sha(",".join(brute.personal(t))) for d, t in texts.items()}
    rows = queries.QUERIES["op7_secret_scan"](spark, SF_DIR).collect()
    assert {r.doc_id: r.base_sha256 for r in rows} == {d: brute.sha(",".join(brute.secrets(t))) for d, t in texts.items()}


def test_language_held_out_accuracy(spark, given):
    import zlib

    truth = {row.doc_id: row.lang for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in queries.QUERIES["op10_language"](spark, SF_DIR).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pipeline_equals_brute_force(spark, given):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = {row.doc_id for row in corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR).collect()}
    texts = documents(spark)
    assert {d for d, t in texts.items() if any(c.isalpha() for c in t or "") and len((t or "").split()) > 5} <= known
    left = [(d, texts[d]) for d in sorted(known)]
    kept = brute.exact(left)
    left = [(d, t) for d, t in left if kept[d][2]]
    kept = brute.near(left, 5)
    left = [(d, t) for d, t in left if kept[d][2]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = brute.contaminated(left, items)
    left = {d: t for d, t in left if leaks[d][1] <= 0.5 * leaks[d][0]}
    library = Tokenizer.from_file(bpe.default_vocabulary())
    got = {row.doc_id: row for row in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(left)
    for d, row in got.items():
        assert row.text == left[d] or leaks[d][4]
        assert row.tokens == library.encode(row.text, add_special_tokens=False).ids and row.n_tokens == len(row.tokens)
    assert not any(v[4] for v in brute.contaminated([(d, r.text) for d, r in got.items()], items).values())


def test_stages_keep_columns(spark, given):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "decontamination", "BPE encoding"]
