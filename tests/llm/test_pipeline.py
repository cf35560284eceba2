import subprocess
import sys
import zlib
from pathlib import Path

import duckdb

import __spark_entry__ as contract
import corpus_pipeline
from shockwell.llm import simhash as simhash_module, toxicity
from shockwell.plans.storage import settled, written
from tests.llm.helpers import ODD, components, documents, ids_of, lower_az, pii_spans, simhash

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and len(corpus_pipeline.STAGES) == 5
    assert {"op10_exact_dedup", "op11_collocations", "op12_jaccard_join"} == {n for n in contract.oracle_sql() if n.startswith("op")}


def test_the_rest_works_without_the_subpackage():
    code = ("import sys; sys.modules['shockwell.llm'] = None; import __spark_entry__ as e; "
            "names = e.queries(); assert 'equity_risk' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_exact_dedup_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(contract.oracle_sql()["op10_exact_dedup"])
    got = contract.queries()["op10_exact_dedup"](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_near_copies_of_the_pipeline_broadcast_no_keys(spark, monkeypatch):
    plans = {}

    def recorded(df, path, *rest, **options):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, path, *rest, **options)

    monkeypatch.setattr(simhash_module, "written", recorded)
    docs = documents(spark, [(k, f"some words of document {k * k} and {k}") for k in range(30)])
    assert corpus_pipeline.drop_near_copies(spark, docs, SF).count() > 0
    joins = [line for line in plans["pairs"].splitlines() if "Join " in line and ", Inner," in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_stages_against_brute_force(spark):
    docs = [corpus_pipeline.common.table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(settled(stage(spark, docs[-1], SF), "stage"))
    assert all(d.columns == docs[0].columns for d in docs[:5])
    raw, clean, exact, near, masked = ({r.doc_id: r.text for r in d.collect()} for d in docs[:5])
    scored = toxicity.toxicity(docs[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert clean == {r.doc_id: raw[r.doc_id] for r in scored if r.predicted == 0}
    keep = {}
    for i, t in clean.items():
        keep[lower_az(t)] = max(i, keep.get(lower_az(t), i))
    assert exact.keys() == set(keep.values())
    root = components([simhash(t) for t in exact.values()])
    named = {}
    for i, t in exact.items():
        c = root[simhash(t)]
        named[c] = min(i, named.get(c, i))
    assert near.keys() == set(named.values())
    assert masked.keys() == near.keys()
    for i, t in near.items():
        spans = pii_spans(t)
        if not spans:
            assert masked[i] == t
        else:
            assert not any(t[a:b] in masked[i] for a, _, b, _ in spans)
    packed = docs[5].collect()
    pieces = {}
    for r in sorted(packed, key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    assert pieces == dict(zip(masked, ids_of(masked.values(), end=1)))


def test_odd_rows_pass_through_every_stage(spark):
    table = documents(spark, ODD)
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, SF), "stage")
        assert docs.schema == table.schema, name
    left = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(left) == docs.count()
    texts = [t for _, t in left]
    assert sum(not (t or "").strip() for t in texts) == 1  # blank texts are near copies of each other
    assert any("<EMAIL>" in (t or "") and "<IP>" in t and "<CARD>" in t and "<PHONE>" in t for t in texts)
    assert {r.n_chars - len(r.text) for r in docs.collect() if r.text} == {0}
    assert corpus_pipeline.pack(spark, docs, SF).count() >= len(left)


def test_empty_table_passes_through_empty(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "stage")
        assert docs.count() == 0


def test_run_is_all_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
