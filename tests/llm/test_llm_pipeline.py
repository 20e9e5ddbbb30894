"""The pipeline stage by stage against slow versions, and the registered queries."""

import hashlib
import re

import corpus_pipeline
import pytest
from lantern.llm import queries
from lantern.session import ship
from test_llm_nearcopies import slow_kept

TABLES = ("documents", "labels", "benchmark")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage makes of the documents at sf0.01."""
    sf_dir = "/root/testdata/sf0.01"
    docs, made = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        made.append(docs)
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return [*made, docs]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_quality(spark, steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns
    kept = by_id(steps[1])
    labels = by_id(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    clean = [k in kept for k, r in labels.items() if r.quality == 1 and r.toxic == 0]
    bad = [k in kept for k, r in labels.items() if r.quality == 0]
    assert sum(clean) > 0.95 * len(clean) and sum(bad) < 0.05 * len(bad)


def test_one_of_each_class_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert sorted(by_id(steps[2])) == slow_kept(rows)


def test_benchmarks_go_and_others_stay(spark, steps):
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    before, after = by_id(steps[2]), by_id(steps[3])
    leaks = {k for k, r in before.items() if any(i in plain(r.text) for i in items)}
    assert leaks and set(after) == set(before) - leaks


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def test_personal_data_is_replaced(steps):
    secret = re.compile(r"[\w.]+@mail\d|\b4\d{15}\b|\+1 \(\d{3}\) 555-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b")
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    for key, row in before.items():
        found = [v for v in secret.findall(row.text) if not v.isdigit() or luhn(v)]
        assert all(value not in after[key].text for value in found)
        assert found or re.search("token|password|AKIA", row.text) or row.text == after[key].text
        assert after[key].n_chars == len(after[key].text)


def test_ids_decode_to_the_texts(steps):
    texts, made = by_id(steps[4]), by_id(steps[5])
    assert set(texts) == set(made)
    for key, row in made.items():
        assert row.decoded_sha256 == hashlib.sha256(texts[key].text.encode()).hexdigest() and row.n_tokens == len(row.ids)


def test_odd_documents(spark, tmp_path):
    """Nulls, empty texts, repeats and no rows at all go through every stage."""
    for name in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (9000, "", "en", "s", 0), (9001, None, "en", "s", 0), (3, "again", "en", "s", 5)], docs.schema)
    for start in (docs.unionByName(odd).union(docs.limit(9)), docs.limit(0)):
        step = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{name}-{start.count()}"
            stage(spark, step, str(tmp_path)).write.parquet(path)
            step = spark.read.parquet(path)
        assert step.count() <= start.count()


def test_all_are_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= names and ship(spark) is spark


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_against_sql(spark, sf_dir, name):
    from oracle import compare, connect

    query, sql = queries.QUERIES[name]
    assert compare(query(spark, sf_dir), sql, connect(sf_dir)) == ""
