"""What the plans look like: pruning, no cross joins, early limits, skewed joins split."""

import re

import pytest
from pyspark.sql import functions as F

from lantern.operators import retrieval
from lantern.operators.ranking import first_rows
from lantern.operators.tokens import vocabulary, with_vocabulary
from lantern.plans.registry import QUERIES
from lantern.session import shuffle_partitions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [n for n in QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name][0](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["tfidf_embed", "ingest_chunks", "rouge_full", "eval_summary", "batch_answer"])
def test_python_runs_once(spark, sf_dir, name):
    assert plan(QUERIES[name][0](spark, sf_dir)).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["rouge12_nostem", "bleu"])
def test_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name][0](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text


def test_columns_are_pruned(spark, sf_dir):
    text = plan(QUERIES["eval_choice_accuracy"][0](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text
    text = plan(QUERIES["group_advantage"][0](spark, sf_dir))
    assert "text:string" not in text


@pytest.mark.parametrize("name", ["last_history", "forecast_last5", "knn_top3", "sample_examples", "history_latest"])
def test_few_per_group_are_cut_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name][0](spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_limits_filter_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 100_000, 1, 4).withColumn("text", F.md5(F.col("id").cast("string"))).write.parquet(path)
    df = spark.read.parquet(path)
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(id,", plan(first_rows(df, 50, "id")))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(id,", plan(first_rows(df, 50, "id", last=True)))


def test_partitions_by_size():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 << 40) == 819_200


@pytest.fixture
def small_joins(spark):
    """Settings under which little data is large: no broadcasts, small partitions."""
    new = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_words_are_split(spark, small_joins):
    """A third of all tokens are one word; its lookup is spread over tasks."""

    def word(i):
        other = F.concat(F.lit("w"), ((F.col("id") * 60 + i) % 997).cast("string"))
        return F.when(i % 3 == 0, F.lit("the")).otherwise(other)

    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(59)), word))
    df = spark.range(0, 8000, 1, 8).select("id", words.alias("text"))
    vocab = vocabulary(df, "text")
    coded = with_vocabulary(df, {"ids": F.col("text")}, vocab, 512, broadcast_bytes=0)
    rows = coded.select("id", "ids").collect()
    assert "skew=true" in plan_after(coded)
    assert len(rows) == 8000 and all(len(r.ids) == 60 for r in rows)


def test_known_vocabulary_needs_no_shuffle(spark):
    df = spark.createDataFrame([(i, "one two three") for i in range(50)], "id long, text string")
    coded = with_vocabulary(df, {"ids": F.col("text")}, vocabulary(df, "text"), 512)
    assert "Exchange" not in plan(coded)


def test_hot_neighbours_are_split(spark, small_joins):
    """A third of all queries have the same nearest text."""
    found = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("query_id"),
        F.lit(1).alias("rank"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("neighbour_id"),
    )
    texts = spark.range(0, 30_000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    out = retrieval.contexts(found, texts)
    assert out.count() == 30_000
    assert "skew=true" in plan_after(out)


def plan_after(df):
    """The final adaptive plan, once the frame itself has run."""
    df._jdf.queryExecution().toRdd().count()
    return plan(df)
