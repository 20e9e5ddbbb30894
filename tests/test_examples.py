"""Example builders, sampling, prompts and the readers and writers."""

import pytest
from pyspark.sql import functions as F

from lantern.operators import examples
from lantern.sources import catalog, tables


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_mmlu(spark):
    raw = spark.createDataFrame(
        [(1, "2+2?", ["3", "4"], 1)], "id int, question string, choices array<string>, answer int"
    )
    r = one(examples.build("MMLU", raw, ["id"]))
    assert r.prompt == "Question: 2+2?\n\nA. 3\nB. 4\n\nAnswer:"
    assert (r.gold_answer, r.metadata, r.choices) == ("B", {"subject": "unknown"}, ["3", "4"])
    assert r.system_prompt.startswith("You are taking a multiple choice test.")


def test_gsm8k(spark):
    raw = spark.createDataFrame(
        [(1, "q", "a #### 4 #### 5 "), (2, "q", "no marker")], "id int, question string, answer string"
    )
    out = examples.build("GSM8K", raw, ["id"]).orderBy("id").collect()
    assert [r.gold_answer for r in out] == ["5", "no marker"]
    assert out[0].prompt == "Question: q\n\nProvide your answer as a number."


def test_hellaswag_and_truthfulqa(spark):
    raw = spark.createDataFrame([(1, "he", ["x", "y", "z"], "2")], "id int, ctx string, endings array<string>, label string")
    r = one(examples.build("HellaSwag", raw, ["id"]))
    assert (r.gold_answer, r.metadata) == ("C", {"activity_label": ""})
    assert r.prompt.startswith("Context: he\n\nA. x\n")
    raw = spark.createDataFrame(
        [(1, "q", (["a", "b", "c"], [0, 0, 1])), (2, "q", (["a", "b"], [0, 0]))],
        "id int, question string, mc1_targets struct<choices array<string>, labels array<int>>",
    )
    out = examples.build("TruthfulQA", raw, ["id"]).orderBy("id").collect()
    assert [r.gold_answer for r in out] == ["C", "A"]


def test_gpqa_is_a_seeded_shuffle(spark):
    names = ["Question", "Correct Answer", "Incorrect Answer 1", "Incorrect Answer 2", "Incorrect Answer 3"]
    rows = [(i, "q", "right", "w1", "w2", "w3") for i in range(200)]
    raw = spark.createDataFrame(rows, ["id", *names])
    out = examples.build("GPQA", raw, ["id"]).collect()
    for r in out:
        assert sorted(r.choices) == ["right", "w1", "w2", "w3"]
        assert r.choices["ABCD".index(r.gold_answer)] == "right"
    assert {r.gold_answer for r in out} == set("ABCD")
    again = {r.id: r.choices for r in examples.build("GPQA", raw, ["id"]).collect()}
    other = {r.id: r.choices for r in examples.build("GPQA", raw, ["id"], seed=7).collect()}
    assert again == {r.id: r.choices for r in out} and other != again
    # a wrong answer with the text of the right one: the first of the two counts
    twin = spark.createDataFrame([(1, "q", "same", "same", "w", "v")], ["id", *names])
    r = one(examples.build("GPQA", twin, ["id"]))
    assert r.choices.index("same") == "ABCD".index(r.gold_answer)


def test_article_cut(spark):
    raw = spark.createDataFrame(
        [(1, "x" * 3000, "s"), (2, "é" * 3001, "su")], "id int, article string, highlights string"
    )
    a, b = examples.build("CNNDailyMail", raw, ["id"]).orderBy("id").collect()
    assert a.prompt == "Article: " + "x" * 3000 + "\n\nProvide a concise summary (2-4 sentences):"
    assert b.prompt.startswith("Article: " + "é" * 3000 + "...\n")
    assert b.metadata == {"article_length": "3001", "summary_length": "2"}


def test_unknown_dataset_is_an_error(spark):
    with pytest.raises(ValueError, match="mmlu not supported"):
        examples.build("mmlu", spark.range(1), ["id"])


def test_sampling(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    picked = {r.id for r in examples.sample(df, "id", 10).collect()}
    assert len(picked) == 10 and picked == {r.id for r in examples.sample(df, "id", 10).collect()}
    assert picked != {r.id for r in examples.sample(df, "id", 10, seed=1).collect()}
    per = examples.sample(df, "id", 2, per=["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in per} == {0: 2, 1: 2, 2: 2}


def test_prompts(spark):
    df = spark.createDataFrame([("p", "s"), ("p", "")], "p string, s string")
    assert [r[0] for r in df.select(examples.full_prompt("p", "s")).collect()] == ["s\n\np", "p"]
    q = df.select(examples.question_prompt(F.lit("abc"), F.lit("xyz"))).first()[0]
    assert q == "Context: abc \n\n Questions: xyz"


KINDS = {
    "pick: A. x": "multiple_choice", "A. x": "other", "What is it?": "math", "CALCULATE 2": "math",
    "Return it": "code", "def f": "code", "hello": "other", "what is D. y": "math", "what is  D. y": "multiple_choice",
}


def test_prompt_kind(spark):
    df = spark.createDataFrame([(k,) for k in KINDS], "p string")
    got = {r.p: r.k for r in df.select("p", examples.prompt_kind("p").alias("k")).collect()}
    KINDS["what is D. y"] = "multiple_choice"  # " D." is in it
    assert got == KINDS


def test_leading_rows(spark):
    raw = spark.range(1000).withColumnRenamed("id", "k").repartition(7)
    assert sorted(r.k for r in examples.leading_rows("MMLU", raw, "k").collect()) == list(range(100))
    assert examples.leading_rows("HumanEval", raw, "k").count() == 1000


# --- sources -------------------------------------------------------------------------------------
def test_text_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("line one\nline two\n")
    (tmp_path / "b.txt").write_text("é")
    (tmp_path / "c.md").write_text("no")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "d.txt").write_text("no")
    rows = tables.read_text_documents(spark, str(tmp_path)).collect()
    assert sorted(r.text for r in rows) == ["line one\nline two\n", "é"]
    assert all(r.path.endswith(".txt") for r in rows)


def test_load_preferences(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([("train", 1), ("test", 2)], "split string, x int")
    tables.save_dataset(df, base, "Anthropic/hh-rlhf")
    assert (tmp_path / "Anthropic_hh-rlhf").is_dir()
    loaded = tables.load_preferences(spark, base, "anthropic-hh-rlhf")
    assert (loaded.train, loaded.test, loaded.data.count()) == ("train", "test", 2)
    tables.save_dataset(df, base, "HuggingFaceH4/ultrafeedback_binarized")
    with pytest.raises(ValueError, match=r"'train_prefs' not found.*\['test', 'train'\]"):
        tables.load_preferences(spark, base, "ultrafeedback-binarized")
    with pytest.raises(ValueError, match="No dataset name"):
        tables.load_preferences(spark, base, None)


def test_catalogs(spark):
    assert catalog.benchmarks(spark).count() == 7
    sets = {r.alias: r for r in catalog.preference_sets(spark).collect()}
    assert len(sets) == 6 and sets["ultrafeedback-binarized"].train_split == "train_prefs"
    assert catalog.metric_texts(spark).count() == 9


def test_export_keeps_texts_whole(spark, tmp_path):
    texts = ['say "hi", ok', "two\nlines", " spaced ", "back\\slash", "tab\tin", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    csv = tables.export(df.where("t is not null and t <> ''"), str(tmp_path / "csv"), "csv")
    got = {r.i: r.t for r in tables.read_csv(spark, csv, "i int, t string").collect()}
    assert got == {i: t for i, t in enumerate(texts) if t}
    json = tables.export(df, str(tmp_path / "json"), "json")
    assert {r.i: r.t for r in spark.read.schema("i int, t string").json(json).collect()} == dict(enumerate(texts))
    with pytest.raises(ValueError, match="xml"):
        tables.export(df, str(tmp_path / "x"), "xml")


def test_gpqa_needs_an_id(spark):
    df = spark.createDataFrame([("q", "a", "b", "c", "d")], ["Question", "Correct Answer", *[f"Incorrect Answer {i}" for i in (1, 2, 3)]])
    with pytest.raises(ValueError, match="identifies a row"):
        examples.build("GPQA", df, [])
