"""Preference data: edge cases, ties, hot groups and errors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lantern.functions.checks import check_parameters
from lantern.functions.preference import preference_loss
from lantern.operators import preference as pref
from lantern.operators.ranking import first_per_group, first_rows, joined_text, positions, rank_within, running_totals
from lantern.operators.skew import split_hot, spread
from lantern.operators.tokens import vocabulary, with_vocabulary


def test_transcripts(spark):
    long = "\n\nHuman: a\n\nAssistant: b\n\nHuman: c\n\nAssistant: d \n"
    rows = [(long, " plain "), (" plain ", long)]
    out = pref.split_transcripts(spark.createDataFrame(rows, "chosen string, rejected string")).collect()
    assert tuple(out[0]) == ("\n\nHuman: a\n\nAssistant:", "d", " plain ")
    assert tuple(out[1]) == ("", " plain ", "d")


def test_transcripts_only_without_prompt(spark):
    df = spark.createDataFrame([("p", "c", "r")], "prompt string, chosen string, rejected string")
    assert pref.with_prompt(df).columns == ["prompt", "chosen", "rejected"]
    assert pref.with_prompt(df).first().chosen == "c"


def test_missing_columns(spark):
    df = spark.createDataFrame([("p", "c")], "prompt string, chosen string")
    with pytest.raises(ValueError, match="missing required column: rejected"):
        pref.prepare(df, "dpo")
    for method in ("ppo", "grpo", "online_dpo"):
        with pytest.raises(ValueError, match="missing 'prompt'"):
            pref.prepare(df.drop("prompt"), method)
    with pytest.raises(ValueError, match=r"Unknown method: sft. Available: \['dpo', 'ppo', 'online_dpo', 'grpo'\]"):
        pref.prepare(df, "sft")


def test_loss(spark):
    margins = [0.0, 2.0, -2.0, 800.0, -800.0]
    df = spark.createDataFrame([(m, 0.0) for m in margins], "c double, r double")
    out = [r[0] for r in df.select(preference_loss("c", "r")).collect()]
    assert out == pytest.approx([math.log(2), 0.126928, 2.126928, 0.0, 800.0], abs=1e-6)
    # loss(d) - loss(-d) = -d
    assert out[1] - out[2] == pytest.approx(-2.0)


def test_ranking_and_pairs_with_ties(spark):
    rows = [("p", 0, "a", 1.0), ("p", 1, "b", 1.0), ("p", 2, "c", 0.5), ("p", 3, "d", 0.5)]
    df = spark.createDataFrame(rows, "prompt string, n int, text string, reward double")
    ranked = pref.rank(df, ["prompt"], "n").orderBy("rank").collect()
    assert "".join(r.text for r in ranked) == "abcd"
    pair = pref.pairs(df, ["prompt"], "n", "text").first()
    assert (pair.chosen, pair.rejected, pair.samples) == ("a", "d", 4)
    plain = pref.pairs(df.withColumn("reward", -F.col("n").cast("double")), ["prompt"], "n", "text", reward=None).first()
    assert (plain.chosen, plain.rejected) == ("a", "d")


def skewed(spark, n=3000):
    """One group holds a third of the rows; rewards have many ties."""
    rng = random.Random(4)
    rows = [
        ("hot" if i % 3 == 0 else f"g{i % 100}", i, float(rng.randint(0, 3)), f"t{i}") for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "g string, n int, reward double, text string").repartition(6)


def ranks_of(rows):
    want = {}
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        want.update({r[1]: k for k, r in enumerate(ordered, 1)})
    return want


@pytest.mark.parametrize("hot_rows", [1_000_000, 500, 10])
def test_ranking_of_hot_groups(spark, hot_rows):
    rows, df = skewed(spark)
    ranked = rank_within(df, ["g"], [F.col("reward").desc(), F.col("n")], hot_rows=hot_rows)
    assert {r.n: r["rank"] for r in ranked.collect()} == ranks_of(rows)
    assert ranked.columns == ["g", "n", "reward", "text", "rank"]


def test_split_hot(spark):
    _, df = skewed(spark)
    cold, hot = split_hot(df, ["g"], 500)
    assert {r.g for r in hot.select("g").distinct().collect()} == {"hot"}
    assert cold.count() + hot.count() == 3000
    assert split_hot(df, ["g"], 5000)[1] is None


def test_first_per_group_beyond_the_pruning_limit(spark):
    rows, df = skewed(spark, 6000)
    got = first_per_group(df, ["g"], [F.col("reward").desc(), F.col("n")], 1500, "place")
    want = {n for n, r in ranks_of(rows).items() if r <= 1500}
    assert {r.n for r in got.collect()} == want


@pytest.mark.parametrize("hot_rows", [1_000_000, 500])
def test_advantage(spark, hot_rows):
    rows, df = skewed(spark)
    out = pref.group_advantage(df, ["g"], hot_rows=hot_rows).collect()
    groups = {}
    for g, _, reward, _ in rows:
        groups.setdefault(g, []).append(reward)
    assert len(out) == len(rows)
    for r in out:
        v = groups[r.g]
        mean = sum(v) / len(v)
        sd = math.sqrt(sum((x - mean) ** 2 for x in v) / (len(v) - 1))
        assert r.advantage == pytest.approx((r.reward - mean) / (sd + 1e-4))
    assert out[0].asDict().keys() == {"g", "n", "reward", "text", "advantage"}


def test_advantage_clip_and_lonely_groups(spark):
    df = spark.createDataFrame([("a", 0.0)] * 200 + [("a", 9.0), ("b", 1.0)], "g string, reward double")
    out = pref.group_advantage(df, ["g"], clip=10.0).collect()
    assert max(r.advantage for r in out) == 10.0 and {r.g for r in out} == {"a"}
    with pytest.raises(ValueError):
        pref.group_advantage(df, ["g"], clip=0.0)


def test_advantage_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 1.0), ("a", 2.0)], "g string, reward double")
    for hot in (1, 100):
        out = pref.group_advantage(df, ["g"], hot_rows=hot).collect()
        assert len(out) == 4 and sorted(round(r.advantage, 2) for r in out if r.g is None) == [-0.71, 0.71]


def test_vocabulary_paths_agree(spark):
    """Held by the workers or joined; rows repeat, one text is null, some words are unknown."""
    rows = [(1, "beta alpha"), (1, "beta alpha"), (1, "alpha beta"), (2, None), (2, ""), (3, "alpha zzz beta alpha")]
    df = spark.createDataFrame(rows, "id long, text string")
    vocab = vocabulary(df.where("id = 1"), "text")
    want = [[1, 0], [1, 0], [0, 1], [], [], [0, 2, 1, 0]]
    for size in (1 << 20, 0):
        out = with_vocabulary(df, {"ids": F.col("text")}, vocab, None, broadcast_bytes=size)
        assert sorted((r.id, r.text or "", r.ids) for r in out.collect()) == sorted((i, t or "", w) for (i, t), w in zip(rows, want))


def test_positions_and_limits(spark):
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 5000).repartition(9)
    assert {r.k: r.position for r in positions(df, [F.col("k")]).collect()} == {i: i for i in range(5000)}
    for n in (1, 10, 700, 4999, 5000, 9000):
        assert sorted(r.k for r in first_rows(df, n, "k").collect()) == list(range(min(n, 5000)))
        want = list(range(max(0, 5000 - n), 5000))
        assert sorted(r.k for r in first_rows(df, n, "k", last=True).collect()) == want
    assert first_rows(df, None, "k").count() == first_rows(df, 0, "k").count() == 5000


def test_limit_beyond_one_task(spark):
    df = spark.range(30_000).repartition(5)
    assert sorted(r.id for r in first_rows(df, 12_000, "id").collect()) == list(range(12_000))


def test_first_rows_beyond_doubles(spark):
    """Neighbouring ids that are one number as doubles."""
    df = spark.range(100_000).select((F.lit(1 << 60) + (F.col("id") * 7919) % 100_000).alias("k"))
    for n in (10, 50, 3000):
        assert sorted(r.k - (1 << 60) for r in first_rows(df, n, "k").collect()) == list(range(n))
        want = list(range(100_000 - n, 100_000))
        assert sorted(r.k - (1 << 60) for r in first_rows(df, n, "k", last=True).collect()) == want
    assert pref.buffer(None, df, 10, "k").count() == pref.prompt_cap(df, "k", 10).count() == 10


@pytest.mark.parametrize("rows", [20, 200_000])
def test_first_rows_takes_null_keys_last(spark, rows):
    df = spark.range(rows).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("k"))
    filled = [i for i in range(rows) if i % 4]
    for last in (False, True):
        got = [r.k for r in first_rows(df, 10, "k", last=last).collect()]
        assert sorted(got) == (filled[-10:] if last else filled[:10])
    more = [r.k for r in first_rows(df, len(filled) + 2, "k").collect()]
    assert len(more) == len(filled) + 2 and more.count(None) == 2


def test_first_rows_with_one_value_everywhere(spark):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") < 5, F.col("id")).otherwise(9))
    got = [(r.k, r.id) for r in first_rows(df, 8, "k", F.col("id")).collect()]
    assert got == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (9, 5), (9, 6), (9, 7)]


def test_limit_splits(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    out = pref.limit_splits(df, "id", max_train=10, max_test=0)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 10, "test": 25}
    alone = pref.limit_splits(df.where("split = 'train'"), "id", max_train=500, max_test=5)
    assert alone.count() == 75


def test_buffer(spark):
    old = spark.createDataFrame([(1,), (2,)], "seq long")
    new = spark.createDataFrame([(3,), (4,)], "seq long")
    for size, want in ((3, [2, 3, 4]), (None, [1, 2, 3, 4]), (0, [1, 2, 3, 4]), (9, [1, 2, 3, 4])):
        assert sorted(r.seq for r in pref.buffer(old, new, size, "seq").collect()) == want
    with pytest.raises(ValueError):
        pref.buffer(old, new, -1, "seq")


@pytest.mark.parametrize("size", [1, 7, 40, 1200])
def test_buffer_snapshots(spark, size):
    rng = random.Random(6)
    rows = [(i, rng.choice([1, 1, 1, 2, 4, 5, 9])) for i in range(2000)]
    out = pref.buffer_snapshots(spark.createDataFrame(rows, "seq long, it int"), size, "seq", "it").collect()
    got, want = {}, {}
    for r in out:
        got.setdefault(r.snapshot, set()).add(r.seq)
    for k in {it for _, it in rows}:
        upto = sorted((it, seq) for seq, it in rows if it <= k)
        want[k] = {seq for _, seq in upto[-size:]}
    assert got == want


def test_snapshots_of_single_rows(spark):
    """An iteration for each row: as many iterations as rows, size of them in each snapshot."""
    df = spark.range(3000).selectExpr("id AS seq", "id AS it").repartition(6)
    out = pref.buffer_snapshots(df, 3, "seq", "it").groupBy("snapshot").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count("seq").alias("n"))
    for r in out.collect():
        assert (r.a, r.b, r.n) == (max(0, r.snapshot - 2), r.snapshot, min(3, r.snapshot + 1))


def test_hot_groups_of_long_and_null_keys(spark):
    """Hot groups are joined by 16 bytes: nulls on either side are different groups, and keys may be long."""
    rng = random.Random(9)
    long = "x" * 50_000
    keys = [(None, "a"), ("a", None), (None, None), (long, "b"), (long, "c"), ("cold", "d")]
    rows = [(*keys[i % 6 if i < 300 else i % 5], i, rng.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, h string, id int, reward double").repartition(4)
    for hot_rows in (1, 80, 10_000):
        ranks = {r.id: r.rank for r in rank_within(df, ["g", "h"], [F.col("id")], hot_rows=hot_rows).collect()}
        made = {r.id: r.advantage for r in pref.group_advantage(df, ["g", "h"], hot_rows=hot_rows).collect()}
        assert len(ranks) == len(made) == len(rows)
        for key in keys:
            own = [r for r in rows if r[:2] == key]
            mean = sum(r[3] for r in own) / len(own)
            deviation = math.sqrt(sum((r[3] - mean) ** 2 for r in own) / (len(own) - 1))
            for place, r in enumerate(own):
                assert ranks[r[2]] == place + 1 and made[r[2]] == pytest.approx((r[3] - mean) / (deviation + 1e-4))


def test_running_totals(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, 1, 5, -2])) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    made = {r.k: r.total for r in running_totals(df, [F.col("k")], "v", "total").collect()}
    total = 0
    for k, v in rows:
        total += v or 0
        assert made[k] == total
    assert running_totals(df.limit(0), [F.col("k")], "v", "total").collect() == []


def test_stat_means(spark):
    rows = [(1, {"a": 1.0, "b": None}), (2, {"a": 3.0, "c": 9.0}), (3, {"b": None})]
    df = spark.createDataFrame(rows, "step int, stats map<string,double>")
    assert [tuple(r) for r in pref.stat_means(df).collect()] == [("train_a", 2.0)]
    assert pref.stat_means(df.where("step > 9")).count() == 0


def test_completion_texts(spark):
    kind = "id int, completion array<struct<role string, content string>>"
    rows = [(1, [("a", "x"), ("a", "y")]), (2, [("a", None)]), (3, [])]
    prompts = spark.createDataFrame([(1, "p")], "id int, prompt string")
    out = pref.completions_with_prompts(spark.createDataFrame(rows, kind), prompts, "id").orderBy("id").collect()
    assert [(r.completion_text, r.prompt) for r in out] == [("x", "p"), ("", ""), ("[]", "")]
    plain = pref.completions_with_prompts(spark.createDataFrame([(1, "x")], "id int, completion string"), prompts, "id")
    assert plain.first().completion_text == "x"


def test_finished_only(spark):
    df = spark.createDataFrame([(5, False), (8, False), (8, True)], "n int, done boolean")
    assert pref.finished_only(df, "n", 8).count() == 1
    assert pref.finished_only(df, "n", 8, "done").count() == 2


def test_evaluation_reward(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "reward double")
    assert tuple(pref.evaluation_reward(df).first()) == (1.5, 2)
    assert tuple(pref.evaluation_reward(df.where("reward > 5")).first()) == (0.0, 0)


# --- tokens --------------------------------------------------------------------------------------
def talk(spark):
    rows = [(1, "the cat The Dog", "sat", "ran off"), (2, "", "the", "cat"), (3, "dog " * 10, "zebra", "")]
    return spark.createDataFrame(rows, "id int, prompt string, chosen string, rejected string")


def test_vocabulary(spark):
    out = vocabulary(talk(spark), "prompt").orderBy("id").collect()
    assert [(r.word, r.n, r.id) for r in out] == [("dog", 11, 0), ("the", 2, 1), ("cat", 1, 2)]


def test_tokenise(spark):
    vocab = vocabulary(talk(spark), "prompt")
    out = pref.prepare(talk(spark).select("id", "prompt"), "ppo", ["id"], 3, vocab=vocab).orderBy("id").collect()
    assert [r.input_ids for r in out] == [[1, 2, 1], [], [0, 0, 0]]
    assert [r.attention_mask for r in out] == [[1, 1, 1], [], [1, 1, 1]]
    assert out[0].query == out[0].prompt == "the cat The Dog"


def test_own_tokenizer(spark):
    def letters(texts):
        return [[ord(c) for c in t] for t in texts]

    out = pref.tokenise_prompts(talk(spark), ["id"], 4, tokenizer=letters).orderBy("id").collect()
    assert out[0].input_ids == [ord(c) for c in "the "]
    pairs = pref.reward_pairs(talk(spark), ["id"], 6, tokenizer=letters, pad=-1).orderBy("id").collect()
    assert pairs[1].input_ids_chosen == [116, 104, 101, -1, -1, -1]
    assert pairs[1].attention_mask_chosen == [1, 1, 1, 0, 0, 0]
    assert all(len(x) == 6 for r in pairs for x in r[1:])


def test_reward_pairs_with_vocabulary(spark):
    vocab = vocabulary(talk(spark), "prompt")
    out = pref.reward_pairs(talk(spark), ["id"], 5, vocab=vocab).orderBy("id").collect()
    # prompt and completion are joined without a space: "Dogsat" and "Dogran" are unknown, and have id 3
    assert out[0].input_ids_chosen == [1, 2, 1, 3, 0] and out[0].attention_mask_chosen == [1, 1, 1, 1, 0]
    assert out[1].input_ids_rejected == [2, 0, 0, 0, 0]


def test_dpo_lengths(spark):
    df = spark.createDataFrame([(list(range(10)), list(range(20)))], "p array<int>, c array<int>")
    end = pref.dpo_lengths(df, "p", "c", 4, 10).first()
    assert (end.p, end.c) == ([6, 7, 8, 9], list(range(6)))
    start = pref.dpo_lengths(df, "p", "c", 4, 10, "keep_start").first()
    assert start.p == [0, 1, 2, 3]
    assert pref.dpo_lengths(df, "p", "c", 8, 5).first().c == []
    with pytest.raises(ValueError, match="truncation_mode"):
        pref.dpo_lengths(df, "p", "c", 4, 10, "middle")


def test_joined_text_over_blocks(spark):
    rows = [("hot" if i % 3 else f"g{i}", i, f"<{i}>") for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, turn int, text string").repartition(7)
    got = {r.g: r.flat for r in joined_text(df, ["g"], "turn", "text", "flat", block=64).collect()}
    want = {}
    for g, _, t in rows:
        want[g] = want.get(g, "") + t
    assert got == want


def test_linear_reward(spark):
    rng = random.Random(8)
    truth = [1.5, -2.0, 0.5]
    rows = []
    for _ in range(400):
        a, b = ([rng.gauss(0, 1) for _ in truth] for _ in range(2))
        better = sum(w * (x - y) for w, x, y in zip(truth, a, b)) > 0
        rows.append((a, b) if better else (b, a))
    df = spark.createDataFrame(rows, "chosen array<double>, rejected array<double>")
    weights = pref.fit_linear_reward(df, "chosen", "rejected").coefficients.toArray().tolist()
    scored = df.select(pref.linear_reward("chosen", weights).alias("c"), pref.linear_reward("rejected", weights).alias("r"))
    out = pref.mean_loss(scored, "c", "r").first()
    assert out.loss < 0.2 and out.pairs == 400
    assert scored.where("c > r").count() > 380


def test_parameter_ranges():
    check_parameters(samples_per_prompt=2, label_smoothing=0.0, top_p=1.0, num_iterations=None)
    for bad in (
        {"samples_per_prompt": 1}, {"label_smoothing": 1.1}, {"top_p": 0.0}, {"temperature": 0},
        {"replay_ratio": -0.1}, {"beta": 0.0}, {"no_such": 1},
    ):
        with pytest.raises(ValueError):
            check_parameters(**bad)


def test_spread(spark):
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(0, 100, 1, 20)).rdd.getNumPartitions() == 20
