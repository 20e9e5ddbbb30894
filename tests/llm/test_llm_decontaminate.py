"""Template decontamination: verbatim passages against a plain search, exchanged values, odd rows."""

import re

from lantern.llm import decontaminate as d

QUESTION = "A train leaves Boston at 40 km per hour and meets Alice after 3 hours, how far did the train from Boston go?"
PROSE = "Nothing of the kind is to be found in here, as these are other words about other things in another order."


def pairs(df):
    return {(r.doc_id, r.item_id): r.changed for r in df.collect()}


def test_verbatim_passages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    wanted = {r.item_id: plain(r.text) for r in items.collect()}
    want = {(k, i) for k, t in texts.items() for i, s in wanted.items() if s in t}
    assert want and set(pairs(d.contaminated(docs, items))) == want


def test_exchanged_values(spark):
    items = spark.createDataFrame([(1, QUESTION), (2, QUESTION), (3, "too short"), (4, None)], "item_id long, text string")
    other = QUESTION.replace("Boston", "Paris").replace("40 km", "75.5 miles").replace("3 hours", "nine hours").replace("Alice", "Bob")
    torn = other.replace("from Paris", "from Rome")
    rows = [
        (1, f"{PROSE} {QUESTION} {PROSE}"),
        (2, f"{PROSE} {other} {PROSE}"),
        (3, f"{PROSE} {torn} {PROSE}"),
        (4, PROSE),
        (5, None),
        (6, ""),
        (7, f"{other}\n{PROSE}\n{QUESTION}"),
        (None, QUESTION),
        (8, QUESTION.lower()),
        (8, QUESTION.lower()),
    ]
    docs = spark.createDataFrame([(k, t, 5, "q") for k, t in rows], "doc_id long, text string, hash int, form string")
    found = pairs(d.contaminated(docs, items))
    assert found.keys() >= {(1, 1), (2, 1), (7, 1), (None, 1)} and not found.keys() & {(3, 1), (4, 1)}
    assert found[(1, 1)] is False and found[(2, 1)] is True
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {3, 4, 5, 6} and not {1, 2, 7, None} & {r.doc_id for r in kept.collect()}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id long, text string")
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert pairs(d.contaminated(docs.limit(0), items)) == {} == pairs(d.contaminated(docs, items.limit(0)))
    assert d.clean(docs, items.limit(0)).count() == 1


def test_passes_and_blocks_change_nothing(spark, monkeypatch):
    items = spark.createDataFrame([(i, QUESTION.replace("train", f"w{i}x")) for i in range(4)], "item_id long, text string")
    rows = [(i, f"{PROSE} " * 30 + QUESTION.replace("train", f"w{i}x") + f" {PROSE}" * 30) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = pairs(d.contaminated(docs, items))
    monkeypatch.setattr(d, "PASS_HASHES", 7)
    assert pairs(d.contaminated(docs, items)) == whole and len(whole) >= 3
    forms = [f for _, fs in d.template(rows[0][1]) for f in fs]
    monkeypatch.setattr(d, "BLOCK", 64)
    assert [f for _, fs in d.template(rows[0][1]) for f in fs] == forms


def test_case_and_breaks(spark):
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    broken = QUESTION.replace("Boston", "\nBoston").replace("Alice", "\nAlice")
    lower = QUESTION.lower().replace("40", "75.5").replace(" 3 ", " nine ")
    texts = [QUESTION.lower(), QUESTION.upper(), broken, lower, lower.replace("from boston", "from rome"), PROSE]
    docs = spark.createDataFrame([(8 + i, f"{PROSE}\n{t} {PROSE}") for i, t in enumerate(texts)], "doc_id long, text string")
    found = pairs(d.contaminated(docs, items))
    assert found.items() >= {(8, 1): False, (9, 1): False, (10, 1): False, (11, 1): True}.items() and (13, 1) not in found


def test_every_item_is_searched_for(spark):
    texts = [
        "What is 345 times 27?",
        "12 + 45 + 17 + 33 + 90 + 61 + 8 + 77 + 23 + 54",
        "Anna Bell Carl Dunn Emma Ford Gary Hall Iris Jung",
        "Who wrote Dune?",
        "北京是哪个国家的首都",
        "中国",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(i, f"{PROSE} {t} {PROSE}") for i, t in enumerate(texts)] + [(9, f"{PROSE} What is 346 times 27? {PROSE}")]
    rows += [(10, "他问北京是哪个国家的首都吗"), (11, f"{PROSE} {texts[2].upper()}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pairs(d.contaminated(docs, items))
    assert set(found) == {*((i, i) for i in range(len(texts))), (10, 4), (11, 2)} and not any(found.values())
