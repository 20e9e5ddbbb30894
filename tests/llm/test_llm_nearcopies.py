"""Near copies against the Jaccard similarity of every pair of small tables."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from lantern.llm import nearcopies


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def slow_kept(rows):
    """The smallest key of each class over all pairs of a similarity of 0.8 or more."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, j in combinations(range(len(rows)), 2):
        if min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return sorted(least.values())


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == slow_kept([tuple(r) for r in docs.collect()])


def test_chains_and_crowds(spark):
    """Chains of small changes: many texts of a bucket are near its other texts, but not the smallest one."""
    draw = random.Random(3)
    rows = []
    for _ in range(3):
        words = [f"w{draw.randrange(10**6)}" for _ in range(120)]
        for _ in range(60):
            rows.append((len(rows), " ".join(words)))
            words[draw.randrange(120)] = f"w{draw.randrange(10**6)}"
    rows += [(500, ""), (501, None), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, "one three")]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == slow_kept(rows)
    assert nearcopies.keep_one(docs.limit(0)).collect() == []
    odd = docs.limit(0).union(spark.createDataFrame([(None, "one two"), (None, None), (7, "x"), (7, "x")], docs.schema))
    assert sorted((r.doc_id for r in nearcopies.keep_one(odd).collect()), key=str) == [7, None, None]


def test_templates_are_not_compared_whole(spark, monkeypatch):
    """Texts that share most of a template but are no near copies: few pairs get as far as their sets."""
    draw = random.Random(5)
    shared = [f"t{i}" for i in range(300)]
    rows = [(k, " ".join(shared + [f"w{draw.randrange(10**7)}" for _ in range(180)])) for k in range(300)]
    rows += [(k + 1000, rows[k][1] + " more") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met = []
    plain = nearcopies.alike

    def counted(pairs, lanes):
        made = plain(pairs, lanes)
        met.append((pairs.count(), made.count()))
        return made

    monkeypatch.setattr(nearcopies, "alike", counted)
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == slow_kept(rows)
    candidates, compared = map(sum, zip(*met))
    assert compared < 20 * len(rows) and compared < candidates


def test_operator_3_finds_candidates(spark, monkeypatch):
    """The stage links texts by fingerprints and their grid, also where no bucket of MinHash is shared."""
    draw = random.Random(11)
    rows = [(k, " ".join(f"w{draw.randrange(10**6)}" for _ in range(400))) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(30)]
    docs = spark.createDataFrame(rows + [(200, ""), (201, "!")], "doc_id long, text string")
    made = nearcopies.sketches(docs, "doc_id", "text", 5).localCheckpoint()
    prints = {r.fp: r.print for r in made.collect() if len(r.buckets)}
    reach = {(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]) & (1 << 64) - 1 in (0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i in range(64) for j in range(i)))}
    found = {tuple(r) for r in nearcopies.by_fingerprint(made.select("fp", "print", "buckets", "lanes")).collect()}
    assert len(reach) > 10 and found <= reach
    assert {p for pair in found for p in pair} == {p for pair in reach for p in pair}

    plain = nearcopies.sketches
    alone = lambda *a: plain(*a).withColumn("buckets", F.transform("buckets", lambda b: F.xxhash64(b, "fp")))
    monkeypatch.setattr(nearcopies, "sketches", alone)
    kept = {r.doc_id for r in nearcopies.keep_one(docs).collect()}
    assert len(kept) <= len(rows) + 2 - len(reach) and {200, 201} <= kept and set(range(40)) <= kept


def test_crowded_buckets_make_no_pairs_as_rows(spark, monkeypatch):
    """Many variants of one text, most of them too far from each other to be near copies: the rows that are
    compared grow with the texts, also where a bucket is cut into blocks, and no link is lost."""
    draw = random.Random(17)

    def variants(n):
        base, rows = [f"w{draw.randrange(10**6)}" for _ in range(150)], []
        for k in range(n):
            words = list(base)
            for _ in range(draw.randrange(1, 16)):
                words[draw.randrange(150)] = f"w{draw.randrange(10**6)}"
            rows.append((k, " ".join(words)))
        return rows

    met = []
    plain = nearcopies.alike
    monkeypatch.setattr(nearcopies, "alike", lambda pairs, lanes: met.append(pairs.count()) or plain(pairs, lanes))
    for n, block in ((240, 8 << 20), (240, 60_000)):
        monkeypatch.setattr(nearcopies, "BLOCK_BYTES", block)
        rows = variants(n)
        met.clear()
        kept = sorted(r.doc_id for r in nearcopies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert kept == slow_kept(rows) and 1 < len(kept) < n
        assert sum(met) < 60 * n, (n, block, met)


def test_crowded_buckets_are_not_met_with_drawn_texts(spark, monkeypatch):
    """Texts of one template, most of them no near copies: a text is a row for its buckets' smallest texts only, and
    a block gives fewer pairs than it has texts."""
    draw = random.Random(23)
    base, rows = [f"w{draw.randrange(10**6)}" for _ in range(150)], []
    for k in range(240):
        words = list(base)
        for _ in range(draw.randrange(1, 12)):
            words[draw.randrange(150)] = f"w{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    met, found = [], []
    alike, blocks = nearcopies.alike, nearcopies.similar_in_blocks

    def counted(crowded, *rest):
        made = blocks(crowded, *rest)
        found.append((crowded.groupBy("bucket").count().groupBy().sum("count").first()[0], made.count()))
        return made

    monkeypatch.setattr(nearcopies, "alike", lambda pairs, lanes: met.append(pairs.count()) or alike(pairs, lanes))
    monkeypatch.setattr(nearcopies, "similar_in_blocks", counted)
    kept = sorted(r.doc_id for r in nearcopies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == slow_kept(rows) and 1 < len(kept) < len(rows)
    assert len(met) <= 2 and found and all(pairs < texts for texts, pairs in found), (met, found)
