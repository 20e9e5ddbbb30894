"""SimHash against slow second versions over small tables."""

import random

import pytest
import xxhash
from lantern.llm import components as graph
from lantern.llm import simhash
from lantern.llm.components import components


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(rows):
    prints = [(key, slow_fingerprint(text)) for key, text in rows]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    least = {}
    for key, p in prints:
        if key is not None:
            least[find(p)] = min(key, least.get(find(p), key))
    return sorted([(key, f"{p:016x}", least.get(find(p))) for key, p in prints], key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == slow_classes(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c"), (7, "a b c"),
        (8, "A B C d"), (None, "a b c"), (None, "nothing like it here"), (9, "É é É é"), (10, "x " * 5000),
    ]
    docs = spark.createDataFrame([(k, t, 0, "z") for k, t in rows], "doc_id long, text string, fp int, key string")
    assert found(simhash.near_duplicates(docs)) == slow_classes(rows)
    empty = docs.limit(0)
    assert found(simhash.near_duplicates(empty)) == [] and found(simhash.keep_one(empty)) == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 6, 7, 8, 9, 10]
    assert kept.where("doc_id IS NULL").count() == 2


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(4000))
    whole = simhash.fingerprint(text)
    blocks = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: blocks(data, 50))
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text)


@pytest.mark.parametrize("cell", [2, 64])
def test_links_of_chains_and_crowds(spark, monkeypatch, cell):
    """Prints around a few centres; small cells send nearly all of them the way of crowded ones."""
    monkeypatch.setattr(simhash, "CELL", cell)
    draw = random.Random(5)
    prints = set()
    for _ in range(4):
        at = draw.getrandbits(64)
        for _ in range(120):
            prints.add(at)
            at ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 1, 2, 3])))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(r) for r in simhash.near_links(df).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in links)

    def groups(edges):
        root = {p: p for p in signed}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {p: find(p) for p in signed}

    all_pairs = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    assert groups(links) == groups(all_pairs)


def test_components_of_a_chain(spark):
    draw = random.Random(2)
    names = draw.sample(range(10_000), 300)
    edges = [(names[i], names[i + 1]) for i in range(199)] + [(names[i], names[i + 1]) for i in range(200, 299)]
    edges += edges[:50] + [(7_000_001, 7_000_001)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {n: min(names[:200]) for n in names[:200]} | {n: min(names[200:]) for n in names[200:]}
    assert got == want | {7_000_001: 7_000_001}


@pytest.mark.parametrize("rows", [3, 40, 1 << 19])
def test_components_of_links_in_parts(spark, monkeypatch, rows):
    """Chains, stars and random links alike, whether one task settles them or rounds do."""
    monkeypatch.setattr(graph, "PART_ROWS", rows)
    draw = random.Random(rows)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(i, 230) for i in range(200, 230)]
    edges += [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    root = {node: node for edge in edges for node in edge}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    draw.shuffle(edges)
    made = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert dict(tuple(r) for r in components(made).collect()) == root
    named = made.selectExpr("lpad(a, 4, '0') AS a", "lpad(b, 4, '0') AS b")
    assert {int(r.node): int(r.root) for r in components(named).collect()} == root


def test_components_take_few_jobs(spark):
    """The driver keeps plans, stages and threads of every job: a chain of 60 is no reason for rounds of ten jobs each,
    and what makes the edges runs once."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long").mapInArrow(run, "a long, b long")
    spark.sparkContext.setJobGroup("components", "")
    try:
        assert {r.root for r in components(edges).collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert made.value == 60
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("components")) <= 12
