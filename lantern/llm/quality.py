"""A weak-label quality classifier (operator 10).

Overlapping heuristic labellers vote on every document. Expectation-maximisation over all documents'
votes estimates how accurate each labeller is, without true labels; the posterior labels then train a
hashed linear scorer, which decides. Two tasks are fitted alike: junk and toxic.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm.texts import keyed, map_texts, sampled
from lantern.session import durable

# Insults that the list labeller looks for.
INSULTS = frozenset("clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())

# Documents (about so many, by hash) whose posterior labels train the scorer, and labelled documents from
# which the lexicon labellers learn. Counting votes, estimating accuracies and scoring cover all rows.
FIT_DOCUMENTS = 5_000
FIT_LABELS = 20_000
LEXICON = 5_000
FEATURES = 1 << 18
PREFIX = 5
BEGINNINGS = (5, 7)
# features of training rows that the driver lays out at a time
FIT_CHUNK = 1 << 18

GOOD, BAD, NONE = "0", "1", "-"
JUNK = ("symbols", "capitals", "repeats", "vocabulary", "menu", "decorated")
TOXIC = ("insults", "words", "prefixes", "hits")

BLOCK = 1 << 20
WORD = re.compile(r"[^\W\d_]+")
DECORATED = re.compile(r"\w[^\w\s]{2,}(?!\S)")
# bytes that are counted by what is left without them
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = bytes(i for i in range(33, 127) if not chr(i).isalnum())
MENU = ("|", "•", "·", "»")
SPACE = re.compile(r"\s")


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text cut at white space into pieces of about ``size`` characters."""
    start = 0
    while start < len(text):
        space = SPACE.search(text, start + size)
        stop = space.start() if space else len(text)
        yield text[start:stop]
        start = stop


@dataclass
class Lexicon:
    words: frozenset
    prefixes: frozenset


@dataclass
class Profile:
    """What the labellers and the scorer look at, counted over a whole text."""

    votes: str
    features: object


def band(value: float, good: float, bad: float) -> str:
    """A vote: good up to one value, bad from the other on, none in between."""
    return GOOD if value <= good else BAD if value >= bad else NONE


def profile(text: str, lexicon: Lexicon, featured: bool = True) -> Profile:
    """Votes of the labellers (junk, then toxic) and hashed features of a whole text.

    Features are a presence bit per word and word beginning, hashed to ``FEATURES`` places so that their
    number is bounded whatever the text's length, and after them one per vote. A text without words gets
    no votes.
    """
    import numpy as np

    words = letters = capitals = symbols = decorated = menu = repeats = hits = insults = pre = 0
    slots: set[int] = set()
    seen: set[int] = set()
    last = ""
    for block in blocks(text):
        data, lower = block.encode(), WORD.findall(block.lower())
        distinct = set(lower)
        begun = {w[:PREFIX] for w in distinct}
        words += len(lower)
        letters += len(data) - len(data.translate(None, LETTERS))
        capitals += len(data) - len(data.translate(None, CAPITALS))
        marks = len(data) - len(data.translate(None, SYMBOLS))
        symbols += marks
        # so few symbols cannot decorate enough words for any vote but "good"
        decorated += len(DECORATED.findall(block)) if marks > 0.05 * len(lower) else 0
        menu += sum(map(block.count, MENU))
        repeats += sum(map(str.__eq__, lower, [last, *lower]))
        last = lower[-1] if lower else last
        insults += len(distinct & INSULTS)
        hits += len(distinct & lexicon.words)
        pre += len({w[:n] for n in BEGINNINGS for w in distinct} & lexicon.prefixes)
        seen.update(map(hash, distinct))
        if featured:
            slots.update(zlib.crc32(w.encode()) % FEATURES for w in distinct)
            slots.update(zlib.crc32(w.encode(), 1) % FEATURES for w in begun)
    if not words:
        votes = NONE * len(JUNK + TOXIC)
    else:
        rate = log(max(len(seen), 1)) / log(words) if words >= 30 else 1.0
        votes = "".join(
            (
                band(symbols / (letters + symbols), 0.07, 0.11),
                band(capitals / max(1, letters), 0.2, 0.5),
                band(repeats / words, 0.04, 0.15) if words >= 8 else NONE,
                band(-rate, -0.78, -0.70) if words >= 30 else NONE,
                band(menu / words, 0.01, 0.2),
                band(decorated / words, 0.05, 0.25),
                BAD if insults else NONE,
                BAD if hits else GOOD,
                BAD if pre else GOOD,
                band(hits + pre + insults, 0, 2),
            )
        )
    if not featured:
        return Profile(votes, None)
    voted = [FEATURES + 3 * i + (NONE + GOOD + BAD).index(vote) for i, vote in enumerate(votes)]
    return Profile(votes, np.array(sorted(slots) + voted, "<i4"))


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Words and word beginnings that are found nearly only in documents labelled toxic.

    About ``FIT_LABELS`` labelled documents are read, chosen by the hash of their key. Copies
    would make any word of a toxic text look toxic, so texts count once per smallest word hash, which
    copies share. Without toxic labels both sets are empty.
    """
    wanted = labels.select(F.col("doc_id").alias("labelled"), (F.col("toxic") == 1).alias("toxic")).where("toxic IS NOT NULL")
    wanted = sampled(wanted, FIT_LABELS, 7, "labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("labelled"))

    def terms(text: str) -> tuple:
        words = {w for block in blocks(text) for w in WORD.findall(block.lower())}
        begun = {"^" + w[:n] for n in BEGINNINGS for w in words if len(w) > n}
        return min((zlib.crc32(w.encode(), 7) for w in words), default=0), sorted(words | begun)

    held = durable(
        map_texts(
            keyed(rows, "toxic", "text").select(F.col("key").cast("bigint").alias("key"), "text"),
            lambda: terms,
            "key bigint, signature bigint, terms array<string>",
            pa.schema([("key", pa.int64()), ("signature", pa.int64()), ("terms", pa.list_(pa.string()))]),
        )
    )
    once = (
        held.select("key", "signature", F.explode("terms").alias("term"))
        .groupBy("term", "signature")
        .agg(F.max("key").alias("key"))
    )
    counts = once.groupBy("term").agg(
        F.sum("key").alias("bad"), F.count(F.lit(1)).alias("all")
    )
    toxic = held.where("key = 1").select("signature").distinct().count()
    least = max(6, toxic // 150)
    found = counts.where((F.col("bad") >= least) & (F.col("bad") >= 0.95 * F.col("all"))).orderBy(F.desc("bad"), "term")
    names = [row.term for row in found.limit(LEXICON).collect()]
    return Lexicon(frozenset(n for n in names if n[0] != "^"), frozenset(n[1:] for n in names if n[0] == "^"))


def estimate(patterns: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """The posterior probability of "bad" for each pattern of votes, from how often each was seen.

    Expectation-maximisation of a model in which labellers vote independently given the class. An absent
    vote says nothing. It starts from the share of bad votes, so "bad" cannot change sides. Patterns
    without a vote get the prior.
    """
    import numpy as np

    names = sorted(patterns)
    if not names:
        return {}
    counts = np.array([patterns[n] for n in names], float)
    bad = np.array([[c == BAD for c in n] for n in names], float)
    good = np.array([[c == GOOD for c in n] for n in names], float)
    posterior = (bad.sum(1) + 0.1) / (bad.sum(1) + good.sum(1) + 1.0)
    posterior = np.where(bad.sum(1) >= 2, np.maximum(posterior, 0.6), posterior)
    for _ in range(rounds):
        prior = min(max(float(posterior @ counts / counts.sum()), 1e-4), 0.5)
        rates = []
        for weight, ahead in ((posterior * counts, 0.5), ((1 - posterior) * counts, 0.01)):
            yes, no = weight @ bad, weight @ good
            rates.append((yes + 2 * ahead) / (yes + no + 2))
        one, zero = np.clip(rates[0], 0.02, 0.999), np.clip(rates[1], 0.0005, 0.5)
        odds = np.log(prior / (1 - prior)) + bad @ np.log(one / zero) + good @ np.log((1 - one) / (1 - zero))
        posterior = 1 / (1 + np.exp(-odds))
    return dict(zip(names, posterior.tolist()))


def values(features):
    """What each feature counts: the words of a text together as much as one vote."""
    import numpy as np

    hashed = features < FEATURES
    return np.where(hashed, 1 / np.sqrt(max(1, hashed.sum())), 1.0)


def fit_linear(rows: list, targets, rounds: int = 80, sparse: float = 1e-4):
    """Weights and bias of a logistic scorer over presence features with soft targets.

    Accelerated proximal gradient with an L1 penalty on words; those in fewer than three rows stay zero.
    """
    import numpy as np

    size = FEATURES + 3 * len(JUNK + TOXIC)
    weights, bias = np.zeros(size), 0.0
    if not rows:
        return weights, bias
    seen = np.zeros(size, np.int64)
    for r in rows:
        np.add.at(seen, r, 1)
    scale = [1 / np.sqrt(max(1, (r < FEATURES).sum())) for r in rows]
    kept = [r[seen[r] >= 3] for r in rows]
    # a bounded number of features at a time is laid out with its rows and values
    cuts, held = [0], 0
    for at, r in enumerate(kept, 1):
        held += len(r)
        if held > FIT_CHUNK or at == len(kept):
            cuts.append(at)
            held = 0

    def chunks() -> Iterator[tuple]:
        for start, stop in zip(cuts, cuts[1:]):
            sizes = [len(r) for r in kept[start:stop]]
            flat = np.concatenate(kept[start:stop]).astype(np.int64)
            yield start, stop, flat, np.where(flat < FEATURES, np.repeat(scale[start:stop], sizes), 1.0), np.repeat(np.arange(stop - start), sizes)

    step = 4.0 / (2.0 + len(JUNK + TOXIC))
    penalty = np.where(np.arange(size) < FEATURES, step * sparse, 0.0)
    ahead, ahead_bias, pace = weights.copy(), bias, 1.0
    for _ in range(rounds):
        slope, total = np.zeros(size), 0.0
        for start, stop, flat, value, row in chunks():
            margin = np.bincount(row, ahead[flat] * value, stop - start) + ahead_bias
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - targets[start:stop]) / len(rows)
            np.add.at(slope, flat, error[row] * value)
            total += error.sum()
        moved = ahead - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - penalty, 0)
        new_bias = ahead_bias - step * total
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / quicker * (new - weights)
        ahead_bias = new_bias + (pace - 1) / quicker * (new_bias - bias)
        weights, bias, pace = new, new_bias, quicker
    return weights, bias


@dataclass
class Model:
    lexicon: Lexicon
    posteriors: tuple[dict, dict]  # by pattern of votes; at most 3^6 and 3^4 of them
    scorers: tuple  # (weights, bias) for junk and toxic


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """The model for ``docs``: lexicons, accuracies from the votes of every document, scorers.

    Only counts per pattern of votes and the bounded training rows come to the driver.
    """
    import numpy as np

    lexicon = learn_lexicon(docs, labels)
    sent = spark.sparkContext.broadcast(lexicon)
    voted = map_texts(
        keyed(docs, "doc_id", "text").select(F.lit(0).cast("bigint").alias("key"), "text"),
        lambda: lambda text: (profile(text, sent.value, featured=False).votes,),
        "key bigint, votes string",
        pa.schema([("key", pa.int64()), ("votes", pa.string())]),
    )
    counts = {r.votes: r["count"] for r in voted.groupBy("votes").count().collect()}
    posteriors = []
    for part in (slice(0, len(JUNK)), slice(len(JUNK), None)):
        task: dict[str, int] = {}
        for votes, n in counts.items():
            task[votes[part]] = task.get(votes[part], 0) + n
        posteriors.append(estimate(task))
    training = map_texts(
        keyed(sampled(docs, FIT_DOCUMENTS, 11, "doc_id", "text"), "doc_id", "text").select(F.col("key").cast("bigint").alias("key"), "text"),
        lambda: lambda text: (lambda p: (p.votes, p.features.tobytes()))(profile(text, sent.value)),
        "key bigint, votes string, features binary",
        pa.schema([("key", pa.int64()), ("votes", pa.string()), ("features", pa.binary())]),
    )
    rows = sorted(((r.votes, bytes(r.features)) for r in training.collect()))
    vectors = [np.frombuffer(f, "<i4") for _, f in rows]
    scorers = []
    for posterior, part in zip(posteriors, (slice(0, len(JUNK)), slice(len(JUNK), None))):
        targets = np.array([posterior.get(v[part], 0.0) for v, _ in rows])
        weights, bias = fit_linear(vectors, targets)
        scorers.append((weights.astype(np.float32), float(bias)))
    return Model(lexicon, tuple(posteriors), tuple(scorers))


def scored(model: Model, text: str) -> tuple[float, float, str]:
    """Probabilities of junk and toxic by the scorers, and the votes; a text without votes is junk."""
    import numpy as np

    seen = profile(text, model.lexicon)
    if not seen.votes.strip(NONE):
        return 1.0, 0.0, seen.votes
    weight = values(seen.features)
    odds = [float(w[seen.features] @ weight) + b for w, b in model.scorers]
    junk, toxic = (1 / (1 + np.exp(-np.clip(odds, -30, 30)))).tolist()
    return junk, toxic, seen.votes


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``junk`` and ``toxic`` (probabilities), ``votes`` and ``accepted`` (both below a half) of
    every row. A text without words (null, empty, signs only) has no votes and is junk. Repeated rows score alike; extra columns are left out; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.schema([("key", pa.int64()), ("junk", pa.float64()), ("toxic", pa.float64()), ("votes", pa.string())])
    made = map_texts(
        keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint")),
        lambda: lambda value: scored(sent.value, value),
        "key bigint, junk double, toxic double, votes string",
        arrow,
    )
    return made.withColumn("accepted", (F.col("junk") < 0.5) & (F.col("toxic") < 0.5)).withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the scorers accept, with all their columns; only the text goes through Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def passes(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([max(scored(sent.value, text or "")[:2]) < 0.5 for text in batch.to_pylist()], pa.bool_())

    return docs.where(passes(docs["text"]))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(spark, docs, labels))
