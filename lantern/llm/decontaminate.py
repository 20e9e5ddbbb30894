"""Benchmark decontamination by templates (operator 5).

Numbers, units and names become typed placeholders, so a question keeps its template when its values are
exchanged. As a name is known by its capital alone, a window counts in a second form too, in which names
are words and case has no part; what has too few plain words for either is found word for word. Windows of templates are joined by hash; on each alignment of a document with an item the
values that stand in the placeholders must map consistently (the same value always to the same one).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm.texts import keyed, slices
from lantern.session import durable

WINDOW = 8
# an item with fewer tokens, or a window with fewer plain words, is looked for word for word alone
LEAST_TOKENS = 5
LEAST_PLAIN = 4
# share of an item's searchable tokens that a document must cover
COVERED = 0.5
# hashes that one pass over the documents takes along: 32 MB
PASS_HASHES = 4 << 20

# Words that stand for numbers, and units.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion".split()
)
UNITS = frozenset(
    "% $ € £ ¥ ° mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound "
    "pounds ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros percent kb mb gb hz khz "
    "mhz ghz v kv w kw mw j kj cal kcal pa kpa bar meter meters metre metres kilometer kilometers kilogram "
    "kilograms gram grams degree degrees".split()
)
# scripts without spaces between words: every sign is a token
ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN = re.compile(
    rf"\d+(?:[.,:/]\d+)*|[^\W\d_{ALONE}]+(?:['’][^\W\d_{ALONE}]+)*|[%$€£¥°]|[.!?\n]|(?=[^\W\d_])[{ALONE}]"
)
ENDS = frozenset(".!?\n")
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
PLACES = frozenset((NUMBER, UNIT, NAME))
BLOCK = 1 << 20
SPACE = re.compile(r"\s")


def template(text: str) -> Iterator[tuple[list[str], list[str]]]:
    """Tokens as written and their template (lower case, or a placeholder), in blocks of a long text.

    A number is a run of digits or a number word; a unit is a unit word beside a number; a name is a word
    with a capital and small letters after it that does not begin a sentence.
    """
    start, opens, number = 0, True, False
    while start < len(text):
        space = SPACE.search(text, start + BLOCK)
        stop = space.start() if space else len(text)
        found = TOKEN.findall(text, start, stop)
        words, forms = [], []
        for i, word in enumerate(found):
            if word in ENDS:
                opens, number = True, False
                continue
            form = word.lower()
            if word[0].isdigit() or form in NUMBERS:
                form, number = NUMBER, True
            elif form in UNITS and (number or (i + 1 < len(found) and found[i + 1][0].isdigit())):
                form, number = UNIT, False
            else:
                number = False
                if not opens and form != word and len(word) > 1 and word[0] != form[0] and word[1:] == form[1:]:
                    form = NAME
            opens = False
            words.append(word)
            forms.append(form)
        yield words, forms
        start = stop


def window_hashes(forms: list[str], width: int):
    """A 64-bit hash of each run of ``width`` forms."""
    import numpy as np

    if len(forms) < width:
        return np.zeros(0, np.uint64)
    one = np.array([zlib.crc32(f.encode()) for f in forms], np.uint64)
    one = (one ^ (one >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(len(forms) - width + 1, np.uint64)
    for i in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + one[i : len(forms) - width + 1 + i]
    return total ^ (total >> np.uint64(29))


# a window's form is its template, the case-blind one beside a template, its words, or the case-blind one alone
TEMPLATE, BLIND, WORDS, BLIND_ALONE = range(4)


def blind(words: list[str], forms: list[str]) -> list[str]:
    """The template with names as lower-case words."""
    return [w.lower() if f == NAME else f for w, f in zip(words, forms)]


def forms_of(words: list[str], forms: list[str]) -> list[tuple[int, list[str]]]:
    """The forms in which a window of an item is looked for: word for word where its template says too little."""
    plain = blind(words, forms)
    enough = [len(forms) >= LEAST_TOKENS and sum(f not in PLACES for f in form) >= LEAST_PLAIN for form in (forms, plain)]
    made = [(TEMPLATE, forms)] if enough[0] else [(WORDS, [w.lower() for w in words])]
    if enough[1] and plain != forms:
        made.append((BLIND if enough[0] else BLIND_ALONE, plain))
    return made


WINDOWS = pa.schema(
    [
        ("key", pa.int64()),
        ("hash", pa.int64()),
        ("width", pa.int32()),
        ("at", pa.int64()),
        ("form", pa.string()),
        ("words", pa.list_(pa.string())),
        ("tokens", pa.int64()),
        ("kind", pa.int32()),
    ]
)
WINDOWS_DDL = "key bigint, hash bigint, width int, at bigint, form string, words array<string>, tokens bigint, kind int"


def _emitted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WINDOWS)], schema=WINDOWS)


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Every window of every distinct item in each of its forms: ``item`` (the smallest key that has it),
    ``hash``, ``width``, ``place`` in the item, ``form``, ``kind``, ``values`` and the item's ``tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for item, value in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    words, forms = [], []
                    for w, f in template(value):
                        words += w
                        forms += f
                    width = min(WINDOW, len(forms))
                    for at in range(len(forms) - width + 1 if width else 0):
                        held = words[at : at + width]
                        for kind, form in forms_of(held, forms[at : at + width]):
                            hashed = int(window_hashes(form, width).view("i8")[0])
                            rows.append((item, hashed, width, at, " ".join(form), held, len(forms), kind))
                if rows:
                    yield _emitted(rows)

    windows = keyed(items, key, text).withColumn("key", F.col("key").cast("bigint")).mapInArrow(run, WINDOWS_DDL)
    windows = windows.select(
        F.col("key").alias("item"), "hash", "width", F.col("at").alias("place"), "form", "kind", F.col("words").alias("values"), "tokens"
    )
    # copies of an item give the same windows at the same places: one of them is searched for
    return windows.groupBy("hash", "width", "place", "form", "kind", "values", "tokens").agg(F.min("item").alias("item"))


def document_windows(docs: DataFrame, wanted: list, widths: dict[int, set[int]], key: str, text: str) -> DataFrame:
    """The windows of every document whose hash is among ``wanted`` (a sorted array, sent to the tasks);
    ``widths`` has the kinds of forms that the items have in each width."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        hashes = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, value in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    words, forms, passed = [], [], 0
                    for w, f in template(value):
                        # the end of the last block is seen again, so that no window is cut
                        passed += max(0, len(words) - WINDOW + 1)
                        words, forms = words[1 - WINDOW :] + w, forms[1 - WINDOW :] + f
                        lows = [w.lower() for w in words]
                        plain = [w if f == NAME else f for w, f in zip(lows, forms)]
                        for width, kinds in widths.items():
                            seen = []
                            for some, form in (({TEMPLATE}, forms), ({BLIND, BLIND_ALONE}, plain), ({WORDS}, lows)):
                                if not some & kinds or len(form) < width:
                                    continue
                                made = window_hashes(form, width).view("i8")
                                place = np.searchsorted(hashes, made)
                                hit = hashes[np.minimum(place, len(hashes) - 1)] == made
                                for other in seen:  # the same form once
                                    hit &= other != made
                                seen.append(made)
                                for at in map(int, np.flatnonzero(hit)):
                                    rows.append(
                                        (doc, int(made[at]), width, passed + at, " ".join(form[at : at + width]), words[at : at + width], 0, 0)
                                    )
                if rows:
                    yield _emitted(rows)

    return keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint")).mapInArrow(run, WINDOWS_DDL).drop("tokens", "kind")


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``key``, ``item``, ``covered`` (share of the item's tokens, or of those that a template can find), ``changed`` (whether some
    value differs from the item's) for each document that holds an item's template with consistent values.

    The document's windows are found in as many passes as the items' hashes need (a pass takes along 32 MB
    of them) and then joined with the items' windows. A group of the checks is one document on one
    alignment with one item, so it has no more rows than the item has windows, however often an item
    occurs. Rows that share a key are one document; null texts hold nothing; items with fewer than five
    tokens are found word for word alone; copies of an item are found under the smallest key; empty tables give an
    empty result; extra columns are left out.
    """
    import numpy as np

    windows = durable(item_windows(items, item_key, item_text))
    widths: dict[int, set[int]] = {}
    for r in windows.select("width", "kind").distinct().collect():
        widths.setdefault(r.width, set()).add(r.kind)
    slots = max(1, -(-windows.count() // PASS_HASHES))
    found = None
    for number in range(slots):
        part = windows.where(F.pmod("hash", F.lit(slots)) == number).select("hash").distinct()
        hashes = np.sort(np.array([r.hash for r in part.toLocalIterator()], np.int64))
        if not len(hashes):
            continue
        rows = document_windows(docs, hashes, widths, key, text)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = docs.sparkSession.createDataFrame([], WINDOWS_DDL).drop("tokens", "kind")
    met = found.join(windows, ["hash", "width", "form"]).select(
        "key", "item", "tokens", "width", "place", "kind", (F.col("at") - F.col("place")).alias("shift"), "values", "words"
    )
    # (value in the item, value in the document) where the two differ in more than case or stand in a placeholder
    sides = F.filter(
        F.transform(F.arrays_zip("values", "words"), lambda z: F.struct(F.lower(z["values"]).alias("a"), F.lower(z["words"]).alias("b"))),
        lambda z: z["a"].isNotNull(),
    )
    # an alignment is judged by its templates, by all forms and by the words alone: none spoils another
    judged = F.when(F.col("kind") == TEMPLATE, F.array(F.lit(0), F.lit(1)))
    judged = judged.when(F.col("kind") == WORDS, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    firm = lambda: F.when(F.col("kind") <= BLIND, F.struct("place", "width"))
    parts = met.select("*", sides.alias("sides")).select("*", F.explode(judged).alias("judged"))
    aligned = parts.groupBy("key", "item", "tokens", "shift", "judged").agg(
        F.collect_set(F.struct("place", "width")).alias("places"),
        F.collect_set(firm()).alias("firm"),
        F.array_distinct(F.flatten(F.collect_set("sides"))).alias("sides"),
    )
    same = F.size("sides") == F.size(F.array_distinct(F.transform("sides", lambda z: z["a"])))
    changed = F.exists("sides", lambda z: z["a"] != z["b"])
    consistent = aligned.where(same).select("key", "item", "tokens", "places", "firm", changed.alias("changed"))
    tokens = lambda places: F.array_distinct(
        F.flatten(F.transform(places, lambda p: F.sequence(p["place"], p["place"] + p["width"] - 1)))
    )
    covers = consistent.groupBy("key", "item", "tokens").agg(
        F.size(tokens(F.array_distinct(F.flatten(F.collect_set("places"))))).alias("hit"),
        F.size(tokens(F.array_distinct(F.flatten(F.collect_set("firm"))))).alias("firm_hit"),
        F.max("changed").alias("changed")
    )
    searchable = windows.groupBy(F.col("item").alias("whole")).agg(
        F.size(tokens(F.collect_set(F.struct("place", "width")))).alias("searchable"),
        F.size(tokens(F.collect_set(firm()))).alias("firm_searchable"),
    )
    # windows that only the same words can fill do not count against an item with other values
    firm_share = F.when(F.col("firm_searchable") > 0, F.col("firm_hit") / F.col("firm_searchable")).otherwise(0.0)
    share = F.greatest(F.col("hit") / F.col("searchable"), firm_share)
    return (
        covers.join(searchable, F.col("item") == F.col("whole"))
        .where(share >= COVERED)
        .select(F.col("key").alias(key), F.col("item").alias("item_id"), F.round(share, 4).alias("covered"), "changed")
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item, all columns as they are. Rows without a key go
    only where such a row holds an item: they are one document."""
    leaks = contaminated(docs, items, key, text).select(F.col(key).alias("leak")).distinct()
    return docs.join(leaks, docs[key].eqNullSafe(leaks["leak"]), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold which benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
