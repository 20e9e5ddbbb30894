"""I-Match document fingerprints over randomised lexicon subsets (operator 4), in SQL expressions alone.

Terms whose inverse document frequency lies in a chosen band form the lexicon: neither the words that
every text has, nor those that a single edit brings in. The lexicon is dealt at random into 128 subsets;
a text's distinct terms of each subset, sorted, are hashed. Texts that share most of their terms agree in
many of the hashes, equal texts in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# the band of ln(documents / documents with the term): from a fifth down to a two-hundredth of them
IDF_LOW, IDF_HIGH = 1.6, 5.3
SUBSETS = 128
GROUPS = 16
# a lexicon of so many terms goes along in the plan; a larger one is joined
PLAN_TERMS = 50_000
# neighbours are found within buckets of consecutive keys
BUCKET_ROWS, MOST_BUCKETS = 2_000, 100_000


def words(text: Column) -> Column:
    """Distinct words of a text: what lies between ASCII white space, in lower case."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[\x09-\x0D\x20]+", -1)), lambda w: w != "")


def lexicon(docs: DataFrame, text: str = "text", low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """The terms (column ``term``) in the band, by their counts over all documents.

    At ``high`` = 5.3 a term is in at least one of 200 documents, so there are at most 200 times as many
    as a document has distinct terms on average, however large the corpus.
    """
    # every text is counted once per term before the shuffle, so frequent terms are one row per task there
    total = docs.count()
    counts = docs.select(F.explode(words(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term").count()
    idf = F.log(F.lit(float(max(total, 1))) / F.col("count"))
    return counts.where(idf.between(low, high)).select("term")


def with_terms(df: DataFrame, text: str, out: str, chosen: list[str] | DataFrame) -> DataFrame:
    """``df`` with array ``out``: the lexicon's terms in the text, or all of its words if it has none."""
    if isinstance(chosen, list):
        band = F.filter(F.col("_words"), lambda w: w.isin(chosen)) if chosen else F.array().cast("array<string>")
        rows = df.withColumn("_words", words(F.col(text))).withColumn(out, band)
        return rows.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(F.col("_words"))).drop("_words")
    # equal texts have equal terms, so the text's digest is a key whatever keys the rows have
    marked = df.withColumn("_digest", F.sha2(text, 256))
    once = marked.groupBy("_digest").agg(F.first(text).alias("_text")).select("_digest", words(F.col("_text")).alias("_words"))
    some = (
        once.select("_digest", F.explode("_words").alias("term"))
        .join(chosen, "term")
        .groupBy("_digest")
        .agg(F.collect_set("term").alias(out))
    )
    whole = once.join(some, "_digest", "left").select(F.col("_digest").alias("_d"), F.coalesce(out, "_words").alias(out))
    return marked.join(whole, F.col("_digest") == F.col("_d")).drop("_digest", "_d")


def hashes(terms: str) -> Column:
    """For each subset a number from 1 to 65535 that hashes its sorted terms, or 0 if there is none."""
    each = SUBSETS // GROUPS
    joined = "array_join(transform(array_sort(p), x -> x.t), ' ')"
    one = f"IF(size(p) = 0, 0, CAST(pmod(xxhash64({joined}), 65535) + 1 AS INT))"
    return F.expr(
        f"flatten(transform(sequence(0, {GROUPS - 1}), g -> element_at(transform("
        f"array(filter(transform({terms}, t -> named_struct('t', t, 's', pmod(xxhash64(t), {SUBSETS}))), x -> x.s DIV {each} = g)), "
        f"part -> transform(sequence(0, {each - 1}), j -> element_at(transform("
        f"array(filter(part, x -> x.s % {each} = j)), p -> {one}), 1))), 1)))"
    )


def written(values: str) -> Column:
    """Four hexadecimal digits for each subset, 0000 for one without terms."""
    return F.array_join(F.transform(values, lambda v: F.lower(F.lpad(F.hex(v), 4, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """The share of equal hashes among the subsets of which either text has terms; 1 if neither has any."""
    either = f"size(filter(zip_with({a}, {b}, (x, y) -> x <> 0 OR y <> 0), z -> z))"
    equal = f"size(filter(zip_with({a}, {b}, (x, y) -> x <> 0 AND x = y), z -> z))"
    return F.expr(f"IF({either} = 0, 1.0D, {equal} / {either})").cast("double")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """``key`` and ``fingerprint`` of every row; null texts are empty, and those have zeros only."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    made = with_terms(rows, "_text", "_terms", chosen_terms(docs, text, low, high))
    return made.select(key, hashes("_terms").alias("_hashes")).select(key, written("_hashes").alias("fingerprint"))


def chosen_terms(docs: DataFrame, text: str, low: float, high: float) -> list[str] | DataFrame:
    """The lexicon as a list if it has few enough terms, else as a table."""
    found = lexicon(docs, text, low, high)
    some = [r.term for r in found.limit(PLAN_TERMS + 1).collect()]
    return sorted(some) if len(some) <= PLAN_TERMS else found


def followed(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``text``) dealt into buckets of consecutive keys, with the row that follows a
    bucket also in it: ``bucket``, ``extra`` and the columns ``place`` that order rows by descending key.

    Rows without a key come last, rows with equal keys by the hash of their texts. One shuffle carries
    the texts; what the driver and all tasks see is one row per bucket, 100,000 at most.
    """
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).first()
    buckets = min(MOST_BUCKETS, max(1, seen.n // BUCKET_ROWS))
    width = ((seen.most or 0) - (seen.least or 0)) // buckets + 1
    last = abs(seen.least or 0) // width + 2
    bucket = F.coalesce(F.expr(f"CAST(doc_id AS DECIMAL(20, 0)) DIV {width}").cast("bigint"), F.lit(-last))
    placed = rows.select(
        "doc_id",
        "text",
        bucket.alias("bucket"),
        F.struct(
            F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("back"), F.xxhash64("text").alias("hash")
        ).alias("place"),
    )
    heads = placed.groupBy("bucket").agg(F.min("place").alias("head"))
    above = Window.orderBy("bucket")
    # the first row of a bucket follows the bucket above; that of the uppermost one follows the lowest
    heads = heads.select(
        F.col("bucket").alias("own"),
        "head",
        F.coalesce(F.lead("bucket").over(above), F.first("bucket").over(above)).alias("before"),
    )
    met = placed.join(F.broadcast(heads), F.col("bucket") == F.col("own"))
    homes = F.when(
        F.col("place") == F.col("head"),
        F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")),
            F.struct(F.col("before").alias("bucket"), F.lit(True).alias("extra")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))))
    return met.select("doc_id", "text", "place", F.explode(homes).alias("home")).select(
        "doc_id", "text", "place", F.col("home.bucket").alias("bucket"), F.col("home.extra").alias("extra")
    )


def compare_edits(docs: DataFrame, low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """Each document beside its edited text and the next document (by descending key; after the last the
    first): ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    Edited: the last third of the code points replaced by as many from the start of the next document, or
    all that it has. Null texts are empty; a single document is followed by itself; repeated rows follow
    one another; extra columns are left out; an empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = chosen_terms(rows, "text", low, high)
    order = Window.partitionBy("bucket").orderBy("extra", "place")
    edited = (
        followed(rows)
        .withColumn("next", F.coalesce(F.lead("text").over(order), F.lit("")))
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn("edited", F.concat(F.expr("substr(text, 1, CAST(n_chars - n_chars DIV 3 AS INT))"), F.expr("substr(next, 1, CAST(n_chars DIV 3 AS INT))")))
        .drop("next")
    )
    made = with_terms(with_terms(edited, "text", "own_terms", chosen), "edited", "edited_terms", chosen)
    hashed = made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "bucket",
        "extra",
        "place",
        hashes("own_terms").alias("own"),
        hashes("edited_terms").alias("other"),
    )
    return (
        hashed.withColumn("following", F.lead("own").over(order))
        .where("NOT extra")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            written("own").alias("fingerprint"),
            written("other").alias("edited_fingerprint"),
            likeness("own", "other").alias("near_edited"),
            likeness("own", "following").alias("near_next"),
        )
    )


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
