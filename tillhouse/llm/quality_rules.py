"""Quality rules: base rules, and the log-likelihood ratio of hashed n-grams between trusted and raw text.

Every word and every pair of neighbouring words falls into one of `BUCKETS` hash buckets. Two multinomials over the
buckets are counted, with `SMOOTHING` added to each bucket: one over the trusted documents (labelled quality 1 and not
toxic), one over all documents. A document's score is the mean over its n-grams of log p_trusted - log p_raw. It is kept
if it passes the base rules and scores at least `THRESHOLD`: the same rule for every document, without drawing.

The raw counts cover every word of every document. The trusted ones come from at most about `MAX_TRUSTED` labelled
documents: where there are more, those whose hashed id falls below that share. The ids are broadcast, 8 bytes each; the
bound is what makes that safe. The two tables of `BUCKETS` weights reach the scoring as one array.

A null text has no words, fails the base rules and scores 0. Rows with a null id are judged like others but are never
trusted; repeated rows count as often as they occur. No labels give equal multinomials, so only the base rules decide.
No rows give no rows. Other columns are left alone. Only DataFrame functions are used, on whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import let, words

BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.05
MAX_TRUSTED = 100_000
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = "#*$%&|<>"


def _shifted(values: Column, by: int) -> Column:
    """values[by:], cut short at the end; the array itself is at least `by` long or gives an empty one."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _pairs(values: Column, join) -> Column:
    """join(values[i], values[i + 1]) for each neighbouring pair."""
    following = _shifted(values, 1)
    return F.zip_with(F.slice(values, F.lit(1), F.size(following)), following, join)


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _pair_hashes(hashes: Column) -> Column:
    return _pairs(hashes, lambda a, b: F.xxhash64(a, b))


def _buckets(hashes: Column) -> Column:
    """The buckets of all words and of all neighbouring pairs."""
    return F.concat(F.transform(hashes, _bucket), F.transform(_pair_hashes(hashes), _bucket))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _repeat_words(hashes: Column, pairs: Column) -> Column:
    """Words covered by a three-word window that occurs twice or more in the text."""
    third = _shifted(hashes, 2)
    triples = F.zip_with(F.slice(pairs, F.lit(1), F.size(third)), third, lambda p, h: F.xxhash64(p, h))

    def covered(keys: Column) -> Column:
        placed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        twice = let(placed, lambda p: _pairs(p, lambda x, y: F.when(x["k"] == y["k"], F.array(x["i"], y["i"]))))
        places = F.flatten(F.filter(twice, lambda x: x.isNotNull()))
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

    return let(triples, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(covered(t)))


def _duplicate_lines(text: Column) -> Column:
    # A line without a word holds white space alone.
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Ids of labelled good documents, all of them or about `limit`."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    good = good.select(F.col("doc_id").cast("long").alias("_trusted")).distinct()
    share = 1 << 32
    below = F.least(F.lit(share), F.lit(share) * F.lit(limit) / F.greatest(good.agg(F.count("*")).scalar(), F.lit(1)))
    return good.filter(F.pmod(F.xxhash64("_trusted", F.lit("trusted")), F.lit(share)) < below)


def bucket_weights(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """One row with `weights`: log p_trusted - log p_raw of each bucket."""
    ids = trusted_ids(labels, limit)
    marked = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("_trusted"), "left")
    grams = marked.select(F.col("_trusted").isNotNull().alias("good"), F.explode(let(_word_hashes(F.col("text")), _buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count(F.when(F.col("good"), 1)).alias("good"))
    all_buckets = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counts = all_buckets.join(counts, "bucket", "left").fillna(0)
    listed = counts.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("rows"), F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good")
    )

    def share(count: Column, total: Column) -> Column:
        # Without trusted text both sides are the same.
        return F.log((count + SMOOTHING) / (total + SMOOTHING * BUCKETS))

    weight = lambda x: F.when(F.col("all_good") > 0, share(x["good"], F.col("all_good")) - share(x["raw"], F.col("all_raw"))).otherwise(0.0)
    return listed.select(F.transform("rows", weight).alias("weights"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = MAX_TRUSTED) -> DataFrame:
    """One row per document: `row`, a struct of its columns, and `quality`, a struct of n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score and kept."""
    weights = bucket_weights(docs, labels, limit).scalar()
    text = F.coalesce("row.text", F.lit(""))

    def measured(hashes: Column) -> Column:
        return let(_pair_hashes(hashes), lambda pairs: measures(hashes, pairs))

    def measures(hashes: Column, pairs: Column) -> Column:
        summed = lambda keys: F.aggregate(keys, F.lit(0.0), lambda total, k: total + F.get(F.col("_weights"), _bucket(k)))
        score = (summed(hashes) + summed(pairs)) / F.greatest(F.size(hashes) + F.size(pairs), F.lit(1))
        return F.struct(F.size(hashes).cast("long").alias("n_words"), _repeat_words(hashes, pairs).cast("long").alias("n_repeat_words"), score.alias("score"))

    inside = F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    # The generator makes the measures columns of their own, which later steps read instead of computing them again.
    rows = docs.select(F.struct("*").alias("row"), weights.alias("_weights"))
    rows = rows.select("row", F.inline(F.array(let(_word_hashes(F.col("row.text")), measured))).alias("_n", "_repeat", "_score"))
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeat") > MAX_REPEAT_PCT * F.col("_n"))
    quality = F.struct(
        F.col("_n").alias("n_words"),
        inside.alias("word_chars"),
        symbols.alias("n_symbols"),
        _duplicate_lines(F.col("row.text")).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.col("_score").alias("score"),
        (~failed & (F.col("_score") >= threshold)).alias("kept"),
    )
    return rows.select("row", quality.alias("quality"))
