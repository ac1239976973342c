"""Mixing sources to target weights by Poisson replication (operator 3); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import table

SEED = "mix-1"
# Without given weights, a source of size n weighs n ** ALPHA.
ALPHA = 0.5
# A rate above this is the sum of several Poisson numbers of a rate below it, each with a hash of its own.
MOST_RATE = 16
# Up to so many sources (about 1 KB each), the rates are broadcast; beyond, both sides are salted.
BROADCAST_SOURCES, SALTS = 5_000, 32

RATES_SQL = """
    SELECT source, rate, pieces, aggregate(
        sequence(1, CAST(mean + 12 * sqrt(mean) + 30 AS INT)),
        named_struct('term', exp(-mean), 'cdf', array(exp(-mean))),
        (s, k) -> named_struct(
            'term', s.term * mean / k,
            'cdf', concat(s.cdf, array(element_at(s.cdf, -1) + s.term * mean / k)))).cdf AS cdf
    FROM (SELECT source, rate, pieces, rate / pieces AS mean
          FROM (SELECT source, rate, CAST(greatest(1, ceil(rate / {most_rate})) AS INT) AS pieces FROM {targets}))
"""


def source_rates(docs: DataFrame, weights: DataFrame | None, budget: float | None) -> DataFrame:
    """(source, rate): the mean number of copies of a document that brings each source to its share of ``budget`` characters."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(ALPHA)))
    else:
        given = weights.select(F.col("source").alias("__source"), F.col("weight").cast("double").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    total = weighed.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    want = F.lit(float(budget)) if budget is not None else F.col("all_size")
    # One row on the right side: a scalar, not a product of rows.
    return weighed.join(F.broadcast(total), F.lit(True)).select(
        "source", F.when(F.col("size") > 0, want * F.col("weight") / F.col("all_weight") / F.col("size")).otherwise(1.0).alias("rate")
    )


def uniform(seed: str, piece: Column) -> Column:
    """A number in [0, 1) from the hash of the seed, the doc_id and the number of the piece."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), piece.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget: float | None = None,
    seed: str = SEED,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) repeated to the target weights, in a global random order, plus copy (from 1).

    A source's rate is its share of the ``budget`` (default: all characters)
    over its size; the number of copies of a document is the least k whose Poisson
    probability of at most k reaches a uniform number hashed from its doc_id.  So the
    number depends on nothing but the seed, the doc_id and the rate, and a lost task
    repeats it exactly.  Documents of one source need not meet: sizes are map-side
    combined, and the rates go to the documents.

    Defined cases: null texts count as empty; a null source is a source; a source
    without characters is kept as it is on average (rate 1); a source missing
    from given ``weights`` has weight 0; rows with one doc_id (or null) have equal numbers of copies;
    a column named copy is replaced.
    """
    rates = docs.sparkSession.sql(RATES_SQL, targets=source_rates(docs, weights, budget), most_rate=float(MOST_RATE))
    rates = rates.select(F.col("source").alias("__source"), F.col("pieces").alias("__pieces"), F.col("cdf").alias("__cdf"))
    plain = docs.drop("copy")
    same = plain["source"].eqNullSafe(rates["__source"])
    if rates.limit(broadcast_sources + 1).count() <= broadcast_sources:
        rated = plain.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = plain.withColumn("__own", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)).cast("int"))
        rated = dealt.join(salted, dealt["source"].eqNullSafe(salted["__source"]) & (dealt["__own"] == salted["__salt"])).drop("__salt", "__own")
    numbers = F.transform(F.sequence(F.lit(0), F.col("__pieces") - 1), lambda i: uniform(seed, i))
    copies = F.aggregate(
        numbers, F.lit(0), lambda n, u: n + F.size(F.filter(F.col("__cdf"), lambda p: p < u))
    )
    return (
        rated.withColumn("__copies", copies)
        .where("__copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .withColumn("__order", F.xxhash64("doc_id", "copy", F.lit(seed)))
        .repartition("__order")
        .sortWithinPartitions("__order")
        .select(*plain.columns, "copy")
    )


def op3_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(table(spark, sf_dir, "documents"))


OP3_SQL = f"""
WITH RECURSIVE sizes AS (
    SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, CASE WHEN size > 0 THEN (SELECT sum(size) FROM sizes) * pow(size, {ALPHA})
        / (SELECT sum(pow(size, {ALPHA})) FROM sizes) / size ELSE 1.0 END AS rate FROM sizes
), means AS (
    SELECT source, CAST(greatest(1, ceil(rate / {MOST_RATE})) AS INT) AS pieces, rate / greatest(1, ceil(rate / {MOST_RATE})) AS mean FROM rates
), terms AS (
    SELECT source, 0 AS k, exp(-mean) AS term, exp(-mean) AS cdf FROM means
    UNION ALL
    SELECT t.source, t.k + 1, t.term * m.mean / (t.k + 1), t.cdf + t.term * m.mean / (t.k + 1)
    FROM terms t JOIN means m ON t.source IS NOT DISTINCT FROM m.source WHERE t.k < CAST(floor(m.mean + 12 * sqrt(m.mean) + 30) AS INT)
), numbers AS (
    SELECT d.doc_id, d.source, CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || p.i), 1, 13)) AS BIGINT)
        / 4503599627370496.0 AS u
    FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source, LATERAL (SELECT unnest(range(0, m.pieces)) AS i) p
), copies AS (
    SELECT n.doc_id, count(t.k) AS n FROM numbers n JOIN terms t ON n.source IS NOT DISTINCT FROM t.source AND t.cdf < n.u GROUP BY n.doc_id
)
SELECT d.*, CAST(c.copy AS INT) AS copy
FROM documents d JOIN copies ON d.doc_id IS NOT DISTINCT FROM copies.doc_id, LATERAL (SELECT unnest(range(1, copies.n + 1)) AS copy) c
"""
