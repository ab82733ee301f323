"""Mixing sources to target weights by Poisson replication (native).

Each source has a size (code points of its texts, plus one end mark for each
document) and a target share of the mixture.  Its mean repetition rate is
``lambda = target size / size``.  A document is repeated ``k`` times, where
``k`` inverts the Poisson distribution of mean ``lambda`` at a uniform number
hashed from seed, document and source: expected sizes meet the targets, each
document is decided alone, and a rerun gives the same rows.  Copies are then
dealt over all partitions by a hashed key and sorted by it, which shuffles the
mixture globally whatever the order of the input.

Scale: one aggregate over (source, length) with map-side combine; a join with
one row for each source, which Spark broadcasts while that table is small and
else splits where a source is hot; one exchange of the copies on a uniform key.

Defined cases: a null source is a source of its own; null and empty texts have
size 1 (the end mark); a source without a target weight, or with weight 0, is
left out; repeated rows draw the same number and are each repeated; an empty
table gives an empty mixture.  Input columns named like the operator's own
(``copy_no``, ``mean_rate``, ``shuffle_key``) are replaced by them where they are
asked for; all others, whatever their names, come back as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import materialize, own_columns_win

OWN = ("copy_no", "mean_rate", "shuffle_key")
HEX_DIGITS = 13  # 52 bits, exact in a double


def _uniform(key: Column) -> Column:
    bits = F.conv(F.substring(F.md5(key), 1, HEX_DIGITS), 16, 10).cast("double")
    return bits / F.lit(float(16**HEX_DIGITS))


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, size, weight, mean_rate, cdf) for each source that is used.

    ``weights``: target weights by source; without them, the weight of a source
    is its size to the power ``temperature``.  ``epochs``: size of the mixture
    over size of the corpus."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + F.lit(1)).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(temperature))))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "given string, weight double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("given"))).select("source", "size", "weight")
    sizes = materialize(sizes.filter("weight > 0"), "mixing-sizes")
    total, weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    mean = F.lit(float(epochs) * float(total or 0)) * F.col("weight") / F.lit(float(weight or 1.0)) / F.col("size")
    # P(K <= k) for k = 0 .. m, by the recursion log p(k) = log p(k-1) + log(mean / k)
    steps = F.sequence(F.lit(1), (F.ceil(F.col("mean_rate") + 12 * F.sqrt("mean_rate")) + 40).cast("int"))
    start = F.struct((-F.col("mean_rate")).alias("logp"), F.array(F.exp(-F.col("mean_rate"))).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        logp = acc["logp"] + F.log("mean_rate") - F.log(k.cast("double"))
        return F.struct(logp.alias("logp"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + F.exp(logp))).alias("cdf"))

    return sizes.withColumn("mean_rate", mean).withColumn("cdf", F.aggregate(steps, start, step, lambda acc: acc["cdf"]))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: int = 17, annotate: bool = True) -> DataFrame:
    """The mixture: a row for each copy.  With ``annotate``, also ``copy_no``
    (from 1), the source's ``mean_rate`` and the ``shuffle_key`` that orders
    the mixture; without, the columns of ``docs`` alone."""
    docs = own_columns_win(docs, OWN) if annotate else docs
    rates = source_rates(docs, weights, temperature, epochs)
    # the input's columns are one struct, so that none can clash with the operator's own
    doc = F.col("doc")
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc["doc_id"].cast("string"), F.lit("-")), F.coalesce(doc["source"], F.lit("-")))
    drawn = docs.select(F.struct("*").alias("doc")).join(rates.select("source", "mean_rate", "cdf"), doc["source"].eqNullSafe(F.col("source")))
    drawn = drawn.select("doc", "mean_rate", "cdf", key.alias("key")).withColumn("u", _uniform(F.col("key")))
    copies = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    drawn = drawn.select("doc", "mean_rate", "key", copies.alias("n")).filter("n > 0")
    drawn = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n"))))
    drawn = drawn.select("doc", "mean_rate", "copy_no", F.md5(F.concat_ws(":", F.col("key"), F.col("copy_no").cast("string"))).alias("shuffle_key"))
    return drawn.repartition("shuffle_key").sortWithinPartitions("shuffle_key").select("doc.*", *(OWN if annotate else ()))
