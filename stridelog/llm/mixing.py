"""Mixing sources to target weights by repeating documents a Poisson number of times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.llm.common import text_of, written

DIGITS = 13           # hex digits of a digest taken as a uniform number below 1
STEPS_BROADCAST = 1_000_000  # probabilities of all sources together, of eight bytes each


def uniform(seed: str, *cols: Column) -> Column:
    """A number in [0, 1) from the MD5 digest of the seed and some values; null is a value."""
    named = [F.coalesce(c.cast("string"), F.lit("null")) for c in cols]
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *named)), 1, DIGITS)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None,
                 exponent: float = 0.5, source_col: str = "source",
                 text_col: str = "text") -> DataFrame:
    """A row per source: ``_source``, size in bytes, target weight, and mean repetition rate.

    ``weights`` names target shares, of which sources it leaves out get none. Without it the
    share of a source is its size to the power ``exponent``. The rate brings a source from its
    size to its share of the corpus, whose total size stays about the same. A null source is a
    source of its own. A source without bytes has the rate 0.
    """
    sizes = docs.groupBy(F.col(source_col).alias("_source")).agg(
        F.sum(F.octet_length(text_of(text_col))).alias("_bytes"))
    if weights is None:
        share = F.pow(F.col("_bytes").cast("double"), F.lit(float(exponent)))
    else:
        named = [F.when(F.col("_source") == k, F.lit(float(v))) for k, v in weights.items()]
        share = F.coalesce(*named, F.lit(0.0))
    shared = sizes.withColumn("_share", F.when(F.col("_bytes") > 0, share).otherwise(F.lit(0.0)))
    total = shared.agg(F.sum("_bytes").alias("_all"), F.sum("_share").alias("_shares"))
    weight = F.col("_share") / F.nullif(F.col("_shares"), F.lit(0.0))
    rate = F.coalesce(weight * F.col("_all") / F.nullif(F.col("_bytes"), F.lit(0)), F.lit(0.0))
    return shared.crossJoin(F.broadcast(total)).select(
        "_source", "_bytes", weight.alias("_weight"), rate.alias("_rate"))


def _most(rate: Column) -> Column:
    """A count that a Poisson distribution of this mean does not exceed, to double precision."""
    return F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")


def poisson_steps(rate: Column) -> Column:
    """P(count <= 0), P(count <= 1), ... of a Poisson distribution, up to where 1 is reached.

    Each probability follows from the one before in logarithms, so large rates do not
    underflow; twelve standard deviations beyond the mean no double is left below 1.
    """
    last = _most(rate)
    safe = F.greatest(rate, F.lit(1e-300))
    start = F.struct(F.array(F.exp(-rate)).alias("steps"), (-rate).alias("log"),
                     F.exp(-rate).alias("sum"))

    def add(at: Column, k: Column) -> Column:
        log = at["log"] + F.log(safe / k)
        total = at["sum"] + F.exp(log)
        return F.struct(F.array_append(at["steps"], total).alias("steps"), log.alias("log"),
                        total.alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), last), start, add)["steps"]


def replicate(docs: DataFrame, weights: dict[str, float] | None = None,
              exponent: float = 0.5, seed: str = "mix", id_col: str = "doc_id",
              source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` repeated to the target weights and in random order over all partitions.

    A document's count is the inverse of its source's Poisson distribution at a number from
    the hash of seed, id and source: any run on any cluster gives the same copies. ``_copy``
    numbers the copies from 0, ``_rate`` is the source's rate, and ``_place`` in [0, 1) gives
    the global order: rows are dealt over partitions by it and sorted within each. Repeated
    rows have the same id and so the same count, and are told apart by nothing else. Columns of
    ``docs`` with the names of the added ones give way. Null ids and sources are values like others.
    """
    rates = written(source_rates(docs, weights, exponent, source_col, text_col), "rates")
    size = rates.agg(F.sum(_most(F.col("_rate"))).alias("n")).first()["n"] or 0
    rates = rates.select("_source", "_rate", poisson_steps(F.col("_rate")).alias("_steps"))
    if size <= STEPS_BROADCAST:  # beyond it sources are shuffled like any join
        rates = F.broadcast(rates)
    added = ("_copy", "_rate", "_place")
    others = F.struct(*[c for c in docs.columns if c not in added]).alias("_row")
    keys = F.col(id_col).alias("_id"), F.col(source_col).alias("_from")
    counted = docs.select(others, *keys).join(
        rates, F.col("_from").eqNullSafe(F.col("_source"))).withColumn(
        "_u", uniform(f"{seed}-count", F.col("_id"), F.col("_from")))
    copies = F.size(F.filter("_steps", lambda p: p <= F.col("_u")))
    repeated = (
        counted.withColumn("_n", copies).where(F.col("_n") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    )
    place = uniform(f"{seed}-order", F.col("_id"), F.col("_from"), F.col("_copy"))
    return (
        repeated.select("_row", "_copy", "_rate", place.alias("_place"))
        .repartition("_place").sortWithinPartitions("_place").select("_row.*", *added)
    )
