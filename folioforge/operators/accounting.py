"""Token and cost accounting: deduplicated calls, tiered prices, daily rows.

Unknown and zero differ: a total over unknown values is null where it must be
complete (``totals``), and skips them where it reports what is known (``known``).
Money is an exact integer of 1e-8 dollars: token counts times rates per million
tokens with two decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Model, tier and dollars per million tokens: input, cached input, cache write, output.
PRICES = (
    ("alpha", "short", "2.50", "0.25", "3.00", "10.00"),
    ("alpha", "long", "5.00", "0.50", "6.00", "15.00"),
    ("nova", "short", "1.25", "0.13", "1.50", "5.00"),
    ("nova", "long", "2.50", "0.25", "3.00", "7.50"),
)
THRESHOLD = 53_000
PAGE_DOLLARS = "0.03"
TOKENS = ("input_tokens", "cached_input_tokens", "cache_write_tokens", "output_tokens")
COUNTS = ("priced_calls", "unpriced_calls", "tier_unresolved_calls", "cache_usage_unreported_calls")


def price_rows(prices: Sequence[tuple[str, ...]] = PRICES) -> str:
    """The price book as SQL rows, in hundredths of a dollar per million tokens."""
    return ", ".join("('{}', '{}', {}, {}, {}, {})".format(*p[:2], *(round(float(x) * 100) for x in p[2:])) for p in prices)


def price_book(spark: SparkSession, prices: Sequence[tuple[str, ...]] = PRICES) -> DataFrame:
    """One row a model with both tiers; its size is that of the list."""
    rows = spark.sql(f"SELECT model, tier, CAST(i AS BIGINT) i, CAST(c AS BIGINT) c, CAST(w AS BIGINT) w, CAST(o AS BIGINT) o FROM VALUES {price_rows(prices)} AS p(model, tier, i, c, w, o)")
    tiers = [F.max(F.when(F.col("tier") == t, F.struct("i", "c", "w", "o"))).alias(t) for t in ("short", "long")]
    return rows.groupBy("model").agg(*tiers)


def first_calls(calls: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each call in a total order."""
    rank = Window.partitionBy(key).orderBy(*order)
    return calls.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def _amount(tier: Column) -> Column:
    ordinary = F.col("input_tokens") - F.col("cached_input_tokens") - F.col("cache_write_tokens")
    return ordinary * tier["i"] + F.col("cached_input_tokens") * tier["c"] + F.col("cache_write_tokens") * tier["w"] + F.col("output_tokens") * tier["o"]


def price_calls(calls: DataFrame, book: DataFrame, threshold: int | None = THRESHOLD) -> DataFrame:
    """Adds ``priced``, the ``tier`` and the ``low`` and ``high`` cost of each call.

    A call is priced if its model is listed, its counts are known and not negative, and
    cached and written tokens fit in the input. Above the threshold (strictly) the long
    tier applies; without one both tiers bound the cost.
    """
    rows = calls.join(book, "model", "left")
    known = F.lit(True)
    for t in TOKENS:
        known = known & F.coalesce(F.col(t) >= 0, F.lit(False))
    fits = F.col("cached_input_tokens") + F.col("cache_write_tokens") <= F.col("input_tokens")
    rows = rows.withColumn("priced", F.coalesce(F.col("short").isNotNull() & known & fits, F.lit(False)))
    if threshold is None:
        low, high = F.least(_amount(F.col("short")), _amount(F.col("long"))), F.greatest(_amount(F.col("short")), _amount(F.col("long")))
        rows = rows.withColumn("tier", F.lit(None).cast("string"))
    else:
        rows = rows.withColumn("tier", F.when(F.col("input_tokens") > threshold, "long").otherwise("short"))
        low = high = F.when(F.col("tier") == "long", _amount(F.col("long"))).otherwise(_amount(F.col("short")))
    return rows.withColumn("low", F.when(F.col("priced"), low)).withColumn("high", F.when(F.col("priced"), high)).drop("short", "long")


def cost_columns(threshold: int | None = THRESHOLD) -> list[Column]:
    """The aggregates of a cost: counts, tokens of priced calls, and bounds."""
    priced = F.col("priced")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(priced, value)), F.lit(0))

    return [
        F.count_if(priced).alias("priced_calls"),
        F.count_if(~priced).alias("unpriced_calls"),
        (F.count_if(priced) if threshold is None else F.lit(0).cast("long")).alias("tier_unresolved_calls"),
        F.count_if(priced & F.col("cache_usage_unreported")).alias("cache_usage_unreported_calls"),
        total(F.col("input_tokens") - F.col("cached_input_tokens") - F.col("cache_write_tokens")).alias("ordinary_input_tokens"),
        *[total(F.col(t)).alias(t) for t in TOKENS[1:]],
        total(F.col("low")).alias("low_e8"),
        total(F.col("high")).alias("high_e8"),
    ]


def calendar(spark: SparkSession, days: DataFrame) -> DataFrame:
    """Every day from the first of ``first`` to ``last``: one row for each, without gaps."""
    return days.select(F.explode(F.sequence("first", "last")).alias("day"))


def daily_rows(completions: DataFrame, costs: DataFrame, today: str | None = None) -> DataFrame:
    """One row a day, days without completions included, and a cumulative row without a day.

    ``costs`` has one row a completion ``id``; completions without one count as zero.
    """
    rows = completions.join(costs.withColumnRenamed("doc_id", "id"), "id", "left")
    sums = ["source_pages", "elapsed_seconds", "priced_calls", "unpriced_calls", "low_e8"]
    one = rows.groupBy("day").agg(
        F.count("*").alias("completed"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.count_if(F.col("missing_logs")).alias("with_missing_logs"),
        F.count_if(F.col("elapsed_seconds").isNull()).alias("with_unknown_elapsed"),
    )
    ends = completions.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    values = [c for c in one.columns if c != "day"]
    dense = calendar(completions.sparkSession, ends).join(one, "day", "left").na.fill(0, values)
    return dense.rollup("day").agg(*[F.sum(c).alias(c) for c in values], F.grouping("day").cast("int").alias("cumulative")).withColumn("provisional", F.coalesce(F.col("day") == F.lit(today).cast("date"), F.lit(False)))


def call_totals(calls: DataFrame, keys: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """Counts, and for each token column a total that is null if any value is unknown, what is known, and how many aren't."""
    finish = calls.where("event = 'finish'")
    out = [F.count("*").alias("calls"), F.sum(F.greatest(F.lit(0.0), F.coalesce("seconds", F.lit(0.0)))).alias("model_seconds"), F.count_if(F.col("attempt") > 1).alias("retries"), F.count_if(F.col("status") == "error").alias("failed_calls")]
    for t in tokens:
        out += [
            F.when(F.count(t) == F.count("*"), F.sum(t)).alias(f"total_{t}"),
            F.coalesce(F.sum(t), F.lit(0)).alias(f"known_{t}"),
            (F.count("*") - F.count(t)).alias(f"missing_{t}"),
        ]
    return finish.groupBy(*keys).agg(*out) if keys else finish.agg(*out)


def abandoned_starts(calls: DataFrame, accounted: DataFrame, key: str = "call_id") -> DataFrame:
    """Starts that neither finish nor were charged before."""
    starts = calls.where("event = 'start'")
    return starts.join(calls.where("event = 'finish'").select(key), key, "left_anti").join(accounted.select(key), key, "left_anti")


def last_per(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def previous_completion(completions: DataFrame) -> DataFrame:
    """Adds the latest earlier completion of the same source."""
    before = Window.partitionBy("source").orderBy("completed_at", "id").rowsBetween(Window.unboundedPreceding, -1)
    return completions.withColumn("previous_at", F.max("completed_at").over(before))


def merge_ledgers(local: DataFrame, remote: DataFrame, cutover: str) -> DataFrame:
    """Local rows before the cutover day, remote rows from it on."""
    day = F.lit(cutover).cast("date")
    return local.where(F.col("day") < day).unionByName(remote.where(F.col("day") >= day))


def ledger_faults(ledger: DataFrame) -> DataFrame:
    """Ids that repeat, and rows without an id or day: a ledger with any is rejected."""
    repeated = ledger.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate id").alias("fault"), "n")
    blank = ledger.where("id is null or day is null").groupBy("id").agg(F.count("*").alias("n")).select("id", F.lit("missing id or day").alias("fault"), "n")
    return repeated.unionByName(blank)


def dollars(e8: Column) -> Column:
    """Four decimals of an amount in 1e-8 dollars, ties to the even digit."""
    whole, rest = F.floor(e8 / 10_000), F.pmod(e8, F.lit(10_000))
    units = whole + ((rest > 5_000) | ((rest == 5_000) & (whole % 2 == 1))).cast("long")
    return F.format_string("$%d.%04d", F.floor(units / 10_000), F.pmod(units, F.lit(10_000)))


def cost_label(pages: Column | None = None, page_dollars: str = PAGE_DOLLARS) -> Column:
    """The label of a cost: one amount or a range, a page surcharge and the sum, or that nothing is priced.

    Its words are fixed values of the report format.
    """
    def span(low: Column, high: Column) -> Column:
        return F.when(low == high, dollars(low)).otherwise(F.concat(dollars(low), F.lit(" - "), dollars(high)))

    low, high = F.col("low_e8"), F.col("high_e8")
    nothing = (F.col("priced_calls") == 0) & (F.col("unpriced_calls") > 0)
    part = F.when(F.col("unpriced_calls") > 0, "（部分）").otherwise("")
    base = F.when(nothing, F.lit("未计价")).otherwise(F.concat(span(low, high), part))
    if pages is None:
        return base
    extra = pages * F.lit(round(float(page_dollars) * 100_000_000)).cast("long")
    return F.when(nothing, F.concat(base, F.lit(" + "), dollars(extra))).otherwise(F.concat(base, F.lit(" + "), dollars(extra), F.lit(" = "), span(low + extra, high + extra)))
