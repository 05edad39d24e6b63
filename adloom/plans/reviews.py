"""Product reviews: keyed copies for reading, monthly rankings, aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom import schemas
from adloom.functions import flags, text
from adloom.functions.shape import present
from adloom.operators.ranking import latest_per_key, top_per_group

# Star ratings that make a critic and a supporter.
LOW_STARS = (1, 2)
HIGH_STARS = (4, 5)

# Primary keys of the keyed copies: partition key, then clustering columns.
BY_PRODUCT = ("product_id", "review_date", "review_id")
BY_PRODUCT_RATING = ("product_id", "star_rating", "review_date", "review_id")
BY_CUSTOMER = ("customer_id", "review_date", "review_id")


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews. Bad dates and ratings become null."""
    return raw.withColumns({
        "review_date": text.to_day(F.col("review_date")),
        "star_rating": text.to_int(F.col("star_rating"))})


# Of rows marked by :func:`mark_last_writes`, the column that says which of them a keyed copy holds.
MARKS = {BY_PRODUCT: "last_of_product", BY_PRODUCT_RATING: "last_of_rating"}


def mark_last_writes(raw: DataFrame, order: str) -> DataFrame:
    """Raw reviews dealt and sorted by ranges of the product key, with the columns ``MARKS``: the two copies by product then
    take their rows as they are stored, so one shuffle serves both. ``order`` is unique and says which write is later.

    The key with a rating holds the key without, so the writes of either are in one range. Rows without a whole key are in
    no copy; each counts as a key of its own, as all of them would come to one task otherwise."""
    day, stars, alone, key = "_day", "_stars", "_alone", ["product_id", "_day", "review_id", "_alone"]
    typed = raw.withColumn(day, text.to_day(F.col("review_date")))
    whole = F.col("product_id").isNotNull() & F.col(day).isNotNull() & F.col("review_id").isNotNull()
    dealt = typed.withColumn(alone, F.when(~whole, F.col(order))).repartitionByRange(*key).withColumn(stars, text.to_int(F.col("star_rating")))
    dealt = dealt.sortWithinPartitions(*key, stars)  # the order of both windows, so rows are sorted once
    last = lambda *by: F.col(order) == F.max(order).over(Window.partitionBy(*by))
    marked = dealt.withColumn(MARKS[BY_PRODUCT], whole & last(*key)).withColumn(
        MARKS[BY_PRODUCT_RATING], whole & F.col(stars).isNotNull() & last(*key, stars))
    return marked.drop(day, stars, alone)


def _keyed(reviews: DataFrame, key: Sequence[str], columns: Sequence[str], written: Sequence[str], ranged: bool = False, buckets: int = 0) -> DataFrame:
    if MARKS.get(key) in reviews.columns:
        return reviews.filter(F.col(MARKS[key])).select(*columns)
    rows = present(reviews.select(*dict.fromkeys([*columns, *written])), *key)
    return latest_per_key(rows, key, written, ranged, buckets).select(*columns)


def reviews_by_product(reviews: DataFrame, written: Sequence[str], ranged: bool = False, buckets: int = 0) -> DataFrame:
    return _keyed(reviews, BY_PRODUCT, schemas.REVIEWS_BY_PRODUCT, written, ranged, buckets)


def reviews_by_product_rating(reviews: DataFrame, written: Sequence[str], ranged: bool = False) -> DataFrame:
    """The rating is part of this key, so rows without one are left out."""
    return _keyed(reviews, BY_PRODUCT_RATING, schemas.REVIEWS_BY_PRODUCT_RATING, written, ranged)


def reviews_by_customer(reviews: DataFrame, written: Sequence[str], ranged: bool = False) -> DataFrame:
    """A narrow copy, so the bodies are never shuffled. It holds what the product
    copy holds, hence rows need a product too."""
    with_product = reviews.filter(F.col("product_id").isNotNull())
    return _keyed(with_product, BY_CUSTOMER, schemas.REVIEWS_BY_CUSTOMER, written, ranged)


def newest_reviews(keyed: DataFrame, partition_key: Sequence[str], limit: int = 10) -> DataFrame:
    """First page of every partition: newest date first, then review id."""
    return top_per_group(keyed, partition_key, [F.desc("review_date"), F.asc("review_id")], limit)


def _with_period(reviews: DataFrame) -> DataFrame:
    return present(reviews.withColumn("period", text.month_label(F.col("review_date"))), "period")


def _review_count(reviews: DataFrame, who: str) -> DataFrame:
    return _with_period(reviews).groupBy("period", who).agg(F.count(F.lit(1)).alias("review_count"))


def top_products_by_period(reviews: DataFrame) -> DataFrame:
    return _review_count(reviews, "product_id")


def top_customers_verified(reviews: DataFrame) -> DataFrame:
    return _review_count(reviews.filter(flags.verified_yes(F.col("verified_purchase"))), "customer_id")


def top_haters(reviews: DataFrame) -> DataFrame:
    return _review_count(reviews.filter(F.col("star_rating").isin(*LOW_STARS)), "customer_id")


def top_backers(reviews: DataFrame) -> DataFrame:
    return _review_count(reviews.filter(F.col("star_rating").isin(*HIGH_STARS)), "customer_id")


def customer_marts(reviews: DataFrame) -> DataFrame:
    """The three customer rankings from one scan and one shuffle, as one table with a
    ``mart`` column; a load that needs all three reads the reviews once."""
    counts = _with_period(reviews).groupBy("period", "customer_id").agg(
        F.count_if(flags.verified_yes(F.col("verified_purchase"))).alias("verified"),
        F.count_if(F.col("star_rating").isin(*LOW_STARS)).alias("haters"),
        F.count_if(F.col("star_rating").isin(*HIGH_STARS)).alias("backers"))
    return (
        counts.unpivot(["period", "customer_id"], ["verified", "haters", "backers"], "mart", "review_count")
        .filter(F.col("review_count") > 0)
    )


def top_of_period(mart: DataFrame, who: str, limit: int = 10, period: str | None = None) -> DataFrame:
    """Leaders of one month, or of each month."""
    rows = mart if period is None else mart.filter(F.col("period") == period)
    return top_per_group(rows, ["period"], [F.desc("review_count"), F.asc(who)], limit)


def verified_reviews(raw: DataFrame) -> DataFrame:
    """Complete reviews of verified purchases, in any spelling of the flag. A date
    that is there but cannot be read keeps its row; it only lacks month and year."""
    complete = present(raw, "review_id", "product_id", "review_date")
    return present(clean_reviews(complete), "star_rating").filter(
        flags.verified_any(F.col("verified_purchase")))


def product_stats(verified: DataFrame) -> DataFrame:
    return verified.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"), F.avg("star_rating").alias("avg_rating"))


def customer_activity(verified: DataFrame) -> DataFrame:
    return verified.groupBy("customer_id").agg(F.count("review_id").alias("verified_reviews_count"))


def product_trends(verified: DataFrame) -> DataFrame:
    return verified.groupBy(
        "product_id", F.year("review_date").cast("bigint").alias("year"),
        F.month("review_date").cast("bigint").alias("month"),
    ).agg(F.count("review_id").alias("review_count"))
