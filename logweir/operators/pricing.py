"""Watched products against the prices on captured pages."""

from pyspark.sql import functions as F

from logweir.fixed_values import PRICE_BELOW, PRICE_ELEMENT_IDS, PRICE_NOT_BELOW
from logweir.functions import element_text, parse_price, price_text
from logweir.operators.joins import BROADCAST_BYTES, fits_broadcast, skew_safe_join

PRICE_MISSING = "Price not found"


def page_price(html, element_ids=PRICE_ELEMENT_IDS):
    """Price on a page: the first of the elements that is there."""
    return parse_price(F.coalesce(*[element_text(html, name) for name in element_ids]))


def newest_page(pages, order_by="page_id", element_ids=PRICE_ELEMENT_IDS):
    """(url, price) of the newest capture of every url.

    The price is cut out ahead of the shuffle, so pages themselves never move, and each task
    sends one row per url however often it was captured.
    """
    prices = pages.select("url", F.col(order_by), page_price(F.col("html"), element_ids).alias("price"))
    newest = F.max(F.struct(order_by, "price"))
    return prices.groupBy("url").agg(newest.alias("newest")).select("url", "newest.price")


def first_rows(df, order_by, n=5):
    """The first n rows in the given order; ties go by all columns, so that every evaluation takes
    the same rows."""
    return df.orderBy(*order_by, *[F.col(f"`{name}`") for name in df.columns]).limit(n)


def price_status(
    watchlist,
    pages,
    *,
    order_by="page_id",
    element_ids=PRICE_ELEMENT_IDS,
    keep=(),
    max_broadcast_bytes=BROADCAST_BYTES,
    **skew,
):
    """Every watched product with its current price, status and report line.

    Below the target means strictly below; the target counts in whole units. A product without a
    page, or whose page has no readable price, is reported as such.

    When the watched urls are measured to be small, pages of other urls are left out before
    anything is parsed, and the prices, at most one per watched url, are broadcast. Otherwise
    prices and products meet by shuffle, with hot urls of the watchlist split.
    """
    watched = watchlist.withColumn("target", F.col("Target Price").cast("int"))
    urls = watchlist.select(F.col("URL").alias("url"))
    small = fits_broadcast(urls, max_broadcast_bytes)
    if small:
        pages = pages.join(F.broadcast(urls), "url", "left_semi")
    prices = newest_page(pages, order_by, element_ids).withColumnRenamed("url", "URL")
    if small:
        rows = watched.join(F.broadcast(prices), "URL", "left")
    else:
        rows = skew_safe_join(watched, prices, ["URL"], "left", **skew)
    status = (
        F.when(F.col("price").isNull(), PRICE_MISSING)
        .when(F.col("price") < F.col("target"), PRICE_BELOW)
        .otherwise(PRICE_NOT_BELOW)
    )
    shown = F.coalesce(price_text(F.col("price")), F.lit("unknown"))
    line = F.concat(
        F.col("Model"), F.lit(" Present Price: Rs."), shown, F.lit(" Status:"), F.col("status")
    )
    return rows.withColumn("status", status).select(
        *keep, "Model", "URL", "target", "price", "status", line.alias("line")
    )
