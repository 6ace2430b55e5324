"""Cleaning of invoice rows: typed casts, positive-value filters, country check.

Input columns (all text, as the invoice message carries them): ``Country``,
``UnitPrice``, ``Quantity``, ``InvoiceDate``. Everything is row-local (no
shuffle) and works on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.decode import parse_time
from tideline.functions.fixed import COUNTRY_PATTERN, INVOICE_DATE_FORMAT

PRICE_LIMIT = 1e12  # prices are summed as decimals: 16 digits before the point, 8 after
CLEAN_COLUMNS = ["Country", "UnitPrice", "Quantity", "InvoiceDate"]


def typed_invoice(df: DataFrame, date_format: str = INVOICE_DATE_FORMAT) -> DataFrame:
    """Casts only: price -> double, quantity -> int, date text -> timestamp_ntz."""
    return df.withColumns({
        "UnitPrice": F.col("UnitPrice").try_cast("double"),
        "Quantity": F.col("Quantity").try_cast("int"),
        "InvoiceDate": parse_time("InvoiceDate", date_format),
    })


def retail_clean(df: DataFrame, date_format: str = INVOICE_DATE_FORMAT,
                 country_pattern: str = COUNTRY_PATTERN) -> DataFrame:
    """Keep rows with quantity > 0, a price over 0 and under ``PRICE_LIMIT`` and
    a country holding a letter.

    Not-a-number and infinite prices are over every limit. Unparseable numbers are NULL and fail the comparisons, so they are
    dropped too. A row whose date does not parse is kept with a NULL date
    (it passes every filter; a time window later ignores it).
    """
    t = typed_invoice(df, date_format)
    return (t.filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & (F.col("UnitPrice") < PRICE_LIMIT))
             .select(*CLEAN_COLUMNS)
             .filter(F.col("Country").rlike(country_pattern)))


def reject_reason(date_format: str = INVOICE_DATE_FORMAT,
                  country_pattern: str = COUNTRY_PATTERN):
    """First failed check of a raw invoice row, or ``ok`` / ``no_date``."""
    q = F.col("Quantity").try_cast("int")
    p = F.col("UnitPrice").try_cast("double")
    d = parse_time("InvoiceDate", date_format)
    return (F.when(q.isNull(), "bad_quantity")
             .when(q <= 0, "quantity_not_positive")
             .when(p.isNull(), "bad_price")
             .when(p <= 0, "price_not_positive")
             .when(p >= PRICE_LIMIT, "price_out_of_range")
             .when(F.col("Country").isNull() | ~F.col("Country").rlike(country_pattern),
                   "bad_country")
             .when(d.isNull(), "no_date")
             .otherwise("ok"))


def retail_rejects(df: DataFrame, **kw) -> DataFrame:
    """Row counts per reason: the clean step drops rows silently; this says why.

    ``no_date`` rows survive the clean step but fall in no time window.
    One hash aggregate with map-side combine: a handful of groups at any size.
    """
    return (df.select(reject_reason(**kw).alias("reason"))
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
