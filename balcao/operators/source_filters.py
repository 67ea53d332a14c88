"""The selections under which source reports are drawn, as filters on the facts themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t
from balcao.functions.period import in_period


def channel_sales(sales: DataFrame, seller: str = "code") -> DataFrame:
    """Sales booked on the seller code that stands for the app channel."""
    return sales.where(t.code_key(F.col(seller).cast("string")) == vocab.CHANNEL_SELLER_CODE)


def is_hb_product(group: Column, department: Column) -> Column:
    """Health and beauty, without the departments that do not count. Unknown ones count."""
    excluded = F.coalesce(department.cast("string").isin(*vocab.HB_EXCLUDED_DEPARTMENTS), F.lit(False))
    return (group.cast("string") == vocab.HB_PRODUCT_GROUP) & ~excluded


def hb_products(products: DataFrame, group: str = "group", department: str = "department") -> DataFrame:
    return products.where(is_hb_product(F.col(group), F.col(department)))


def period_sales(sales: DataFrame, as_of: str, sold_at: str = "sold_at") -> DataFrame:
    """Sales of the reporting period that ``as_of`` falls into."""
    return sales.where(in_period(F.col(sold_at), as_of))


def active_staff(staff: DataFrame, dismissed: str = "Data de desligamento") -> DataFrame:
    """People without a date of dismissal; texts for missing values are no date."""
    date = t.strip(F.col(f"`{dismissed}`").cast("string"))
    gone = ~date.isin(*vocab.MISSING_TEXTS)
    return staff.where(~F.coalesce(gone, F.lit(False)))
