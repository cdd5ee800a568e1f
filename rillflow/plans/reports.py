"""The dashboard queries (AGG-07 .. AGG-11, SCH-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import contains_all
from rillflow.operators.aggregates import exact_sum
from rillflow.operators.search import Hits, search_page

# Labels of the reports.
GENDER_LABELS = {"F": "女", "M": "男"}
AGE_LABELS = ["20岁以下", "20到29岁", "30岁以上"]

# The columns of the detail page.
DETAIL_COLUMNS = [
    "create_time", "order_price", "province_name", "sku_name", "sku_num", "total_amount",
    "user_age", "user_gender",
]


def dau_total(users: DataFrame, day: str) -> DataFrame:
    """Active users of a day, 0 when there is no such day (AGG-07)."""
    return users.where(F.col("dt") == day).agg(F.count(F.lit(1)).alias("dau_total"))


def dau_by_hour(users: DataFrame, day: str) -> DataFrame:
    """Active users by hour for a day and the day before, in one pass (AGG-08)."""
    days = [F.lit(day), F.date_format(F.date_sub(F.lit(day).cast("date"), 1), "yyyy-MM-dd")]
    found = users.where(F.col("dt").isin(*days))
    return found.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("cnt"))


def _matched(wide: DataFrame, item: str, field: str, day: str | None) -> DataFrame:
    rows = wide if day is None else wide.where(F.col("create_date") == day)
    return rows.where(contains_all(F.col("sku_name"), item) & F.col(field).isNotNull())


def gender_label(gender: Column) -> Column:
    label = gender
    for code, text in GENDER_LABELS.items():
        label = F.when(gender == code, text).otherwise(label)
    return label


def sales_by_gender(wide: DataFrame, item: str, day: str | None = None) -> DataFrame:
    """Sales of the items matching all words, by gender (AGG-09, AGG-10)."""
    sales = _matched(wide, item, "user_gender", day).groupBy("user_gender").agg(
        exact_sum(F.col("split_total_amount")).alias("value")
    )
    return sales.select(gender_label(F.col("user_gender")).alias("name"), "value")


def sales_by_age(wide: DataFrame, item: str, day: str | None = None) -> DataFrame:
    """Sales by age bucket: three rows when anything matched, else none (AGG-09, AGG-11)."""
    under, twenties, over = AGE_LABELS
    age, amount = F.col("user_age"), F.col("split_total_amount").cast("decimal(18,2)")
    sums = _matched(wide, item, "user_age", day).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.when(age < 20, amount)).alias("a"),
        F.sum(F.when((age >= 20) & (age <= 29), amount)).alias("b"),
        F.sum(F.when(age > 29, amount)).alias("c"),
    )
    bucket = lambda label, column: F.struct(
        F.lit(label).alias("name"), F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value")
    )
    rows = F.array(bucket(under, "a"), bucket(twenties, "b"), bucket(over, "c"))
    return sums.where(F.col("_rows") > 0).select(F.inline(rows))


def item_detail(
    wide: DataFrame, item: str, day: str | None = None, page_no: int = 1, page_size: int = 20
) -> Hits:
    """One page of the order details whose item matches all words (SCH-08)."""
    condition = None if day is None else F.col("create_date") == day
    return search_page(
        wide, "sku_name", item, "detail_id", DETAIL_COLUMNS, condition, every_token=True,
        page_no=page_no, page_size=page_size,
    )
