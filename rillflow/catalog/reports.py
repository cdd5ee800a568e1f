"""Dashboard queries over the two wide tables."""

from rillflow.catalog.records import ORDER_WIDE
from rillflow.catalog.registry import query
from rillflow.catalog.warehouse import DAU, dau, wide
from rillflow.plans import reports

DAY, YESTERDAY = "2024-01-15", "2024-01-14"
ITEM = "bolt red"


@query(f"WITH {DAU} SELECT count(*) AS dau_total FROM dau WHERE dt = '{DAY}'")
def dau_total(t):
    """AGG-07."""
    return reports.dau_total(dau(t), DAY)


@query(f"""WITH {DAU} SELECT dt, hr, count(*) AS cnt FROM dau WHERE dt IN ('{DAY}', '{YESTERDAY}')
GROUP BY dt, hr""")
def dau_by_hour_two_days(t):
    """AGG-08."""
    return reports.dau_by_hour(dau(t), DAY)


MATCHED = f"""{ORDER_WIDE},
matched AS (SELECT * FROM order_wide
            WHERE regexp_matches(sku_name, '\\bred\\b') AND regexp_matches(sku_name, '\\bbolt\\b'))"""


@query(f"""WITH {MATCHED}, sales AS (
  SELECT user_gender, CAST(sum(CAST(split_total_amount AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM matched GROUP BY user_gender)
SELECT CASE user_gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE user_gender END AS name, value
FROM sales WHERE user_gender IS NOT NULL""")
def sales_by_gender(t):
    """AGG-09, AGG-10."""
    return reports.sales_by_gender(wide(t), ITEM)


@query(f"""WITH {MATCHED}, groups AS (
  SELECT user_age, sum(CAST(split_total_amount AS DECIMAL(18,2))) AS amount FROM matched
  WHERE user_age IS NOT NULL GROUP BY user_age),
labels(name, low, high) AS (
  VALUES ('20岁以下', -1000, 19), ('20到29岁', 20, 29), ('30岁以上', 30, 1000))
SELECT name, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS value
FROM labels LEFT JOIN groups ON user_age BETWEEN low AND high
WHERE EXISTS (SELECT 1 FROM groups) GROUP BY name""")
def sales_by_age(t):
    """AGG-09, AGG-11."""
    return reports.sales_by_age(wide(t), ITEM)


@query(f"""WITH {MATCHED}
SELECT create_time, order_price, province_name,
       regexp_replace(sku_name, '\\b(red|bolt)\\b', '<em>\\1</em>', 'g') AS sku_name,
       sku_num, total_amount, user_age, user_gender
FROM matched ORDER BY detail_id LIMIT 20""")
def item_detail_page(t):
    """SCH-08, PRJ-03, SCH-06, SRT-03."""
    return reports.item_detail(wide(t), ITEM).detail


@query(f"WITH {MATCHED} SELECT count(*) AS total FROM matched")
def item_detail_total(t):
    """SCH-08."""
    return reports.item_detail(wide(t), ITEM).total
