"""The metric as Spark SQL text over a table chosen by parameter.

The reference substitutes ``${dataset}`` into its SQL text. Here the table name is a
bound parameter (``IDENTIFIER(:tbl)``) and the window bounds are typed parameters, so
nothing is spliced into the statement. Same explode form and exact cent sums as the
DataFrame version; ``12.0D``/``100.0D`` are written as doubles on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.metric import _month, window_months

MRR_MONTHLY_SQL = """
WITH active AS (
  SELECT CAST(start_date AS DATE) AS sd,
         CAST(canceled_at AS DATE) AS cd,
         CAST(unit_amount_cents AS BIGINT) AS cents,
         CASE lower(`interval`) WHEN 'month' THEN CAST(interval_count AS BIGINT) * 100
                                WHEN 'year'  THEN CAST(interval_count AS BIGINT) * 1200 END AS divisor
  FROM IDENTIFIER(:tbl)
  WHERE status NOT IN ('incomplete', 'incomplete_expired')
),
bounded AS (
  SELECT cents, divisor,
         greatest(trunc(sd, 'MM'), :w0) AS lo,
         least(coalesce(add_months(trunc(cd, 'MM'), -1), :w1), :w1) AS hi
  FROM active
  WHERE divisor IS NOT NULL AND sd IS NOT NULL
),
per_group AS (
  SELECT month, divisor, SUM(cents) AS cents
  FROM bounded
  LATERAL VIEW explode(CASE WHEN lo <= hi THEN sequence(lo, hi, INTERVAL 1 MONTH) END) m AS month
  GROUP BY month, divisor
)
SELECT month,
       CAST(SUM(CAST(cents AS DECIMAL(28,0)) / CAST(divisor AS DECIMAL(10,0))) AS DECIMAL(38,9)) AS mrr_amount
FROM per_group
GROUP BY month
"""


def mrr_monthly_sql(spark: SparkSession, table_name: str, start, end) -> DataFrame:
    """G1 through ``spark.sql`` with the table name and window passed as parameters."""
    window_months(start, end)
    w0, w1 = _month(start), _month(end)
    return spark.sql(MRR_MONTHLY_SQL, args={"tbl": table_name, "w0": w0, "w1": w1})

