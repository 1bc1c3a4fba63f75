"""Which firms are labelled distressed one quarter ahead?"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r


@query(
    "flagship_distressed_firms",
    ctes("labeled")
    + f"""SELECT firm_id, CAST(count(*) AS BIGINT) AS quarters, CAST(sum(distress_label) AS BIGINT) AS distressed_quarters,
 {r('avg(distress_label)', 6)} AS distress_rate, max(CASE WHEN distress_label = 1 THEN quarter_key END) AS last_distressed
 FROM labeled GROUP BY firm_id""",
)
def flagship(spark, folder):
    labeled = X.labeled_panel(spark, folder)
    return labeled.groupBy("firm_id").agg(
        F.count(F.lit(1)).alias("quarters"),
        F.sum(F.col("distress_label").cast("bigint")).alias("distressed_quarters"),
        F.round(F.avg("distress_label"), 6).alias("distress_rate"),
        F.max(F.when(F.col("distress_label") == 1, F.col("quarter_key"))).alias("last_distressed"),
    )
