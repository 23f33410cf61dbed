"""CSV ingestion (A1) on real data: the sales view written as CSV part files
and read back as text gives the same grouped metrics as the Parquet path."""

from pyspark.sql import functions as F

from revlens.operators import aggregate as agg
from revlens.plans.queries import q_group_region_product
from revlens.sources import views as V
from revlens.sources.csv import scan_csv
from revlens.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_sales_csv_roundtrip(spark, tmp_path):
    path = str(tmp_path / "sales_csv")
    V.v_sales(Tables(spark, SF)).write.option("header", True).csv(path)
    sales = scan_csv(spark, path, required={"region", "product", "revenue"})
    assert sales.dtypes == [(c, "string") for c in sales.columns]
    typed = sales.withColumn("revenue", F.col("revenue").cast("decimal(12,2)"))
    got = sorted(tuple(r) for r in agg.group_metrics(typed).collect())
    want = sorted(tuple(r) for r in q_group_region_product(spark, SF).collect())
    assert got == want and len(got) > 0
