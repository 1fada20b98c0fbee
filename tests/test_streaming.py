"""W15 through a file stream: two drops of staged sales, then a replayed drop."""

from pyspark.sql import functions as F

from starmart import config as C
from starmart.catalog import Warehouse
from starmart.loads import Staged
from starmart.session import scratch_path
from starmart.streaming.incremental import start_sales_feed

from .conftest import SF001


def test_file_stream_loads_increments_idempotently(spark):
    staged = Staged.from_driver(spark, SF001)
    root = scratch_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/wh")
    sales = staged.sales
    early = sales.filter(F.col("transaction_date") < F.lit(C.BATCH2_AS_OF))
    late = sales.filter(F.col("transaction_date") >= F.lit(C.BATCH2_AS_OF))
    early.write.parquet(f"{root}/in/drop=1")
    q = start_sales_feed(wh, staged, f"{root}/in/drop=1", f"{root}/ckpt1", C.BATCH2_AS_OF)
    q.awaitTermination()
    n1 = wh["fact_sales"].count()
    late.write.parquet(f"{root}/in2/drop=2")
    early.write.parquet(f"{root}/in2/drop=3")          # a replay of the first drop
    q = start_sales_feed(wh, staged, f"{root}/in2", f"{root}/ckpt2", C.BATCH2_AS_OF)
    q.awaitTermination()
    total = wh["fact_sales"].count()
    want = sales.select("transaction_id", "product_business_key").distinct().count()
    assert 0 < n1 < total == want
