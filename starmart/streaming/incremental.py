"""W15 fed by Structured Streaming: staged sales files arriving in a folder.

The first micro-batch of a feed loads the dimensions from the given staging;
each one then runs the audited incremental load of its sales against the
published dimensions and publishes a snapshot. A feed may replay a batch, so it
ignores conflicts on the business key: with the reference's key, a sale whose
product has a new version since would be loaded again (W14). ``availableNow``
drains what is there and stops, which suits scheduled runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DecimalType, LongType, StructField, StructType

from ..catalog import Warehouse
from ..loads import Staged
from ..runs import run_full_etl

SALES_SCHEMA = StructType([
    StructField("transaction_id", LongType()), StructField("transaction_date", DateType()),
    StructField("customer_business_key", LongType()),
    StructField("store_business_key", LongType()),
    StructField("product_business_key", LongType()), StructField("quantity", LongType()),
    StructField("unit_price", DecimalType(10, 2)), StructField("total_amount", DecimalType(10, 2)),
    StructField("discount_amount", DecimalType(10, 2))])


def start_sales_feed(wh: Warehouse, dims: Staged, sales_dir: str, checkpoint: str,
                     as_of: dt.date, mode: str = "business",
                     available_now: bool = True) -> StreamingQuery:
    """Start the feed; ``dims`` supplies staged customers, products and stores."""
    stream = wh.spark.readStream.schema(SALES_SCHEMA).parquet(sales_dir)

    loaded: list[int] = []  # the epoch that loaded the dimensions, once it has

    def load(batch: DataFrame, epoch_id: int) -> None:
        staged = Staged(dims.customers, dims.products, dims.stores, batch)
        run_full_etl(wh, staged, as_of, mode=mode, kind="incremental", dimensions=not loaded)
        loaded.append(epoch_id)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
