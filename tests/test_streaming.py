"""Streams end with the same table as the batch."""

from pyspark.sql import functions as F

from barloom.operators.blocks import TIME
from barloom.sources import bars as src
from barloom.streaming import ingest


def same(a, b):
    columns = src.BARS_SCHEMA.names
    return a.select(*columns).exceptAll(b.select(*columns)).isEmpty() and b.select(*columns).exceptAll(a.select(*columns)).isEmpty()


def test_streamed_bars_equal_the_batch_and_survive_a_restart(spark, bars, scratch):
    hourly = bars.where("interval = '1h'").select(*src.BARS_SCHEMA.names)
    landing, path, progress = (scratch.path(n) for n in ("landing", "bars", "progress"))
    late = F.col(TIME) >= F.lit("2024-01-12").cast("timestamp")
    hourly.where(late).write.parquet(landing)

    def run(checkpoint):
        stream = spark.readStream.schema(hourly.schema).parquet(landing)
        ingest.ingest_bars(stream, path, checkpoint).awaitTermination()
        return src.read_bars(spark, path)

    assert same(run(progress), hourly.where(late))
    # A later file has older bars and repeats what is stored; a lost checkpoint replays everything.
    hourly.write.mode("append").parquet(landing)
    assert same(run(progress), hourly)
    assert same(run(scratch.path("other-progress")), hourly)


def test_tick_stream_emits_closed_bars_once_and_closes_the_rest(spark, sf_dir, scratch):
    from verification import fixtures as fx
    from verification.queries import QUERIES, _tick_stream

    path = scratch.path("bars")
    for _ in range(2):  # a restart finds nothing new
        ingest.ingest_ticks(_tick_stream(spark, sf_dir), path, scratch.path("progress")).awaitTermination()
    found, batch = src.read_bars(spark, path), QUERIES["bars_from_ticks"](spark, sf_dir)
    columns = src.BARS_SCHEMA.names
    assert found.count() == found.select("symbol", "interval", TIME).distinct().count() < batch.count()
    assert found.select(*columns).exceptAll(batch.select(*columns)).isEmpty()
    assert {r["interval"] for r in found.select("interval").distinct().collect()} == {"5m", "1h", "4h", "1d"}
    ingest.close_open_bars(fx.ticks(spark, sf_dir), path)
    assert same(src.read_bars(spark, path), batch)
