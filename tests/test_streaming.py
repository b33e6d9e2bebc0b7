import navlib as nl
from navlib.sources import fixtures as fx
from navlib.sources.store import scratch_path
from navlib.streaming import follow_landing


def test_landing_folder_ingest_is_idempotent(spark, sf_small):
    landing = scratch_path(spark, "landing")
    nav_path = scratch_path(spark, "nav")
    lines = fx.feed_lines(spark, sf_small)
    lines.coalesce(2).write.mode("overwrite").text(landing + "/day1")
    expected = nl.parse_nav_text(spark.read.text(landing + "/day1")).count()
    ck = scratch_path(spark, "ck")
    q = follow_landing(spark, landing + "/day1", nav_path, checkpoint_location=ck)
    q.awaitTermination(300)
    assert nl.read_table(spark, nav_path).count() == expected
    # same files again under a new checkpoint: rows are already stored
    q2 = follow_landing(spark, landing + "/day1", nav_path, checkpoint_location=scratch_path(spark, "ck2"))
    q2.awaitTermination(300)
    assert nl.read_table(spark, nav_path).count() == expected
