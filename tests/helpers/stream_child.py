"""Child process for the hard-kill test: replicate a landed feed slowly
(one file per batch, a pause after each batch) until killed."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(
    os.path.abspath(__file__)))))

from keelson.plans import feeds  # noqa: E402
from keelson.session import get_session  # noqa: E402
from keelson.sinks.target import FileTarget  # noqa: E402
from keelson.streaming.replicate import replicate  # noqa: E402
from test_stream import FEED, SCHEMA  # noqa: E402


class Slow(FileTarget):
    def write_batch(self, df, batch_id, system_id=None, run="direct"):
        super().write_batch(df, batch_id, system_id, run)
        time.sleep(1.5)


def main():
    feed, target_path, ckpt, ckdir = sys.argv[1:5]
    spark = get_session("child", master="local[2]", conf={
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
    spark.sparkContext.setCheckpointDir(ckdir)
    t = Slow(spark, target_path, ["id"], SCHEMA)
    t.seed(feeds.employee_base(spark, "/root/testdata/sf0.001"))
    s = (spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(feed))
    q = replicate(s, t, ["id"], checkpoint=ckpt, trigger={"availableNow": True})
    q.awaitTermination()


if __name__ == "__main__":
    main()
