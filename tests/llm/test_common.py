import glob
import time

from pyspark.sql import functions as F

from tierforge.llm.common import SHUFFLE_CLEANUP, discard, stored


def test_shuffle_files_go_when_the_table_is_stored(shipped):
    dirs = shipped._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}
    before, set_to = files(), shipped.conf.get(SHUFFLE_CLEANUP, None)
    table = stored(shipped.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    late = time.time() + 10
    while files() - before and time.time() < late:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 7 and shipped.conf.get(SHUFFLE_CLEANUP, None) == set_to
    discard(table)


def test_stored_tables_have_no_marker(shipped):
    table = stored(shipped.range(3).toDF("id"), "test")
    assert not glob.glob(f"{table.stored_at.removeprefix('file:')}/_SUCCESS") and table.count() == 3
    discard(table)
