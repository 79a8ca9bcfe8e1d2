"""The similarity join's residual buckets, and what its written tables leave behind."""

import glob
import random
import time
from collections import defaultdict

from pyspark.sql import functions as F

from kestrel.llm import jaccard
from kestrel.llm.common import saved

SCHEMA = "bucket bigint, id bigint, label bigint"


def test_buckets_with_much_the_same_members_become_few(spark):
    rng = random.Random(3)
    before = {100 * group + b: set(rng.sample(range(1000 * group, 1000 * group + 40), 25)) for group in range(3) for b in range(60)}
    rows = [(b, i, i) for b, ids in before.items() for i in ids]
    after = defaultdict(set)
    for r in jaccard._merged(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.label == r.id and r.id not in after[r.bucket]
        after[r.bucket].add(r.id)
    assert all(any(ids <= new for new in after.values()) for ids in before.values())
    assert all(len({i // 1000 for i in ids}) == 1 for ids in after.values())
    assert sum(map(len, after.values())) < len(rows) / 10


def test_buckets_that_share_only_one_member_stay(spark):
    rows = [(b, i, i) for b in range(20) for i in [0, *range(1 + 200 * b, 201 + 200 * b)]]
    got = jaccard._merged(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == rows


def test_a_written_table_leaves_no_shuffle_files(spark):
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for d in disks.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}

    before = files()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    table = saved(spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 999).alias("k")).agg(F.sum("id").alias("s")), "shuffled")
    until = time.time() + 20  # files are removed in the background
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == setting
    assert table.count() == 999
