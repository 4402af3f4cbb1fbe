"""Leaders of keys: a group that shares many keys meets a few leaders in all of them."""

import numpy as np
from pyspark.sql import functions as F

from florametrics.llm.linking import link


def test_a_group_of_many_keys_meets_few_leaders(spark):
    """200 ids in 32 keys of mostly equal values: two leaders per key would be some 28 pairs an id."""
    rng = np.random.default_rng(7)
    same = rng.random((200, 32)) < 0.6
    rows = spark.createDataFrame([(int(k if same[i, k] else 1000 + 40 * i + k), i) for i in range(200) for k in range(32)], "key long, id long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    bits = spark.range(200).select("id", F.lit(b"\0" * 8).alias("bits"))
    found = link(rows, verify, bits, 64)
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(1, 200)}
    assert seen[0] < 200 * 16
