"""Results do not depend on how many shuffle partitions (and so rank/pack tasks) there are."""
import pytest

import __spark_entry__ as E

from conftest import SF

NAMES = ["train_test_split_exact", "pack_sequences", "round_robin", "near_duplicates", "parse_questions",
         "diverse_questions", "recipe_search"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_4_16_partitions(spark, name):
    q = E.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            df = q(spark, SF)
            results.append(sorted(tuple(str(v) for v in r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
