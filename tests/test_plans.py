"""Plans that must not evaluate or scan anything twice."""
import pytest

from chatloom.operators import complete as C
from chatloom.operators import generate as G
from chatloom.plans.registry import QUERIES, load_all

from conftest import SF


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")


@pytest.mark.parametrize("name", ["recipe_nutrition_qa", "recipe_time_qa"])
def test_a_pair_of_messages_reads_the_chat_once(spark, name):
    load_all()
    assert scans(QUERIES[name](spark, SF)) == scans(QUERIES["assign_positions"](spark, SF))


def test_the_article_rounds_run_once(spark, monkeypatch):
    """Questions are read for their diversity and for their answers: the model is asked for the list once per article."""
    asked = spark.sparkContext.accumulator(0)
    import pandas as pd

    def fn(prompts, params):
        if params["max_tokens"] == 600:
            asked.add(len(prompts))
        return pd.Series([(params["options"][2] if params["options"] else "1. What?\n2. Why?") for _ in prompts])

    inputs = spark.createDataFrame([(i, f"article {i}") for i in range(7)], "id long, text string")
    rows = G.question_chat(inputs, C.BatchModel(fn, cache_answers=False)).collect()
    assert len(rows) == 28 and asked.value == 7
