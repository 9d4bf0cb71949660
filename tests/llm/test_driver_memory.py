"""What the pipeline asks of the driver: arrays instead of lists of numbers, and short rounds of components."""

import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame as Frame

from riskloom.llm import components, toxicity


def test_fitting_collects_no_lists_of_features(spark, monkeypatch):
    words = ["vile rotten filth. good day", "good day sir. calm water", "rotten filth here", "calm day", "", None]
    docs = spark.createDataFrame([(k, words[k % 6]) for k in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 6 in (0, 2))) for k in range(120)], "doc_id long, toxic int")
    seen, collect = [], Frame.collect

    def spied(self):
        seen.extend(self.columns)
        return collect(self)

    monkeypatch.setattr(Frame, "collect", spied)
    model = toxicity.fit(docs, labels)
    assert "bags" not in seen
    monkeypatch.undo()

    train = toxicity.train_set(docs, labels).orderBy("id").collect()
    place = {f: i for i, f in enumerate(model.weights)}
    bags = [(*toxicity._bags(r.text, place), r.toxic) for r in train]
    weights, bias = toxicity.fit_noisy_or(sorted(bags, key=lambda b: 0), len(place))
    assert model.bias == pytest.approx(bias)
    assert list(model.weights.values()) == pytest.approx(list(weights))
    assert model.score("rotten filth") > 0.5 > model.score("calm day")


def test_a_round_of_components_shuffles_five_times_at_most(spark, tmp_path):
    links = spark.createDataFrame([(k, k - 1) for k in range(1, 50)], "u long, v long")
    links.write.parquet(str(tmp_path / "links"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = components._small_star(components._large_star(spark.read.parquet(str(tmp_path / "links"))))
        one.collect()
        plan = one._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        ran = [line for line in plan.splitlines() if re.search(r"\bExchange hash", line) and "Reused" not in line]
        assert len(ran) <= 5, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
