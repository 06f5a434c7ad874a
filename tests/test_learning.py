import itertools
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.operators import explain, features, model, runs
from sensorloom.schemas import VIBRATION_COLUMNS
from sensorloom.session import scratch
from sensorloom.workload import frames


@pytest.fixture(scope="module")
def trained(spark):
    from conftest import SF

    df = frames.features(spark, SF)
    return model.train(df, VIBRATION_COLUMNS, "status", "damaged", depths=(3, 5), folds=2), df


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000).withColumn("id", F.when(F.col("id") == 9, None).otherwise(F.col("id")))
    train, test = features.split(df, [0.7, 0.3], 42, "id")
    assert train.count() + test.count() == 5000 and 3300 < train.count() < 3700
    assert train.intersect(test).count() == 0
    assert rows(features.split(df.repartition(11), [0.7, 0.3], 42, "id")[0]) == rows(train)
    a, b, c = features.split(df, [1, 1, 2], 1)
    assert a.count() + b.count() + c.count() == 5000


def test_keyed_sample_is_stable(spark):
    df = spark.range(20000)
    some = features.sample(df, 0.1, 3, "id")
    assert 1800 < some.count() < 2200 and rows(some) == rows(features.sample(df.repartition(5), 0.1, 3, "id"))
    assert features.sample(df, 0.1, 3).count() > 1500


def test_balance_caps_every_class(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 30 == 0, "rare").when(F.col("id") % 3 == 0, "mid")
                                  .otherwise("hot").alias("c"), (F.col("id") % 7).alias("w"))
    for order in (None, ["w", "id"]):
        out = features.balance(df, "c", 500, ["hot", "rare"], order)
        assert rows(out.groupBy("c").count()) == [("hot", 500), ("rare", 100)]
        assert out.distinct().count() == 600 and out.join(df, df.columns, "left_anti").count() == 0
    ordered = features.balance(df, "c", 10, order=["w", "id"]).where("c = 'hot'")
    expected = df.where("c = 'hot'").orderBy("w", "id").limit(10)
    assert rows(ordered) == rows(expected)
    assert rows(features.balance_any(df, "c", 500, ["hot", "rare"]).groupBy("c").count()) == [("hot", 500), ("rare", 100)]


def test_balance_with_many_copies_of_one_row(spark):
    copies = spark.range(2000).select(F.lit(1).alias("v"), F.lit("hot").alias("c"))
    others = spark.range(50).select((F.col("id") + 2).cast("int").alias("v"), F.lit("hot").alias("c"))
    df = copies.union(others)
    assert features.balance(df, "c", 300).count() == 300
    assert features.balance(df, "c", 5000).count() == 2050
    assert features.balance(df, "c", 2049).count() == 2049


def test_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s STRING")
    out, names = features.label_index(df, "s")
    assert names == ["a", "b"] and rows(out) == [("a", 0.0), ("a", 0.0), ("b", 1.0)]
    tie, names = features.label_index(df.where("s = 'b'").union(df.limit(1)), "s")
    assert names == ["a", "b"]
    named, names = features.label_index(df, "s", positive="a")
    assert names[1] == "a" and rows(named) == sorted([("a", 1.0), ("a", 1.0), ("b", 0.0), (None, None)], key=repr)


def test_null_features_fail_skip_or_pass(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 9.0)], "a DOUBLE, b DOUBLE")
    with pytest.raises(Exception):
        features.feature_stages(["a", "b"]).fit(df).transform(df).collect()
    assert features.feature_stages(["a", "b"], handle_invalid="skip").fit(df).transform(df).count() == 2


def test_metrics_on_known_pairs(spark):
    pairs = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 1 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 4
    pred = spark.createDataFrame(pairs, "label DOUBLE, prediction DOUBLE")
    m = model.class_metrics(pred).first()
    assert (m["precision"], m["recall"]) == (0.6, 0.75) and m["f1"] == pytest.approx(2 / 3)
    assert m["weighted_f1"] == pytest.approx((4 * 2 / 3 + 6 * 8 / 11) / 10)
    assert rows(model.confusion(pred)) == [(0.0, 0.0, 4), (0.0, 1.0, 2), (1.0, 0.0, 1), (1.0, 1.0, 3)]
    assert rows(model.confusion_matrix(pred, [0, 1])) == [(0.0, 4, 2), (1.0, 1, 3)]
    never = pred.withColumn("prediction", F.lit(0.0))
    m = model.class_metrics(never).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)
    scores = spark.createDataFrame([(1.0, 0.9), (1.0, 0.5), (0.0, 0.5), (0.0, 0.1)], "label DOUBLE, s DOUBLE")
    assert model.auroc(scores, score="s") == pytest.approx(3.5 / 4)


def test_scorer_needs_no_label(trained):
    fitted, df = trained
    assert set(fitted.search) == {3, 5} and fitted.labels[1] == "damaged"
    scored = model.score(fitted.scorer, df.drop("status"), ["vec_id"])
    assert scored.columns == ["vec_id", "prediction"] and scored.count() == df.count()
    assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_shapley_values_add_up_to_the_margin(spark, trained):
    fitted, df = trained
    scored = model.score(fitted.scorer, df)
    values = explain.shap(fitted.classifier, scored, VIBRATION_COLUMNS, ["vec_id", "rawPrediction"], dtype="double")
    base = explain.leaves(spark, fitted.classifier, 8).base
    total = sum((F.col(f"{c}_shap_value") for c in VIBRATION_COLUMNS), F.lit(base))
    worst = values.select(F.max(F.abs(total - vector_to_array("rawPrediction")[1]))).first()[0]
    assert worst < 1e-9
    floats = explain.shap(fitted.classifier, scored, VIBRATION_COLUMNS)
    assert floats.columns == [f"{c}_shap_value" for c in VIBRATION_COLUMNS]
    assert {f.dataType.simpleString() for f in floats.schema.fields} == {"float"}


def test_shapley_values_equal_the_definition():
    """Against the sum over all subsets of features, on random boxes."""
    rng = np.random.default_rng(1)
    n, f = 12, 4
    low = np.where(rng.random((n, f)) < 0.5, -np.inf, rng.normal(size=(n, f)))
    high = np.where(rng.random((n, f)) < 0.5, np.inf, low + 1)
    high = np.where(np.isinf(low) & np.isfinite(high), 0.3, high)
    share = np.where(np.isinf(low) & np.isinf(high), 1.0, rng.uniform(0.1, 0.9, (n, f)))
    table = explain.Leaves(rng.normal(size=n), low, high, share)
    x = rng.normal(size=(7, f))
    x[3, 1] = np.nan

    def worth(row, known):
        total = 0.0
        for leaf in range(n):
            p = table.value[leaf]
            for j in range(f):
                inside = not row[j] <= low[leaf, j] and (row[j] <= high[leaf, j] or np.isinf(high[leaf, j]))
                p *= float(inside) if j in known else share[leaf, j]
            total += p
        return total

    expected = np.zeros((len(x), f))
    for r, row in enumerate(x):
        for i in range(f):
            others = [j for j in range(f) if j != i]
            for size in range(f):
                weight = math.factorial(size) * math.factorial(f - size - 1) / math.factorial(f)
                for known in itertools.combinations(others, size):
                    expected[r, i] += weight * (worth(row, {*known, i}) - worth(row, set(known)))
    assert np.allclose(explain.shapley_values(x, table), expected, atol=1e-12)


def test_summaries_of_values(spark, trained):
    fitted, df = trained
    scored = model.score(fitted.scorer, df)
    values = explain.shap(fitted.classifier, scored, VIBRATION_COLUMNS, ["vec_id", *VIBRATION_COLUMNS]).cache()
    top = explain.mean_abs(values, 6).collect()
    assert len(top) == 6 and [r[1] for r in top] == sorted((r[1] for r in top), reverse=True)
    one = explain.row(values, "vec_id", 3).collect()
    assert len(one) == 8 and abs(one[0]["shap_value"]) >= abs(one[-1]["shap_value"])
    curve = explain.dependence(values, "AN3", "AN9", bins=3)
    assert curve.agg(F.sum("n")).first()[0] == df.count() and curve.count() <= 9
    weights = explain.importances(spark, fitted.classifier, VIBRATION_COLUMNS).collect()
    assert sum(r["weight"] for r in weights) == pytest.approx(1.0)
    assert [r["weight"] for r in weights] == sorted((r["weight"] for r in weights), reverse=True)


def test_dependence_bins(spark):
    df = spark.createDataFrame([(float(i) if i < 10 else None, float(i)) for i in range(11)], "f DOUBLE, f_shap_value DOUBLE")
    for how in ("quantile", "width"):
        out = explain.dependence(df, "f", bins=5, how=how).orderBy("bin").collect()
        assert [r["n"] for r in out] == [1, 2, 2, 2, 2, 2], how
    flat = explain.dependence(df.withColumn("f", F.lit(1.0)), "f", bins=5, how="width")
    assert [r["bin"] for r in flat.collect()] == [0]


def test_runs_versions_and_stages(spark, trained):
    fitted, df = trained
    root = scratch(spark, "runs")
    runs.log(spark, root, "gbt", {"AUROC": 0.7}, scorer=fitted.scorer, source="gold")
    runs.log(spark, root, "gbt", {"AUROC": 0.9, "f1": float("nan")}, scorer=fitted.scorer)
    runs.log(spark, root, "gbt", {"AUROC": 0.99}, status="FAILED")
    runs.log(spark, root, "other", {"AUROC": 0.95})
    runs.log(spark, root, "gbt", {"f1": 1.0})
    best = runs.best(spark, root, "gbt", "AUROC").first()
    assert best["metric"] == 0.9
    with pytest.raises(ValueError):
        runs.load_production(spark, root, "gbt")
    assert runs.register(spark, root, best) == 1 and runs.register(spark, root, best) == 2
    runs.promote(spark, root, "gbt", 1)
    runs.promote(spark, root, "gbt", 2)
    stages = runs.versions(spark, root, "gbt").select("version", "stage")
    assert rows(stages) == [(1, "Archived"), (2, "Production")]
    with pytest.raises(ValueError):
        runs.promote(spark, root, "gbt", 7)
    scorer = runs.load_production(spark, root, "gbt")
    assert rows(model.score(scorer, df, ["vec_id"])) == rows(model.score(fitted.scorer, df, ["vec_id"]))


def test_balance_ends_on_null_labels(spark):
    df = spark.range(200).withColumn("label", F.when(F.col("id") % 4 != 0, F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))))
    sizes = {r.label: r["count"] for r in features.balance(df, "label", 10).groupBy("label").count().collect()}
    assert sizes == {None: 10, "c1": 10, "c2": 10, "c3": 10}


def test_quantile_edges_are_exact(spark):
    df = spark.range(30_001).select((F.col("id") * 7919 % 30_001).cast("double").alias("v"))
    assert explain.exact_quantiles(df, "v", [(1, 4), (1, 2), (3, 4)]) == [7500.0, 15000.0, 22500.0]
    assert explain.exact_quantiles(df.limit(0), "v", [(1, 2)]) == [None]


def _shuffled_rows(df):
    """Rows that the exchanges of an executed plan wrote."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total = max(total, node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("kind", ["bigint", "double", "timestamp", "date", "string"])
def test_cut_off_keeps_exactly_the_first_rows(spark, kind):
    rows_ = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 9, "b").when(F.col("id") % 1000 == 9, F.lit(None)).otherwise("c").alias("g"),
        F.when(F.col("id") % 997 == 0, None).otherwise(F.xxhash64("id") % 100_000).alias("x"), "id")
    x = {"timestamp": F.timestamp_seconds("x"), "date": F.date_from_unix_date(F.col("x").cast("int")),
         "string": F.format_string("%08d", F.col("x") + 100_000)}.get(kind, F.col("x").cast(kind if kind in ("bigint", "double") else "bigint"))
    df = rows_.withColumn("x", x)
    rank = F.row_number().over(Window.partitionBy("g").orderBy("x", "id"))
    want = df.withColumn("r", rank).where("r <= 300").drop("r")
    got = features.balance(df, "g", 300, order=["x", "id"])
    assert rows(got) == rows(want)
    near = features.within_cut_off(df, "g", "x", 300)
    if kind != "string":
        sizes = {r["g"]: r["count"] for r in near.groupBy("g").count().collect()}
        nulls = df.where("x IS NULL").groupBy("g").count().collect()
        held = {r["g"]: r["count"] for r in nulls}
        assert all(n - held.get(g, 0) <= 2.2 * 300 for g, n in sizes.items()), sizes
        got.write.format("noop").mode("overwrite").save()
        counted = features.first_per_group(near, "g", ["x", "id"], 300)
        counted.collect()
        assert _shuffled_rows(counted) <= 4 * 2.2 * 300 + len(held) * 100


def test_cut_off_with_ties_and_skew(spark):
    """Ties beyond any cut-off, one huge class beside tiny ones, and an order that starts with NULLs only."""
    df = spark.range(40_000).select((F.col("id") % 997 == 0).cast("int").alias("g"), F.lit(1).alias("tie"),
                                    F.lit(None).cast("double").alias("nothing"), "id")
    for first in ("tie", "nothing"):
        got = features.balance(df, "g", 25, order=[first, "id"])
        assert sorted((r["g"], r["id"]) for r in got.collect()) == [(0, i) for i in range(1, 26)] + [(1, 997 * i) for i in range(25)]
