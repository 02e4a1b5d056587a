import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import rows
from riskloom.functions.risk import risk_band, risk_factors
from riskloom.operators import models, prepare as prep, score
from riskloom.plans import dashboard, data_quality, modelling
from riskloom.sources import synth
from riskloom.sources.tables import cached, read_csv
from riskloom.spec import STUDENTS, RoleSpec, normalise
from riskloom.streaming.scoring import read_stream, score_stream


@pytest.fixture(scope="module")
def quality(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("students"))
    return data_quality.students(spark, 1500, folder=folder), folder


@pytest.fixture(scope="module")
def trained(quality):
    return modelling.train(quality[0].cleaned.table, STUDENTS, depth=10)


def test_generated_table_has_the_published_shape(quality):
    done = quality[0]
    raw = done.raw
    assert raw.count() == 1500 and raw.filter("evadiu = 1").count() == 450
    nulls = raw.select([F.count_if(F.col(c).isNull()).alias(c) for c in raw.columns]).first().asDict()
    assert {c: n for c, n in nulls.items() if n} == {c: 45 for c in STUDENTS.numeric}
    summary = {r["item"]: (r["column"], r["value"]) for r in done.summary.collect()}
    assert summary["missing"] == (None, 225.0) and summary["positive rate"][1] == pytest.approx(30.0)
    top = {summary[f"correlation {i}"][0]: summary[f"correlation {i}"][1] for i in (1, 2, 3)}
    assert top["faltas"] == pytest.approx(0.73, abs=0.03)
    assert top["cr"] == pytest.approx(-0.73, abs=0.03)
    assert top["reprovacoes"] == pytest.approx(0.53, abs=0.06)
    assert 110 <= summary["outliers"][1] <= 170


def test_clean_ranges(quality):
    done = quality[0].cleaned.table
    lo_hi = done.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in STUDENTS.numeric for f in (F.min, F.max)]).first()
    assert (lo_hi["min_periodo"], lo_hi["max_periodo"]) == (1, 8)
    assert lo_hi["min_cr"] >= 2.0 and lo_hi["max_cr"] <= 10.0
    assert lo_hi["max_faltas"] <= 30 and lo_hi["max_reprovacoes"] <= 6
    assert lo_hi["min_idade"] >= 17 and lo_hi["max_idade"] <= 45
    assert dict(done.dtypes)["faltas"] == "int" and dict(done.dtypes)["cr"] == "double"


def test_csv_files_hold_the_same_tables(spark, quality):
    done, folder = quality
    assert rows(read_csv(spark, f"{folder}/alunos").drop("nome")) == rows(done.raw.drop("nome"))
    clean = done.cleaned.table
    assert rows(read_csv(spark, f"{folder}/alunos_limpo", clean.schema), "id_aluno", "cr") == rows(clean, "id_aluno", "cr")
    assert read_csv(spark, f"{folder}/dicionario_dados", done.dictionary.schema).count() == 10


def test_generation_does_not_depend_on_partitions(spark):
    ids = synth.student_ids(spark, 300)
    assert rows(synth.raw_students(ids.repartition(7))) == rows(synth.raw_students(ids.coalesce(1)))


def test_inject_nulls_counts(spark):
    df = spark.range(1000).select("id", F.lit(1.0).alias("a"), F.lit("t").alias("b"))
    got = synth.inject_nulls(df, "id", ["a", "b"], 0.1).agg(F.count("a"), F.count("b")).first()
    assert tuple(got) == (900, 900)
    assert synth.inject_nulls(df, "id", ["a"], 0.0).filter("a is null").count() == 0
    loose = synth.inject_nulls(df, "id", ["a"], 0.1, exact=False).filter("a is null").count()
    assert 50 < loose < 150


def test_draws_follow_their_distributions(spark):
    d = synth.students(synth.student_ids(spark, 40000))
    got = {r["evadiu"]: r for r in d.groupBy("evadiu").agg(
        F.avg("cr").alias("cr"), F.avg("faltas").alias("f"), F.avg("reprovacoes").alias("r"),
        F.avg((F.col("situacao_financeira") == "estavel").cast("int")).alias("e"),
        F.avg("idade").alias("i")).collect()}
    assert got[1]["cr"] == pytest.approx(4.2, abs=0.05) and got[0]["cr"] == pytest.approx(6.5, abs=0.05)
    assert got[1]["r"] == pytest.approx(2.2, abs=0.05) and got[0]["r"] == pytest.approx(0.68, abs=0.03)
    assert got[1]["e"] == pytest.approx(0.10, abs=0.01) and got[0]["e"] == pytest.approx(0.386, abs=0.01)
    assert got[0]["f"] == pytest.approx(1.5 * 3.3 - 0.5, abs=0.15)
    assert got[0]["i"] == pytest.approx(17 + 28 * 0.25 - 0.5, abs=0.15)


def test_prepared_shape_and_names(trained):
    ready = trained.prepared
    assert (ready.train.count(), ready.test.count()) == (1200, 300)
    assert rows(ready.test.groupBy("label").count()) == [(0.0, 210), (1.0, 90)]
    assert ready.names[:5] == list(STUDENTS.numeric) and len(ready.names) == 13
    assert ready.names[5] == "curso_Administração" and ready.names[-1] == "situacao_financeira_intermediaria"
    z = np.array([r[0] for r in ready.train.select(vector_to_array("features")).collect()])
    assert np.allclose(z[:, :5].mean(0), 0) and np.allclose(z[:, :5].std(0), 1)
    assert np.allclose(z[:, 5:10].sum(1), 1) and np.allclose(z[:, 10:].sum(1), 1)


def test_unseen_and_null_categories_are_zero(spark, trained):
    df = spark.createDataFrame([(1, 5.0, 3.0, 0.0, 20.0, "zzz", None)],
                               "periodo int, cr double, faltas double, reprovacoes double, idade double, "
                               "curso string, situacao_financeira string")
    v = trained.prepared.model.transform(df).select(vector_to_array("features")).first()[0]
    assert v[5:] == [0.0] * 8 and any(v[:5])


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert rows(prep.standardise(df, prep.scale_stats(df, ["x"]))) == [(0.0,), (0.0,)]


def test_label_encoder(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "k string")
    fitted = prep.label_encoder(df, ["k"])
    assert rows(fitted.transform(df).distinct()) == [("a", 0.0), ("b", 1.0), ("c", 2.0)]
    with pytest.raises(Exception, match="unknown value new"):
        fitted.transform(spark.createDataFrame([("new",)], "k string")).collect()


def test_one_hot_columns(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    known = prep.categories(df, ["k"])
    assert known == {"k": ["a", "b"]}
    unseen = df.unionByName(spark.createDataFrame([("zz",)], "k string"))
    assert rows(prep.one_hot(unseen, known)) == [(0, 0), (0, 0), (0, 1), (1, 0)]


def test_logistic_regression_solves_the_penalised_problem(trained):
    """The gradient of sum-loss + |w|^2 / 2 vanishes at the fitted coefficients."""
    logistic = trained.scorers[models.LOGISTIC].stages[-1]
    got = trained.prepared.train.select(vector_to_array("features"), "label").collect()
    x, y = np.array([r[0] for r in got]), np.array([r[1] for r in got])
    w, b = logistic.coefficients.toArray(), logistic.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-3
    assert abs((p - y).sum()) < 1e-3


def test_model_quality(trained):
    got = {(r["model"], r["metric"]): r["value"] for r in trained.metrics.collect()}
    for name in (models.LOGISTIC, models.FOREST):
        assert got[name, "Acurácia"] > 0.90 and got[name, "ROC-AUC"] > 0.90
    assert trained.confusion.groupBy("model").agg(F.sum("n")).first()[1] == 300
    assert trained.roc.filter(F.col("model") == models.LOGISTIC).count() >= 3
    assert trained.best.first()["model"] in (models.LOGISTIC, models.FOREST)


def test_importances_and_coefficients(trained):
    imp = trained.importances
    assert imp.count() == 13 and imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    top = models.top_importances(imp, 3).orderBy("place").collect()
    assert [r["feature"] for r in top] == ["cr", "faltas", "reprovacoes"]
    assert top[0]["bar"] == "#" * int(top[0]["importance"] * 50)
    assert models.flag_importances(imp).filter("strong").count() == 4
    coef = {r["feature"]: r["effect"] for r in trained.coefficients.collect()}
    assert len(coef) == 13 and coef["cr"] == "lowers" and coef["faltas"] == "raises"


SCENARIOS = [
    (1, 3.0, 30, 4, 18, "Direito", "dificuldade", "alto"),
    (6, 8.5, 1, 0, 24, "Medicina", "estavel", "baixo"),
    (3, 5.5, 10, 1, 21, "Administração", "intermediaria", "medio"),
]
FORM = ("periodo int, cr double, faltas int, reprovacoes int, idade int, curso string, "
        "situacao_financeira string, espera string")


def test_scenarios(spark, trained):
    df = spark.createDataFrame(SCENARIOS, FORM)
    scored = score.score(df, trained.scorers[models.LOGISTIC], models.LOGISTIC)
    got = {r["espera"]: r for r in score.check_scenarios(scored).collect()}
    assert got["alto"]["verdict"] == "consistente" and got["alto"]["pred"] == 1
    assert got["baixo"]["verdict"] == "consistente" and got["baixo"]["pred"] == 0
    assert [f["level"] for f in got["alto"]["factors"]] == ["vermelho"] * 4
    assert got["baixo"]["factors"] == []
    assert got["alto"]["delta"] == pytest.approx(got["alto"]["prob"] - 30)
    assert set(df.columns) <= set(scored.columns)


def test_band_limits(spark):
    df = spark.createDataFrame([(60.0,), (59.99,), (35.0,), (34.99,), (None,)], "p double")
    assert [r[0] for r in df.select(risk_band(F.col("p"))).collect()] == ["alto", "medio", "medio", "baixo", None]


def test_factor_limits(spark):
    data = [(5.0, 15, 0, "estavel"), (6.5, 16, 1, "intermediaria"), (4.9, 8, 3, "dificuldade"), (None, 9, 2, None)]
    df = spark.createDataFrame(data, "cr double, faltas int, reprovacoes int, situacao_financeira string")
    got = df.select(F.concat_ws("|", F.transform(risk_factors(), lambda f: f["code"])), risk_factors()[0]["message"])
    assert [tuple(r) for r in got.collect()] == [
        ("cr_abaixo_da_media|faltas_acima_da_media", "CR abaixo da média (5.0)"),
        ("faltas_altas|possui_reprovacoes|financeira_intermediaria", "Alto número de faltas (16)"),
        ("cr_muito_baixo|reprovacoes_criticas|financeira_dificuldade", "CR muito baixo (4.9 < 5.0)"),
        ("faltas_acima_da_media|possui_reprovacoes", "Faltas acima da média (9)"),
    ]


def test_save_load_and_load_or_fit(spark, quality, trained, tmp_path):
    calls = []

    def table():
        calls.append(1)
        return quality[0].cleaned.table

    for _ in range(2):
        loaded = modelling.scorers(table, STUDENTS, str(tmp_path), depth=3)
    assert len(calls) == 1
    df = spark.createDataFrame(SCENARIOS, FORM)
    for name in loaded:
        assert score.with_probability(df, loaded[name]).count() == 3
    same = [r["prob"] for r in score.with_probability(df, loaded[models.LOGISTIC]).collect()]
    want = [r["prob"] for r in score.with_probability(df, trained.scorers[models.LOGISTIC]).collect()]
    assert same == pytest.approx(want, abs=1e-6)


def test_load_or_fit_does_not_hide_other_errors(spark, tmp_path):
    path = tmp_path / "m"
    (path / "metadata").mkdir(parents=True)
    (path / "metadata" / "part-00000").write_text("not json\n")
    with pytest.raises(Exception):
        models.load_or_fit(str(path), lambda: pytest.fail("must not fit"))


def test_legacy(spark, quality):
    raw = quality[0].raw
    done = modelling.train_legacy(raw, STUDENTS, trees=30, depth=8)
    got = {r["row"]: r["f1"] for r in done.report.collect()}
    assert got["accuracy"] > 0.9
    assert done.confusion.agg(F.sum("n")).first()[0] == 300
    scored = score.legacy_score(raw.drop("evadiu"), done.model)
    assert dict(scored.dtypes)["evadiu"] == "boolean"
    assert scored.filter("probabilidade_evasao < 0 or probabilidade_evasao > 100").count() == 0


def test_stream_equals_batch(spark, quality, trained, tmp_path):
    clean = quality[0].cleaned.table
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    model = trained.scorers[models.LOGISTIC]

    def transform(df):
        return score.score(df, model, models.LOGISTIC).select("id_aluno", "prob", "band")

    clean.repartition(3).write.parquet(source)
    score_stream(read_stream(spark, source, clean.schema), transform, out, str(tmp_path / "log")).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(transform(clean))
    # a restart with one more file scores only that file
    clean.limit(10).write.mode("append").parquet(source)
    score_stream(read_stream(spark, source, clean.schema), transform, out, str(tmp_path / "log")).awaitTermination()
    assert spark.read.parquet(out).count() == 1510


def test_dashboard_tables(quality):
    clean = quality[0].cleaned.table
    for choice in ("Todos", "Direito"):
        made = dashboard.tables(clean, choice)
        total = made["kpis"].first()["total"]
        assert made["scatter"].count() == total == made["density"].agg(F.sum("n")).first()[0]
        assert made["at_risk"].count() == made["kpis"].first()["positives"]
        assert made["rate_by_curso"].count() == 5 and made["choices"].count() == 5
        assert made["box_outliers"].count() == made["box"].agg(F.sum("outliers")).first()[0]
    assert normalise(clean).columns == clean.columns


def test_model_tab(trained):
    made = dashboard.model_tables(trained, 3)
    assert {n: made[n].count() for n in ("metrics", "best", "confusion", "report", "importances", "top_importances", "coefficients")} == {
        "metrics": 10, "best": 1, "confusion": 8, "report": 10, "importances": 13, "top_importances": 3, "coefficients": 13}
    assert made["roc"].count() > 4


def test_missing_values_do_not_end_fits_or_scoring(spark, quality, trained):
    raw = quality[0].raw
    odd = raw.withColumns({
        "cr": F.when(F.col("id_aluno") % 50 == 0, float("nan")).otherwise(F.col("cr")),
        "curso": F.when(F.col("id_aluno") % 70 == 0, None).otherwise(F.col("curso"))})
    done = modelling.train_legacy(odd, STUDENTS, trees=5, depth=4)
    assert score.legacy_score(odd, done.model).filter("probabilidade_evasao is null").count() == 0
    unseen = odd.limit(3).withColumn("curso", F.lit("zzz"))
    assert score.legacy_score(unseen, done.model).count() == 3
    scored = score.score(odd, trained.scorers[models.LOGISTIC], models.LOGISTIC)
    assert scored.count() == 1500 and scored.filter("prob is null or isnan(prob)").count() == 0


def test_a_missing_value_counts_as_the_mean(spark, trained):
    mean = trained.prepared.model.transform(spark.createDataFrame(
        [(None, float("nan"), None, None, None, None, None)],
        "periodo int, cr double, faltas double, reprovacoes double, idade double, curso string, "
        "situacao_financeira string")).select(vector_to_array("features")).first()[0]
    assert mean == [0.0] * 13


def test_too_many_categories_are_an_error(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("x"))
    for call in (lambda: prep.categories(df, ["k"]), lambda: prep.scale_stats(df, ["x"], ["k"])):
        with pytest.raises(prep.TooManyCategories):
            call()
    assert prep.label_encoder(df, ["k"]).transform(df).agg(F.max("k_enc")).first()[0] == 2999


def test_cached_reads_once(spark, quality):
    held = cached(quality[0].cleaned.table)
    assert held.is_cached and held.count() == held.count() == 1500
    held.unpersist()


def gini_by_hand(tree, size):
    """Summed gain of each feature in one tree: what its splits take from the rows' impurity."""
    total = np.zeros(size)

    def impurity(node):
        counts = np.array([node.impurityStats().stats()[i] for i in range(2)])
        return 1.0 - ((counts / counts.sum()) ** 2).sum(), counts.sum()

    def walk(node):
        if node.subtreeDepth() == 0:
            return
        here, n = impurity(node)
        (left, a), (right, b) = impurity(node.leftChild()), impurity(node.rightChild())
        total[node.split().featureIndex()] += n * here - a * left - b * right
        walk(node.leftChild())
        walk(node.rightChild())

    walk(tree._call_java("rootNode"))
    return total / total.sum() if total.sum() else total


def test_importances_are_the_gains_of_the_splits(spark):
    """A second way to the numbers, from the nodes of the grown trees, at the default depth."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.3, 300) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "label"])
    forest = models.fit_forest(df, trees=8)
    want = sum(gini_by_hand(t, 4) for t in forest.trees)
    assert forest.featureImportances.toArray() == pytest.approx(want / want.sum(), abs=1e-9)
    nodes = models.tree_nodes(forest)
    got = dict(rows(models.gains(nodes)))
    assert [got.get(i, 0.0) for i in range(4)] == pytest.approx(want / want.sum(), abs=1e-9)
    assert nodes.count() == forest.totalNumNodes
    assert forest.transform(df).filter("prediction = label").count() >= 290


def test_a_forest_that_cannot_split_has_no_gains(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), float(i % 2)) for i in range(20)], ["features", "label"])
    nodes = models.tree_nodes(models.fit_forest(df, trees=3))
    assert rows(nodes, "tree", "node", "feature", "threshold", "left", "right") == [(i, 0, None, None, None, None) for i in range(3)]
    assert models.gains(nodes).count() == 0


def test_legacy_forest_of_many_categories(spark):
    """More values than the usual number of bins."""
    data = [(i, float(i % 9), f"k{i % 400}", int(i % 400 < 120)) for i in range(1200)]
    df = spark.createDataFrame(data, "id long, x double, k string, y int")
    spec = RoleSpec(id="id", target="y", numeric=("x",), categorical=("k",))
    model = models.fit_legacy(df.withColumn("label", F.col("y").cast("double")), spec, trees=5)
    assert model.transform(df).filter("prediction = y").count() > 1000
