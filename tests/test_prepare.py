"""Conversion, cleaning, scaling, encoding and feature construction on hand-checked tables."""

import math
import re
from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.functions.steps import ColumnStep
from millrace.operators import clean, convert, encode, engineer, scale
from millrace.sources import generate, tables

NAN = float("nan")


def values(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        (1, 1.0, "a", "1.5", True),
        (2, NAN, "b", " 2 ", None),
        (3, None, None, "x", False),
        (4, 4.0, "b", None, True),
        (5, 100.0, "b", "3d", None),
    ]
    return spark.createDataFrame(rows, "id bigint, x double, c string, s string, f boolean")


def test_kinds_and_groups(dirty, spark):
    wide = spark.range(30).selectExpr("concat('t', id) AS text", "CAST(id % 3 AS STRING) AS cat", "id % 2 = 0 AS flag", "current_date() AS day")
    assert convert.column_kinds(wide) == {"text": "text", "cat": "categorical", "flag": "boolean", "day": "datetime"}
    assert convert.group_candidates(wide) == ["cat", "flag", "day"]
    assert convert.select_kind(dirty, "numeric", "boolean").columns == ["id", "x", "f"]


def test_to_numeric_modes(dirty):
    assert values(convert.to_numeric(dirty, ["s"]).transform(dirty), "s") == [1.5, 2.0, None, None, None]
    assert values(convert.to_numeric(dirty, ["s"], "ignore").transform(dirty), "s")[2] == "x"
    with pytest.raises(Exception):
        convert.to_numeric(dirty, ["s"], "raise").transform(dirty).collect()


def test_parse_boolean_needs_every_value(spark):
    df = spark.createDataFrame([(1, "Yes", "1", 1.0, 2.0), (2, "no ", "maybe", None, 0.0)], "id int, a string, b string, c double, d double")
    out = convert.parse_boolean(df, ["a", "b", "c", "d"]).transform(df)
    assert values(out, "a") == [True, False]
    assert values(out, "b") == ["1", "maybe"]
    assert values(out, "c") == [True, None]
    assert values(out, "d") == [2.0, 0.0]


def test_codes_and_labels(dirty):
    assert values(convert.category_codes(dirty, ["c"]), "c") == [0, 1, -1, 1, 1]
    assert values(encode.label_encode(dirty, ["c"]), "c") == [0, 1, 2, 1, 1]
    assert values(encode.label_step(dirty, ["c"]).transform(dirty), "c") == [0.0, 1.0, 2.0, 1.0, 1.0]


def test_category_codes_large_path(dirty, monkeypatch):
    from millrace.operators import ordered

    monkeypatch.setattr(ordered, "SMALL_VALUES", 1)
    assert values(convert.category_codes(dirty, ["c"]), "c") == [0, 1, -1, 1, 1]


def test_missing_counts_nan(dirty):
    info = {r["column"]: r for r in clean.missing_info(dirty).collect()}
    assert info["x"]["missing_count"] == 2 and info["x"]["missing_percentage"] == 40.0
    assert clean.drop_high_missing(dirty, 30.0).columns == ["id", "c", "s"]
    assert [r["column"] for r in clean.missing_info(dirty, only_missing=True).collect()] == ["f", "x", "c", "s"]


def test_drop_constant_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 5, None), (1, None, None)], "a int, b int, c int")
    assert clean.drop_constant(df).columns == ["b"]


def test_impute(dirty):
    step = clean.impute(dirty, {"x": "median", "c": "mode"})
    out = step.transform(dirty)
    assert values(out, "x") == [1.0, 4.0, 4.0, 4.0, 100.0]
    assert values(out, "c") == ["a", "b", "b", "b", "b"]
    assert values(out, "f") == [True, True, False, True, True]
    summary = {r["column"]: r for r in clean.imputation_summary(dirty, step).collect()}
    assert summary["x"]["missing_count"] == 2 and summary["x"]["strategy"] == "median"
    auto = clean.impute(dirty)
    assert auto.state["x"]["strategy"] == "median"  # skewed
    constant = clean.impute(dirty, "constant", {"x": -1.0}).transform(dirty)
    assert values(constant, "x")[1] == -1.0 and values(constant, "c")[2] is None
    with pytest.raises(ValueError):
        clean.impute(dirty, "guess")


def test_custom_impute_accepts_callables(dirty):
    out = clean.custom_impute(dirty, {"x": lambda c: F.col("id") * 1.0, "c": "none"})
    assert values(out, "x") == [1.0, 2.0, 3.0, 4.0, 100.0]
    assert values(out, "c")[2] == "none"


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 10)] + [(10, 1000.0), (11, None)], "id int, x double")
    assert max(v for v in values(clean.clip_iqr(df, ["x"]).transform(df), "x") if v is not None) == pytest.approx(14.5)
    assert clean.remove_outliers_iqr(df, "x").transform(df).count() == 9
    row = clean.outlier_report(df, ["x"]).collect()[0]
    assert row["n_outliers"] == 1 and row["outlier_percentage"] == 10.0
    z = clean.clip_zscore(df, ["x"], 1.0).transform(df)
    assert values(z, "x")[-1] is None and values(z, "x")[0] == 1.0


def test_scaling_rules(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 3.0, 7.0), (3, None, 7.0)], "id int, x double, k double")
    mm = scale.scale_minmax(df, ["x", "k"], (-1, 1))
    assert values(mm.transform(df), "x") == [-1.0, 1.0, None] and values(mm.transform(df), "k") == [-1.0] * 3
    st = scale.scale_standard(df, ["x", "k"])
    assert values(st.transform(df), "x") == [-1.0, 1.0, None] and values(st.transform(df), "k") == [0.0] * 3
    rb = scale.scale_robust(df, ["x", "k"])
    assert values(rb.transform(df), "x") == [-1.0, 1.0, None]
    for step in (mm, st, rb):
        assert values(scale.inverse_scale(step.transform(df), step), "x") == [1.0, 3.0, None]
        assert values(scale.inverse_scale(step.transform(df), step), "k") == [7.0] * 3
    assert values(scale.log_transform(spark.createDataFrame([(1, -2.0), (2, 0.0)], "id int, x double"), ["x"]).transform(spark.createDataFrame([(1, -2.0), (2, 0.0)], "id int, x double")), "x") == [None, 0.0]


def test_steps_survive_json_and_pipeline_models(dirty, tmp_path):
    step = clean.impute(dirty, {"x": "mean", "c": "mode"})
    want = values(step.transform(dirty), "x")
    assert values(ColumnStep.from_json(step.to_json()).transform(dirty), "x") == want
    onehot = encode.onehot(dirty, ["c"])
    path = str(tmp_path / "steps")
    PipelineModel([step.stage(), onehot.stage()]).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(dirty)
    assert values(out, "x") == want and values(out, "c_b") == [0, 1, 1, 1, 1] and "c" not in out.columns


def test_encoders(spark):
    rows = [(i, v, y) for i, (v, y) in enumerate([("a", 1)] * 3 + [("b", 0)] * 5 + [(None, 1)])]
    df = spark.createDataFrame(rows, "id int, c string, y int")
    assert values(encode.frequency_encode(df, "c").transform(df), "c")[0] == pytest.approx(3 / 9)
    assert values(encode.frequency_encode(df, "c").transform(df), "c")[-1] is None
    prior = 4 / 9
    w = 1 / (1 + math.exp(-(3 - 20) / 10))
    enc = encode.target_encode(df, "c", "y")
    assert values(enc.transform(df), "c")[0] == pytest.approx(w * 1 + (1 - w) * prior)
    unseen = spark.createDataFrame([(1, "zzz")], "id int, c string")
    assert values(enc.transform(unseen), "c") == [pytest.approx(prior)]
    woe = encode.woe_encode(df, "c", "y")
    assert values(woe.transform(df), "c")[0] == pytest.approx(math.log((4 / 6) / (1 / 7)))
    assert values(woe.transform(unseen), "c") == [0.0]
    with pytest.raises(ValueError):
        encode.distinct_values(df, ["c"], max_levels=1)


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "Red red fox"), (2, "fox!"), (3, "a b")], "id int, t string")
    got = {(r["id"], r["token"]): r["tfidf"] for r in encode.tfidf(df, "id", "t").collect()}
    red, fox = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    assert set(got) == {(1, "red"), (1, "fox"), (2, "fox")}
    assert got[(1, "red")] == pytest.approx(red / math.hypot(red, fox)) and got[(2, "fox")] == pytest.approx(1.0)


def test_feature_rules(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0), (2, None, 4.0), (3, None, None)], "id int, a double, b double")
    ops = [{"name": n, "columns": ["a", "b"], "operation": n} for n in ("sum", "mean", "ratio", "difference", "product")]
    out = engineer.derive(df, ops).transform(df)
    assert values(out, "sum") == [2.0, 4.0, 0.0]
    assert values(out, "mean") == [1.0, 4.0, None]
    assert values(out, "ratio") == [None, None, None]
    assert values(out, "product") == [0.0, 4.0, 1.0]
    poly = engineer.polynomial(df, ["a", "b"], 3)
    assert list(poly.exprs) == ["poly_a^2", "poly_a b", "poly_b^2", "poly_a^3", "poly_a^2 b", "poly_a b^2", "poly_b^3"]
    assert list(engineer.polynomial(df, ["a", "b"], 2, interaction_only=True).exprs) == ["poly_a b"]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)] + [(9, None)], "id int, x double")
    assert values(engineer.cut_bins(df, "x", [0, 2, 5], output="b").transform(df), "b") == [0, 0, 1, 1, 1, None, None, None, None]
    assert values(engineer.quantile_bins(df, "x", 4, output="b").transform(df), "b") == [0, 0, 1, 1, 2, 2, 3, 3, None]
    flat = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id int, x double")
    with pytest.raises(ValueError):
        engineer.quantile_bins(flat, "x", 4)
    assert len(engineer.quantile_edges(flat, "x", 4, "drop")) < 5


def test_pca_choice_of_components(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + (i % 2) * 0.01, float((i * 7) % 11)) for i in range(50)], "a double, b double, c double")
    comps = engineer.pca(df, ["a", "b", "c"], variance_ratio=0.95)
    assert len(comps.explained_ratio) == 1
    full = engineer.pca(df, ["a", "b", "c"], 3)
    assert sum(full.explained_ratio) == pytest.approx(1.0)
    row = full.transform(df).agg(*[F.avg(f"pca_component_{i}").alias(f"m{i}") for i in (1, 2, 3)]).collect()[0]
    assert all(abs(v) < 1e-9 for v in row)


def test_generators_and_sources(spark, tmp_path):
    base = generate.keyed_rows(spark, 500)
    reg = generate.gen_regression(base, "row_id", 3, 2, 1, 1, 1)
    stats = reg.agg(F.avg("target").alias("m"), F.stddev_pop("target").alias("s")).collect()[0]
    assert stats["m"] == pytest.approx(50) and stats["s"] == pytest.approx(10)
    assert reg.orderBy("row_id").collect() == generate.gen_regression(base, "row_id", 3, 2, 1, 1, 1).orderBy("row_id").collect()
    assert set(len(v) for v in values(generate.gen_mixed(base, "row_id", 1), "text_col_0", "row_id")) == {10}
    holes = generate.inject_missing(reg, "row_id", ["float_feature_0"], 0.3)
    share = holes.where("float_feature_0 IS NULL").count() / 500
    assert 0.2 < share < 0.4
    path = str(tmp_path / "t.csv")
    reg.select("row_id", "target").coalesce(1).write.option("header", True).csv(path)
    back = tables.scan_table(spark, path)
    assert back.count() == 500 and dict(back.dtypes)["target"] == "double"
    assert tables.split_target(back) == (["row_id"], "target")
    nan = spark.createDataFrame([(NAN,), (1.0,)], "x double")
    assert tables.nan_to_null(nan).where("x IS NULL").count() == 1


def test_steps_run_on_a_stream(spark, data, tmp_path):
    from millrace.streaming.apply import score_stream

    static = spark.read.parquet(f"{data}/events.parquet").select("event_id", "value")
    step = scale.scale_standard(static, ["value"])
    source = str(tmp_path / "in")
    static.write.parquet(source)
    stream = spark.readStream.schema(static.schema).parquet(source)
    q = score_stream(stream, step, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == static.count()
    assert abs(out.agg(F.avg("value")).collect()[0][0]) < 1e-9


def test_tfidf_counts_texts_in_place_and_adds_up_repeated_keys(spark, monkeypatch):
    texts = [(1, "Aa bb aa c"), (2, None), (None, "bb x1 \u00c9t\u00e9"), (1, "bb bb zz"), (3, ""), (4, "a b"), (None, "x1"), (5, "zz " * 450)]
    df = spark.createDataFrame(texts, "id int, text string")
    monkeypatch.setattr(encode, "TEXTS", 3)
    for frequent in (0, encode.FREQUENT):
        monkeypatch.setattr("millrace.operators.lookup.SMALL_VALUES", frequent)
        for rows in (texts, texts[:3] + texts[4:6]):
            tf = Counter((k, t) for k, x in rows for t in re.findall(r"\w{2,}", (x or "").lower()))
            n = Counter(t for _, t in tf)
            w = {(k, t): c * (math.log((1 + len(rows)) / (1 + n[t])) + 1) for (k, t), c in tf.items()}
            norm = Counter()
            for (k, _), x in w.items():
                norm[k] += x * x
            got = encode.tfidf(spark.createDataFrame(rows, df.schema), "id", "text").collect()
            assert {(r.id, r.token): r.tfidf for r in got} == {p: pytest.approx(x / math.sqrt(norm[p[0]])) for p, x in w.items()}
            assert len(got) == len(w)
    counted = encode._counts(df.select(df.id.alias("key"), "text"))
    assert [sorted(map(tuple, r.counts)) for r in counted.collect()[:2]] == [[("aa", 2), ("bb", 1)], []]
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
