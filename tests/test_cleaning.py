import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwise.operators import cleaning as C
from pitwise.operators.joins import keep_last, mark_all_copies, mark_duplicates, outer_with_side, null_safe_left_join, top_k
from pitwise.sources import tables as S


def test_missing_values(spark):
    df = spark.createDataFrame([(1, None, 10.0, "a"), (2, None, None, "b"), (3, None, 30.0, "a"), (4, 1.0, 40.0, None), (5, 2.0, 30.0, "b")],
                               "row long, high_missing double, low_missing_num double, low_missing_cat string")
    out = C.impute(C.drop_sparse_columns(df, 0.50))
    assert "high_missing" not in out.columns
    rows = {r["row"]: r for r in out.collect()}
    assert rows[2]["low_missing_num"] == 30.0 and rows[4]["low_missing_cat"] == "a"      # tie of modes: the smaller one


def test_column_without_values_becomes_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k long, t string")
    assert [r["t"] for r in C.impute(df).collect()] == ["Unknown", "Unknown"]


def test_clip(spark):
    rows = [(i, float(i % 10), v, i % 3) for i, v in enumerate([10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 1000.0, -1000.0, 12.0, 13.0])]
    df = spark.createDataFrame(rows, "n long, normal double, with_outlier double, level int")
    out = C.clip_iqr(df).toPandas()
    q1, q3 = 11.25, 13.75
    assert out["with_outlier"].max() == q3 + 1.5 * (q3 - q1) and out["with_outlier"].min() == q1 - 1.5 * (q3 - q1)
    assert sorted(set(out["level"])) == [0, 1, 2] and out["normal"].max() == 9.0


def test_default_name_rule(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4)], "player_id long, width double, value double, is_win int")
    assert C.clippable(df) == ["value"]


def test_dates_are_filled_forward(spark):
    df = spark.createDataFrame([(0, "2020-01-01", "a"), (1, "bad", "b"), (2, "2020-01-03", "c")], "pos long, transfer_date string, name string")
    out = C.standardize_dates(df, order_by="pos").orderBy("pos")
    assert dict(out.dtypes)["transfer_date"] == "timestamp"
    assert [str(r["d"]) for r in out.select(F.to_date("transfer_date").alias("d")).collect()] == ["2020-01-01", "2020-01-01", "2020-01-03"]


def test_full_clean(spark):
    df = spark.createDataFrame([(0, "2020-01-01", 1.0, "x"), (1, "2020-01-01", 1.0, "x"), (2, "2020-01-02", None, None)], "pos long, match_date string, score double, team string")
    out = C.clean_table(df, order_by="pos").drop("pos")
    assert out.count() == 2 and out.dropna().count() == 2


def test_files_in_files_out(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    (raw / "b_games.csv").write_text("game_date,minutes,flag\n2020-01-01,90,true\n2020-01-02,NA,false\n2020-01-03,60,\n")
    (raw / "a_empty.csv").write_text("x,y\n")
    tables = S.load_tables(spark, str(raw))
    assert list(tables) == ["a_empty", "b_games"]
    assert dict(tables["b_games"].dtypes) == {"game_date": "string", "minutes": "bigint", "flag": "boolean"}
    cleaned = {n: C.clean_table(S.with_row_order(t), order_by="row_order").drop("row_order") for n, t in tables.items() if not t.isEmpty()}
    paths = S.write_tables({**cleaned, "a_empty": tables["a_empty"]}, str(out))
    assert list(paths) == ["b_games"] and paths["b_games"].endswith("b_games_clean")
    back = S.read_modeling_table(spark, paths["b_games"], dates=["game_date"])
    assert back.count() == 3 and back.where("minutes is null").count() == 0 and dict(back.dtypes)["game_date"] == "date"


def test_loading_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.load_tables(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        S.load_tables(spark, str(tmp_path))
    assert S.load_tables(spark, str(tmp_path), on_error="skip") == {} and S.load_tables(spark, str(tmp_path / "none"), on_error="skip") == {}
    with pytest.raises(FileNotFoundError, match="b"):
        S.require_tables({"a": None}, ["a", "b"])


def test_explicit_schema_and_splits(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,v,d,s\n1,3.0,2020-01-01,x\n2,nan,not a date,NULL\n")
    df = S.load_tables(spark, str(tmp_path), schemas={"t": "k long, v double, d date, s string, extra long"})["t"]
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(1, 3.0, dt.date(2020, 1, 1), "x", None), (2, None, None, None, None)]
    path = S.write_splits(df.withColumn("split", F.when(F.col("k") == 1, "train").otherwise("test")), str(tmp_path / "s"))
    assert spark.read.parquet(path).where("split = 'train'").count() == 1
    assert [tuple(r) for r in S.schema_metadata(df.select("k", "s")).collect()] == [("k", "bigint"), ("s", "string")]


def test_duplicates_keep_first_by_position(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", 1), (4, "a", 1)], "pos long, k string, j int")
    got = {r["pos"]: (r["is_duplicate"], r["c"]) for r in mark_all_copies(mark_duplicates(df, ["k", "j"], "pos"), ["k", "j"], "pos", "c").collect()}
    assert got == {1: (False, True), 3: (True, True), 2: (False, False), 4: (False, False)}


def test_keep_last_and_top(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "y")], "k string, pos int, v string")
    assert sorted(tuple(r) for r in keep_last(df, ["k"], ["pos"]).collect()) == [("a", 2, "x"), ("b", 1, "y")]
    assert top_k(df, by=["k"], order_by=[F.col("pos").desc()], k=1).count() == 2


def test_null_keys_match_in_outer_join(spark):
    a = spark.createDataFrame([(1, "l1"), (None, "l2"), (3, "l3")], "k int, a string")
    b = spark.createDataFrame([(1, "r1"), (None, "r2"), (4, "r4")], "k int, b string")
    got = sorted((r["k"] or 0, r["a"] or "", r["b"] or "", r["side"]) for r in outer_with_side(a, b, ["k"]).collect())
    assert got == [(0, "l2", "r2", "both"), (1, "l1", "r1", "both"), (3, "l3", "", "left_only"), (4, "", "r4", "right_only")]
    joined = null_safe_left_join(a, b, on={"k": "k"}, take={"b": "b"})
    assert {r["a"]: r["b"] for r in joined.collect()} == {"l1": "r1", "l2": "r2", "l3": None}
