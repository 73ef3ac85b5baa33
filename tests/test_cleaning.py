"""Single cleaning steps on small frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions import columns
from ticketlake.operators import cleaning, quality
from ticketlake.spec import ORIGIN, PROBLEMS


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in columns))


def test_column_steps(spark):
    df = frame(spark, [" ", " .1", "Status", "Novo (x)"], ("a", "b", "c", "d"))
    assert cleaning.map_names(df, PROBLEMS).columns == ["status", "novo_x"]
    named = frame(spark, ["status", "Novo (x)"], ("c", "d"))
    assert cleaning.sanitize_columns(named, ["status"]).columns == ["status", "novo_x"]
    with pytest.raises(ValueError):
        cleaning.sanitize_columns(frame(spark, ["a b", "a-b"], ("1", "2")))
    with pytest.raises(ValueError):
        cleaning.map_names(frame(spark, ["Status", "status"], ("1", "2")))


def test_row_steps(spark):
    df = frame(spark, ["a", "b", ORIGIN], ("N/A", "x", "f"), ("", None, "f"), ("y", "nan", "f"))
    kept = cleaning.clean(df)
    assert [tuple(r) for r in kept.collect()] == [(None, "x", "f"), ("y", None, "f")]


def test_flags_and_counts(spark):
    df = frame(
        spark, ["numero", "status", ORIGIN],
        ("1", "a", "f"), ("x", "a", "f"), (None, None, "f"), ("inf", None, "g"), ("2.5", "nan", "g"),
    )
    flagged = cleaning.flag_rows(df, PROBLEMS, ["numero", "status"])
    got = [(r.numero, r.status, r[cleaning.KEPT], r[cleaning.BAD_KEY]) for r in flagged.collect()]
    assert got == [
        (1, "a", True, False), (None, "a", False, False), (None, None, False, False),
        (None, None, True, True), (2, None, True, False),
    ]
    counts = {r[ORIGIN]: (r.qt_recebidas, r.qt_validas, r.qt_rejeitadas) for r in cleaning.account(flagged).collect()}
    assert counts == {"f": (3, 1, 2), "g": (2, 2, 0)}


def test_file_without_key_column_rejects_empty_rows_only(spark):
    df = frame(spark, ["status", ORIGIN], ("a", "f"), ("", "f"))
    kept = cleaning.flag_rows(df, PROBLEMS, ["status"]).collect()
    assert [r[cleaning.KEPT] for r in kept] == [True, False]


def test_violations_and_duplicates(spark):
    rows = frame(spark, ["numero", "prioridade", "paliativo", ORIGIN],
                 ("1", "P1", "x" * 11, "f"), ("1", "P12345", None, "f"), ("1", "P1", None, "g"))
    rows = rows.withColumn("numero", F.col("numero").cast("int"))
    found = sorted(tuple(r) for r in quality.violations(rows).collect())
    assert found == [("f", "paliativo", 11, 10), ("f", "prioridade", 6, 5)]
    assert [tuple(r) for r in quality.duplicate_keys(rows).collect()] == [("f", 1, 2)]


def test_staging_shape(spark):
    rows = frame(spark, ["status", "extra"], ("a", "b"))
    staging = quality.to_staging(rows, PROBLEMS.staging_schema())
    assert staging.columns == [*PROBLEMS.names, "extra"]
    assert staging.select("numero", "status", "extra").first() == (None, "a", "b")


def test_dates_with_fractions_and_long_keys(spark):
    texts = ["2024-04-01 02:57:46.667000", "2024-04-01T02:57:46", "2024-04-01T02:57:46.5", "2024-04-01 02:57", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r[0] for r in rows.select(columns.coerce_date("d").cast("string")).collect()]
    assert got == ["2024-04-01"] * 3 + [None, None]
    keys = spark.createDataFrame([("9007199254740993",), ("9007199254740992.0",), ("1e3",)], "numero string")
    cleaned = cleaning.clean(keys, PROBLEMS.with_key_type(T.LongType()), meta=())
    assert sorted(r[0] for r in cleaned.select("numero").collect()) == [1000, 9007199254740992, 9007199254740993]
