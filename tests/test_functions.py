"""Cell, name and label rules on hand-made values."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions import columns as C
from ticketlake.functions.names import resolve_names, sanitize_name
from ticketlake.operators.cleaning import BAD_KEY, KEPT, flag_rows
from ticketlake.spec import NANOSECOND_DATES, NULL_TOKENS, PROBLEMS


def values(spark, texts, expression):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_headers_get_numbers_and_positions(spark):
    rows = {
        1: ([" ", "a", " ", "", " ", None], [" ", "a", " .1", "Unnamed: 3", " .2", "Unnamed: 5"]),
        2: (["a", "a.1", "a", "a"], ["a", "a.1", "a.2", "a.3"]),
        3: (["Unnamed: 1", ""], ["Unnamed: 1", "Unnamed: 1.1"]),
        4: ([], []),
        5: (None, None),
    }
    frame = spark.createDataFrame([(i, header) for i, (header, _) in rows.items()], "i int, h array<string>")
    found = {r.i: r.n for r in frame.select("i", C.dedupe_headers("h").alias("n")).collect()}
    assert found == {i: names for i, (_, names) in rows.items()}


def test_sanitize():
    assert sanitize_name(" Número do Caso ") == "n_mero_do_caso"
    assert sanitize_name("__Status 30/04__") == "status_30_04"
    assert sanitize_name("—") == ""


@given(st.text(max_size=20))
@settings(max_examples=200, deadline=None)
def test_sanitize_shape(text):
    name = sanitize_name(text)
    assert name == sanitize_name(name)
    assert "__" not in name and name == name.strip("_")


def test_resolve_names():
    good = resolve_names(["Número", " ", " .3", "Status 30/04", "status"], PROBLEMS)
    assert good.sources == {"numero": "Número", "status_30_04": "Status 30/04", "status": "status"}
    assert "mesmo nome" in resolve_names(["Status", "status"], PROBLEMS).error
    assert "mesmo nome" in resolve_names(["Novo-1", "novo 1"], PROBLEMS).error
    assert resolve_names(["???"], PROBLEMS).error
    assert resolve_names(["dt insert"], PROBLEMS).error
    assert resolve_names(["nm_arquivo_origem", "Número"], PROBLEMS).sources == {"numero": "Número"}


def test_null_tokens(spark):
    assert values(spark, list(NULL_TOKENS), C.null_token("c")) == [None] * len(NULL_TOKENS)
    assert values(spark, [" ", "none", "x", None], C.null_token("c")) == [" ", "none", "x", None]


def test_norm_text(spark):
    texts = ["\t10/05 ", " nan ", "NaT", "  ", "a  b\n", " x ", None]
    assert values(spark, texts, C.norm_text("c")) == ["10/05", None, None, None, "a  b", "x", None]


def test_dates(spark):
    texts = ["2024-04-01 00:00:00", "2024-04-01", "01/04/2024", "foo", "2024-02-30", "9999-01-01", "13/13/2024", None]
    day = dt.date(2024, 4, 1)
    far = dt.date(9999, 1, 1)
    assert values(spark, texts, C.coerce_date("c")) == [day, day, dt.date(2024, 1, 4), None, None, far, None, None]
    assert values(spark, texts, C.coerce_date("c", bounds=NANOSECOND_DATES))[5] is None
    odd = [" 2024-04-01\t", "2024-04-01 24:00:00", "2024-04-01 23:59:60", "2024-4-1", "2024-04-01x", "20240401", "2024", ""]
    assert values(spark, odd, C.coerce_date("c")) == [day] + [None] * 7
    other = ["01.04.2024", "2024-04-01", "Apr 1, 2024"]
    assert values(spark, other, C.coerce_date("c", ["dd.MM.yyyy"])) == [day, None, None]
    assert values(spark, other, C.coerce_date("c", ["MMM d, yyyy"])) == [None, None, day]


def test_keys(spark):
    texts = ["12", "12.7", "-3.9", " 7 ", "1e3", ".5", "5.", "1d", "1f", "abc", "0x10", "", None, "inf",
             "-Infinity", "3000000000", "2147483647", "-2147483648", "+4", "."]
    expected = [12, 12, -3, 7, 1000, 0, 5, None, None, None, None, None, None, None,
                None, None, 2147483647, -2147483648, 4, None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_i int, numero string")
    rows = flag_rows(frame, PROBLEMS, ["numero"]).orderBy("_i").collect()
    assert [r.numero for r in rows] == expected
    assert [t for t, r in zip(texts, rows) if r[BAD_KEY]] == ["inf", "-Infinity", "3000000000"]
    assert [r[KEPT] for r in rows] == [e is not None or r[BAD_KEY] for e, r in zip(expected, rows)]
    long = ["3000000000", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "9007199254740993.0"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(long)], "_i int, numero string")
    rows = flag_rows(frame, PROBLEMS.with_key_type(T.LongType()), ["numero"]).orderBy("_i").collect()
    assert [r.numero for r in rows] == [3000000000, 2**63 - 1, -(2**63), None, 9007199254740993]
    assert [r[BAD_KEY] for r in rows] == [False, False, False, True, False]


def test_open_and_rank(spark):
    texts = ["Resolvido", "resolvido ", "CANCELADO", "Aberto", None, "Não"]
    assert values(spark, texts, C.is_open("c")) == [False, False, False, True, None, True]
    assert values(spark, ["P1", "p2 ", "P3", "P4", None], C.priority_rank("c")) == [1, 2, 3, 4, 4]


def test_labels(spark):
    assert values(spark, [None, "x"], C.label_null("c")) == ["Não informado", "x"]
    day = F.to_date("c")
    assert values(spark, ["2024-04-09", None], C.fmt_day(day)) == ["09/04/2024", None]
    assert values(spark, ["a.XLSX", "a.xls", "a.csv", "xlsx"], C.is_workbook("c")) == [True, True, False, False]


def test_comparison_key_keeps_accents(spark):
    keys = values(spark, ["Não", "NÃO  ", "Nao", " Não"], C.ci_key("c"))
    assert keys[0] == keys[1] and len(set(keys)) == 3


@pytest.mark.parametrize("name", ["numero", "dt_abertura"])
def test_schema_has_types(name):
    kinds = {f.name: f.dataType for f in PROBLEMS.production_schema()}
    assert kinds[name] in (T.IntegerType(), T.DateType())
