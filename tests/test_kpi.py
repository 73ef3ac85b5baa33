"""Groups, labels, filters and audit KPIs on hand-made rows."""

import datetime as dt
import decimal

import pytest

from ticketlake.operators.filters import NullOr, apply_filters, cross_filter
from ticketlake.plans import kpi
from ticketlake.spec import PROBLEMS

SCHEMA = PROBLEMS.production_schema()


def problem(numero, **values):
    return tuple({"numero": numero, **values}.get(name) for name in SCHEMA.names)


@pytest.fixture(scope="module")
def problems(spark):
    return spark.createDataFrame(
        [
            problem(1, status="Aberto", prioridade="P1", jornada_impactada="A", dt_abertura=dt.date(2024, 2, 1)),
            problem(2, status="resolvido ", prioridade="p1", jornada_impactada=None, paliativo="Sim"),
            problem(3, status="Resolvido", prioridade="P2", jornada_impactada="Não informado"),
            problem(4, status=None, prioridade=None, jornada_impactada="a "),
            problem(5, status="ABERTO", prioridade="P3", jornada_impactada=None, dt_abertura=dt.date(2024, 1, 31)),
        ],
        SCHEMA,
    )


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_groups_fold_case_and_blanks(problems):
    assert sorted(r[1] for r in kpi.count_by(problems, "status").collect()) == [1, 2, 2]
    by_priority = dict(rows(kpi.count_by(problems, "prioridade")))
    assert by_priority == {"P1": 2, "P2": 1, "P3": 1, None: 1}


def test_null_group_and_literal_label_stay_apart(problems):
    journeys = rows(kpi.count_open_by(problems, "jornada_impactada"))
    assert journeys.count(("Não informado", 2, 1)) == 1
    assert journeys.count(("Não informado", 1, 0)) == 1
    assert ("A", 2, 1) in journeys  # the row without status is not open


def test_scalars(problems):
    assert rows(kpi.total(problems)) == [(5,)]
    assert rows(kpi.open_total(problems)) == [(2,)]
    assert rows(kpi.p1_open_total(problems)) == [(1,)]


def test_orders(problems):
    counts = [tuple(r) for r in kpi.card_by(problems, "jornada_impactada", "Não informado").collect()]
    assert [c[1] for c in counts] == [2, 2, 1]
    assert [r[0] for r in kpi.BASIC_CARDS["by_priority"](problems).collect()] == [None, "P1", "P2", "P3"]
    assert [r.numero for r in kpi.open_table_exec(problems).collect()] == [1, 5]
    assert [r.dt_abertura for r in kpi.open_table_basic(problems).collect()] == ["01/02/2024", "31/01/2024"]
    assert kpi.open_table_exec(problems).first().paliativo == "—"


def test_filters(problems):
    assert apply_filters(problems, status=None).count() == 5
    assert apply_filters(problems, status="aberto", prioridade="P1").count() == 1
    assert apply_filters(problems, jornada_impactada="Não informado").count() == 1
    with pytest.raises(ValueError):
        apply_filters(problems, sistema="x")


def test_cross_filter(problems):
    assert cross_filter("by_status", "Aberto") == {"status": "Aberto"}
    params = cross_filter("by_journey", "Não informado")
    assert isinstance(params["jornada_impactada"], NullOr)
    assert apply_filters(problems, **params).count() == 3
    assert set(kpi.dashboard(problems, **params)) == set(kpi.EXEC_CARDS)


@pytest.mark.parametrize("params", [{}, {"status": "aberto"}, {"prioridade": "none such"}])
def test_dashboard_equals_its_cards(problems, params):
    cards = kpi.dashboard(problems, **params)
    for name, card in cards.items():
        single = kpi.filtered(name, problems, **params)
        assert card.columns == single.columns
        assert sorted(map(repr, card.collect())) == sorted(map(repr, single.collect())), name


def test_dashboard_scans_its_table_once(problems, tmp_path):
    path = str(tmp_path / "p")
    problems.write.parquet(path)
    counts = kpi.dashboard_counts(problems.sparkSession.read.parquet(path), paliativo="Sim")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_filtered_table_keeps_closed_rows(problems):
    assert kpi.filtered("open_table", problems).count() == 5


def runs(spark, *items):
    schema = (
        "id_log long, nm_arquivo string, nm_tabela_destino string, dt_processamento timestamp_ntz, "
        "qt_linhas_recebidas int, qt_linhas_inseridas int, qt_linhas_rejeitadas int, ds_status string, "
        "ds_erro string, tm_duracao_seg decimal(10,2)"
    )
    return spark.createDataFrame(list(items), schema)


def run(i, when, received, inserted, status, seconds):
    return (i, f"f{i}", "t", when, received, inserted, 0, status, None, decimal.Decimal(seconds))


def test_daily(spark):
    day = dt.date(2024, 5, 2)
    frame = runs(
        spark,
        run(1, dt.datetime(2024, 5, 2, 23, 59, 59), 10, 8, "sucesso", "1.00"),
        run(2, dt.datetime(2024, 5, 2, 0, 0, 0), None, None, "falha", "2.01"),
        run(3, dt.datetime(2024, 5, 3, 0, 0, 0), 5, 5, "sucesso", "9.00"),
    )
    assert [r.nm_arquivo for r in kpi.daily_summary(frame, day).collect()] == ["f2", "f1"]
    assert rows(kpi.daily_totals(frame, day)) == [(10, 8, 1)]
    assert rows(kpi.daily_totals(frame, dt.date(2020, 1, 1))) == [(0, 0, 0)]
    health = kpi.health_card(frame).collect()
    assert [r["data"] for r in health] == ["03/05/2024", "02/05/2024"]
    assert health[1].media_seg == decimal.Decimal("1.51")


def test_views_are_usable_from_sql(spark, problems):
    frame = runs(spark, run(1, dt.datetime(2024, 5, 2), 1, 1, "sucesso", "1.00"))
    names = kpi.register_views(problems, frame)
    assert len(names) == 11
    assert spark.sql("SELECT * FROM vw_problemas_abertos").count() == 2
    assert spark.sql("SELECT qt_execucoes FROM vw_pipeline_health").first()[0] == 1
