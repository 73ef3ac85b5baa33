"""Landing formats, checks, merge rules, batches and streams."""

import datetime as dt
import itertools
import os
import time

import pytest
from pyspark.sql import functions as F

from books import write_book
from ticketlake.operators import merge, quality, routing
from ticketlake.operators.audit import unknown_table_alerts
from ticketlake.plans.ingest import ingest_batch, project_landing, read_audit, resolve_layouts
from ticketlake.session import Scratch
from ticketlake.sources import landing as L
from ticketlake.sources.workbook import sheet_rows, workbook_files
from ticketlake.spec import ORIGIN, PATH, PROBLEMS, TableSpec
from ticketlake.storage.snapshot import ConcurrentCommit, SnapshotTable
from ticketlake.streaming import landing as stream
from ticketlake.streaming import settled
from ticketlake.streaming.landing import apply_batch, ingest_delimited, replay, stream_landing

TS = [dt.datetime(2024, 5, d) for d in range(1, 9)]
HEADER = ["Número", "Prioridade", "Status", "Data", "Título", " ", " ", "Data de conclusão"]


@pytest.fixture
def store(tmp_path):
    return SnapshotTable(str(tmp_path / "table"), buckets=3), str(tmp_path / "audit")


def table_rows(spark, table, *columns):
    _, df = table.current(spark)
    return {r[0]: tuple(r)[1:] for r in df.select("numero", *columns).collect()}


def audit_of(result):
    return {
        r.nm_arquivo: (r.qt_linhas_recebidas, r.qt_linhas_inseridas, r.qt_linhas_rejeitadas, r.ds_status)
        for r in result.runs.collect()
    }


def csv_file(folder, name, lines, age=0):
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    if age:
        os.utime(path, (time.time() - age,) * 2)
    return str(path)


# Workbooks ---------------------------------------------------------------------------
def test_workbook_cells(tmp_path):
    path = write_book(
        tmp_path / "a.xlsx",
        [
            ["h1", None, "h1", ("inlineStr", "h <4>")],
            [1, 2.5, ("b", 1), ("e", "#N/A")],
            None,
            [("date", 45383), ("custom", 45383.5), ("n", "1E3"), ("date", 0.25)],
            [None, None, None, ("str", "f & g")],
            [None, None],
        ],
    )
    rows = list(sheet_rows(open(path, "rb").read(), "Página4"))
    assert rows == [
        ["h1", None, "h1", "h <4>"],
        ["1", "2.5", "True"],
        [],
        ["2024-04-01 00:00:00", "2024-04-01 12:00:00", "1000", "06:00:00"],
        [None, None, None, "f & g"],
    ]
    assert list(sheet_rows(open(path, "rb").read(), 0)) == []
    with pytest.raises(ValueError):
        list(sheet_rows(open(path, "rb").read(), "Outra"))


def test_read_workbooks(spark, tmp_path):
    write_book(tmp_path / "A.XLSX", [["x", "x", None], ["1", "2", "3"]])
    write_book(tmp_path / "b.xlsx", [["y"], ["4"]])
    (tmp_path / "c.txt").write_text("no")
    df = L.read_workbooks(spark, str(tmp_path), "Página4")
    got = sorted(tuple(r) for r in df.select(ORIGIN, "x", "`x.1`", "`Unnamed: 2`", "y").na.fill("-").collect())
    assert got == [("A.XLSX", "1", "2", "3", "-"), ("b.xlsx", "-", "-", "-", "4")]


# Delimited files ------------------------------------------------------------------------
def test_delimited_files_with_different_headers(spark, tmp_path):
    csv_file(tmp_path, "a.csv", ["h,v,v", '1,"x, ""y""",', ",,", "2,z"])
    csv_file(tmp_path, "b.csv", ["v,novo", "q,w"])
    csv_file(tmp_path, "vazio.csv", ["h"])
    df = L.read_landing(spark, str(tmp_path), "csv")
    got = [(r[ORIGIN], r["h"], r["v"], r["v.1"], r["novo"]) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(
        [("a.csv", "1", 'x, "y"', None, None), ("a.csv", None, None, None, None),
         ("a.csv", "2", "z", None, None), ("b.csv", None, "q", None, "w")], key=repr)


def test_landing_parquet_is_text(spark, tmp_path):
    spark.range(3).withColumn("d", F.lit(1.5)).coalesce(1).write.parquet(str(tmp_path / "p"))
    df = L.read_landing(spark, str(tmp_path / "p"), "parquet")
    assert {t for c, t in df.dtypes if c in ("id", "d")} == {"string"}
    with pytest.raises(ValueError):
        L.read_landing(spark, str(tmp_path), "xml")


def test_settled(spark):
    now = dt.datetime(2024, 1, 1, 0, 0, 10)
    files = spark.createDataFrame(
        [("old", 5, dt.datetime(2024, 1, 1, 0, 0, 7)), ("new", 5, dt.datetime(2024, 1, 1, 0, 0, 8)),
         ("empty", 0, dt.datetime(2023, 1, 1))],
        "f string, length long, dt_chegada timestamp_ntz",
    )
    kept = L.only_settled(files, 3, F.lit(now).cast("timestamp_ntz")).collect()
    assert [r.f for r in kept] == ["old"]


# Routing ------------------------------------------------------------------------------------
def test_route(spark):
    specs = [
        TableSpec(prefix="ab", table="t1", key="k", columns=()),
        TableSpec(prefix="ABC", table="t2", key="k", columns=()),
        TableSpec(prefix="z", table="missing", key="k", columns=()),
    ]
    files = spark.createDataFrame([("AbcX.xlsx",), ("Z1.xlsx",), ("xab.xlsx",)], f"{ORIGIN} string")
    ok, ignored, unknown = routing.route(files, specs, ["t1", "t2"])
    assert [(r.prefixo, r.tabela) for r in ok.collect()] == [("ab", "t1")]
    assert [r[ORIGIN] for r in ignored.collect()] == ["xab.xlsx"]
    alert = unknown_table_alerts(unknown, F.lit(TS[0])).first()
    assert alert.nm_arquivo == "Z1.xlsx" and "missing" in alert.ds_mensagem and "Z1.xlsx" in alert.ds_mensagem


# Merge rules ------------------------------------------------------------------------------------
def merge_frames(spark):
    target = spark.createDataFrame(
        [(1, "a", "x", TS[0], None), (2, "b", "y", TS[0], TS[1]), (3, "c", "z", TS[0], None)],
        "numero int, status string, titulo string, dt_insert timestamp_ntz, dt_atualizacao timestamp_ntz",
    )
    source = spark.createDataFrame(
        [(1, None), (3, "c"), (4, "d"), (None, "e")], "numero int, status string"
    )
    return target, source


@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, small):
    target, source = merge_frames(spark)
    merged = merge.merge_upsert(target, source, "numero", F.lit(TS[5]), broadcast_source=small)
    got = sorted(tuple(r) for r in merged.collect())
    assert got == [
        (1, None, None, TS[0], TS[5], "UPDATE"),
        (2, "b", "y", TS[0], TS[1], None),
        (3, "c", None, TS[0], TS[5], "UPDATE"),
        (4, "d", None, TS[5], None, "INSERT"),
    ]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_can_keep_missing_columns(spark, small):
    target, source = merge_frames(spark)
    merged = merge.merge_upsert(
        target, source, "numero", F.lit(TS[5]), keep_missing=True, broadcast_source=small
    )
    got = {r.numero: (r.status, r.titulo) for r in merged.collect()}
    assert got == {1: (None, "x"), 2: ("b", "y"), 3: ("c", "z"), 4: ("d", None)}


def test_broadcast_merge_does_not_shuffle_the_target(spark):
    target, source = merge_frames(spark)
    plan = merge.merge_upsert(
        target, source, "numero", F.lit(TS[5]), broadcast_source=True
    )._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_evolution_adds_sorted_text_columns(spark):
    target, _ = merge_frames(spark)
    new = merge.new_columns(target.columns, ["z", "status", "a", "dt_insert"])
    assert new == ["a", "z"]
    assert dict(merge.evolve(target, new).dtypes)["z"] == "string"


def sequence(spark, table_rows, files, keep_missing=False):
    """Merge files given as {name: [(numero, status, titulo)]} in one job."""
    rows = [
        (n, s, t, TS[i], name, [] if t is not None or not keep_missing else ["titulo"])
        for i, (name, content) in enumerate(files.items()) for n, s, t in content
    ]
    frame = spark.createDataFrame(
        rows, f"numero int, status string, titulo string, dt_chegada timestamp_ntz, {ORIGIN} string, _ausentes array<string>"
    )
    target = spark.createDataFrame(
        table_rows,
        f"numero int, status string, titulo string, {ORIGIN} string, dt_insert timestamp_ntz, dt_atualizacao timestamp_ntz",
    )
    merged = merge.merge_sequence(
        target, frame, "numero", ["dt_chegada", ORIGIN], F.lit(TS[7]), keep_missing
    )
    return merged, frame


FILES = {
    "f1": [(1, "a", "t1"), (2, "b", "t2")],
    "f2": [(2, "B", None), (3, "c", "t3")],
    "f3": [(3, "C", None), (9, "z", None)],
}
START = [(1, "old", "old", "f0", TS[0], None), (8, "k", "k", "f0", TS[0], None), (9, "y", "y", "f0", TS[0], None)]


def test_sequence_equals_one_file_after_the_other(spark):
    merged, rows = sequence(spark, START, FILES)
    got = {r.numero: tuple(r)[1:6] for r in merged.collect()}
    state = [tuple(r) for r in START]
    tally = {}
    for name, content in FILES.items():
        source = spark.createDataFrame(
            [(n, s, t, name) for n, s, t in content], f"numero int, status string, titulo string, {ORIGIN} string"
        )
        target = spark.createDataFrame(state, merge.production_rows(merged).schema)
        step = merge.merge_upsert(target, source, "numero", F.lit(TS[7]))
        counts = merge.merge_actions(step).filter(F.col(ORIGIN) == name).first()
        tally[name] = (counts.qt_inseridas, counts.qt_atualizadas)
        state = [tuple(r) for r in merge.production_rows(step).collect()]
    assert got == {r[0]: r[1:] for r in state}
    actions = merge.merge_actions(merged, rows)
    assert {r[0]: (r[1], r[2]) for r in actions.collect()} == tally


def test_sequence_can_keep_missing_columns(spark):
    merged, _ = sequence(spark, START, FILES, keep_missing=True)
    got = {r.numero: (r.status, r.titulo) for r in merged.collect()}
    assert got == {1: ("a", "t1"), 2: ("B", "t2"), 3: ("C", "t3"), 8: ("k", "k"), 9: ("z", "y")}


def test_split(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], f"{ORIGIN} string, numero int")
    good, bad = quality.split_files(rows, rows.filter("numero = 2"))
    assert (good.first().numero, bad.first().numero) == (1, 2)


# Batches --------------------------------------------------------------------------------------------
def test_batch_of_workbooks(spark, tmp_path, store):
    table, audit = store
    folder = tmp_path / "in"
    folder.mkdir()
    write_book(
        folder / "gproblemas_1.xlsx",
        [HEADER,
         ["1", "P1", "Aberto", ("date", 45383), "t1", "x", "y", "\t10/05 "],
         ["2.9", "P2", "N/A", "foo", "t2", None, None, "nan"],
         ["abc", "P2", "Aberto"],
         None,
         [None, None, None, None, None, "só lixo"],
         [3, "P3", "Aberto", "01/04/2024", "t3"]],
    )
    write_book(folder / "gproblemas_2.xlsx", [HEADER, ["4", "PRIORIDADE", "Aberto"], ["5", "P1", "x"]])
    write_book(folder / "gproblemas_3.xlsx", [HEADER, ["6", "P1", "a"], ["6", "P2", "b"]])
    write_book(folder / "gproblemas_4.xlsx", [HEADER, ["inf", "P1", "a"], ["3000000000", "P2", "b"]])
    write_book(folder / "gproblemas_5.xlsx", [["Número", "Status", "status"], ["7", "a", "b"]])
    write_book(folder / "gproblemas_6.xlsx", [HEADER, ["8", "P1", "a"]], sheet="Outra")
    write_book(folder / "gproblemas_7.xlsx", [["Número", "Status 30/04"], ["1", "nota"], ["9", "n9"]])
    write_book(folder / "gproblemas_8.xlsx", [["Status"], ["sem chave"]])
    write_book(folder / "gproblemas_9.xlsx", [HEADER])
    (folder / "gproblemas_a.xlsx").write_bytes(b"broken")
    (folder / "gproblemas_b.xls").write_bytes(b"old")
    write_book(folder / "outro.xlsx", [HEADER, ["99", "P1", "a"]])
    for i, path in enumerate(sorted(folder.iterdir())):
        os.utime(path, (1_700_000_000 + i,) * 2)

    result, = apply_batch(workbook_files(spark, str(folder)), "b1", table, audit, TS[1])
    assert audit_of(result) == {
        "gproblemas_1.xlsx": (6, 3, 3, "sucesso"),
        "gproblemas_2.xlsx": (2, 0, 2, "falha"),
        "gproblemas_3.xlsx": (2, 0, 2, "falha"),
        "gproblemas_4.xlsx": (2, 0, 2, "falha"),
        "gproblemas_5.xlsx": (1, 0, 1, "falha"),
        "gproblemas_6.xlsx": (0, 0, 0, "falha"),
        "gproblemas_7.xlsx": (2, 2, 0, "sucesso"),
        "gproblemas_8.xlsx": (1, 0, 0, "sucesso"),
        "gproblemas_9.xlsx": (0, 0, 0, "sucesso"),
        "gproblemas_a.xlsx": (0, 0, 0, "falha"),
        "gproblemas_b.xls": (0, 0, 0, "falha"),
    }
    errors = {r.nm_arquivo: r.ds_erro for r in result.runs.collect() if r.ds_erro}
    assert "limite 5" in errors["gproblemas_2.xlsx"]
    assert "chave repetida" in errors["gproblemas_3.xlsx"]
    assert "fora da faixa" in errors["gproblemas_4.xlsx"]
    assert "mesmo nome" in errors["gproblemas_5.xlsx"]
    assert "não encontrada" in errors["gproblemas_6.xlsx"]
    assert ".xls" in errors["gproblemas_b.xls"]
    assert [r.id_log for r in result.runs.orderBy("id_log").collect()] == list(range(1, 12))

    got = table_rows(spark, table, "status", "dt_abertura", "dt_conclusao", "status_30_04", ORIGIN, "dt_atualizacao")
    assert got == {
        1: (None, None, None, "nota", "gproblemas_7.xlsx", TS[1]),  # the later file empties the row
        2: (None, None, None, None, "gproblemas_1.xlsx", None),
        3: ("Aberto", dt.date(2024, 1, 4), None, None, "gproblemas_1.xlsx", None),
        9: (None, None, None, "n9", "gproblemas_7.xlsx", None),
    }
    places = {r.nm_arquivo: r.nm_destino for r in result.destinations.collect()}
    assert places["gproblemas_1.xlsx"] == "processados/2024-05" and places["gproblemas_2.xlsx"] == "erros"
    assert result.alerts.count() == 11

    # the same batch id again changes nothing
    again, = apply_batch(workbook_files(spark, str(folder)), "b1", table, audit, TS[2])
    assert again.skipped and again.version == result.version
    assert read_audit(spark, audit).count() == 11

    # a replay only moves the update time
    before = table_rows(spark, table, "status_30_04", "dt_insert")
    tally = replay(spark, str(folder / "gproblemas_7.xlsx"), table, audit, "r1", TS[3]).first()
    assert tuple(tally) == (1, 0)
    assert table_rows(spark, table, "status_30_04", "dt_insert") == before
    assert table_rows(spark, table, "dt_atualizacao")[9] == (TS[3],)
    last = read_audit(spark, audit).filter("id_log = 12").first()
    assert (last.qt_linhas_inseridas, last.nm_arquivo) == (2, "gproblemas_7.xlsx")


def test_batches_of_any_size_give_one_table(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    paths = []
    for i in range(4):
        lines = ["Número,Status,Título"] + [f"{n},s{i},t{n}" for n in range(i, i + 5)]
        paths.append(csv_file(folder, f"gproblemas_{i}.csv", lines, age=100 - i * 10))
    results = []
    for split in ([paths], [[p] for p in paths]):
        table = SnapshotTable(str(tmp_path / f"t{len(split)}"), buckets=2)
        audit = str(tmp_path / f"a{len(split)}")
        for i, part in enumerate(split):
            ingest_delimited(spark, part, table, audit, f"b{i}", TS[0])
        runs = {
            r.nm_arquivo: (r.qt_linhas_recebidas, r.qt_linhas_inseridas, r.qt_linhas_rejeitadas)
            for r in read_audit(spark, audit).collect()
        }
        results.append((table_rows(spark, table, "status", "titulo", ORIGIN, "dt_insert"), runs))
    assert results[0] == results[1]


@pytest.mark.parametrize("title", ["plain", "two\nlines"])
def test_files_in_parts_are_one_file_each(spark, tmp_path, store, title):
    """Two files of three parts: a key in two parts of the first fails that file alone."""
    table, audit = store
    for name, keys in (("a", [1, 2, 1]), ("b", [3, 4, 5])):
        folder = tmp_path / "in" / f"arquivo={name}.csv"
        folder.mkdir(parents=True)
        for i, key in enumerate(keys):
            csv_file(folder, f"part-{i}.csv", ["Número,Título", f'{key},"{title}"'], age=50 - i)
    landing = L.load_delimited(spark, str(tmp_path / "in"), parts=True)
    assert landing.files.count() == 2 and landing.rows.count() == 6
    assert landing.rows.select(PATH, L.ARRIVAL).distinct().count() == 2
    tally = replay(spark, str(tmp_path / "in"), table, audit, "r", TS[0], fmt="csv", parts=True)
    assert tuple(tally.first()) == (1, 1)
    assert table_rows(spark, table, "titulo") == {k: (title,) for k in (3, 4, 5)}
    runs = {r.nm_arquivo: (r.qt_linhas_recebidas, r.ds_status) for r in read_audit(spark, audit).collect()}
    assert runs == {"arquivo=a.csv": (3, "falha"), "arquivo=b.csv": (3, "sucesso")}


def test_replayed_files_are_written_by_many_tasks(spark, monkeypatch):
    """No task takes a whole file, as the number of files does not grow with the rows."""
    import __spark_entry__ as entry_module

    seen = []

    def listed(spark, path, *args, **kwargs):
        seen.append(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).count())
        return replay(spark, path, *args, **kwargs)

    rows = entry_module.fx.faulty_landing_rows
    monkeypatch.setattr(entry_module, "replay", listed)
    monkeypatch.setattr(entry_module.fx, "faulty_landing_rows", lambda *a: rows(*a).repartition(3))
    assert tuple(entry_module.replay_tally(spark, "/root/testdata/sf0.001").first()) == (2, 2)
    assert seen == [12]


def test_batch_without_good_rows_writes_no_version(spark, tmp_path, store):
    table, audit = store
    path = csv_file(tmp_path, "gproblemas_x.csv", ["Número,Prioridade", "1,muito longa"])
    result = ingest_delimited(spark, path, table, audit, "b", TS[0])
    assert result.version == 0 and audit_of(result)["gproblemas_x.csv"] == (1, 0, 1, "falha")
    assert table.current(spark)[1].count() == 0


def test_keep_missing_option(spark, tmp_path, store):
    table, audit = store
    first = csv_file(tmp_path, "gproblemas_1.csv", ["Número,Título", "1,t"], age=50)
    second = csv_file(tmp_path, "gproblemas_2.csv", ["Número,Status", "1,Aberto"])
    ingest_delimited(spark, first, table, audit, "1", TS[0])
    ingest_batch(spark, L.load_delimited(spark, second), table, audit, "2", TS[1], keep_missing=True)
    assert table_rows(spark, table, "titulo", "status") == {1: ("t", "Aberto")}


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "s"), buckets=2)
    for i in range(4):
        rows = spark.createDataFrame([(i,)], "numero int")
        df = quality.to_staging(rows, PROBLEMS.production_schema())
        assert table.publish(df, f"b{i}", TS[0]) == i + 1
    assert table.publish(df, "b0", TS[0]) == 1
    assert [f[:3] for f in table.expire(spark)] == ["v=1", "v=2"]
    version, current = table.current(spark)
    assert version == 4 and [r.numero for r in current.collect()] == [3]
    assert table.publish(df.limit(0), "none", TS[0]) == 5
    assert table.current(spark)[1].collect() == []


def folders_of(df):
    return {f.split("/data/")[1].split("/part-")[0] for f in df.inputFiles()}


def test_a_batch_writes_and_reads_only_the_buckets_it_touches(spark, tmp_path, store):
    table, audit = SnapshotTable(str(tmp_path / "s"), buckets=8), str(tmp_path / "audit")
    df = quality.to_staging(spark.range(200).selectExpr("cast(id as int) numero"), PROBLEMS.production_schema())
    table.publish(df, "b", TS[0])
    before = folders_of(table.current(spark)[1])
    assert len(before) == 8
    path = csv_file(tmp_path, "gproblemas_1.csv", ["Número,Status", "5,novo", "6,novo"])
    result = ingest_delimited(spark, path, table, audit, "1", TS[1])
    assert result.totals["qt_atualizadas"] == 2 and result.totals["qt_inseridas"] == 0
    touched = table.touched(spark.createDataFrame([(5,), (6,)], "numero int"))
    after = folders_of(table.current(spark)[1])
    assert len(after) == 8 and len(after - before) == len(touched) < 8
    assert {f.split("=")[-1] for f in after - before} == {str(b) for b in touched}
    assert folders_of(table.part(spark, touched)[1]) == after - before
    rows = table_rows(spark, table, "status", "dt_atualizacao")
    assert len(rows) == 200 and rows[5] == ("novo", TS[1]) and rows[7] == (None, None)

    # Shared folders outlive the version that wrote them; replaced ones go.
    assert table.expire(spark, keep=2) == []
    gone = table.expire(spark, keep=1)
    assert set(gone) == before - after
    assert len(table_rows(spark, table)) == 200


def test_a_large_batch_is_not_shuffled_again_for_its_buckets(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "s"), buckets=3)
    df = quality.to_staging(spark.range(100).selectExpr("cast(id as int) numero"), PROBLEMS.production_schema())
    table.publish(df, "b", TS[0])
    tasks = table.tasks(spark)
    assert tasks == 6
    _, part = table.part(spark, [0, 1])
    sides = [side.repartition(tasks, F.col("numero")) for side in (part, df.select("numero", "status"))]
    merged = merge.merge_upsert(*sides, "numero", F.lit(TS[1]))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 2
    per_task = merged.select(F.spark_partition_id().alias("t"), table.bucket(spark).alias("b")).distinct()
    assert per_task.groupBy("t").count().agg(F.max("count")).first()[0] == 1


def test_landing_stream(spark, tmp_path, store):
    table, audit = store
    folder = tmp_path / "in"
    folder.mkdir()

    specs = [PROBLEMS, TableSpec(prefix="gmudancas", table="tb_x", key="k", columns=())]
    alerts = []

    def run():
        stream_landing(
            spark, str(folder), str(tmp_path / "cp"), table, audit, specs, settle_seconds=0.1,
            on_alerts=lambda rows: alerts.extend(r.nm_arquivo for r in rows.collect()),
        ).awaitTermination()

    write_book(folder / "gproblemas_1.xlsx", [HEADER, ["1", "P1", "Aberto"]])
    (folder / "gproblemas_2.xlsx").write_bytes(b"broken")
    write_book(folder / "gproblemas_3.XLSX", [HEADER, ["2", "P1", "Aberto"]])
    (folder / "gproblemas.txt").write_text("x")
    write_book(folder / "gmudancas_1.xlsx", [HEADER])
    run()
    assert sorted(alerts) == [
        "gmudancas_1.xlsx", "gproblemas_1.xlsx", "gproblemas_2.xlsx", "gproblemas_3.XLSX"]
    assert set(table_rows(spark, table)) == {1, 2}
    write_book(folder / "gproblemas_4.xlsx", [HEADER, ["1", "P2", "Resolvido"]])
    run()
    run()
    ids = [r.id_lote for r in table.commits(spark).select("id_lote").collect()]
    assert len(ids) == 2 and not any("None" in i for i in ids)
    assert table_rows(spark, table, "prioridade") == {1: ("P2",), 2: ("P1",)}
    statuses = sorted((r.nm_arquivo, r.ds_status) for r in read_audit(spark, audit).collect())
    assert statuses == [
        ("gproblemas_1.xlsx", "sucesso"), ("gproblemas_2.xlsx", "falha"),
        ("gproblemas_3.XLSX", "sucesso"), ("gproblemas_4.xlsx", "sucesso"),
    ]


def test_lookup_beyond_the_broadcast_bound(spark):
    from ticketlake.operators.lookup import join_lookup

    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("f"), "id"
    )
    lookup = rows.filter("id < 500").select("f").distinct().withColumn("v", F.lit(1))
    for how in ("inner", "left_anti", "left_semi"):
        small = sorted(map(tuple, join_lookup(rows, lookup, "f", how, True).collect()))
        salted = sorted(map(tuple, join_lookup(rows, lookup, "f", how, False).collect()))
        assert small == salted and small


def test_batch_is_done_again_after_a_crash_before_the_commit(spark, tmp_path, store, monkeypatch):
    table, audit = store
    path = csv_file(tmp_path, "gproblemas_1.csv", ["Número,Status", "1,Aberto"])
    commit = SnapshotTable.commit

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(SnapshotTable, "commit", crash)
    with pytest.raises(RuntimeError):
        ingest_delimited(spark, path, table, audit, "b", TS[0])
    monkeypatch.setattr(SnapshotTable, "commit", commit)
    assert table.current(spark)[0] == 0
    result = ingest_delimited(spark, path, table, audit, "b", TS[0])
    assert not result.skipped and result.version == 1
    assert [r.id_log for r in read_audit(spark, audit).collect()] == [1]
    assert table_rows(spark, table, "status") == {1: ("Aberto",)}


def test_merge_into_an_outdated_version_is_refused(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "s"), buckets=2)
    df = quality.to_staging(spark.range(3).selectExpr("cast(id as int) numero"), PROBLEMS.production_schema())
    first, second = table.write(df, 1), table.write(df, 1)
    assert table.commit(spark, 0, first, "a", TS[0]) == 1
    with pytest.raises(ConcurrentCommit):
        table.commit(spark, 0, second, "b", TS[0])


def test_file_names_with_blanks_and_accents(spark, tmp_path, store):
    table, audit = store
    folder = tmp_path / "pasta é 1"
    folder.mkdir()
    csv_file(folder, "gproblemas ação+1% 1.csv", ["Número,Status", "1,Aberto"])
    csv_file(folder, "gproblemas ação 2.csv", ["Status,Número", "Aberto,2"])
    result = ingest_delimited(spark, str(folder), table, audit, "b", TS[0])
    assert set(audit_of(result)) == {"gproblemas ação+1% 1.csv", "gproblemas ação 2.csv"}
    assert table_rows(spark, table, ORIGIN) == {
        1: ("gproblemas ação+1% 1.csv",), 2: ("gproblemas ação 2.csv",)}
    write_book(folder / "gproblemas ç.xlsx", [HEADER, ["3", "P1", "x"]])
    rows, = apply_batch(workbook_files(spark, str(folder)), "c", table, audit, TS[1])
    assert set(audit_of(rows)) == {"gproblemas ç.xlsx"}


def test_batch_leaves_no_intermediates(spark, tmp_path, store):
    from ticketlake.session import scratch_root

    table, audit = store
    folder = scratch_root(spark) + "/ticketlake"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    path = csv_file(tmp_path, "gproblemas_1.csv", ["Número,Status", "1,Aberto"])
    result = ingest_delimited(spark, path, table, audit, "b", TS[0])
    assert set(os.listdir(folder)) == before
    assert audit_of(result) == {"gproblemas_1.csv": (1, 1, 0, "sucesso")}


@pytest.mark.parametrize("name", ["gproblemas_1.xlsx", "outros.xlsx"])
def test_stream_survives_a_batch_without_readable_workbooks(spark, tmp_path, store, name):
    table, audit = store
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        stream_landing(spark, str(folder), str(tmp_path / "cp"), table, audit, settle_seconds=0.1).awaitTermination()

    (folder / name).write_bytes(b"broken")
    run()
    write_book(folder / "gproblemas_2.xlsx", [HEADER, ["1", "P1", "Aberto"]])
    run()
    assert table.current(spark)[1].count() == 1
    runs = {r.nm_arquivo: r.ds_status for r in read_audit(spark, audit).collect()}
    assert runs.pop("gproblemas_2.xlsx") == "sucesso"
    assert runs == ({name: "falha"} if name.startswith("gproblemas") else {})


def test_commit_without_data_keeps_the_bucket_count(spark, tmp_path):
    path = str(tmp_path / "s")
    df = quality.to_staging(spark.range(200).selectExpr("cast(id as int) numero"), PROBLEMS.production_schema())
    SnapshotTable(path, buckets=4).publish(df, "a", TS[0])
    other = SnapshotTable(path, buckets=16)
    other.commit(spark, 1, None, "b", TS[1])
    assert {r.qt_baldes for r in other.commits(spark).collect()} == {4}
    assert other.publish(df, "c", TS[1]) == 2
    assert len(folders_of(other.current(spark)[1])) == 4
    assert other.current(spark)[1].count() == 200


# Identity, several tables, settling -------------------------------------------------------------
OTHER = TableSpec(
    prefix="gmudancas", table="tb_mudancas", key="numero", sheet=1,
    columns=(*PROBLEMS.columns[:1], *(c for c in PROBLEMS.columns if c.name in ("status", ORIGIN))),
    rename={"Número": "numero", "Status": "status"},
)


def two_tables(tmp_path):
    return [SnapshotTable(str(tmp_path / "t1"), buckets=2), SnapshotTable(str(tmp_path / "t2"), OTHER, buckets=2)]


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path, store):
    table, audit = store
    for i, rows in enumerate((["1,a", "2,a"], ["2,b", "3,b", "x,b"])):
        (tmp_path / str(i)).mkdir()
        csv_file(tmp_path / str(i), "gproblemas.csv", ["Número,Status", *rows], age=50 - 10 * i)
    result = ingest_delimited(spark, [str(tmp_path / "0"), str(tmp_path / "1")], table, audit, "b", TS[0])
    runs = sorted((r.nm_caminho[-16:], r.qt_linhas_recebidas, r.qt_linhas_inseridas) for r in read_audit(spark, audit).collect())
    assert runs == [("0/gproblemas.csv", 2, 2), ("1/gproblemas.csv", 3, 2)]
    assert table_rows(spark, table, "status") == {1: ("a",), 2: ("b",), 3: ("b",)}
    assert result.totals["qt_inseridas"] == 3 and result.totals["qt_atualizadas"] == 0


def test_two_tables_and_a_crash_between_their_commits(spark, tmp_path, monkeypatch):
    tables, audit, folder = two_tables(tmp_path), str(tmp_path / "audit"), tmp_path / "in"
    folder.mkdir()
    write_book(folder / "gproblemas_1.xlsx", [HEADER, ["1", "P1", "Aberto"]])
    write_book(folder / "gmudancas_1.xlsx", [["Número", "Status", "Só aqui"], ["7", "s", "t"], ["8", "s", None]])
    specs, commit, seen = [PROBLEMS, OTHER], SnapshotTable.commit, []

    def crash(self, *args, **kwargs):
        if self.spec is OTHER and not seen:
            seen.append(1)
            raise RuntimeError("lost")
        return commit(self, *args, **kwargs)

    def run():
        stream_landing(
            spark, str(folder), str(tmp_path / "cp"), tables, audit, specs, settle_seconds=0.1
        ).awaitTermination()

    monkeypatch.setattr(SnapshotTable, "commit", crash)
    with pytest.raises(Exception, match="lost"):
        run()
    assert set(table_rows(spark, tables[0])) == {1} and tables[1].current(spark)[0] == 0
    assert [r.nm_arquivo for r in read_audit(spark, audit).collect()] == ["gproblemas_1.xlsx"]
    run()
    assert table_rows(spark, tables[1], "status", "s_aqui") == {7: ("s", "t"), 8: ("s", None)}
    assert "s_aqui" not in tables[0].current(spark)[1].columns
    assert [t.current(spark)[0] for t in tables] == [1, 1]
    runs = sorted((r.nm_arquivo, r.nm_tabela_destino, r.qt_linhas_inseridas) for r in read_audit(spark, audit).collect())
    assert runs == [("gmudancas_1.xlsx", "tb_mudancas", 2), ("gproblemas_1.xlsx", "tb_problemas_gov_ti", 1)]


def test_a_growing_file_is_ingested_once_and_whole(spark, tmp_path, store, monkeypatch):
    table, audit = store
    folder = tmp_path / "in"
    folder.mkdir()
    whole = write_book(tmp_path / "whole.xlsx", [HEADER, *[[str(i), "P1", "Aberto"] for i in range(50)]])
    content = open(whole, "rb").read()
    path = folder / "gproblemas_1.xlsx"

    def run(**options):
        stream_landing(
            spark, str(folder), str(tmp_path / "cp"), table, audit, settle_seconds=0.1, **options
        ).awaitTermination()

    def while_copied(spark, directory, sightings, glob, seconds):
        """The file grows between the two looks."""
        for part in (content[:500], content[:1500]):
            path.write_bytes(part)
            settled.sight(spark, directory, sightings, glob)

    with monkeypatch.context() as patched:
        patched.setattr(stream, "look", while_copied)
        run()
    assert table.current(spark)[0] == 0 and read_audit(spark, audit).count() == 0
    path.write_bytes(content)
    run()
    run()
    assert len(table_rows(spark, table)) == 50
    assert [(r.ds_status, r.qt_linhas_recebidas) for r in read_audit(spark, audit).collect()] == [("sucesso", 50)]
    # The same content under the same path is known, also if its time changes; other content is new.
    os.utime(path, (1_800_000_000,) * 2)
    run()
    assert read_audit(spark, audit).count() == 1
    write_book(path, [HEADER, ["99", "P1", "Aberto"]])
    run(archive_dir=str(tmp_path / "archive"))
    assert len(table_rows(spark, table)) == 51 and not path.exists()
    kept = [p.name for p in (tmp_path / "archive").rglob("*.xlsx")]
    assert kept == ["gproblemas_1.xlsx"]


def test_archive_leaves_unrouted_files_alone(spark, tmp_path, store):
    table, audit = store
    folder = tmp_path / "in"
    folder.mkdir()
    write_book(folder / "gproblemas_1.xlsx", [HEADER, ["1", "P1", "Aberto"]])
    (folder / "gproblemas_2.xlsx").write_bytes(b"broken")
    write_book(folder / "outro.xlsx", [HEADER, ["2", "P1", "Aberto"]])
    stream_landing(
        spark, str(folder), str(tmp_path / "cp"), table, audit, settle_seconds=0.1, archive_dir=str(tmp_path / "done")
    ).awaitTermination()
    assert [p.name for p in folder.iterdir()] == ["outro.xlsx"]
    moved = {p.name: p.parent.name for p in (tmp_path / "done").rglob("*.xlsx")}
    assert moved["gproblemas_2.xlsx"] == "erros" and len(moved) == 2


def test_replay_counts_files_that_no_table_takes(spark, tmp_path, store):
    table, audit = store
    folder = tmp_path / "erros"
    folder.mkdir()
    write_book(folder / "gproblemas_1.xlsx", [HEADER, ["1", "P1", "Aberto"]])
    write_book(folder / "outro.xlsx", [HEADER, ["2", "P1", "Aberto"]])
    assert tuple(replay(spark, str(folder), table, audit, "1", TS[0]).first()) == (1, 1)
    assert tuple(replay(spark, str(folder / "outro.xlsx"), table, audit, "2", TS[0]).first()) == (0, 1)


def test_runs_of_a_refused_batch_stay_hidden(spark, tmp_path, store, monkeypatch):
    table, audit = store
    commit = SnapshotTable.commit
    first = csv_file(tmp_path, "gproblemas_1.csv", ["Número,Status", "1,a"])

    def refuse(self, spark, base, *args):
        return commit(self, spark, base - 1, *args)

    monkeypatch.setattr(SnapshotTable, "commit", refuse)
    with pytest.raises(ConcurrentCommit):
        ingest_delimited(spark, first, table, audit, "a", TS[0])
    assert read_audit(spark, audit).count() == 0
    monkeypatch.setattr(SnapshotTable, "commit", commit)
    second = csv_file(tmp_path, "gproblemas_2.csv", ["Número,Status", "2,a"])
    ingest_delimited(spark, second, table, audit, "b", TS[0])
    assert [(r.id_log, r.nm_arquivo) for r in read_audit(spark, audit).collect()] == [(1, "gproblemas_2.csv")]


def test_seconds_are_those_of_the_file(spark, tmp_path, store):
    table, audit = store
    large = ["Número,Status"] + [f"{i},a" for i in range(2000)]
    csv_file(tmp_path, "gproblemas_1.csv", large)
    csv_file(tmp_path, "gproblemas_2.csv", ["Número,Status", "9001,a"])
    result = ingest_delimited(spark, str(tmp_path / "*.csv"), table, audit, "b", TS[0])
    seconds = {r.nm_arquivo: float(r.tm_duracao_seg) for r in result.runs.collect()}
    assert seconds["gproblemas_1.csv"] > 10 * seconds["gproblemas_2.csv"]


# Layouts and line breaks ------------------------------------------------------------------------
def test_more_layouts_than_any_bound(spark):
    n, names = 20_001, ("Número", "Status", "Título", "Sistema", "Paliativo", "Impacto", "Prioridade", "Descrição")
    headers = list(itertools.islice(itertools.permutations(names), n))
    rows = [(f"f{i}", TS[0], [str(i) if c == "Número" else c.lower() for c in h], list(h)) for i, h in enumerate(headers)]
    named = spark.createDataFrame(
        rows, f"{PATH} string, {L.ARRIVAL} timestamp_ntz, {L.CELLS} array<string>, cabecalho array<string>"
    ).withColumn(ORIGIN, F.col(PATH))
    landing = L.finished(named.drop("cabecalho"), L.file_rows(named.drop(L.CELLS)), Scratch())
    assert landing.layouts.count() == n
    found, columns = project_landing(landing, PROBLEMS, resolve_layouts(landing.layouts, PROBLEMS))
    assert len(columns) == len(names)
    totals = found.agg(F.countDistinct("numero"), F.min("status"), F.max("status"), F.min("impacto"), F.max("impacto"))
    assert tuple(totals.first()) == (n, "status", "status", "impacto", "impacto")


def test_surplus_cells_fail_their_file_only(spark, tmp_path, store):
    table, audit = store
    csv_file(tmp_path, "gproblemas_1.csv", ["Número,Status", "1,a,sobra", "2,b,,,"])
    csv_file(tmp_path, "gproblemas_2.csv", ["Número,Status,Título", "3,a,t", '4,"a, b",t,,'])
    csv_file(tmp_path, "gproblemas_3.csv", ["Número,Status", "5,a,,,,lá longe"])
    result = ingest_delimited(spark, str(tmp_path / "*.csv"), table, audit, "b", TS[0])
    assert {n: r[3] for n, r in audit_of(result).items()} == {
        "gproblemas_1.csv": "falha", "gproblemas_2.csv": "sucesso", "gproblemas_3.csv": "falha"}
    assert table_rows(spark, table, "status") == {3: ("a",), 4: ("a, b",)}
    errors = {r.nm_arquivo: r.ds_erro for r in result.runs.collect()}
    assert "mais células" in errors["gproblemas_1.csv"]
    with pytest.raises(Exception, match="mais células"):
        L.read_landing(spark, str(tmp_path / "gproblemas_1.csv"), "csv").collect()


def test_quoted_line_breaks_survive(spark, tmp_path, store):
    table, audit = store
    csv_file(tmp_path, "gproblemas_1.csv", ['Número,Status,"Tít""ulo"', '1,"Em', 'andamento",x', '2,"a ""b""",y'])
    csv_file(tmp_path, "gproblemas_2.csv", ["Status,Número", "Aberto,3", '"c ""d""",4'])
    csv_file(tmp_path, "gproblemas_3.csv", ['"Sta', 'tus",Número,Status', '"q', 'r",5,s'])
    for multi_line in (None, True):
        df = L.read_landing(spark, str(tmp_path / "*.csv"), "csv", multi_line=multi_line)
        got = {r["Número"]: (r["Status"], r['Tít"ulo'], r["Sta\ntus"]) for r in df.collect()}
        assert got == {
            "1": ("Em\nandamento", "x", None), "2": ('a "b"', "y", None), "3": ("Aberto", None, None),
            "4": ('c "d"', None, None), "5": ("s", None, "q\nr")}
    result = ingest_delimited(spark, str(tmp_path / "*.csv"), table, audit, "b", TS[0])
    assert {r[3] for r in audit_of(result).values()} == {"sucesso"}
    assert table_rows(spark, table, "status")[1] == ("Em\nandamento",)


def test_delimited_options(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeff'N;m';Céu\r\n1;'x;y'\r\n\r\n2;z\r\n".encode("latin-1", "ignore"))
    df = L.read_landing(spark, str(tmp_path / "a.csv"), "csv", sep=";", quote="'", encoding="ISO-8859-1")
    assert sorted((r["N;m"], r["Céu"]) for r in df.collect()) == [("1", "x;y"), ("2", "z")]
    (tmp_path / "b.csv").write_bytes("\ufeffNúmero,B\n\n7,é\n".encode())
    df = L.read_landing(spark, str(tmp_path / "b.csv"), "csv")
    assert [(r["Número"], r["B"]) for r in df.collect()] == [("7", "é")]
    (tmp_path / "c.csv").write_text("")
    assert L.read_landing(spark, str(tmp_path / "c.csv"), "csv").count() == 0


def test_parquet_files_whose_types_do_not_go_together(spark, tmp_path, store):
    table, audit = store
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "a")], "`Número` int, `Status` string").coalesce(1).write.parquet(path)
    spark.createDataFrame([("2", 5)], "`Número` string, `Prioridade` int").coalesce(1).write.mode("append").parquet(path)
    result = ingest_batch(spark, L.load_parquet(spark, path), table, audit, "b", TS[0])
    assert {r[3] for r in audit_of(result).values()} == {"sucesso"}
    assert table_rows(spark, table, "status", "prioridade") == {1: ("a", None), 2: (None, "5")}
