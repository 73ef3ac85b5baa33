"""Input frames of the registered queries, derived from the driver's tables.

The bindings follow FIXTURES.md, over whole tables. ``numero`` is BIGINT here: the
order keys of a large data set do not fit the INT of the product's own table.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators.lookup import number_rows
from ticketlake.operators.quality import to_staging
from ticketlake.sources.landing import ARRIVAL, CELLS, Landing, file_rows, finished
from ticketlake.session import Scratch
from ticketlake.spec import CREATED, ORIGIN, PATH, PROBLEMS, UPDATED

SPEC = PROBLEMS.with_key_type(T.LongType())
EXTRA_HEADER = "Status 30/04"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production table. Customers get their nation and region first: those two
    tables have a fixed size, so the orders pass through one large join only."""
    customers = (
        read(spark, sf_dir, "customer")
        .join(F.broadcast(read(spark, sf_dir, "nation")), F.expr("c_nationkey = n_nationkey"))
        .join(F.broadcast(read(spark, sf_dir, "region")), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", "c_mktsegment", "n_name", "r_name")
    )
    orders = read(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(key % 97 == 0, None)
        .when(key % 7 == 0, "Cancelado")
        .when(F.col("o_orderstatus") == "F", "Resolvido")
        .when(F.col("o_orderstatus") == "P", "Em andamento")
        .otherwise("Aberto")
    )
    return orders.join(customers, F.expr("o_custkey = c_custkey")).select(
        key.cast("long").alias("numero"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("prioridade"),
        F.concat(F.lit("Order "), _text("o_orderkey")).alias("titulo"),
        F.to_date("o_orderdate").alias("dt_abertura"),
        status.alias("status"),
        F.when(customer % 13 != 0, F.col("n_name")).alias("gerente_responsavel"),
        F.col("c_mktsegment").alias("departamento_relator"),
        F.when(key % 11 != 0, F.col("r_name")).alias("jornada_impactada"),
        F.concat(F.lit("SYS"), (customer % 20).cast("string")).alias("sistema"),
        F.when(key % 3 == 0, "Sim").when(key % 3 == 1, "Não").alias("paliativo"),
        F.concat(F.lit("Impact "), (key % 5).cast("string")).alias("impacto"),
    )


def etl_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table."""
    received = (F.col("user_id") + F.col("event_id") % 50).cast("int")
    failed = F.col("event_type") == "error"
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id_log"),
        F.concat(F.lit("gproblemas_"), _text("user_id"), F.lit(".xlsx")).alias("nm_arquivo"),
        F.lit(PROBLEMS.table).alias("nm_tabela_destino"),
        F.col("ts").cast("timestamp_ntz").alias("dt_processamento"),
        received.alias("qt_linhas_recebidas"),
        F.when(failed, 0).otherwise(F.col("user_id").cast("int")).alias("qt_linhas_inseridas"),
        F.when(failed, received)
        .otherwise((F.col("event_id") % 50).cast("int"))
        .alias("qt_linhas_rejeitadas"),
        F.when(failed, "falha")
        .when(F.col("event_type") == "signup", "parcial")
        .otherwise("sucesso")
        .alias("ds_status"),
        F.lit(None).cast("string").alias("ds_erro"),
        F.col("value").cast("decimal(10,2)").alias("tm_duracao_seg"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server log: one file per day, its lines numbered in time order."""
    stamp = F.concat(F.substring(_text("ts"), 1, 19), F.lit(",123 "))
    kind, user, event = F.col("event_type"), _text("user_id"), _text("event_id")
    line = (
        F.when(kind == "error", F.concat(stamp, F.lit("ERROR mod.user"), user, F.lit(" :: failure "), "props"))
        .when(kind == "signup", F.concat(stamp, F.lit("WARN mod.query :: slow SQL "), "props"))
        .when(kind == "purchase", F.concat(stamp, F.lit("WARN mod.cache :: evicted "), "props"))
        .when(kind == "click", F.concat(F.lit("    at com.example.Call"), event))
        .otherwise(F.concat(F.lit("Caused by: reason "), event))
    )
    events = read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("log_file"), "ts", "event_id", line.alias("line")
    )
    hour = F.date_trunc("hour", "ts")
    return number_rows(events, ["ts", "event_id"], "line_no", ["log_file"], hour).select(
        "log_file", "line_no", "line"
    )


# Landing files -----------------------------------------------------------------------
def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet rows: four files with bad keys, bad dates, missing-value words,
    empty rows, two junk columns and one header the table does not know."""
    rows = problems(spark, sf_dir)
    n = F.col("numero")
    key = F.when(n % 17 == 0, "abc").when(n % 19 == 0, F.concat(_text("numero"), F.lit(".7")))
    iso = _text("dt_abertura")
    us_date = F.concat_ws("/", F.substring(iso, 6, 2), F.substring(iso, 9, 2), F.substring(iso, 1, 4))
    opened = (
        F.when(n % 23 == 0, "foo")
        .when(n % 3 == 0, us_date)
        .when(n % 3 == 1, F.concat(iso, F.lit(" 00:00:00")))
        .otherwise(iso)
    )
    closed = (
        F.when(n % 5 == 0, "\t10/05 ")
        .when(n % 5 == 1, "nan")
        .when(n % 5 == 2, " NaT ")
        .when(n % 5 == 3, "sem data")
    )
    cells = {
        "Número": key.otherwise(_text("numero")),
        "Prioridade": F.col("prioridade"),
        "Título": F.col("titulo"),
        "Data": opened,
        "Data de conclusão": closed,
        "Status": F.col("status"),
        "Gerente responsável": F.col("gerente_responsavel"),
        "Departamento relator": F.col("departamento_relator"),
        "Jornada impactada": F.col("jornada_impactada"),
        "Sistema": F.col("sistema"),
        "Paliativo": F.col("paliativo"),
        "Impacto": F.when(n % 29 == 0, "N/A").otherwise(F.col("impacto")),
        " ": F.lit("x"),
        " .1": F.lit(None).cast("string"),
        EXTRA_HEADER: F.when(n % 31 == 0, F.concat(F.lit("nota "), _text("numero"))),
    }
    filled = {h: (c if h == " " else F.when(n % 37 != 0, c)) for h, c in cells.items()}
    return rows.select(
        *[c.alias(h) for h, c in filled.items()],
        F.concat(F.lit("gproblemas_"), (n % 4).cast("string"), F.lit(".csv")).alias(ORIGIN),
    )


def faulty_landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing files with too long texts in file 3 and repeated rows in file 2."""
    rows = landing_rows(spark, sf_dir)
    number = F.col("`Número`").try_cast("long")
    too_long = (F.col(ORIGIN) == "gproblemas_3.csv") & (number % 29 == 0)
    longer = rows.withColumn(
        "Prioridade", F.when(too_long, "URGENTE").otherwise(F.col("Prioridade"))
    )
    repeated = F.when((F.col(ORIGIN) == "gproblemas_2.csv") & (number % 31 == 0), 2).otherwise(1)
    return longer.withColumn("_copia", F.explode(F.sequence(F.lit(1), repeated))).drop("_copia")


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production before the merge: every problem with an even number."""
    rows = to_staging(problems(spark, sf_dir).filter("numero % 2 = 0"), SPEC.staging_schema())
    return rows.withColumn(CREATED, F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")).withColumn(
        UPDATED, F.lit(None).cast("timestamp_ntz")
    )


def reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small batch: the problems of the last day, reopened."""
    rows = problems(spark, sf_dir)
    last = rows.agg(F.max("dt_abertura").alias("_dia"))
    late = rows.join(F.broadcast(last), F.expr("dt_abertura = _dia")).drop("_dia")
    return late.withColumns({"status": F.lit("Reaberto"), ORIGIN: F.lit("gproblemas_reabertos.csv")})


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header row per customer: the priorities of their orders, some of them empty."""
    cell = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority"))
    named = read(spark, sf_dir, "orders").select("o_custkey", F.struct("o_orderkey", cell.alias("h")).alias("c"))
    cells = F.array_sort(F.collect_list("c"))
    headers = named.groupBy("o_custkey").agg(cells.alias("c"))
    return headers.select("o_custkey", F.transform("c", lambda c: c["h"]).alias("cabecalho"))


def mixed_layouts(spark: SparkSession, sf_dir: str) -> Landing:
    """Seven files with a header row each: five orders of the columns, one without the
    status, one with columns to be dropped."""
    rows = problems(spark, sf_dir)
    names = ("Número", "Prioridade", "Título", "Status", "Sistema")
    values = [_text("numero"), *[F.col(c) for c in ("prioridade", "titulo", "status", "sistema")]]
    kind = (F.col("numero") % 7).cast("int")
    x = F.lit("x")

    def by_kind(cells: list[Column], junk: Column, more: Column) -> Column:
        turned = [F.array(*cells[k:], *cells[:k]) for k in range(5)]
        layouts = [*turned, F.array(*cells[:3], cells[4]), F.array(junk, cells[0], more, *cells[1:])]
        chosen = F.when(kind == 0, layouts[0])
        for k, layout in enumerate(layouts[1:], 1):
            chosen = chosen.when(kind == k, layout)
        return chosen

    origin = F.concat(F.lit("gproblemas_"), kind.cast("string"), F.lit(".csv")).alias(ORIGIN)
    arrival = F.expr("TIMESTAMP_NTZ '2024-05-01 00:00:00'").alias(ARRIVAL)
    cells = by_kind(values, x, x).alias(CELLS)
    header = by_kind([F.lit(n) for n in names], F.lit(" "), F.lit(" ")).alias("cabecalho")
    named = rows.select(origin, arrival, cells, header).withColumn(PATH, F.col(ORIGIN))
    files = named.select(PATH, ORIGIN, ARRIVAL, "cabecalho").distinct()
    return finished(named.select(PATH, ORIGIN, ARRIVAL, CELLS), file_rows(files), Scratch())


# Workbooks -----------------------------------------------------------------------------
BOOK_ROWS = 5_000
_BOOK_COLUMNS = ("Número", "Título", "Status", "Paliativo")
_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _book(rows: pd.DataFrame) -> pd.DataFrame:
    """One small workbook: a sheet of text cells under a header row."""

    def line(values) -> str:
        cells = (
            "<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            for v in values
        )
        return f"<row>{''.join(cells)}</row>"

    ordered = rows.sort_values("_ordem")
    body = line(_BOOK_COLUMNS) + "".join(map(line, ordered[list(_BOOK_COLUMNS)].itertuples(index=False)))
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as book:
        sheet = f'<sheet name="{PROBLEMS.sheet}" sheetId="1" r:id="rId1"/>'
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS}" xmlns:r="{_REL}"><sheets>{sheet}</sheets></workbook>')
        relation = '<Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/>'
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{relation}</Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_NS}"><sheetData>{body}</sheetData></worksheet>')
    return pd.DataFrame({ORIGIN: [rows[ORIGIN].iloc[0]], "content": [content.getvalue()]})


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The problems as workbook files of some thousand rows each."""
    number = F.floor(F.col("numero") / BOOK_ROWS).cast("string")
    cells = [_text("numero"), F.col("titulo"), F.col("status"), F.col("paliativo")]
    rows = problems(spark, sf_dir).select(
        F.concat(F.lit("gproblemas_"), number, F.lit(".xlsx")).alias(ORIGIN), F.col("numero").alias("_ordem"),
        *[c.alias(n) for c, n in zip(cells, _BOOK_COLUMNS, strict=True)],
    )
    books = rows.groupBy(ORIGIN).applyInPandas(_book, f"{ORIGIN} string, content binary")
    arrival = F.expr("TIMESTAMP_NTZ '2024-05-01 00:00:00'").alias(ARRIVAL)
    return books.select(F.col(ORIGIN).alias(PATH), ORIGIN, arrival, "content")
