"""Landing files: every cell a string, one file one unit of failure.

Files of one batch may have different header rows. Rows stay arrays of cells; header rows
(``layouts``) are a table, and the place of each final column per layout is data that is
joined to the rows, so any number of layouts needs one scan and one plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.columns import dedupe_headers, file_name, file_path
from ticketlake.operators.lookup import join_lookup
from ticketlake.operators.quality import SURPLUS
from ticketlake.session import Scratch, materialize
from ticketlake.sources.workbook import decode_workbooks
from ticketlake.spec import ORIGIN, PATH, SETTLE_SECONDS
from ticketlake.storage.snapshot import literal_path

ARRIVAL = "dt_chegada"
LAYOUT = "id_layout"
CELLS = "celulas"
#: Of a file: seconds its decoding took, digest of its bytes if they were read whole.
SECONDS, DIGEST = "tm_leitura", "ds_sha256"
_HEADER, _PLACES = "cabecalho", "_lugares"
# Path of the part a record was read from: of the file itself, unless it was written in parts.
_PART = "_parte"


@dataclass
class Landing:
    """Rows of a set of files.

    ``rows``: path, file name, arrival and cells. ``files``: one row per file with its
    layout, or the reason if it is unreadable. ``layouts``: header names per layout.
    """

    rows: DataFrame
    files: DataFrame
    layouts: DataFrame
    scratch: Scratch = field(default_factory=Scratch)

    def placed(self, places: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
        """Rows with the given columns, whose cells lie where ``places`` says.

        ``places`` has one row per layout: an array with the position of each column (null
        if the layout lacks it), and the columns ``more``. Cells beyond the header raise the
        flag ``_excedente``.
        """
        per_file = self.files.join(places, LAYOUT, "left").join(
            self.layouts.select(LAYOUT, F.size(_HEADER).alias("_largura")), LAYOUT, "left"
        )
        rows = join_lookup(self.rows, per_file.select(PATH, _PLACES, "_largura", *more), PATH)
        filled = F.exists(F.slice(CELLS, F.col("_largura") + 1, F.size(CELLS)), lambda c: c.isNotNull())
        cells = F.transform(_PLACES, lambda p: F.get(CELLS, p))
        rows = rows.withColumns({"_celulas": cells, SURPLUS: F.coalesce(filled, F.lit(False))})
        values = [F.get("_celulas", F.lit(i)).alias(c) for i, c in enumerate(columns)]
        return rows.select(*values, ORIGIN, PATH, ARRIVAL, SURPLUS, *more)

    def to_frame(self) -> DataFrame:
        """One string column per header over all files, plus file name and arrival."""
        listed = self.layouts.select(F.posexplode(_HEADER).alias("_lugar", "_nome"))
        first = listed.groupBy("_nome").agg(F.min("_lugar").alias("_lugar")).orderBy("_lugar", "_nome")
        names = [r["_nome"] for r in first.collect()]  # the columns of the result
        places = self.layouts.select(LAYOUT, _positions(names, F.col(_HEADER), _indices(F.col(_HEADER))))
        rows = self.placed(places, names)
        lost = F.raise_error(F.concat(F.lit("mais células que o cabeçalho em "), F.col(PATH))).cast("string")
        return rows.withColumn(ORIGIN, F.when(F.col(SURPLUS), lost).otherwise(F.col(ORIGIN))).drop(PATH, SURPLUS)


def _indices(header: Column) -> Column:
    return F.transform(header, lambda _, i: i)


def _positions(columns: Sequence[str], names: Column, places: Column) -> Column:
    """Array with the place of each column, null where there is none."""
    where = F.map_from_arrays(names, places)
    wanted = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    return F.transform(wanted, lambda c: F.try_element_at(where, c)).alias(_PLACES)


def column_places(layouts: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """Places of final columns per layout; ``layouts`` has ``nomes`` and their ``posicoes``."""
    return layouts.select(LAYOUT, _positions(columns, F.col("nomes"), F.col("posicoes")), *more)


def with_layouts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with the id of their header row (column ``cabecalho``), and the table of layouts.

    The id is a hash of the names, so numbering needs no sort and no limit.
    """
    named = files.withColumn(_HEADER, dedupe_headers(_HEADER))
    numbered = named.withColumn(LAYOUT, F.when(F.col(_HEADER).isNotNull(), F.xxhash64(_HEADER)))
    layouts = numbered.filter(F.col(_HEADER).isNotNull()).select(LAYOUT, _HEADER).distinct()
    return numbered.drop(_HEADER), layouts


def finished(rows: DataFrame, files: DataFrame, scratch: Scratch) -> Landing:
    """Landing of rows and of files (path, name, arrival, header, error, seconds, digest)."""
    files, layouts = with_layouts(materialize(files, "files", scratch))
    return Landing(rows, files, materialize(layouts, "layouts", scratch), scratch)


def _arrival() -> Column:
    return F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias(ARRIVAL)


def file_rows(files: DataFrame) -> DataFrame:
    """Files that were not read whole: no error, no seconds, no digest so far."""
    none = F.lit(None).cast("string")
    return files.withColumns({"ds_erro": none, SECONDS: F.lit(0.0), DIGEST: none})


def _file_listing(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """Path, name and arrival of files; their content is not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(file_path().alias(PATH), file_name().alias(ORIGIN), _arrival())


# Delimited files --------------------------------------------------------------------------
def _cells(line: Column, sep: str, quote: str) -> Column:
    """Cells of a header line, null where empty."""
    q, s = ("".join(f"\\x{{{ord(c):x}}}" for c in text) for text in (quote, sep))
    cell = f"(?s){s}({q}(?:[^{q}]|{q}{q})*+{q}(?={s}|$)|(?:(?!{s}).)*+)"
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(cell), F.lit(1))
    bare = lambda c: F.when(
        c.startswith(quote) & c.endswith(quote) & (F.length(c) > 1),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit(quote * 2), F.lit(quote)),
    ).otherwise(c)
    return F.transform(found, lambda c: F.nullif(bare(c), F.lit("")))


def load_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    quote: str = '"',
    encoding: str = "UTF-8",
    multi_line: bool | None = None,
    glob: str | None = None,
    parts: bool = False,
) -> Landing:
    """Delimited text files with a header row each.

    Files are read in splits, one record per line. A file with a line of unpaired quotes has
    line breaks inside cells and goes to the reader that takes a file whole; ``multi_line``
    sets the reader of all files instead. Rows with more filled cells than their header fail
    their file. With ``parts`` each folder that holds files is one file, which goes by the
    folder's name and path: its files are the parts that many tasks wrote, each under the same
    header. It arrives with its last part.
    """
    scratch = Scratch()
    listing = _file_listing(spark, path, glob)
    file, name = file_path(), file_name()
    if parts:
        folder = lambda part: F.regexp_extract(part, "^(.*)/[^/]*$", 1)
        file, name = folder(file), F.substring_index(folder(file), "/", -1)
        whole_files = listing.groupBy(folder(F.col(PATH)).alias(PATH)).agg(F.max(ARRIVAL).alias(ARRIVAL))
        whole_files = whole_files.select(PATH, F.substring_index(PATH, "/", -1).alias(ORIGIN), ARRIVAL)
        listing = materialize(whole_files, "listing", scratch)

    def reader():
        options = {"sep": sep, "quote": quote, "escape": quote, "encoding": encoding}
        return spark.read.options(**options, **({"pathGlobFilter": glob} if glob else {}))

    text = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    line = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        line = F.decode(line.cast("binary"), encoding)
    block = F.col("_metadata.file_block_start").alias("_bloco")
    lines = text.text(path).select(line.alias("_linha"), file.alias(PATH), block)
    # The first line of a file, or of each of its parts, is the first row of its first split.
    starts = lines.filter("_bloco = 0 AND trim(_linha) <> ''").withColumn("_seq", F.monotonically_increasing_id())
    heads = starts.groupBy(PATH).agg(F.min_by("_linha", "_seq").alias("_linha"))
    heads = heads.select(PATH, _cells(F.regexp_replace("_linha", "^﻿", ""), sep, quote).alias(_HEADER))
    heads = materialize(heads, "headers", scratch)
    width = max(heads.agg(F.max(F.size(_HEADER))).first()[0] or 0, 1)
    if multi_line:
        whole = [r[PATH] for r in listing.select(PATH).collect()]  # names of files
    else:
        times = lambda mark: (F.length("_linha") - F.length(F.replace("_linha", F.lit(mark), F.lit("")))) / len(mark)
        # Only lines with more separators than any header has cells for are cut into cells.
        filled = F.when(times(sep) >= width, F.size(_until_last(_cells(F.col("_linha"), sep, quote))))
        odd = F.max(times(quote) % 2).alias("_quebra")
        stats = materialize(lines.groupBy(PATH).agg(odd, F.max(filled).alias("_largura")), "stats", scratch)
        broken = stats.filter("_quebra = 1") if multi_line is None else stats.limit(0)
        whole = [r[PATH] for r in broken.select(PATH).collect()]  # names of files to be read whole
        width = max(width, stats.agg(F.max("_largura")).first()[0] or 0)
    found = [F.array(*[F.col(f"c{i}") for i in range(width)]).alias(CELLS)]
    named = [file.alias(PATH), name.alias(ORIGIN), _arrival()]
    schema = lambda n: ", ".join(f"c{i} string" for i in range(n))
    rows = reader().schema(schema(width)).option("header", True).csv(path).select(*named, *found)
    if whole:
        rows = rows.filter(~F.col(PATH).isin(whole))
        records = _whole_records(reader, schema, whole, width, named, scratch)
        first = records.groupBy(_PART).agg(F.min("_seq").alias("_seq"))
        first = first.join(records, [_PART, "_seq"])
        found = first.groupBy(PATH).agg(F.min_by(CELLS, "_seq").alias(CELLS))
        heads = heads.filter(~F.col(PATH).isin(whole)).unionByName(
            found.select(PATH, _until_last(F.col(CELLS)).alias(_HEADER))
        )
        data = join_lookup(records, first.select(_PART, F.col("_seq").alias("_primeira")), _PART)
        rows = rows.unionByName(data.filter("_seq <> _primeira").drop("_seq", "_primeira", _PART))
    if parts:
        rows = join_lookup(rows.drop(ARRIVAL), listing.select(PATH, ARRIVAL), PATH)
    empty = F.array().cast("array<string>")
    files = listing.join(heads, PATH, "left").withColumn(_HEADER, F.coalesce(_HEADER, empty))
    return finished(rows, file_rows(files), scratch)


def _until_last(cells: Column) -> Column:
    """Cells up to the last filled one."""
    filled = F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1))
    return F.slice(cells, F.lit(1), F.coalesce(F.array_max(filled), F.lit(0)))


def _whole_records(reader, schema, paths: list[str], width: int, named: list[Column], scratch: Scratch) -> DataFrame:
    """All records, headers too, of files with line breaks inside cells.

    Read wider until no record fills the last place, since no line tells a record's width.
    """
    while True:
        cells = F.array(*[F.col(f"c{i}") for i in range(width)]).alias(CELLS)
        scan = reader().schema(schema(width)).option("multiLine", True).csv([literal_path(p) for p in paths])
        records = materialize(
            scan.select(*named, file_path().alias(_PART), cells, F.monotonically_increasing_id().alias("_seq")),
            "records", scratch,
        )
        if records.filter(F.get(CELLS, F.lit(width - 1)).isNotNull()).isEmpty():
            return records
        width *= 2


# Workbooks --------------------------------------------------------------------------------
def load_workbooks(files: DataFrame, sheet: str | int | None, known: DataFrame | None = None) -> Landing:
    """Decoded workbooks; ``files`` as given by ``workbook_files`` or a stream batch.

    Without ``sheet``, columns of ``files`` name it, for files of several tables. Files that
    ``known`` has with the same path and digest are left out. Cells beyond the header get
    names by position.
    """
    scratch = Scratch()
    decoded = materialize(decode_workbooks(files, sheet), "workbooks", scratch)
    closing = decoded.filter("nr_linha = -1").select(PATH, ORIGIN, ARRIVAL, "ds_erro", SECONDS, DIGEST)
    heads = decoded.filter("nr_linha = 0").select(PATH, F.col(CELLS).alias("_head"))
    widths = decoded.groupBy(PATH).agg(F.max(F.size(CELLS)).alias("_width"))
    per_file = closing.join(heads, PATH, "left").join(widths, PATH, "left")
    if known is not None:
        per_file = per_file.join(known.select(PATH, DIGEST).distinct(), [PATH, DIGEST], "left_anti")
    padding = F.array_repeat(F.lit(None).cast("string"), F.col("_width") - F.size("_head"))
    header = F.when(F.col("ds_erro").isNull(), F.concat("_head", padding)).alias(_HEADER)
    listed = per_file.select(PATH, ORIGIN, ARRIVAL, header, "ds_erro", SECONDS, DIGEST)
    rows = decoded.filter("nr_linha > 0").select(PATH, ORIGIN, ARRIVAL, CELLS)
    landing = finished(rows, listed, scratch)
    # A damaged file gives no rows, even if some were decoded before the damage.
    readable = landing.files.filter("ds_erro IS NULL").select(PATH)
    return replace(landing, rows=join_lookup(rows, readable, PATH, "left_semi"))


# Parquet and frames -----------------------------------------------------------------------
def load_parquet(spark: SparkSession, path: str | list[str]) -> Landing:
    """Parquet files taken as landing rows: every column cast to text.

    Files whose columns have types that do not go together are read one schema at a time,
    and each has the header of its own schema then.
    """
    named = [file_path().alias(PATH), file_name().alias(ORIGIN), _arrival()]

    def scan(paths: str | list[str]) -> tuple[DataFrame, list[str]]:
        found = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
        cells = F.array(*[F.col(f"`{c}`").cast("string") for c in found.columns])
        return found.select(*named, cells.alias(CELLS)), found.columns

    scratch = Scratch()
    listing = _file_listing(spark, path, "*.parquet")
    try:
        rows, names = scan(path)
        headers = listing.select(PATH, F.array(*[F.lit(c) for c in names]).alias(_HEADER))
    except Exception as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        alike: dict[str, list[str]] = {}
        for row in listing.select(PATH).collect():  # only footers are read here
            schema = spark.read.parquet(literal_path(row[PATH])).schema.json()
            alike.setdefault(schema, []).append(row[PATH])
        groups = [(paths, *scan([literal_path(p) for p in paths])) for paths in alike.values()]
        rows = groups[0][1]
        for _, more, _ in groups[1:]:
            rows = rows.unionByName(more)
        headers = spark.createDataFrame(
            [(p, names) for paths, _, names in groups for p in paths], f"{PATH} string, {_HEADER} array<string>"
        )
    return finished(rows, file_rows(listing.join(headers, PATH)), scratch)


def from_frame(df: DataFrame, arrival: Column, path: Column | None = None) -> Landing:
    """Landing of rows that a frame already holds, with one header for all: its columns.

    ``nm_arquivo_origem`` names the file of a row, ``path`` tells files apart.
    """
    scratch = Scratch()
    names = [c for c in df.columns if c != ORIGIN]
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in names]).alias(CELLS)
    path = F.col(ORIGIN) if path is None else path
    rows = df.select(path.alias(PATH), ORIGIN, arrival.cast("timestamp_ntz").alias(ARRIVAL), cells)
    files = rows.select(PATH, ORIGIN, ARRIVAL).distinct().withColumn(_HEADER, F.array(*[F.lit(c) for c in names]))
    return finished(rows, file_rows(files), scratch)


def read_landing(spark: SparkSession, path: str | list[str], fmt: str = "csv", **options) -> DataFrame:
    """Landing rows as one frame: a string column per header, file name and arrival."""
    if fmt == "parquet":
        return load_parquet(spark, path).to_frame()
    if fmt == "csv":
        return load_delimited(spark, path, **options).to_frame()
    raise ValueError(f"unknown landing format: {fmt}")


def read_workbooks(spark: SparkSession, path: str | list[str], sheet: str | int = 0) -> DataFrame:
    from ticketlake.sources.workbook import workbook_files

    return load_workbooks(workbook_files(spark, path), sheet).to_frame()


def only_settled(
    files: DataFrame,
    seconds: int = SETTLE_SECONDS,
    now: Column | None = None,
    length: str = "length",
    modified: str = ARRIVAL,
) -> DataFrame:
    """Files that are not empty and were last written at least ``seconds`` ago."""
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    age = F.expr(f"make_dt_interval(0, 0, 0, {seconds})")
    return files.filter((F.col(length) > 0) & (F.col(modified) <= now - age))
