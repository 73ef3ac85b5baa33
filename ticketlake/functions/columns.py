"""Cell and label expressions built from Spark's own functions."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.spec import (
    CLOSED_STATUSES,
    CRITICAL_PRIORITY,
    DATE_FORMATS,
    NULL_DATE_TEXTS,
    NULL_TOKENS,
    OTHER_PRIORITY_RANK,
    PRIORITY_RANKS,
    UNKNOWN_LABEL,
)

# Every character that counts as a blank at the end of a text.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Decimal numbers only: Spark's own cast would also take '1d' and '1f'.
_NUMBER = r"^\s*[+-]?(?=\.?\d)\d*\.?\d*([eE][+-]?\d+)?\s*$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"
# Bits of a key type beside the sign.
KEY_BITS = {T.IntegerType(): 31, T.LongType(): 63}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(moment: dt.datetime) -> Column:
    """Literal time without zone; a plain literal would pass through two time zones."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def ci_key(c: Column | str) -> Column:
    """Comparison key of a text: case and trailing blanks ignored, accents kept.

    A plain string, so grouping stays a hash aggregate; grouping on a collated
    column would sort every partition first.
    """
    return F.lower(F.rtrim(as_column(c)))


def equals_text(c: Column | str, text: str) -> Column:
    return ci_key(c) == ci_key(F.lit(text))


def trim_all(c: Column | str) -> Column:
    """Cut blanks of every kind (tabs, line breaks, no-break spaces) at both ends."""
    return F.btrim(as_column(c), F.lit(_BLANKS))


_NULL_LIST = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def null_token(name: str) -> Column:
    """NULL where the cell holds one of the texts that mean "missing"."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.expr(f"CASE WHEN {quoted} NOT IN ({_NULL_LIST}) THEN {quoted} END")


def norm_text(c: Column | str) -> Column:
    """Trimmed free text; the texts of a missing date become NULL."""
    trimmed = trim_all(c)
    return F.when(~trimmed.isin(*NULL_DATE_TEXTS), trimmed)


# Texts of the fields a date format may have; a time may follow a T and have a fraction, as
# workbook cells print it.
_FIELDS = {
    "yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}", "HH": r"(?:[01]\d|2[0-3])", "mm": r"[0-5]\d",
    "ss": r"[0-5]\d(?:\.\d+)?",
}


def _parse_date(c: Column, fmt: str) -> Column:
    """The date of a text that has the shape of the format.

    Fields have fixed places, so the date is cut out and cast: no formatter runs, and a text
    of another shape costs no exception.
    """
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]+", fmt)
    if not {"yyyy", "MM", "dd"} <= set(parts) or any(p.isalpha() and p not in _FIELDS for p in parts):
        return F.try_to_date(c, fmt)
    shape = "".join(_FIELDS.get(p) or re.escape(p) for p in parts).replace(r"\ (?:[01]", "[T ](?:[01]")
    cut = [F.substring(c, fmt.index(p) + 1, len(p)) for p in ("yyyy", "MM", "dd")]
    return F.when(c.rlike(f"^{shape}$"), F.concat_ws("-", *cut).try_cast("date"))


def coerce_date(
    c: Column | str, formats: Sequence[str] = DATE_FORMATS, bounds: tuple[str, str] | None = None
) -> Column:
    """First format that parses wins; anything else is NULL. The time part is cut.

    The formats are fixed and tried per row, so the result of a row does not depend on which
    other rows share its file or partition. Dates outside ``bounds`` are NULL, if given.
    """
    c, trimmed = as_column(c), trim_all(c)
    plain = F.coalesce(*[_parse_date(c, f) for f in formats])
    parsed = F.coalesce(plain, F.when(trimmed != c, F.coalesce(*[_parse_date(trimmed, f) for f in formats])))
    if bounds is None:
        return parsed
    return F.when(parsed.between(*[F.lit(b).cast("date") for b in bounds]), parsed)


def whole_number(c: Column | str) -> Column:
    """A key cell of digits alone, by a plain cast: what most cells are."""
    return as_column(c).try_cast("bigint")


def exact_integer(c: Column | str) -> Column:
    """The digits of a whole number with an empty fraction, NULL for any other text."""
    digits = F.regexp_extract(trim_all(c), r"^([+-]?\d+)(\.0*)?$", 1)
    return F.when(digits != "", digits)


def key_number(c: Column | str) -> Column:
    """The key cell as a double (infinite for ``inf``), NULL if it is no number."""
    c = as_column(c)
    return (
        F.when(c.rlike(_NUMBER), trim_all(c).try_cast("double"))
        .when(c.rlike(_INFINITY), F.when(c.contains("-"), float("-inf")).otherwise(float("inf")))
    )


def dedupe_headers(header: Column | str) -> Column:
    """Names of a header row: empty ones by position, repeated ones numbered (``h``, ``h.1``).

    A number that another header already has is passed over.
    """

    def add(seen: Column, cell: Column) -> Column:
        base = F.coalesce(F.nullif(cell["h"], F.lit("")), F.concat(F.lit("Unnamed: "), cell["i"].cast("string")))
        numbered = F.transform(
            F.sequence(F.lit(1), F.size(seen) + 1), lambda k: F.concat(base, F.lit("."), k.cast("string"))
        )
        free = F.get(F.filter(numbered, lambda n: ~F.array_contains(seen, n)), F.lit(0))
        return F.concat(seen, F.array(F.when(F.array_contains(seen, base), free).otherwise(base)))

    cells = F.transform(as_column(header), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.aggregate(cells, F.array().cast("array<string>"), add)


def label_null(c: Column | str, text: str = UNKNOWN_LABEL) -> Column:
    return F.coalesce(as_column(c), F.lit(text))


def fmt_day(c: Column | str) -> Column:
    return F.date_format(as_column(c), "dd/MM/yyyy")


def is_open(c: Column | str = "status") -> Column:
    """Not closed; NULL for a NULL status, which a filter treats as not open."""
    return ~ci_key(c).isin(*[s.lower() for s in CLOSED_STATUSES])


def is_p1_open(priority: Column | str = "prioridade", status: Column | str = "status") -> Column:
    return equals_text(priority, CRITICAL_PRIORITY) & is_open(status)


def priority_rank(c: Column | str = "prioridade") -> Column:
    rank = None
    for name, value in PRIORITY_RANKS.items():
        test = equals_text(c, name)
        rank = F.when(test, value) if rank is None else rank.when(test, value)
    return rank.otherwise(OTHER_PRIORITY_RANK)


def is_workbook(c: Column | str) -> Column:
    return F.lower(as_column(c)).rlike(r"\.xlsx?$")


def has_key(key: str) -> Column:
    return F.col(key).isNotNull()


def _decoded(c: str) -> Column:
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))


def file_name() -> Column:
    """Name of the file a row was read from; Spark gives it with blanks encoded."""
    return _decoded("_metadata.file_name")


def file_path() -> Column:
    """Whole path of the file a row was read from, which tells files of one name apart."""
    return _decoded("_metadata.file_path")
