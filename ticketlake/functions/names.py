"""Header rules. They work on the names of one header row, never on data rows."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from ticketlake.spec import CONTROL_COLUMNS, ORIGIN, TableSpec


def sanitize_name(name: str) -> str:
    """Lower-case column name made of ``a-z``, ``0-9`` and single inner underscores."""
    return "_".join(re.findall(r"[a-z0-9]+", name.strip().lower()))


@dataclass(frozen=True)
class ResolvedNames:
    """Final column name -> header, or the reason why the file must be refused."""

    sources: dict[str, str]
    error: str | None = None


def resolve_names(headers: Iterable[str], spec: TableSpec) -> ResolvedNames:
    """Apply drop list, rename map and name sanitising to one header row.

    Two headers with one final name, a header without any usable character and a
    header that claims a control column make the whole file invalid.
    """
    mapped = set(spec.rename.values())
    sources: dict[str, str] = {}
    for header in headers:
        if header in spec.drop:
            continue
        name = spec.rename.get(header, header)
        if name not in mapped:
            name = sanitize_name(name)
        if not name:
            return ResolvedNames({}, f"coluna sem nome utilizável: {header!r}")
        if name in CONTROL_COLUMNS:
            return ResolvedNames({}, f"coluna reservada no arquivo: {header!r}")
        if name == ORIGIN:
            continue  # always filled with the file name
        if name in sources:
            return ResolvedNames(
                {}, f"colunas {sources[name]!r} e {header!r} têm o mesmo nome: {name}"
            )
        sources[name] = header
    return ResolvedNames(sources)
