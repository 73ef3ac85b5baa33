"""Writes small workbooks with the standard library."""

import zipfile
from xml.sax.saxutils import escape

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(index):
    text = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        text = chr(ord("A") + rest) + text
    return text


def cell_xml(ref, value, shared):
    if value is None:
        return ""
    if isinstance(value, tuple):  # ("date", serial) or raw ("b"/"e"/"inlineStr", text)
        kind, text = value
        if kind == "date":
            return f'<c r="{ref}" s="1"><v>{text}</v></c>'
        if kind == "custom":
            return f'<c r="{ref}" s="2"><v>{text}</v></c>'
        if kind == "inlineStr":
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(text)}</t></is></c>'
        return f'<c r="{ref}" t="{kind}"><v>{escape(str(text))}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value not in shared:
        shared.append(value)
    return f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>'


def write_book(path, rows, sheet="Página4", other_sheet=True):
    """``rows``: list of rows (first is the header); None rows are left out of the file."""
    shared = []
    body = ""
    for number, row in enumerate(rows, 1):
        if row is None:
            continue
        cells = "".join(cell_xml(f"{letters(i)}{number}", v, shared) for i, v in enumerate(row))
        body += f'<row r="{number}">{cells}</row>'
    sheets = f'<sheet name="{escape(sheet)}" sheetId="2" r:id="rId2"/>'
    if other_sheet:
        sheets = '<sheet name="Capa" sheetId="1" r:id="rId1"/>' + sheets
    strings = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in shared)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{REL}"><sheets>{sheets}</sheets></workbook>')
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Type="t" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f"<sst {NS}>{strings}</sst>")
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet {NS}><numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/></numFmts>'
            '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData/></worksheet>")
        book.writestr("xl/worksheets/sheet2.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")
    return str(path)
