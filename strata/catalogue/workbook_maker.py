"""Minimal .xlsx files for fixtures: {sheet name: rows} -> bytes. Texts go inline, numbers as numbers."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

from strata.sources.workbook import column_letters

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def _cell(column: int, row: int, value, style: int = 0) -> str:
    if value is None:
        return ""
    place = f"{column_letters(column)}{row}"
    if isinstance(value, tuple):
        value, style = value
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{place}" s="{style}"><v>{value}</v></c>'
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A value (number, 1) is shown with the date style."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        entries = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
        )
        book.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets>{entries}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet {_MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(
                f'<row r="{r}">{"".join(_cell(c, r, v) for c, v in enumerate(row, 1))}</row>' for r, row in enumerate(rows, 1) if row
            )
            book.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {_MAIN}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()
