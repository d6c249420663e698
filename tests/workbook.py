"""A small workbook with every cell kind, written part by part."""

from __future__ import annotations

import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


class Number(str):
    """A numeric cell whose text in the file is given exactly."""


class Styled(str):
    """A numeric cell and the number of its style, as ``style:number``."""


#: Formats of the styles 0 to 7: none, date, date and time, time, percent, elapsed, own date, own text.
STYLES = (
    f'<styleSheet xmlns="{MAIN}"><numFmts count="2">'
    '<numFmt numFmtId="164" formatCode="[$-409]d\\ mmm&quot; of &quot;yy;@"/>'
    '<numFmt numFmtId="165" formatCode="0&quot; days&quot;"/></numFmts>'
    '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs>'
    + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 22, 20, 10, 46, 164, 165))
    + "</cellXfs></styleSheet>"
)


def letters(place: int) -> str:
    return chr(65 + place)


def cell(place: int, number: int, value, shared: list[str]) -> str:
    where = f'r="{letters(place)}{number}"'
    if value is None:
        return ""
    if isinstance(value, Styled):
        style, _, text = value.partition(":")
        return f'<c {where} s="{style}"><v>{text}</v></c>'
    if isinstance(value, bool):
        return f'<c {where} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Number)):
        return f"<c {where}><v>{value}</v></c>"
    if value.startswith("="):
        return f'<c {where} t="str"><f>A1</f><v>{escape(value[1:])}</v></c>'
    if value.startswith("!"):
        return f'<c {where} t="e"><v>{escape(value[1:])}</v></c>'
    shared.append(value)
    return f'<c {where} t="s"><v>{len(shared) - 1}</v></c>'


def write_workbook(path: Path, rows: dict[int, list], sheet: str = "worksheets/sheet1.xml") -> None:
    """``rows`` maps row numbers to cell values; missing numbers are left out of the file."""
    shared: list[str] = []
    body = "".join(
        f'<row r="{number}">'
        + "".join(cell(place, number, value, shared) for place, value in enumerate(values))
        + "</row>"
        for number, values in rows.items()
    )
    texts = "".join(
        f"<si><r><t>{escape(text[:1])}</t></r><r><t>{escape(text[1:])}</t></r>"
        "<rPh><t>sound</t></rPh></si>"
        for text in shared
    )
    member = sheet[1:] if sheet.startswith("/") else f"xl/{sheet}"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>'
            '<sheet name="First" sheetId="7" r:id="rId9"/><sheet name="Other" sheetId="8" r:id="rId1"/>'
            "</sheets></workbook>",
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">'
            f'<Relationship Id="rId1" Type="{LINKS}/worksheet" Target="worksheets/other.xml"/>'
            f'<Relationship Id="rId9" Type="{LINKS}/worksheet" Target="{sheet}"/>'
            "</Relationships>",
        )
        archive.writestr("xl/styles.xml", STYLES)
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{texts}</sst>')
        archive.writestr(member, f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
        archive.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
