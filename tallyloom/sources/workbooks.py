"""Spreadsheets as a distributed source: one workbook per row, parsed in tasks.

The format itself bounds a sheet to 1,048,576 rows, so a task never holds more
than that, and its rows leave it in small batches. No workbook passes through
the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

# Cell texts that a spreadsheet import reads as "no value".
EMPTY_CELLS = frozenset(
    [
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
        "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    ]
)

# Numbers of the built-in formats that show dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), 45, 47, *range(50, 59)])

BATCH_ROWS = 5_000


def parse_workbooks(workbooks: DataFrame, schema: StructType) -> DataFrame:
    """Rows of the first sheet of every workbook in the ``content`` column.

    The header row is skipped and cells bind to the schema by position. Cells
    are read as text, blank ones as null, and then cast to the declared types.
    A number shown as a date reads ``2016-08-21 00:00:00``, one below 1 shown so
    reads ``06:30:00``; elapsed times and percentages stay numbers.
    """
    text = StructType()
    for item in schema:
        text.add(item.name, StringType(), nullable=True)
    rows = workbooks.select("content").mapInPandas(_row_reader(schema.names), text)
    if all(isinstance(item.dataType, StringType) for item in schema):
        return rows
    # Renamed by position first, so that no declared name has to be quoted.
    plain = rows.toDF(*(f"c{place}" for place in range(len(schema))))
    return plain.select(
        *(
            plain[f"c{place}"].try_cast(item.dataType).alias(item.name)
            for place, item in enumerate(schema)
        )
    )


def _row_reader(
    names: list[str],
    empty: frozenset[str] = EMPTY_CELLS,
    batch_rows: int = BATCH_ROWS,
    date_formats: frozenset[int] = DATE_FORMATS,
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task-side function; it carries all it needs, so workers import nothing of ours."""

    def read(batches):
        import datetime
        import io
        import itertools
        import re
        import zipfile
        from xml.etree import ElementTree

        import pandas as pd

        def text_of(element, space):
            """The text of a plain or rich string, phonetic hints left out."""
            parts = []
            for child in element:
                if child.tag == space + "t":
                    parts.append(child.text or "")
                elif child.tag == space + "r":
                    parts.append(child.findtext(space + "t", ""))
            return "".join(parts)

        def elements(archive, member, name):
            """The named elements of a part with their namespace, released after use."""
            with archive.open(member) as part:
                for _, element in ElementTree.iterparse(part):
                    if element.tag.endswith("}" + name):
                        yield element, element.tag[: -len(name)]
                        element.clear()

        def first_sheet(archive):
            sheet, _ = next(elements(archive, "xl/workbook.xml", "sheet"))
            wanted = next(value for key, value in sheet.attrib.items() if key.endswith("}id"))
            for link, _ in elements(archive, "xl/_rels/workbook.xml.rels", "Relationship"):
                if link.get("Id") == wanted:
                    target = link.get("Target")
                    return target[1:] if target.startswith("/") else f"xl/{target}"
            raise ValueError("workbook names a sheet that it does not contain")

        def column_of(reference):
            number = 0
            for letter in itertools.takewhile(str.isalpha, reference):
                number = number * 26 + ord(letter.upper()) - 64
            return number - 1

        def number_text(value):
            """A number as written: no trailing zeros, no digits beyond its precision."""
            try:
                return str(int(value))
            except ValueError:
                number = float(value)
            return str(int(number)) if number.is_integer() else repr(number)

        def shows_date(code):
            """Whether a format has day, month, year, hour or second signs outside of texts."""
            plain = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code.split(";")[0])
            elapsed = re.search(r"\[(h+|m+|s+)\]", plain, re.IGNORECASE)
            return not elapsed and bool(re.search("[dmyhs]", re.sub(r"\[[^\]]*\]", "", plain), re.IGNORECASE))

        def date_styles(archive):
            """Numbers of the cell styles that show dates."""
            if "xl/styles.xml" not in archive.namelist():
                return frozenset()
            root = ElementTree.fromstring(archive.read("xl/styles.xml"))
            custom = {
                item.get("numFmtId"): shows_date(item.get("formatCode", ""))
                for item in root.iter()
                if item.tag.endswith("}numFmt")
            }
            found = set()
            for part in root:
                if part.tag.endswith("}cellXfs"):
                    for place, style in enumerate(part):
                        number = style.get("numFmtId", "0")
                        if custom.get(number, int(number) in date_formats):
                            found.add(str(place))
            return found

        def first_day(archive):
            """The day with number zero: workbooks count from 1900 or from 1904."""
            for item, _ in elements(archive, "xl/workbook.xml", "workbookPr"):
                if item.get("date1904") in ("1", "true"):
                    return datetime.datetime(1904, 1, 1)
            return datetime.datetime(1899, 12, 30)

        def date_text(value, start):
            """The shown date of a number; numbers beyond the calendar stay as they are."""
            days, part = divmod(float(value), 1)
            milliseconds = round(part * 86_400_000)
            if 0 <= days < 1 and milliseconds < 86_400_000 and start.year < 1904:
                return str((datetime.datetime.min + datetime.timedelta(milliseconds=milliseconds)).time())
            # The count from 1900 has a 29 February that year did not have.
            days += start.year < 1904 and 1 <= days < 60
            try:
                return str(start + datetime.timedelta(days=days, milliseconds=milliseconds))
            except OverflowError:
                return number_text(value)

        def value_of(cell, space, shared, dates, start):
            kind = cell.get("t", "n")
            if kind == "inlineStr":
                held = cell.find(space + "is")
                value = "" if held is None else text_of(held, space)
            else:
                value = cell.findtext(space + "v", "")
                if value and kind == "s":
                    value = shared[int(value)]
                elif value and kind == "n":
                    dated = cell.get("s") in dates
                    value = date_text(value, start) if dated else number_text(value)
                elif value and kind == "d":
                    value = value.replace("T", " ") if "T" in value else f"{value} 00:00:00"
                elif value and kind == "b":
                    value = "True" if value == "1" else "False"
            return None if value in empty else value

        def sheet_rows(archive):
            """Rows by position; rows that the sheet leaves out come as blank ones."""
            shared = []
            if "xl/sharedStrings.xml" in archive.namelist():
                strings = elements(archive, "xl/sharedStrings.xml", "si")
                shared = [text_of(item, space) for item, space in strings]
            dates, start = date_styles(archive), first_day(archive)
            position = 0
            for row, space in elements(archive, first_sheet(archive), "row"):
                number = int(row.get("r", position + 1))
                for _ in range(number - position - 1):
                    yield {}
                position = number
                cells, place = {}, -1
                for cell in row:
                    reference = cell.get("r")
                    place = column_of(reference) if reference else place + 1
                    value = value_of(cell, space, shared, dates, start)
                    if value is not None:
                        cells[place] = value
                yield cells

        def records(content):
            """Data rows without the header and without blank rows at the end."""
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                blank = 0
                for cells in itertools.islice(sheet_rows(archive), 1, None):
                    if not cells:
                        blank += 1
                        continue
                    if max(cells) >= len(names):
                        raise ValueError(
                            f"workbook row has {max(cells) + 1} cells, {len(names)} are declared"
                        )
                    for _ in range(blank):
                        yield [None] * len(names)
                    blank = 0
                    yield [cells.get(place) for place in range(len(names))]

        for batch in batches:
            for content in batch["content"]:
                rows = records(content)
                while chunk := list(itertools.islice(rows, batch_rows)):
                    yield pd.DataFrame(chunk, columns=names, dtype=object)

    return read
