"""Raw source files made from the test star by Spark tasks.

They stand in for deliveries: JSON arrays of a bounded number of bytes and workbooks
of a bounded number of rows, built as rows stream through a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import quoted


JSON_BYTES = 32 << 20
WORKBOOK_ROWS = 50_000


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.option("header", True).option("escape", '"').csv(path)


def write_json_arrays(frame: DataFrame, path: str) -> None:
    """A folder of compressed files, each of them one JSON array.

    An array is read whole by one task anyhow, so compression costs no splitting.
    """
    objects = frame.select(F.to_json(F.struct(*map(quoted, frame.columns))).alias("value"))
    arrays = objects.mapInPandas(_joiner(), "value string")
    arrays.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _joiner() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def join(batches):
        import pandas as pd

        objects, size = [], 0
        for batch in batches:
            for value in batch["value"]:
                objects.append(value)
                size += len(value) + 1
                if size >= JSON_BYTES:
                    yield pd.DataFrame({"value": ["[" + ",".join(objects) + "]"]})
                    objects, size = [], 0
        if objects:
            yield pd.DataFrame({"value": ["[" + ",".join(objects) + "]"]})

    return join


def _in_bounds(batches, rows: int):
    """The same rows in frames of ``rows`` each, whatever the batches were."""
    import pandas as pd

    held, count = [], 0
    for batch in batches:
        while count + len(batch) >= rows:
            held.append(batch.iloc[: rows - count])
            batch = batch.iloc[rows - count :]
            yield pd.concat(held)
            held, count = [], 0
        if len(batch):
            held.append(batch)
            count += len(batch)
    if held:
        yield pd.concat(held)


def pack_workbooks(frame: DataFrame) -> DataFrame:
    """Workbooks of up to ``WORKBOOK_ROWS`` rows in ``content``, each its own task's, all cells as text."""
    return _packed(frame, b"")


def _packed(frame: DataFrame, comment: bytes) -> DataFrame:
    """Workbooks that lack only the given comment at their end."""
    names = frame.columns
    text = frame.select(*(quoted(name).cast("string").alias(name) for name in names))
    # A small compressed table is a single scan task, however many workbooks its rows fill.
    books = -(-frame.count() // WORKBOOK_ROWS)
    if books > 1:
        text = text.repartition(books)
    return text.mapInPandas(_packer(names, comment), "content binary")


def _packer(names: list[str], comment: bytes) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def pack(batches):
        import io
        import zipfile
        from xml.sax.saxutils import escape

        import pandas as pd

        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book = (
            f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
        )
        relations = (
            f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
            f'Type="{links}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
        )

        def letters(place):
            name = ""
            while place >= 0:
                name = chr(65 + place % 26) + name
                place = place // 26 - 1
            return name

        def row_xml(number, values):
            cells = "".join(
                f'<c r="{letters(place)}{number}" t="inlineStr">'
                f'<is><t xml:space="preserve">{escape(value)}</t></is></c>'
                for place, value in enumerate(values)
                if value is not None
            )
            return f'<row r="{number}">{cells}</row>'

        for batch in _in_bounds(batches, WORKBOOK_ROWS):
            rows = [row_xml(1, names)]
            records = batch.itertuples(index=False, name=None)
            rows.extend(row_xml(number, record) for number, record in enumerate(records, 2))
            sheet = f'<worksheet xmlns="{main}"><sheetData>{"".join(rows)}</sheetData></worksheet>'
            target = io.BytesIO()
            with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("xl/workbook.xml", book)
                archive.writestr("xl/_rels/workbook.xml.rels", relations)
                archive.writestr("xl/worksheets/sheet1.xml", sheet)
                archive.comment = comment
            whole = target.getvalue()
            yield pd.DataFrame({"content": [whole[: len(whole) - len(comment)]]})

    return pack


def write_workbooks(frame: DataFrame, path: str) -> None:
    """A folder of workbooks, each a whole file that its task writes.

    Spark writes a text's bytes as they are and ends the file with a line break. A
    workbook ends with a comment, so that line break is made the comment's only byte.
    """
    books = _packed(frame, b"\n").select(F.col("content").cast("string").alias("value"))
    books.write.option("maxRecordsPerFile", 1).text(path)
