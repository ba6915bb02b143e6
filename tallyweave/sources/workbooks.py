"""Workbooks as a cell relation: one row for each sheet row, with its cells as texts.

xlsx is read by zipfile and XML alone. Other containers are adapter slots: without a reader they give status `unreadable`,
never an empty table.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators.manifests import container

#: A sheet ends after so many blank rows; the namespace of strict workbooks and the one it is read as.
BLANK_RUN = 1000
STRICT, TRANSITIONAL = "http://purl.oclc.org/ooxml/spreadsheetml/main", "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_EPOCH = dt.datetime(1899, 12, 30)
ROWS = "source string, sheet string, row int, cells array<string>, status string"
#: Readers by container, for formats without one here: name -> bytes -> iterator of (sheet, row, cells).
READERS: dict[str, Callable[[bytes], Iterator[tuple[str, int, list[str]]]]] = {}


#: What reading damaged, encrypted or malformed bytes can raise.
FAULTS = (LookupError, TypeError, ValueError, ArithmeticError, AttributeError, RuntimeError, EOFError, zipfile.BadZipFile, zlib.error, ElementTree.ParseError)


def _number(text: str, dated: bool) -> str:
    value = float(text)
    if dated:
        return (_EPOCH + dt.timedelta(days=value)).strftime("%Y-%m-%d %H:%M")
    return str(int(value)) if value.is_integer() else repr(value)


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_xlsx(content: bytes) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet, row from 1, cells) of a workbook's values; trailing blanks are cut, leading ones kept."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parse = lambda name: ElementTree.fromstring(book.read(name).replace(STRICT.encode(), TRANSITIONAL.encode()))
        n = "{" + TRANSITIONAL + "}"
        names = set(book.namelist())
        shared = ["".join(t.text or "" for t in s.iter(n + "t")) for s in parse("xl/sharedStrings.xml").iter(n + "si")] if "xl/sharedStrings.xml" in names else []
        dated: list[bool] = []
        if "xl/styles.xml" in names:
            styles = parse("xl/styles.xml")
            formats = {f.get("numFmtId"): f.get("formatCode", "") for f in styles.iter(n + "numFmt")}
            for xf in styles.find(n + "cellXfs") if styles.find(n + "cellXfs") is not None else ():
                code = xf.get("numFmtId", "0")
                dated.append(14 <= int(code) <= 22 or bool(re.search(r"[ymdh]", re.sub(r"\"[^\"]*\"|\[[^\]]*\]", "", formats.get(code, "")))))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(_RELATIONS + "Relationship")}
        for sheet in parse("xl/workbook.xml").iter(n + "sheet"):
            at = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            path = targets[at].lstrip("/")
            blank, rows = 0, []
            for row in parse(path if path.startswith("xl/") else f"xl/{path}").iter(n + "row"):
                cells: dict[int, str] = {}
                for k, c in enumerate(row.iter(n + "c")):
                    value, kind = c.find(n + "v"), c.get("t", "n")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(n + "t"))
                    elif value is None or value.text is None:
                        continue
                    elif kind == "s":
                        text = shared[int(value.text)]
                    elif kind == "n":
                        style = int(c.get("s", "0"))
                        text = _number(value.text, style < len(dated) and dated[style])
                    else:
                        text = value.text
                    cells[_column(c.get("r")) if c.get("r") else k] = " ".join(text.split())
                width = max((k + 1 for k, v in cells.items() if v), default=0)
                blank = 0 if width else blank + 1
                if blank > BLANK_RUN:
                    break
                rows.append((sheet.get("name"), int(row.get("r", len(rows) + 1)), [cells.get(k, "") for k in range(width)]))
            while rows and not rows[-1][2]:
                rows.pop()
            yield from rows


def read_workbooks(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Rows (source: sha256, sheet, row, cells, status) of workbook files. A file that can't be read gives one row with a
    null sheet and its status: unsupported or unreadable. Spark's file scan passes over files of no bytes: those are told by
    their manifest (`container` calls them empty)."""
    files = spark.read.format("binaryFile").load(paths).select("content", F.sha2("content", 256).alias("source"), container(F.col("content")).alias("container"))
    readers = {"zip": read_xlsx, **READERS}

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for f in part.itertuples(index=False):
                out = []
                status = "unsupported" if f.container == "unsupported" else "unreadable"
                if f.container in readers:
                    try:
                        out = [(f.source, s, r, c, "read") for s, r, c in readers[f.container](f.content)]
                        status = "no_rows"
                    except FAULTS:
                        out, status = [], "unreadable"
                yield pd.DataFrame(out or [(f.source, None, None, None, status)], columns=["source", "sheet", "row", "cells", "status"])

    # one file at a time reaches Python, however large the batch
    return files.mapInPandas(read, ROWS)
