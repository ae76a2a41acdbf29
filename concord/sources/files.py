"""Files as tables: a scan with its formats told by content, DOCX blocks, and a content-addressed sink.

``scan`` lists files with their bytes (Spark's binaryFile source) and tells their
format; ``blocks`` turns each file into rows of text, or into one row that says why
it has none, so that no file goes silently. ``store`` writes contents under their
SHA-256, skips those that the manifest already holds, and reads what it wrote
again: a file whose bytes do not have their name's digest is an error. ``held``
gives the stored bytes back under every name, equal contents under each of theirs.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: First bytes of formats, in the order they are tried (fixed values).
MAGIC = [(b"%PDF", "pdf"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "doc"), (b"{\\rtf", "rtf"), (b"PK\x03\x04", "zip"), (b"PK\x05\x06", "zip"), (b"PK\x06\x06", "zip")]
#: Formats that ``blocks`` reads.
READ = ["docx", "txt"]
_PART = "word/document.xml"
_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCK = "path string, kind string, pos int, page int, type string, text string, table_id int, row int, col int, nested_in string, error string"


def kind_of(content: str, name: str) -> Column:
    """The format by first bytes; else the file name's ending in lower case, its letters and digits, at most 8; else bin."""
    out = F.when(F.col(name).contains("."), F.left(F.regexp_replace(F.lower(F.substring_index(F.col(name), ".", -1)), "[^a-z0-9]", ""), F.lit(8)))
    out = F.coalesce(F.nullif(out, F.lit("")), F.lit("bin"))
    for magic, kind in reversed(MAGIC):
        out = F.when(F.substring(F.col(content), 1, len(magic)) == F.lit(magic), kind).otherwise(out)
    return out


def scan(spark: SparkSession, path: str) -> DataFrame:
    """path, name, length, content, kind of the files under ``path``; zip files that hold a sound DOCX part are docx."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return told(read.select("path", F.substring_index("path", "/", -1).alias("name"), "length", "content"))


def told(contents: DataFrame) -> DataFrame:
    """``contents`` (name, content and any other columns), wherever they were read, with kind."""
    sniffed = contents.withColumn("kind", kind_of("content", "name"))
    return sniffed.withColumn("kind", F.when(F.col("kind") == "zip", F.when(_is_docx("content"), "docx").otherwise("zip")).otherwise(F.col("kind")))


def document_part(content: bytes) -> bytes | None:
    """The document part of a DOCX whose every member is intact; None of anything else."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            data = archive.read(_PART)
            expat.ParserCreate().Parse(data, True)
            return data if data.strip() and archive.testzip() is None else None
    except (zipfile.BadZipFile, zlib.error, expat.ExpatError, KeyError, EOFError, OSError, RuntimeError, NotImplementedError, ValueError):
        return None


@F.pandas_udf(T.BooleanType())
def _is_docx(content: pd.Series) -> pd.Series:
    return content.map(lambda c: c is not None and document_part(c) is not None).astype(bool)


class _Docx:
    """Paragraphs and tables of a document part, by its start and end tags.

    Tables nest: each has a stack entry with its grid, and its cells are laid out when
    it ends, in the place where it began. A cell fills as many columns as it spans
    (gridSpan); one that goes on from the row above (vMerge) is the cell above.
    Pages are logical: one ends with the body's paragraph that holds an explicit break.
    """

    def __init__(self) -> None:
        self.found: list[list[tuple]] = []
        self.page, self.broken, self.tables, self.n = 1, False, [], 0
        self.text: list[str] | None = None
        self.in_text = False

    def start(self, name: str, attributes: dict[str, str]) -> None:
        tag = name.removeprefix(_WORD)
        value = attributes.get(f"{_WORD}val")
        table = self.tables[-1] if self.tables else None
        cell = table["cell"] if table else None
        self.in_text = tag == "t"
        if tag == "tbl":
            place: list[tuple] = []
            self.found.append(place)
            within = None if cell is None else f"{table['id']}:{table['row']}:{table['col']}"
            self.tables.append({"id": self.n, "row": -1, "col": 0, "cell": None, "grid": {}, "place": place, "within": within, "page": self.page})
            self.n += 1
        elif tag == "tr" and table:
            table["row"], table["col"] = table["row"] + 1, 0
        elif tag in ("gridBefore",) and table and cell is None:
            table["col"] += _number(value, 0)
        elif tag == "tc" and table:
            table["cell"] = {"span": 1, "merged": False, "texts": []}
        elif tag == "gridSpan" and cell is not None:
            cell["span"] = max(1, _number(value, 1))
        elif tag == "vMerge" and cell is not None:
            cell["merged"] = value != "restart"
        elif tag == "p":
            self.text = []
        elif self.text is not None and (tag in ("tab", "cr", "noBreakHyphen") or (tag == "br" and attributes.get(f"{_WORD}type") != "page")):
            self.text.append({"tab": "\t", "noBreakHyphen": "-"}.get(tag, "\n"))
        elif tag in ("lastRenderedPageBreak", "br"):
            self.broken = True

    def end(self, name: str) -> None:
        tag = name.removeprefix(_WORD)
        self.in_text = False
        table = self.tables[-1] if self.tables else None
        if tag == "p" and self.text is not None:
            text, self.text = "".join(self.text), None
            if table is None:
                self.found.append([(self.page, "PARAGRAPH", text, None, None, None, None)])
                self.page, self.broken = self.page + self.broken, False
            elif table["cell"] is not None:
                table["cell"]["texts"].append(text)
        elif tag == "tc" and table and table["cell"] is not None:
            cell, table["cell"] = table["cell"], None
            above = table["grid"].get((table["row"] - 1, table["col"]))
            texts = above if cell["merged"] and above is not None else cell["texts"]
            for _ in range(cell["span"]):
                table["grid"][table["row"], table["col"]] = texts
                table["col"] += 1
        elif tag == "tbl" and table:
            self.tables.pop()
            table["place"].extend((table["page"], "TABLE_CELL", "\n".join(texts), table["id"], row, col, table["within"]) for (row, col), texts in sorted(table["grid"].items()))

    def characters(self, data: str) -> None:
        if self.in_text and self.text is not None:
            self.text.append(data)


def _number(value: str | None, default: int) -> int:
    return int(value) if value and value.isdecimal() else default


def docx_blocks(data: bytes) -> list[tuple]:
    """(page, type, text, table_id, row, col, nested_in) of the paragraphs and table cells of a document part, in their order.

    Tables are numbered from 0 by their start; nested_in is "table:row:col" of the cell that a nested table stands in.
    """
    reader, parser = _Docx(), expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = reader.start, reader.end, reader.characters
    parser.Parse(data, True)
    return [row for rows in reader.found for row in rows]


def blocks(files: DataFrame) -> DataFrame:
    """path, kind, pos, page, type, text, table_id, row, col, nested_in, error of ``scan``'s files: a row per paragraph, line or table cell, or one with the error."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for path, kind, content in zip(frame["path"], frame["kind"], frame["content"], strict=True):
                try:
                    if kind == "docx":
                        found = docx_blocks(document_part(content) or b"")
                    elif kind == "txt":
                        found = [(1, "PARAGRAPH", line, None, None, None, None) for line in bytes(content).decode().splitlines()]
                    else:
                        raise ValueError(f"unsupported format: {kind}")
                    rows += [(path, kind, k, *block, None) for k, block in enumerate(found)] or [(path, kind, *[None] * 8, "no text")]
                except (ValueError, expat.ExpatError) as e:
                    rows.append((path, kind, *[None] * 8, str(e)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in BLOCK.split(", ")]).astype(dict.fromkeys(("pos", "page", "table_id", "row", "col"), "Int32"))

    return files.select("path", "kind", "content").mapInPandas(read, BLOCK)


def store(contents: DataFrame, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """Write (name, content) once per digest, but what ``manifest`` (sha256) holds; the rows written, read again and verified.

    Result: sha256, length, name (the smallest of those with the content).
    """
    spark = contents.sparkSession
    digest = contents.where(F.col("content").isNotNull()).select("name", "content", F.sha2("content", 256).alias("sha256"))
    if manifest is not None:
        digest = digest.join(manifest.select("sha256").distinct(), "sha256", "left_anti")
    fresh = digest.groupBy("sha256").agg(F.min("name").alias("name"), F.any_value("content").alias("content"))
    fresh.withColumn("shard", F.substring("sha256", 1, 2)).write.mode("append").partitionBy("shard").parquet(path)
    back = spark.read.schema(fresh.schema).parquet(path)
    sound = F.when(F.sha2("content", 256) == F.col("sha256"), F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("a stored file does not have its digest "), "sha256")))
    return back.select(sound.alias("sha256"), F.length("content").cast("long").alias("length"), "name")


def held(contents: DataFrame, path: str) -> DataFrame:
    """(name, content) of every row of ``contents`` (name, content) that has a content, as ``store`` wrote it to ``path``.

    Names are matched by digest; a content that is not in the store is an error, no lost row.
    """
    named = contents.where(F.col("content").isNotNull()).select("name", F.sha2("content", 256).alias("sha256"))
    stored = contents.sparkSession.read.schema("sha256 string, content binary").parquet(path)
    missing = F.raise_error(F.concat(F.lit("not in the store: "), "sha256")).cast("binary")
    return named.join(stored, "sha256", "left").select("name", F.coalesce("content", missing).alias("content"))
