"""DOCX scan: paragraphs with section headings and footnotes, read from the archive's XML."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
ROWS = "file string, idx int, section string, text string, notes array<int>, note_texts array<string>, error string"


def footnotes(archive: zipfile.ZipFile) -> dict[int, str]:
    """Footnotes by number; separators (numbers under 1) and empty ones are left out."""
    if "word/footnotes.xml" not in archive.namelist():
        return {}
    root = ElementTree.fromstring(archive.read("word/footnotes.xml"))
    texts = {int(n.get(f"{W}id", "0")): " ".join("".join(t.text or "" for t in n.iter(f"{W}t")).split()) for n in root.iter(f"{W}footnote")}
    return {n: t for n, t in texts.items() if n > 0 and t}


def paragraphs(content: bytes, least: int = 1) -> list[tuple[str | None, str, list[int], list[str]]]:
    """(section, text, note numbers, note texts) of each paragraph of the body, headings apart.

    A note's place is marked [[fn:N]]; a number that comes twice in a paragraph is listed once. Paragraphs
    under `least` characters, and those before the first heading if there is one, keep a null section.
    """
    archive = zipfile.ZipFile(io.BytesIO(content))
    notes = footnotes(archive)
    section, out = None, []
    for p in ElementTree.fromstring(archive.read("word/document.xml")).iter(f"{W}p"):
        style = p.find(f"{W}pPr/{W}pStyle")
        parts, numbers = [], []
        for node in p.iter():
            if node.tag == f"{W}t":
                parts.append(node.text or "")
            elif node.tag in (f"{W}tab", f"{W}br"):
                parts.append(" ")
            elif node.tag == f"{W}footnoteReference":
                n = int(node.get(f"{W}id", "0"))
                if n in notes:
                    parts.append(f"[[fn:{n}]]")
                    numbers += [n] if n not in numbers else []
        text = " ".join("".join(parts).split())
        if style is not None and (style.get(f"{W}val") or "").lower().startswith("heading"):
            section = text or section
        elif len(text) >= least:
            out.append((section, text, numbers, [notes[n] for n in numbers]))
    return out


def docx_paragraphs(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    """ROWS of every file under path; one that can't be read gives a row with its error."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string()]
        names = ["file", "idx", "section", "text", "notes", "note_texts", "error"]
        for batch in batches:
            rows: list[tuple] = []
            for file, content in zip(batch["file"].to_pylist(), batch["content"], strict=True):
                try:
                    rows += [(file, i, *p, None) for i, p in enumerate(paragraphs(content.as_py(), least), 1)]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError) as e:
                    rows.append((file, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return files.mapInArrow(run, ROWS)
