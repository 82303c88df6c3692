"""Binary documents to text: a registry of extractors over (binary, type) columns, run on Arrow batches.

An extractor maps bytes to (text, metadata) or raises ValueError, which becomes the row's error. Types not registered
count as plain text. Own extractors are added with `register`.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Extractor = Callable[[bytes], tuple[str, dict[str, str]]]


def plain(data: bytes) -> tuple[str, dict[str, str]]:
    text = data.decode("utf-8", "replace")
    return text, {"characters": str(len(data)), "lines": str(text.count("\n") + 1)}


def html(data: bytes) -> tuple[str, dict[str, str]]:
    from corpusloom.functions.web import _dom

    text = data.decode("utf-8", "replace")
    found = re.search(r"(?is)<title[^>]*>(.*?)</title>", text)
    return _dom(text), {"title": " ".join(found[1].split())} if found else {}


def docx(data: bytes, most: int = 64 << 20) -> tuple[str, dict[str, str]]:
    """Paragraphs of a word-processor file; refuses a body that unpacks to over `most` bytes."""
    if not data.startswith(b"PK"):
        raise ValueError("not a DOCX file: no ZIP signature")
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            if z.getinfo("word/document.xml").file_size > most:
                raise ValueError("document body too large")
            body = z.read("word/document.xml")
        root = ElementTree.fromstring(body)
    except (KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
        raise ValueError(f"unreadable DOCX file: {e}") from None
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    text = "\n".join("".join(t.text or "" for t in p.iter(f"{ns}t")) for p in root.iter(f"{ns}p"))
    return text, {"characters": str(len(text)), "words": str(len(text.split()))}


def pdf(data: bytes) -> tuple[str, dict[str, str]]:
    if not data.startswith(b"%PDF-"):
        raise ValueError("not a PDF file")
    try:
        from pypdf import PdfReader  # not part of this environment; used where it is installed
    except ImportError:
        raise ValueError("no PDF library is installed") from None
    pages = [p.extract_text() for p in PdfReader(io.BytesIO(data)).pages]
    text = "\n\n".join(pages)
    return text, {"pages": str(len(pages)), "text_length": str(len(text))}


def ocr(data: bytes) -> tuple[str, dict[str, str]]:
    raise ValueError("OCR is not available")


REGISTRY: dict[str, Extractor] = {"text": plain, "txt": plain, "html": html, "docx": docx, "pdf": pdf, "image": ocr, "png": ocr, "jpg": ocr}


def register(kind: str, fn: Extractor) -> None:
    REGISTRY[kind.lower()] = fn


def extracted(df: DataFrame, raw: str, kind: Column, carry: list[str]) -> DataFrame:
    """The carried columns with text, metadata and error."""
    registry = dict(REGISTRY)
    meta = pa.map_(pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, metas, errors = [], [], []
            for data, k in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    text, m = registry.get((k or "").lower(), plain)(data or b"")
                    texts.append(text), metas.append(list(m.items())), errors.append(None)
                except ValueError as e:
                    texts.append(None), metas.append([]), errors.append(str(e))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(metas, meta), pa.array(errors, pa.string())], ["row", "text", "metadata", "error"])

    src = df.select(F.struct(*carry).alias("row"), F.col(raw).cast("binary"), kind.alias("kind"))
    schema = f"row {src.schema['row'].dataType.simpleString()}, text string, metadata map<string,string>, error string"
    return src.mapInArrow(run, schema).select("row.*", "text", "metadata", "error")
