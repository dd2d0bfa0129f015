"""EPUB files as tables of books and chapters."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loregraph.functions.text import book_id, content_hash
from loregraph.sources.html import chapters_from_html

ITEMS = "path string, title string, author string, pos int, item_title string, html string, error string"
# XML names of the package format.
NS = {"c": "urn:oasis:names:tc:opendocument:xmlns:container", "o": "http://www.idpf.org/2007/opf", "dc": "http://purl.org/dc/elements/1.1/"}
DOCUMENT = "application/xhtml+xml"
UNKNOWN_TITLE, UNKNOWN_AUTHOR = "Unknown Title", "Unknown Author"


def read_items(content: bytes) -> tuple[str, str, list[str]]:
    """Title, author, and the documents in the package's order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("META-INF/container.xml")).find(".//c:rootfile", NS).attrib["full-path"]
        package = ElementTree.fromstring(z.read(root))
        first = lambda name: next((x.text.strip() for x in package.iterfind(f".//dc:{name}", NS) if x.text and x.text.strip()), None)
        base = posixpath.dirname(root)
        documents = [z.read(posixpath.normpath(posixpath.join(base, unquote(i.attrib["href"])))).decode("utf-8", "replace") for i in package.iterfind("o:manifest/o:item", NS) if i.attrib.get("media-type") == DOCUMENT]
    return first("title") or UNKNOWN_TITLE, first("creator") or UNKNOWN_AUTHOR, documents


def epub_items(spark: SparkSession, path: str) -> DataFrame:
    """A row a document of every ``.epub`` (any case) below ``path``; an unreadable file is one row with
    its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    title, author, documents = read_items(content)
                    rows = [(p, title, author, i, None, h, None) for i, h in enumerate(documents)]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, AttributeError) as e:
                    rows = [(p, None, None, -1, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "title", "author", "pos", "item_title", "html", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[eE][pP][uU][bB]").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, ITEMS)


def read_epubs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """books (book_id, title, author, file_path, content_hash, chapters, words) and chapters."""
    items = epub_items(spark, path).where("error is null").withColumn("book_id", book_id(F.col("title"), F.col("author")))
    chapters = chapters_from_html(items)
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter_index", "content"))), lambda x: x["content"]), "\n\n")
    hashed = chapters.groupBy("book_id").agg(content_hash(content).alias("content_hash"), F.count("*").cast("int").alias("chapters"), F.sum("word_count").alias("words"))
    names = items.groupBy("book_id").agg(F.min("title").alias("title"), F.min("author").alias("author"), F.min("path").alias("file_path"))
    return names.join(hashed, "book_id").select("book_id", "title", "author", "file_path", "content_hash", "chapters", "words"), chapters
