"""Block text and titles of HTML documents, on Arrow batches.

Elements nest as they are written: an end tag closes the nearest open element of its name and what is open
inside, and a paragraph doesn't end where another begins. So text of a block inside a block comes twice.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from loregraph import types as T
from loregraph.functions.text import normalize_text, word_count

# Elements that are blocks of text, that hold none, that are left out, and where titles stand.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 div".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("script style nav header footer".split())
TITLES = ("h1", "h2", "h3", "title")


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None]] = []
        self.blocks: list[list[str]] = []
        self.everything: list[str] = []
        self.titles: dict[str, list[str]] = {}
        self.title: tuple[str, list[str]] | None = None
        self.skipping = 0
        self.data: list[str] = []

    def _flush(self):
        text, self.data = "".join(self.data).strip(), []
        if not text:
            return
        if self.title:
            self.title[1].append(text)
        if self.skipping:
            return
        self.everything.append(text)
        for _, block in self.open:
            if block is not None:
                block.append(text)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in EMPTY:
            return
        self.skipping += tag in LEFT_OUT
        block = None
        if tag in BLOCKS and not self.skipping:
            block = []
            self.blocks.append(block)
        if tag in TITLES and tag not in self.titles and self.title is None:
            self.titles[tag] = []
            self.title = (tag, self.titles[tag])
        self.open.append((tag, block))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.skipping -= sum(t in LEFT_OUT for t, _ in self.open[i:])
                if self.title and any(t == self.title[0] for t, _ in self.open[i:]):
                    self.title = None
                del self.open[i:]
                return

    def handle_data(self, data):
        self.data.append(data)

    def handle_comment(self, data):
        self._flush()

    def close(self):
        super().close()
        self._flush()


def _parsed(source: str) -> _Blocks:
    p = _Blocks()
    p.feed(source)
    p.close()
    return p


def text_of(source: str | None) -> str | None:
    if source is None:
        return None
    p = _parsed(source)
    blocks = [" ".join(b) for b in p.blocks if b]
    return "\n\n".join(blocks) if blocks else " ".join(p.everything)


def title_of(source: str | None) -> str | None:
    """The first heading of rank 1, else 2, else 3, else the title, that has 1 to 99 characters."""
    if source is None:
        return None
    found = _parsed(source).titles
    return next((t for k in TITLES if (t := " ".join(found.get(k, []))) and len(t) < T.MAX_TITLE), None)


@F.pandas_udf(S.StringType())
def html_to_text(source: pd.Series) -> pd.Series:
    return source.map(text_of)


@F.pandas_udf(S.StringType())
def html_title(source: pd.Series) -> pd.Series:
    return source.map(title_of)


def chapter_title(item_title: Column, source: Column, index: Column) -> Column:
    given = F.when(F.coalesce(item_title, F.lit("")) != "", item_title)
    return F.coalesce(given, html_title(source), F.concat(F.lit("Chapter "), (index + 1).cast("string")))


def chapters_from_html(items: DataFrame) -> DataFrame:
    """``items`` (book_id, pos, item_title, html) to chapters: text normalised, those under 100 characters
    left out, the rest numbered from 0."""
    from pyspark.sql import Window

    texts = items.withColumn("content", normalize_text(html_to_text("html"))).where(F.length("content") >= T.MIN_CHAPTER)
    numbered = texts.withColumn("chapter_index", F.row_number().over(Window.partitionBy("book_id").orderBy("pos")) - 1)
    return numbered.select("book_id", "chapter_index", chapter_title(F.col("item_title"), F.col("html"), F.col("chapter_index")).alias("chapter_title"), "content", word_count(F.col("content")).alias("word_count"))
