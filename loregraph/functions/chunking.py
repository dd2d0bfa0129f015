"""Overlapping chunks that end at paragraphs or sentences, cut in one walk over each text on Arrow batches.

Where a chunk begins depends on where the one before ended, so a column expression would have to fold over
the text and cut each window from its start again; the walk takes time in proportion to the text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from loregraph import types as T


def cut(text: str, size: int, overlap: int) -> list[str]:
    """The chunks of one text, see ``chunks``."""
    if len(text) <= size:
        return [text]
    out, at, half = [], 0, size // 2
    while at + size < len(text):
        stop = text.rfind("\n\n", at, at + size)
        if stop <= at + half:
            stop = text.rfind(". ", at, at + size) + 1
            if stop - 1 <= at + half:
                stop = at + size
        out.append(text[at:stop].strip())
        at = stop - overlap
    return [*out, text[at:].strip()]


def chunks(text: Column, size: int = T.CHUNK_SIZE, overlap: int = T.CHUNK_OVERLAP) -> Column:
    """array<string>. A text of up to ``size`` characters is one chunk as it is. Else a chunk ends at the
    last blank line in its second half, else after the last sentence end there, else at ``size``; chunks
    are stripped, and each but the first starts ``overlap`` characters before the end of the one before.
    ``overlap`` above half of ``size`` wouldn't advance and is refused. Null text has null chunks."""
    half = size // 2
    if overlap > half or overlap < 0 or size < 2:
        raise ValueError(f"overlap must be between 0 and {half}")

    @F.pandas_udf(S.ArrayType(S.StringType()))
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else cut(t, size, overlap))

    return walk(text)


def explode_chunks(chapters: DataFrame, size: int = T.CHUNK_SIZE, overlap: int = T.CHUNK_OVERLAP) -> DataFrame:
    """``chapters`` (…, chapter_index, content) with chunk_idx, chunk_id and text, a row a chunk."""
    cut = chapters.select(*[c for c in chapters.columns if c != "content"], F.posexplode(chunks(F.col("content"), size, overlap)).alias("chunk_idx", "text"))
    return cut.withColumn("chunk_id", F.concat(F.lit("chapter_"), F.col("chapter_index").cast("string"), F.lit(":chunk_"), F.col("chunk_idx").cast("string")))
