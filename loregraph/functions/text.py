"""Column functions on text: normal form, ids, hashes, counts, previews."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S

from loregraph import types as T

#: White space as meant here: Unicode's, and the four separators 1C to 1F.
SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


@F.pandas_udf(S.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(text: Column) -> Column:
    """Canonical composition. Only texts with a character from U+0300 on can change and go to Python."""
    return F.coalesce(_nfc(F.when(text.rlike(r"[^\x00-\x{2FF}]"), text)), text)


def normalize_text(text: Column) -> Column:
    """NFC; tabs, carriage returns, form feeds and U+000B become spaces, runs of spaces one, three or
    more line ends two; ends stripped."""
    spaced = F.regexp_replace(F.regexp_replace(nfc(text), r"[\t\r\f\x0B]+", " "), " +", " ")
    return strip(F.regexp_replace(spaced, r"\n{3,}", "\n\n"))


def _slug(text: Column, length: int) -> Column:
    kept = F.regexp_replace(F.lower(text), r"(?U)[^a-z0-9\s]", "")
    return F.regexp_replace(F.substring(F.regexp_replace(kept, r"(?U)\s+", "_"), 1, length), "^_+|_+$", "")


def book_id(title: Column, author: Column) -> Column:
    """Title and author fuse: what joins them isn't a character that the slug keeps."""
    return _slug(F.concat(title, F.lit("_"), author), T.BOOK_ID_LENGTH)


def entity_id(name: Column, entity_type: Column) -> Column:
    return F.concat(T.id_prefix(entity_type), F.lit("_"), _slug(name, T.ENTITY_ID_LENGTH))


def valid_entity_id(value: Column) -> Column:
    return value.rlike("^[a-z_]+_[a-z0-9_]+$")


def content_hash(text: Column, length: int = 64) -> Column:
    return F.left(F.sha2(text, 256), F.lit(length))


def idempotency_key(book: Column, chapter: Column, chunk: Column, operation: Column, hashed: Column | None = None) -> Column:
    """From the content's hash where there is one, else from the position."""
    place = F.concat_ws(":", book, chapter.cast("string"), chunk.cast("string"), operation)
    if hashed is None:
        return content_hash(place, 16)
    return content_hash(F.when(hashed.isNotNull() & (hashed != ""), F.concat_ws(":", book, operation, hashed)).otherwise(place), 16)


def normalize_name(name: Column) -> Column:
    bare = F.lower(F.replace(F.replace(name, F.lit(".md"), F.lit("")), F.lit("_"), F.lit(" ")))
    return strip(F.regexp_replace(bare, rf"{SPACE}+", " "))


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("int")


def context_usage(prompt: Column, system: Column, limit: Column | int = T.CONTEXT_LIMIT) -> Column:
    """struct<tokens, percent, warn>: estimated share of the model's window."""
    tokens = token_estimate(prompt) + token_estimate(system)
    size = F.lit(limit) if isinstance(limit, int) else limit
    percent = tokens.cast("double") / size * 100
    return F.struct(tokens.alias("tokens"), percent.alias("percent"), (percent > T.CONTEXT_WARN).alias("warn"))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, rf"{SPACE}+"), "")).cast("int")


def preview(text: Column, length: int = T.PREVIEW) -> Column:
    return F.when(F.length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit("..."))).otherwise(text)


def chapter_of(chunk_id: Column) -> Column:
    return F.substring_index(chunk_id, ":", 1)


def recovered_json(response: Column) -> Column:
    """VARIANT of a model's answer: the whole text, else its first fenced block, else from the first
    brace to the last; null if none parses."""
    fence = F.regexp_extract(response, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    braces = F.regexp_extract(response, r"(?s)\{.*\}", 0)
    return F.coalesce(F.try_parse_json(response), F.try_parse_json(fence), F.try_parse_json(braces))
