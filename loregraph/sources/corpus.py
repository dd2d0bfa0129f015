"""Wiki files and folders of markdown entities as tables; both are outside data, so odd parts are left out."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from loregraph import types as T
from loregraph.operators.wiki import markdown_parts


def read_wiki(spark: SparkSession, path: str, labels: bool = False) -> DataFrame:
    """entity_type, wiki_name, description of each entry that is a text or an object; events are named by
    ``event``. With ``labels`` events are of type 'timeline'."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    parts = []
    for t in T.TYPES:
        field = "event" if t.name == "timeline_event" else "name"
        items = raw.select(F.explode(F.try_variant_get("v", f"$.{t.wiki_key}", "array<variant>")).alias("x"))
        # An object cast to text is its JSON; a text entry is itself.
        name = F.coalesce(F.try_variant_get("x", f"$.{field}", "string"), F.when(F.schema_of_variant("x") == "STRING", F.try_variant_get("x", "$", "string")))
        parts.append(items.select(F.lit(t.label if labels else t.name).alias("entity_type"), name.alias("wiki_name"), F.coalesce(F.try_variant_get("x", "$.description", "string"), F.lit("")).alias("description")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("coalesce(wiki_name, '') <> ''")


def wiki_names(wiki: DataFrame) -> DataFrame:
    return wiki.select("entity_type", F.lower("wiki_name").alias("wiki_name")).distinct()


def _shown(value: object) -> str:
    """A value as text: lists of scalars joined by commas, other nested values as JSON."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list) and not any(isinstance(x, (list, dict)) for x in value):
        return ", ".join(_shown(x) for x in value)
    return json.dumps(value, default=str, ensure_ascii=False) if isinstance(value, (list, dict)) else str(value)


def _flat(text: str) -> dict[str, object] | None:
    """Scalars and flat lists, for where no YAML library is installed; None if a line is neither."""
    out: dict[str, object] = {}
    key = None
    for line in text.splitlines():
        item = line.strip()
        if not item or item.startswith("#"):
            continue
        if item.startswith("- ") and key is not None:
            out[key] = [*(out[key] if isinstance(out[key], list) else []), item[2:].strip().strip("\"'")]
        elif ":" in item and line[0] not in " \t":
            key, _, value = (x.strip() for x in item.partition(":"))
            out[key] = [v.strip().strip("\"'") for v in value[1:-1].split(",") if v.strip()] if value.startswith("[") else value.strip("\"'")
        else:
            return None
    return out


def front_matter_of(content: str | None) -> dict[str, str] | None:
    """Keys and values between the opening '---' and the first '---' after it, anywhere; see ``_shown``. Null
    without front matter, or if it's no mapping."""
    if content is None or not content.startswith("---"):
        return None
    end = content.find("---", 3)
    if end < 0:
        return None
    try:
        import yaml
    except ImportError:
        found = _flat(content[3:end])
    else:
        try:
            found = yaml.safe_load(content[3:end])
        except yaml.YAMLError:
            found = None
    return {str(k): _shown(v) for k, v in found.items()} if isinstance(found, dict) else None


@F.pandas_udf(S.MapType(S.StringType(), S.StringType()))
def front_matter(content: pd.Series) -> pd.Series:
    return content.map(front_matter_of)


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """path, name, entity_type, content, description, front_matter of the ``*.md`` files in the type
    folders, those that begin with '_' left out. Folders that are missing have no files."""
    parts = None
    for t in T.TYPES:
        try:
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(f"{root}/{t.folder}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        named = files.select("path", F.decode("content", "UTF-8").alias("content"), F.lit(t.name).alias("entity_type"))
        parts = named if parts is None else parts.unionByName(named)
    if parts is None:
        parts = spark.createDataFrame([], "path string, content string, entity_type string")
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.md$", "")
    return markdown_parts(parts.withColumn("name", name).where(~F.col("name").startswith("_"))).withColumn("front_matter", front_matter("content"))
