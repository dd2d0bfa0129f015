"""The entity types, in the one table from which prefixes, folders, prompts and wiki keys derive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EntityType:
    name: str
    prefix: str
    wiki_key: str | None
    folder: str
    details: tuple[str, ...]
    label: str


# Types with their id prefix, key in wiki files, corpus folder and describing fields.
TYPES = (
    EntityType("character", "char", "characters", "characters", ("physical_traits", "personality_traits", "abilities", "role", "species"), "character"),
    EntityType("location", "loc", "locations_or_places", "locations", ("location_type", "environment", "architecture", "atmosphere"), "location"),
    EntityType("faction", "fac", "factions", "factions", ("faction_type", "goals", "traits"), "faction"),
    EntityType("timeline_event", "evt", "timeline_events", "timeline", ("event_type", "temporal_marker", "participants", "consequences"), "timeline"),
)
BY_NAME = {t.name: t for t in TYPES}
#: Fields that are text or number; the other describing fields are lists of texts.
SCALAR = frozenset(["role", "species", "location_type", "faction_type", "event_type", "temporal_marker"])
#: Prefix and folder of types that aren't in the table.
OTHER_PREFIX, OTHER_FOLDER = "ent", "characters"

# Sizes and limits that results depend on.
CHUNK_SIZE, CHUNK_OVERLAP, FUZZY, MAX_RETRIES = 24_000, 400, 85, 3
MIN_CHAPTER, MAX_TITLE, MAX_CONTEXTS, MAJOR_COUNT = 100, 100, 50, 10
BOOK_ID_LENGTH, ENTITY_ID_LENGTH = 50, 30
CLEANUP_FUZZY, SCORE_MAJOR, SCORE_MINOR = 80, 70, 40
CHECKPOINT_EVERY, SILENT_SECONDS, PROGRESS_CAP = 5, 60, 95
PREVIEW, CONTEXT_LIMIT, CONTEXT_WARN = 500, 32_768, 90.0

MENTIONS = "book_id string, chapter_index int, chapter_title string, chunk_id string, ord long, name string, aliases array<string>, entity_type string, context string"


def _lookup(column: Column, values: dict[str, str], other: str) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(other))


def id_prefix(entity_type: Column) -> Column:
    return _lookup(entity_type, {t.name: t.prefix for t in TYPES}, OTHER_PREFIX)


def folder(entity_type: Column) -> Column:
    return _lookup(entity_type, {t.name: t.folder for t in TYPES}, OTHER_FOLDER)
