"""WARC archives with one Zstandard dictionary each.

An archive starts with a skippable frame that holds the dictionary, built from records of that archive;
then each record is a frame of its own, so a reader with the dictionary can start at any record. Equal
payloads are stored once: the record with the largest page_id is the response, the others are revisits
without payload. Archives are files in a shared folder, written by executors and read back by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import checkpoint, new_folder, ranked, table

#: Fixed values of the format: magic number of the frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
#: Fixed values of the format: the profile of a revisit record with an identical payload.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Raw bytes of records in an archive, of the sample for its dictionary, and of the dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICT_BYTES = 12 << 20, 1 << 20, 64 << 10
LEVEL = 3


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: object) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response, or with ``payload`` None a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {_urn(page)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The bytes of an archive."""
    import zstandard as z

    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[: 128 << 10])
        size += len(sample[-1])
    try:
        trained = z.train_dictionary(min(DICT_BYTES, max(1024, size // 16)), sample).as_bytes()
    except z.ZstdError:  # too few records to train on: their start is a dictionary as it is
        trained = b"".join(sample)[:DICT_BYTES]
    known = z.ZstdCompressionDict(trained)
    known.precompute_compress(level=LEVEL)
    pack = z.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    return struct.pack("<II", SKIPPABLE, len(trained)) + trained + b"".join(pack.compress(r) for r in records)


def unpack(content: bytes) -> bytes:
    """All records of an archive, decompressed with the dictionary in its first frame."""
    import zstandard as z

    magic, n = struct.unpack_from("<II", content)
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't start with a dictionary frame")
    reader = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(content[8 : 8 + n])).stream_reader(content[8 + n :], read_across_frames=True)
    return reader.read()


def parse(raw: bytes) -> Iterator[dict]:
    """Records as dictionaries of their fields, with ``payload`` and ``payload_bytes``."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = int(fields["Content-Length"])
        block = raw[end + 4 : end + 4 + size]
        if lines[0] != "WARC/1.1" or len(block) != size:
            raise ValueError("broken record")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
        fields["payload"] = payload if fields["WARC-Type"] == "response" else None
        if fields["payload"] is not None and sha1_base32(payload) != fields["WARC-Payload-Digest"][5:]:
            raise ValueError(f"wrong payload digest in {fields['WARC-Record-ID']}")
        yield fields
        at = end + 4 + size + 4


def _page(urn: str | None) -> int | None:
    return None if urn in (None, "<urn:page:null>") else int(urn[len("<urn:page:") : -1])


def plan(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html (null for revisits), payload_bytes, sha1 (20 bytes), refers_to.

    Only ids and digests are grouped and meet; the html moves once at most, dealt by page_id, so a payload
    with a third of all rows is in no single task.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.unhex(F.sha1(html.cast("binary"))).alias("sha1"))
    bare = table(keyed.where(F.col("payload_bytes") >= least).groupBy("page_id", "sha1").agg(F.count("*").alias("n")))
    repeated = bare.groupBy(F.col("sha1").alias("of")).agg(F.max("page_id").alias("last"), F.sum("n").alias("all")).where("all > 1 and last is not null").drop("all")
    # Rows that aren't named here are responses.
    named = table(bare.join(repeated, F.col("sha1") == F.col("of")).where("n > 1 or not page_id <=> last").select(F.col("page_id").alias("p"), F.col("sha1").alias("s"), "last", "n"))
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s"))
    last = F.col("page_id").eqNullSafe(F.col("last"))
    columns = ["page_id", "url", "html", "payload_bytes", "sha1"]
    revisit = lambda rows, is_: rows.select("page_id", "url", F.when(~is_, F.col("html")).alias("html"), "payload_bytes", "sha1", F.when(is_, F.col("last")).alias("refers_to"))
    out = revisit(keyed.join(named.where("not p <=> last"), same, "left").select(*columns, "last"), F.col("last").isNotNull())
    again = named.where("p <=> last")
    if again.limit(1).count():
        # Rows that repeat the largest page_id: the first by url is the response.
        out = out.join(again.select("p", "s"), same, "left_anti")
        many = ranked(keyed.join(again, same).where(last).select(*columns, "last"), ["page_id", "sha1"], [F.col("url")])
        out = out.unionByName(revisit(many, F.col("rank") > 0))
    return out


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder``, a URI that all executors reach.
    Returns the list of archives: name, records. A lost task leaves files that the list doesn't name."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []
        size = 0

        def flush() -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(archive(held))
            return pd.DataFrame({"name": [name], "records": [len(held)]})

        for pdf in batches:
            for page, url, html, n, sha1, refers in zip(*(pdf[c] for c in ("page_id", "url", "html", "payload_bytes", "sha1", "refers_to")), strict=True):
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                held.append(record(page, url, None if html is None else html.encode(), int(n), base64.b32encode(sha1).decode(), refers))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return checkpoint(plan(pages, least).mapInPandas(write, "name string, records long"))


def read_archives(folder: str, listed: DataFrame) -> DataFrame:
    """Records of the listed archives, each opened where its name is: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, payload. Each response's payload is held against its digest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            for name in pdf["name"]:
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    content = source.read()
                rows = [
                    (_page(r["WARC-Record-ID"]), r["payload_bytes"], r["WARC-Payload-Digest"][5:], r["WARC-Type"], _page(r.get("WARC-Refers-To")), r["WARC-Target-URI"], r["payload"])
                    for r in parse(unpack(content))
                ]
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return listed.select("name").mapInPandas(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def warc_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all ``pages`` to archives in a new folder of the shared one and read them back: one row per
    row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least ``least`` bytes the one with the largest page_id is the response, and
    smaller payloads are all responses. Null html is the empty payload. Of rows that repeat the largest
    page_id one is the response and the others revisit it, under the same page_id. A null page_id never is
    the largest; if there is no other, a revisit couldn't name its response, so rows are all responses. An
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    listed = write_archives(pages, folder, least)
    if not listed.limit(1).count():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(folder, listed).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 from hexadecimal: groups of 40 bits are ten hexadecimal figures and eight letters.
SQL = """
WITH g AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS last, row_number() OVER (PARTITION BY h, page_id ORDER BY url) AS rn FROM (SELECT page_id, url, coalesce(html, '') AS h FROM pages)),
r AS (SELECT *, last IS NULL OR coalesce(page_id = last AND rn = 1, false) AS response FROM g)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(s, (i // 8) * 10 + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN response THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT response THEN last END AS refers_to FROM r
"""
