"""WARC archives: written from a table, indexed by one pass over the headers, read by coalesced byte ranges.

Writing uses Spark's text writer with the record separator as line separator, so files appear only when
their task commits and any store that Spark writes to will do. Identical payloads are stored once; the
other records are revisits that carry the digest and refer to the stored one.

Index and reading open the archive through Arrow's file systems (local and shared folders, HDFS, object
stores). One task scans a file, jumping from header to header; files hold at most ``RECORDS`` records.
"""

from __future__ import annotations

import os
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map

RECORDS = 50_000
WINDOW = 4 << 20
GAP = 64 << 10
TASK = 16 << 20  # bytes that one task reads back
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, 32 characters."""
    digest = F.sha1(payload)
    parts = [F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 10).cast("long") for k in range(4)]
    letters = [F.substring(F.lit(BASE32), (F.shiftright(p, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for p in parts for shift in range(35, -1, -5)]
    return F.concat(*letters)


def write_archive(pages: DataFrame, folder: str, scratch: Scratch, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One WARC record per row, under ``folder``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a
    response, the others revisit it. A null payload is empty, a null url leaves the header out. A row
    without id is a revisit if a copy has one, else a response; rows repeating the largest id are all
    responses. Other columns are not read; an empty table gives an archive without records.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    # only payloads that occur again go through the join; it is small next to the rows and may be hot
    copies = rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = scratch.keep(copies.select("digest", "bytes", "first"))
    rows = rows.join(copies, ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    line = "\r\n"
    name = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    clean = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("bytes").cast("string"), F.lit(line * 2))
    block = F.concat(http.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: "), name("id"),
        F.lit(f"{line}WARC-Date: {date}"),
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit(f"{line}WARC-Target-URI: "), clean)),
        F.lit(f"{line}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{line}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{line}WARC-Refers-To: "), name("first"))).otherwise(""),
        F.lit(f"{line}Content-Type: application/http; msgtype=response{line}Content-Length: "), F.octet_length("block").cast("string"), F.lit(line * 2),
    )
    record = rows.withColumn("block", block).select(F.concat(head.cast("binary"), F.col("block")).cast("string").alias("value"))
    record.write.option("lineSep", line * 2).option("maxRecordsPerFile", RECORDS).text(folder)
    scratch.drop(copies)


def _open(path: str):
    """An Arrow input file for a path as Spark names it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(path[5:]) if not os.path.exists(path[5:].replace("//", "/", 1)) else path[5:].replace("//", "/", 1))
    store, inner = fs.FileSystem.from_uri(path if "://" in path else "file://" + quote(path))
    return store.open_input_file(inner)


def scan(file, size: int, step: int = 256 << 10):
    """(offset, length, block offset, headers, HTTP headers) of every record, reading past payloads where they are long."""
    held, base = b"", 0
    offset = 0

    def need(upto: int) -> None:
        nonlocal held, base
        if offset < base or offset > base + len(held):
            held, base = b"", offset
        elif offset > base:
            held, base = held[offset - base :], offset
        while base + len(held) < min(upto, size):
            more = file.read_at(max(step, upto - base - len(held)), base + len(held))
            if not more:
                break
            held += more

    def headers(start: int):
        reach = start + 4096
        while True:
            need(reach)
            end = held.find(b"\r\n\r\n", start - base)
            if end >= 0:
                lines = held[start - base : end].decode("utf-8", "replace").split("\r\n")
                return end + 4 + base, lines[0], dict((a.lower(), b.strip()) for a, _, b in (x.partition(":") for x in lines[1:]))
            if reach >= size:
                raise ValueError(f"a record at {offset} has no end of headers")
            reach = start + 2 * (reach - start)

    while offset < size:
        block, first, head = headers(offset)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {offset}")
        length = int(head["content-length"])
        http = headers(block) if length and "http" in head.get("content-type", "") else (block, "", {})
        end = block + length + 4
        yield offset, end - offset, http[0], head, http[2]
        offset = end


INDEX = "path string, offset long, length long, payload_offset long, record_id string, id long, type string, url string, digest string, refers_to long, payload_bytes long"


def index_archive(spark, folder: str) -> DataFrame:
    """The index: place and length of each record, its id, type, url, digest, reference and payload size."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")

    def key(name: str | None) -> int | None:
        inner = (name or "")[12:-1]
        return int(inner) if inner else None

    def rows(source):
        for f in source:
            with _open(f["path"]) as file:
                for offset, length, payload, head, http in scan(file, f["length"]):
                    name = head.get("warc-record-id")
                    yield (
                        f["path"], offset, length, payload, name, key(name), head.get("warc-type"), head.get("warc-target-uri"),
                        head.get("warc-payload-digest", "").removeprefix("sha1:") or None, key(head.get("warc-refers-to")),
                        int(http["content-length"]) if "content-length" in http else None,
                    )

    return arrow_map(files, INDEX, rows)


def read_payloads(selected: DataFrame, *, window: int = WINDOW, gap: int = GAP) -> DataFrame:
    """``record_id, id, payload`` (binary) of the selected index rows.

    Records are grouped by file and window, so a group is bounded by the window's bytes whatever was
    selected; within it they are sorted and read in ranges that join over gaps of up to ``gap`` bytes. The number
    of tasks follows the bytes to be read, not the few bytes of the index.
    """
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK))
    placed = selected.withColumn("window", F.floor(F.col("offset") / window)).repartition(int(tasks), "path", "window")
    plan = placed.groupBy("path", "window").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length", "payload_offset", "record_id", "id"))).alias("records")
    )

    def rows(source):
        for r in source:
            with _open(r["path"]) as file:
                for run in ranges(r["records"], gap, window):
                    start = run[0]["offset"]
                    data = file.read_at(run[-1]["offset"] + run[-1]["length"] - start, start)
                    for x in run:
                        yield x["record_id"], x["id"], data[x["payload_offset"] - start : x["offset"] + x["length"] - 4 - start]

    return arrow_map(plan.select("path", "records"), "record_id string, id long, payload binary", rows, size=500)


def ranges(records: list[dict], gap: int, most: int):
    """Runs of sorted records that are read at once: small gaps are read through, runs are bounded."""
    run: list[dict] = []
    for r in records:
        if run and (r["offset"] - run[-1]["offset"] - run[-1]["length"] > gap or r["offset"] + r["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` as an archive and read it back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Size and digest of a response come from the payload that was read, those of a revisit from its record.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.folder()
    write_archive(pages, folder, scratch, **columns)
    index = scratch.keep(index_archive(pages.sparkSession, folder))
    stored = read_payloads(index.where("type = 'response'"))
    first = stored.select(F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = index.where("type = 'revisit'").select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    return first.unionByName(again)
