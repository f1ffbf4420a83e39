"""WARC archives with a two-level capture index, both in a folder that all executors reach.

``write_archives`` writes one record per page, each a gzip member of its own, and gives its place.  Of
pages with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the least id is
a response, the others revisit it.  ``write_index`` sorts the places by reversed-host
key and id, compresses runs of ``BLOCK_LINES`` lines, and keeps a sparse directory: the
first key and place of every block, in one file for each index file.  ``lookup``
finds captures by binary search: in the list of index files (at most ``parts``), in one file's
directory, and in one block, which is read by its range.  ``read_records`` reads the
records by their ranges, neighbours together.

Files are named by a fresh id in every attempt of a task and become known by the rows that the
task returns, so a retried or repeated task leaves at most a file that nothing
refers to.  Any file system that Arrow opens by a URI will do.

A null html is an empty payload, a null url an empty key; a null id sorts first and
never counts as the least.  Rows with the least id of their payload are all responses.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import stage, work_path

BLOCK_LINES = 3000
FILE_BYTES = 256 << 20
READ_BYTES = 4 << 20
LEAST_REVISIT = 100
NO_ID = -(1 << 63)
_UNSAFE = {c: f"%{c:02X}" for c in [*range(0x21), 0x7F]}


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then path and query, as in ``com,example,www)/a?b``."""
    url = (url or "").translate(_UNSAFE)
    try:
        parts = urlsplit(url if "://" in url else "//" + url)
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a URL: it stands for itself
        return url
    labels = [host] if ":" in host else host.split(".")[::-1]
    at = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    return f"{','.join(labels)}{at}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def surt_key(url: Column) -> Column:
    return F.arrow_udf(lambda urls: pa.array([surt(u.as_py()) for u in urls], pa.string()), "string")(url)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _new_file(folder: str, suffix: str):
    system, where = _open(folder)
    system.create_dir(where, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return name, system.open_output_stream(f"{where}/{name}", compression=None)


def read_range(path: str, offset: int, length: int) -> bytes:
    system, where = _open(path)
    with system.open_input_file(where) as file:
        return file.read_at(length, offset)


# Records.


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {(url or '').translate(_UNSAFE)}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        fields.append(f"WARC-Refers-To: <urn:x-page:{refers_to}>")
        payload = b""
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(head) + len(payload)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + head + payload + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record and its payload (None for a revisit)."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not first.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")

    def page(name):
        value = fields.get(name, "<urn:x-page:>")[len("<urn:x-page:") : -1]
        return int(value) if value else None

    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page": page("WARC-Record-ID"), "url": unquote(fields["WARC-Target-URI"]), "type": fields["WARC-Type"],
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "refers_to": page("WARC-Refers-To"),
        "payload": None if revisit else block.split(b"\r\n\r\n", 1)[1],
    }


def write_archives(
    df: DataFrame, page: str, url: str, html: str, folder: str, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Write all pages; (key, page, file, offset, length) of each record, as a written table."""
    rows = df.select(F.col(page).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    firsts = rows.filter(F.col("bytes") >= LEAST_REVISIT).groupBy("digest", "bytes").agg(
        F.min("page").alias("least"), F.count("*").alias("n")
    ).filter("n > 1 and least is not null").drop("n")
    rows = rows.join(firsts, ["digest", "bytes"], "left")
    rows = rows.withColumn("refers_to", F.when(~F.col("page").eqNullSafe(F.col("least")), F.col("least")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, at = None, "", 0
        try:
            for batch in batches:
                places = []
                for row in zip(*(batch.column(c) for c in ("page", "url", "payload", "digest", "refers_to"))):
                    page, url, payload, digest, refers_to = (x.as_py() for x in row)
                    if stream is None or at >= FILE_BYTES:
                        if stream is not None:
                            stream.close()
                        (name, stream), at = _new_file(folder, ".warc.gz"), 0
                    packer = zlib.compressobj(6, wbits=31)
                    raw = record(page, url, payload.encode(), digest, refers_to, date)
                    raw = packer.compress(raw) + packer.flush()
                    stream.write(raw)
                    places.append({"key": surt(url), "page": page, "file": name, "offset": at, "length": len(raw)})
                    at += len(raw)
                yield pa.RecordBatch.from_pylist(places, schema=_PLACE)
        finally:
            if stream is not None:
                stream.close()

    made = rows.select("page", "url", "payload", "digest", "refers_to").mapInArrow(write, _PLACE_KIND)
    return stage(made, "captures")


_PLACE_KIND = "key string, page bigint, file string, offset bigint, length bigint"
_PLACE = pa.schema([("key", pa.string()), ("page", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


# Index.


def _sort_key(key: str, page: int | None) -> tuple[str, int]:
    return key, NO_ID if page is None else page


def write_index(places: DataFrame, folder: str, parts: int) -> list[tuple[tuple[str, int], str]]:
    """Sorted, compressed index files with their directories; the first key and name of each of the at most ``parts`` files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, directory, at, name, stream = [], [], 0, "", None

        def block():
            nonlocal at
            raw = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode())
            stream.write(raw)
            directory.append((*lines[0][:2], at, len(raw)))
            at += len(raw)
            lines.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    name, stream = _new_file(folder, ".cdx")
                lines.append((*_sort_key(row["key"], row["page"]), row["file"], row["offset"], row["length"]))
                if len(lines) == BLOCK_LINES:
                    block()
        if stream is None:
            return
        if lines:
            block()
        stream.close()
        system, where = _open(folder)
        with system.open_output_stream(f"{where}/{name}.directory", compression=None) as out:
            out.write("\n".join("\t".join(map(str, x)) for x in directory).encode())
        yield pa.RecordBatch.from_pydict({"key": [directory[0][0]], "page": [directory[0][1]], "file": [name]})

    ordered = places.repartitionByRange(parts, F.col("key"), F.coalesce("page", F.lit(NO_ID)))
    ordered = ordered.sortWithinPartitions("key", F.coalesce("page", F.lit(NO_ID)))
    files = stage(ordered.mapInArrow(write, "key string, page bigint, file string"), "index")
    return sorted(((r.key, r.page), r.file) for r in files.collect())


@lru_cache(maxsize=4)
def _directory(path: str) -> tuple[list, list]:
    system, where = _open(f"{path}.directory")
    with system.open_input_stream(where, compression=None) as file:
        rows = [line.split("\t") for line in file.read().decode().split("\n")]
    return [(r[0], int(r[1])) for r in rows], [(int(r[2]), int(r[3])) for r in rows]


@lru_cache(maxsize=8)
def _block(path: str, offset: int, length: int) -> tuple[list, list]:
    rows = [line.split("\t") for line in zlib.decompress(read_range(path, offset, length)).decode().split("\n")]
    return [(r[0], int(r[1])) for r in rows], [(r[2], int(r[3]), int(r[4])) for r in rows]


def captures(files: list, folder: str, key: tuple[str, int]) -> Iterator[tuple[str, int, int]]:
    """Places of all records of one (key, page), found by binary search in the two levels and the block."""
    firsts = [f[0] for f in files]
    # Equal keys may begin in an earlier file or block than the last one whose first key is not above.
    for part in range(max(bisect.bisect_left(firsts, key) - 1, 0), bisect.bisect_right(firsts, key)):
        path = f"{folder}/{files[part][1]}"
        starts, ranges = _directory(path)
        for at in range(max(bisect.bisect_left(starts, key) - 1, 0), bisect.bisect_right(starts, key)):
            keys, places = _block(path, *ranges[at])
            yield from places[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]


def lookup(wanted: DataFrame, files: list, folder: str) -> DataFrame:
    """(key, page, file, offset, length) of the captures of each distinct (key, page) asked for."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                for file, offset, length in captures(files, folder, _sort_key(row["key"], row["page"])):
                    found.append({**row, "file": file, "offset": offset, "length": length})
            yield pa.RecordBatch.from_pylist(found, schema=_PLACE)

    # In key order, so that a task stays in few blocks.
    ordered = wanted.select("key", F.col("page").cast("long").alias("page")).distinct()
    ordered = ordered.repartitionByRange(F.col("key"), F.col("page")).sortWithinPartitions("key", "page")
    return ordered.mapInArrow(find, _PLACE_KIND)


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """(page, url, type, digest, refers_to, payload) of each place, read from the archives."""
    kind = "page bigint, url string, type string, digest string, refers_to bigint, payload binary"
    schema = pa.schema([("page", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("digest", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["file"], r["offset"], r["length"]) for b in batches for r in b.to_pylist())
        held, size = [], 0
        for file, near in _neighbours(rows):
            start = near[0][0]
            raw = read_range(f"{folder}/{file}", start, near[-1][0] + near[-1][1] - start)
            for offset, length in near:
                held.append(parse(zlib.decompress(raw[offset - start : offset - start + length], wbits=31)))
                size += len(held[-1]["payload"] or b"")
                if size >= READ_BYTES or len(held) >= 2000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    # By file and stretch of it: neighbours meet in a task, and a large archive is read by many.
    stretch = F.floor(F.col("offset") / (4 * READ_BYTES))
    near = places.select("file", "offset", "length").repartition("file", stretch).sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, kind)


def _neighbours(rows) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of records of one file that follow each other, up to about READ_BYTES."""
    name, near = None, []
    for file, offset, length in rows:
        joined = near and file == name and near[-1][0] <= offset <= near[-1][0] + near[-1][1] + (64 << 10)
        if near and not (joined and offset - near[0][0] < READ_BYTES):
            yield name, near
            near = []
        name = file
        near.append((offset, length))
    if near:
        yield name, near


def round_trip(df: DataFrame, page: str, url: str, html: str) -> DataFrame:
    """Write archives and index, then find and read every page again.

    (page, payload_bytes, payload_digest, type, refers_to): size and digest are of the payload
    as read; a revisit has those of the response that it refers to.
    """
    spark = df.sparkSession
    folder = work_path(spark, "warc")
    places = write_archives(df, page, url, html, folder)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = write_index(places, folder, parts)
    wanted = df.select(surt_key(F.col(url)).alias("key"), F.col(page).alias("page"))
    records = read_records(lookup(wanted, files, folder), folder)
    read = records.select(
        "page", "type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2("payload", 256).alias("sha"),
    )
    read = stage(read, "records")
    responses = read.filter("type = 'response'")
    full = responses.select(F.col("page").alias("refers_to"), "digest", "bytes", "sha").dropDuplicates(["refers_to", "digest"])
    revisits = read.filter("type = 'revisit'").select("page", "type", "refers_to", "digest").join(full, ["refers_to", "digest"], "left")
    columns = ["page", "bytes", "sha", "type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns)).toDF(
        "page", "payload_bytes", "payload_digest", "type", "refers_to"
    )
