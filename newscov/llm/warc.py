"""WARC records in ZIP archives: written as stored members, read back by byte ranges.

An archive holds pairs of stored (uncompressed) members: ``archive/data-N.warc.gz``, one gzip
member per record, and ``indexes/data-N.cdxj``, one line per record with its place in there. A
reader looks at the end of the file for the central directory, from there finds where the
members lie, reads the index members and then any record by its own byte range; nothing is
unpacked. Sizes and places beyond 32 bits, and more than 65,535 members, use the ZIP64 fields.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import shared_folder, stored

# --- fixed values of the formats ------------------------------------------------
LOCAL_HEADER = "<4s5H3L2H"
CENTRAL_HEADER = "<4s6H3L5H2L"
END = "<4s4H2LH"
END64 = "<4sQ2H2L4Q"
LOCATOR64 = "<4sLQL"
LOCAL_MARK, CENTRAL_MARK, END_MARK = b"PK\3\4", b"PK\1\2", b"PK\5\6"
END64_MARK, LOCATOR64_MARK = b"PK\6\6", b"PK\6\7"
STORED = 0
ZIP64_FIELD = 1
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values --------------------------------------------------------

#: Compressed bytes after which a member, and stored bytes after which an archive, is closed.
MEMBER_BYTES = 8 << 20
ARCHIVE_BYTES = 1 << 30
#: Bytes of archives a reading task gets, and the widest gap it reads over.
READ_BYTES = 16 << 20
MERGE_BYTES = 4 << 20
GZIP_LEVEL = 4
RECORD_DATE = "2000-01-01T00:00:00Z"
PAGE_URN = "urn:page:"
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))

INDEX_NAMES = (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
RECORDS = "page_id LONG, payload_bytes LONG, payload_digest STRING, record_type STRING, refers_to LONG"


class ZipWriter:
    """Stored members one after the other, then the central directory."""

    def __init__(self, out: BinaryIO, force_zip64: bool = False) -> None:
        self.out, self.force, self.at, self.members = out, force_zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, data: bytes) -> int:
        """Store one member; returns where its data begins."""
        wide = self.force or len(data) >= FULL32
        extra = struct.pack("<2H2Q", ZIP64_FIELD, 16, len(data), len(data)) if wide else b""
        size, crc, start, coded = FULL32 if wide else len(data), zlib.crc32(data), self.at, name.encode()
        self._put(struct.pack(LOCAL_HEADER, LOCAL_MARK, 45 if wide else 20, 0x800, STORED, 0, 33, crc, size, size, len(coded), len(extra)))
        self._put(coded + extra)
        begin = self.at
        self._put(data)
        self.members.append((coded, crc, len(data), start))
        return begin

    def close(self) -> int:
        """Write the directory; returns the size of the archive."""
        begin = self.at
        for name, crc, size, start in self.members:
            wide_size, wide_start = self.force or size >= FULL32, self.force or start >= FULL32
            values = [size, size] * wide_size + [start] * wide_start
            extra = struct.pack(f"<2H{len(values)}Q", ZIP64_FIELD, 8 * len(values), *values) if values else b""
            size, start = FULL32 if wide_size else size, FULL32 if wide_start else start
            version = 45 if values else 20
            self._put(
                struct.pack(CENTRAL_HEADER, CENTRAL_MARK, version, version, 0x800, STORED, 0, 33, crc, size, size, len(name), len(extra), 0, 0, 0, 0, start
                )
            )
            self._put(name + extra)
        size, n = self.at - begin, len(self.members)
        if self.force or n >= FULL16 or size >= FULL32 or begin >= FULL32:
            end = self.at
            self._put(struct.pack(END64, END64_MARK, struct.calcsize(END64) - 12, 45, 45, 0, 0, n, n, size, begin))
            self._put(struct.pack(LOCATOR64, LOCATOR64_MARK, 0, end, 1))
            n, size, begin = FULL16, FULL32, FULL32
        self._put(struct.pack(END, END_MARK, 0, 0, n, n, size, begin, 0))
        return self.at


def read_range(file: BinaryIO, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"archive ends at {start + len(data)}, expected {start + length}")
    return data


def _directory(file: BinaryIO, total: int) -> tuple[int, int]:
    """Where the central directory begins and how long it is."""
    tail_at = max(0, total - struct.calcsize(END) - FULL16)
    tail = read_range(file, tail_at, total - tail_at)
    at = tail.rfind(END_MARK)
    while at >= 0:  # a comment may hold the mark; the true one's comment ends the file
        if len(tail) - at >= struct.calcsize(END) and at + struct.calcsize(END) + struct.unpack_from(END, tail, at)[-1] == len(tail):
            break
        at = tail.rfind(END_MARK, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    *_, n, size, begin, _ = struct.unpack_from(END, tail, at)
    locator = tail_at + at - struct.calcsize(LOCATOR64)
    if (n == FULL16 or FULL32 in (size, begin)) and locator >= 0:
        mark, _, end64, _ = struct.unpack(LOCATOR64, read_range(file, locator, struct.calcsize(LOCATOR64)))
        if mark == LOCATOR64_MARK:
            *_, size, begin = struct.unpack(END64, read_range(file, end64, struct.calcsize(END64)))
    return begin, size


def zip_members(file: BinaryIO, total: int) -> Iterator[tuple[str, int, int, int]]:
    """Name, method, start of the data and size of every member, by the central directory."""
    begin, size = _directory(file, total)
    data, at = read_range(file, begin, size), 0
    while at < len(data):
        fields = struct.unpack_from(CENTRAL_HEADER, data, at)
        if fields[0] != CENTRAL_MARK:
            raise ValueError("damaged central directory")
        method, packed, plain = fields[4], fields[8], fields[9]
        names, extras, comments, start = fields[10], fields[11], fields[12], fields[16]
        at += struct.calcsize(CENTRAL_HEADER)
        name = data[at : at + names].decode()
        extra, at = data[at + names : at + names + extras], at + names + extras + comments
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<2H", extra)
            if kind == ZIP64_FIELD:
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                start = next(wide) if start == FULL32 else start
            extra = extra[4 + length :]
        local = struct.unpack(LOCAL_HEADER, read_range(file, start, struct.calcsize(LOCAL_HEADER)))
        if local[0] != LOCAL_MARK:
            raise ValueError(f"no local header at {start} for {name}")
        yield name, method, start + struct.calcsize(LOCAL_HEADER) + local[9] + local[10], packed


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC 1.1 record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<{PAGE_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", RECORD_DATE),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=PRINTABLE)))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(PAGE_URN)
    return int(number) if number else None


def _write_archives(folder: str, member_bytes: int, archive_bytes: int, force_zip64: bool):
    """Function over Arrow batches: writes archives, returns their paths and sizes.

    Every attempt of a task writes files of its own; those of attempts that did not count
    are in no row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out = zipped = None
        path, member, lines, held, number = "", [], [], 0, 0

        def close_member() -> None:
            nonlocal member, lines, held, number
            if member:
                zipped.add(f"archive/data-{number:05d}.warc.gz", b"".join(member))
                zipped.add(f"indexes/data-{number:05d}.cdxj", "".join(lines).encode())
                member, lines, held, number = [], [], 0, number + 1

        def close_archive() -> pa.RecordBatch:
            close_member()
            size = zipped.close()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size]})

        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "first_id")]):
                page_id, url, html, first = [v.as_py() for v in row]
                payload = html.encode() if html else b""
                digest = base32_sha1(payload)
                is_revisit = first is not None and first != page_id
                if zipped is None:
                    store.create_dir(base, recursive=True)
                    path, number = f"{base}/{uuid.uuid4().hex}.zip", 0
                    out = store.open_output_stream(path)
                    zipped = ZipWriter(out, force_zip64)
                packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, payload, digest, first, is_revisit)) + packer.flush()
                entry = {"offset": held, "length": len(data), "digest": digest, "filename": f"data-{number:05d}.warc.gz"}
                lines.append(f"{quote(url or '', safe=PRINTABLE)} {RECORD_DATE} {json.dumps(entry)}\n")
                member.append(data)
                held += len(data)
                if held >= member_bytes:
                    close_member()
                if zipped.at >= archive_bytes:
                    yield close_archive()
                    out = zipped = None
        if zipped is not None:
            yield close_archive()

    return write


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    member_bytes: int = MEMBER_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    force_zip64: bool = False,
) -> tuple[DataFrame, str]:
    """Write a record per row of ``pages(page_id, url, html)``; returns ``(path, bytes)`` rows and the folder.

    Of equal payloads of at least ``least_bytes`` the smallest page_id's is a response, all others
    revisit it. A null html is an empty payload. Rows that repeat that page_id are responses too.
    A null page_id counts as the largest; where all are null, all are responses. An empty table
    writes no archive. Other columns are not read. A task writes at least one archive, and its
    files stay if it is run again, under other names.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, F.sha1(F.col("html").cast("binary"))))
    # only payloads that come more than once; stored, so that its size decides how it is joined
    firsts = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    firsts = stored(firsts.where("n > 1").drop("n"), "warc-repeats")
    rows = rows.join(firsts, "digest", "left").select("page_id", "url", "html", "first_id")
    written = rows.mapInArrow(_write_archives(folder, member_bytes, archive_bytes, force_zip64), "path STRING, bytes LONG")
    return stored(written, "warc-archives"), folder


def _find_members(folder: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                with store.open_input_file(path) as file:
                    found = list(zip_members(file, size))
                if packed := [name for name, method, *_ in found if method != STORED]:
                    raise ValueError(f"{path}: members are not stored but compressed: {packed[:3]}")
                archives = json.dumps({name.rpartition("/")[2]: start for name, _, start, _ in found if name.startswith("archive/")})
                rows = [
                    (path, name, start, length, archives)
                    for name, _, start, length in found
                    if name.startswith("indexes/") and name.endswith(INDEX_NAMES)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), ["path", "name", "start", "length", "archives"])

    return find


def _find_records(folder: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as file:
                    index = read_range(file, row["start"], row["length"])
                if row["name"].endswith(".gz"):
                    index = gzip.decompress(index)
                entries = [json.loads(line.split(b" ", 2)[2]) for line in index.splitlines() if line and not line.startswith(b"!")]
                archives = json.loads(row["archives"])
                names = [e["filename"].rpartition("/")[2] for e in entries]
                if unknown := set(names) - set(archives):
                    raise ValueError(f"{row['path']}: {row['name']} names archives that the package lacks: {sorted(unknown)[:3]}")
                yield pa.RecordBatch.from_pydict({
                    "path": [row["path"]] * len(entries),
                    "start": pa.array([archives[n] + int(e["offset"]) for n, e in zip(names, entries)], pa.int64()),
                    "length": pa.array([int(e["length"]) for e in entries], pa.int64()),
                })

    return find


def _read_records(folder: str, with_payload: bool):
    def merged(rows: list[dict]) -> Iterator[list[dict]]:
        run: list[dict] = []
        for row in rows:
            if run and (
                row["path"] != run[0]["path"] or row["start"] < run[-1]["start"]
                or row["start"] + row["length"] - run[0]["start"] > MERGE_BYTES
            ):
                yield run
                run = []
            run.append(row)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        path, file = None, None
        for batch in batches:
            for run in merged(batch.to_pylist()):
                if run[0]["path"] != path:
                    path, file = run[0]["path"], store.open_input_file(run[0]["path"])
                begin = run[0]["start"]
                data = read_range(file, begin, run[-1]["start"] + run[-1]["length"] - begin)
                out: dict[str, list] = {c: [] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
                for row in run:
                    at = row["start"] - begin
                    fields, http, payload = parse_record(zlib.decompress(data[at : at + row["length"]], 31))
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base32_sha1(payload) != digest:
                        raise ValueError(f"{path}: payload at {row['start']} does not have its digest")
                    out["page_id"].append(_page(fields["WARC-Record-ID"]))
                    out["payload_bytes"].append(len(payload) if kind == "response" else int(http["Content-Length"]))
                    out["payload_digest"].append(digest)
                    out["record_type"].append(kind)
                    out["refers_to"].append(_page(fields["WARC-Refers-To"]) if kind == "revisit" else None)
                    out["payload"].append(payload if kind == "response" else None)
                kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
                yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in out.items() if with_payload or c != "payload"})

    return read


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives in ``archives(path, bytes)``.

    Records are found by the packages' indexes, plain or gzipped: an index line names its archive, so one index may
    serve several archives and an archive several indexes. A line that names none of the package's raises.

    Archives spread over tasks, then their index members, then byte ranges of records; what a
    record's task reads is that record's range, with its neighbours' where they touch. Revisits
    have a null payload. A payload that does not have its digest raises.
    """
    total = archives.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(1, math.ceil(total / READ_BYTES))
    members = archives.repartition(tasks).mapInArrow(_find_members(folder), "path STRING, name STRING, start LONG, length LONG, archives STRING")
    ranges = members.mapInArrow(_find_records(folder), "path STRING, start LONG, length LONG")
    ranges = ranges.repartitionByRange(tasks, "path", "start").sortWithinPartitions("path", "start")
    schema = RECORDS + (", payload BINARY" if with_payload else "")
    return ranges.mapInArrow(_read_records(folder, with_payload), schema)
