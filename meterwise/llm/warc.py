"""WARC archives with dictionary-compressed records (``.warc.zst``).

Each archive starts with a skippable Zstandard frame that holds the dictionary,
itself compressed; every record then is a frame of its own, compressed with that
dictionary, so records can be read one by one. The dictionary is built from a
bounded sample of the archived records.

Writing runs in Spark tasks, one or more archives for each partition, rolled over
at ``roll_bytes``. A task's archives count only when its rows of the manifest (a
table in the shared folder) are committed, so a lost or repeated task leaves no
double records: its other files are not listed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch

#: Fixed values of the .warc.zst and WARC/1.1 formats.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "path string, records long, bytes long"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given.

    Characters that can't stand in a header line are percent-encoded.
    """
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_id(page_id, digest),
            "WARC-Date": date, "WARC-Target-URI": uri or f"urn:page:{page_id}",
            "WARC-Payload-Digest": f"sha1:{_base32(digest)}", "X-Payload-Length": str(len(payload)),
            "Content-Type": "application/http; msgtype=response"}
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "X-Refers-To-Page-ID": str(refers_to)}
    block = HTTP_HEAD + (payload if refers_to is None else b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record (the payload of a revisit is empty)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, block.partition(b"\r\n\r\n")[2]


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A Zstandard dictionary for records like ``samples``; empty if they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame; nothing without a dictionary."""
    import zstandard

    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICT_MAGIC, len(packed)) + packed


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """The archive's frames as (magic number, bytes), found by their block headers."""
    import zstandard

    at = 0
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end = at + zstandard.frame_header_size(data[at:at + 18])
            last = False
            while not last:
                head = int.from_bytes(data[end:end + 3], "little")
                last = bool(head & 1)
                end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            end += 4 * zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
        else:
            raise ValueError(f"no Zstandard frame at {at}")
        yield magic, data[at:end]
        at = end


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of one archive, in order."""
    import zstandard

    reader = zstandard.ZstdDecompressor()
    for magic, frame in frames(memoryview(data)):
        if magic == DICT_MAGIC:
            known = zstandard.ZstdDecompressor().decompress(frame[8:])
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known))
        elif magic == FRAME_MAGIC:
            yield reader.decompress(frame)


def _writer(folder: str, shared, date: str, roll_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        dictionary = shared.value
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        out, name, records, size = None, None, 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name, records = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    size = out.write(archive_head(dictionary))
                size += out.write(packer.compress(record_bytes(page_id, url, html.encode(), digest, refers_to, date)))
                records += 1
                if size >= roll_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
    return run


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    data = f.read()
                for record in read_archive(data):
                    head, payload = parse_record(record)
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if head["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"a payload's digest is wrong in {path}")
                    number = {k: int(head[k]) if k in head else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
                    rows.append({"page_id": number["X-Page-ID"], "url": head["WARC-Target-URI"], "record_type": head["WARC-Type"],
                                 "payload_bytes": int(head["X-Payload-Length"]), "payload_digest": digest,
                                 "refers_to": number["X-Refers-To-Page-ID"],
                                 "payload": payload if head["WARC-Type"] == "response" else None})
                    size += len(payload)
                    if size > 4 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)
    return run


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]))


def write_archives(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 1000, sample: int = 1000,
                   sample_bytes: int = 64 << 10, roll_bytes: int = 64 << 20, level: int = 3,
                   date: str = "2000-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write a record for every row of ``pages`` (page_id, url, html); returns the folder and its manifest.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes, that with the
    largest page_id is the response and the others revisit it; rows that repeat its
    page_id too are responses as well. The dictionary is trained on about ``sample``
    records of up to ``sample_bytes`` bytes, chosen by hash; with fewer than 8 there
    is none. ``folder`` is a URI in a store that all executors share.

    * null html: an empty payload; null url: the target is ``urn:page:<page_id>``;
    * null page_id: never the response of others; if no row of a payload has one, all
      its rows are responses;
    * an empty table writes no archive; other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = folder or scratch.folder("archives")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    slim = rows.select("page_id", "digest", F.octet_length("html").alias("n"), F.xxhash64("digest", F.lit(1)).alias("u"))
    facts = slim.agg(F.sum((F.col("n") <= sample_bytes).cast("long"))).first()[0] or 0
    share = min(1.0, sample / facts) if facts else 0.0
    chosen = (F.octet_length("html") <= sample_bytes) & (F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # About `sample` rows, of `sample_bytes` at most each, come to the driver.
    picked = sorted({(r.digest, r.page_id or 0, r.url or "", r.html) for r in rows.filter(chosen).dropDuplicates(["digest"]).collect()})
    dictionary = train_dictionary([record_bytes(p, u, h.encode(), d, None, date) for d, p, u, h in picked])
    shared = spark.sparkContext.broadcast(dictionary)

    last = (slim.filter(F.col("n") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("c"))
            .filter("c > 1 AND last IS NOT NULL").select("digest", "last"))
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    records = rows.join(last, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    manifest = scratch.stage(records.mapInArrow(_writer(folder, shared, date, roll_bytes, level), MANIFEST), "manifest", keep=True)
    return folder, manifest


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The records of the archives listed in ``manifest``, read back and verified.

    Columns: ``page_id, url, record_type, payload_bytes, payload_digest`` (lower-case hex),
    ``refers_to`` and ``payload`` (null for revisits). One archive is held at a time.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(width, "path").mapInArrow(_reader(folder), RECORD)
