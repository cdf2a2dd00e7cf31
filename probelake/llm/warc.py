"""WARC archives with Zstandard: a dictionary in a leading skippable frame, each record a frame of its own.

A task gathers its records up to ``FILE_BYTES``, trains a dictionary on them, and writes one archive file with it. Equal
payloads are stored once: the record with the largest id is a response, the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import qualified, staged, work_dir

#: Fixed values of the formats: a skippable frame's magic number that names a dictionary, and a Zstandard frame's.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Uncompressed bytes after which a file is closed; a task holds about so much. Largest dictionary.
FILE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
#: All records of a page carry this date, so that a rerun writes the same bytes.
RECORD_DATE = "1970-01-01T00:00:00Z"
FILE_SUFFIX = ".warc.zst"
READ_BYTES = 16 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def build_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, revisit: bool
) -> bytes:
    """A response with its HTTP head and payload, or a revisit with the head only. ``Page-Id`` is an extension field."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, url, digest)),
        ("WARC-Date", RECORD_DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to, refers_url, digest))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def build_archive(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES) -> bytes:
    """An archive of whole records. Without enough material for a dictionary there is none and no leading frame."""
    try:
        size = min(dictionary_bytes, max(sum(map(len, records)) // 10, 1024))
        trained = zstandard.train_dictionary(size, records, k=512, d=8, f=20, accel=1)
    except (zstandard.ZstdError, ValueError):
        trained = None
    if trained is None:
        packer, out = zstandard.ZstdCompressor(level=6), []
    else:
        packer = zstandard.ZstdCompressor(level=6, dict_data=trained)
        packed = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        out = [struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed]
    out += map(packer.compress, records)
    return b"".join(out)


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, one frame at a time."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data)
        if magic == DICTIONARY_FRAME:
            content = data[8 : 8 + size]
            if content[:4] == struct.pack("<I", ZSTD_FRAME):
                content = unpacker.decompress(content)
            unpacker, at = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)), 8 + size
    while at < len(data):
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(data[at : at + READ_BYTES]))
            at = min(at + READ_BYTES, len(data)) - len(frame.unused_data)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _put(folder: str, name: str, data: bytes) -> None:
    """A whole file or none: it is written aside and renamed. ``folder`` is a URI that Arrow's file systems know."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/.{name}", compression=None) as out:
        out.write(data)
    store.move(f"{path}/.{name}", f"{path}/{name}")


def _numbered(page: Column, payload: Column, min_bytes: int) -> list[Column]:
    size = F.octet_length(payload)
    return [
        F.sha1(payload.cast("binary")).alias("_sha"), size.alias("_size"),
        F.when((size >= min_bytes) & page.isNotNull(), page).alias("_candidate"),
    ]


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
    id_col: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """One record per row of ``pages`` into ``folder``; returns the list of files: ``file, records, bytes``.

    Of rows with equal payloads (SHA-1 and length) of at least ``min_bytes`` the largest id is the response and the
    others revisit it; rows repeating that id are responses too, rows with a null id revisit it. A null html is an empty
    payload. A text longer than ``file_bytes`` gets a file to itself and others that came before it.

    The largest id per payload is found by a grouped maximum that combines before its shuffle; it is written out, so
    that the join back is one that adaptive execution can split when a third of all pages are copies. Each attempt of a
    task writes under names of its own, and only files in the returned list, which Spark commits, count; a lost
    executor leaves at most files that no reader looks at.
    """
    at = qualified(pages.sparkSession, folder)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    ).select("*", *_numbered(F.col("page_id"), F.col("html"), min_bytes))
    best = (
        rows.where(F.col("_candidate").isNotNull()).groupBy("_sha", "_size")
        .agg(F.max(F.struct(F.col("_candidate").alias("id"), "url")).alias("best"))
    )
    best = staged(best.select(F.col("_sha").alias("b_sha"), F.col("_size").alias("b_size"), "best.*"), "warc-responses")
    best = best.toDF("b_sha", "b_size", "refers_to", "refers_url")
    plan = rows.join(
        best, (F.col("_sha") == F.col("b_sha")) & (F.col("_size") == F.col("b_size")) & (F.col("_size") >= min_bytes), "left"
    ).select(
        "page_id", "url", "html", "refers_to", "refers_url",
        (F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("revisit"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records: list[bytes] = []
        held = 0

        def close() -> pd.DataFrame:
            name, data = f"pages-{uuid.uuid4().hex}{FILE_SUFFIX}", build_archive(records)
            _put(at, name, data)
            return pd.DataFrame({"file": [name], "records": [len(records)], "bytes": [len(data)]})

        for batch in batches:
            for page, address, text, refers, refers_url, revisit in batch.itertuples(index=False):
                payload = text.encode("utf-8")
                whole = lambda x: None if pd.isna(x) else int(x)
                records.append(
                    build_record(whole(page), address, payload, payload_digest(payload), whole(refers), refers_url, bool(revisit))
                )
                held += len(records[-1])
                if held >= file_bytes:
                    yield close()
                    records, held = [], 0
        if records:
            yield close()

    exact = plan.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return staged(exact.mapInPandas(write, "file string, records long, bytes long"), "warc-files")


def read_records(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """A row per record: ``page_id, url, record_type, record_id, refers_to_id, digest, payload``.

    ``files`` limits the read to the files listed there. ``payload`` is null for revisits; a response's is checked
    against its digest.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{FILE_SUFFIX}").load(folder)
    found = found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    if files is not None:
        found = found.join(files.select("file"), "file", "left_semi")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for fields, block in read_archive(content):
                    _, _, payload = block.partition(b"\r\n\r\n")
                    digest, response = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
                    if response and payload_digest(payload) != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    rows.append((
                        fields.get("Page-Id"), fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Record-ID"],
                        fields.get("WARC-Refers-To"), digest, payload if response else None,
                    ))
                    held += len(block)
                    if held >= FILE_BYTES // 4:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    names = ["page_id", "url", "record_type", "record_id", "refers_to_id", "digest", "payload"]
    schema = ", ".join(f"{n} {'binary' if n == 'payload' else 'string'}" for n in names)
    return found.select("content").mapInPandas(read, schema).withColumn("page_id", F.col("page_id").cast("long"))


def round_trip(pages: DataFrame, min_bytes: int = 0, **columns: str) -> DataFrame:
    """Writes the archives to the shared folder and reads them back: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``. A revisit's payload is the one of the response that it names."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    files = write_archives(pages, folder, min_bytes, **columns)
    if files.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = staged(
        read_records(spark, folder, files).select(
            "page_id", "record_type", "record_id", "refers_to_id", "digest", F.octet_length("payload").cast("long").alias("bytes")
        ),
        "warc-records",
    )
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("r_id"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("r_bytes"), F.col("digest").alias("r_digest")
    ).dropDuplicates(["r_id"])
    return records.join(staged(responses, "warc-named"), F.col("refers_to_id") == F.col("r_id"), "left").select(
        "page_id", F.coalesce("bytes", "r_bytes").alias("payload_bytes"), F.coalesce("r_digest", "digest").alias("payload_digest"),
        "record_type", "refers_to",
    )
