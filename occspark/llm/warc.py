"""WARC archives: an index first, then coalesced range reads of the selected records.

Writing: of pages with equal payloads of ``REVISIT_BYTES`` bytes or more, the one with the largest
``page_id`` is a response and the others are revisits that refer to it; smaller ones are responses.
Each task writes archives of about ``ARCHIVE_BYTES``, one gzip member per record, and returns an
index row per record: file, offset, length, URL, digest. The index is stored as a table.

Reading: index rows are dealt out by file and sorted by offset; neighbours with gaps of up to
``GAP_BYTES`` become one read of at most about ``READ_BYTES``. Records are then parsed from these bytes.

Defined cases: a null html is an empty payload; null URLs are written as ``about:blank``; pages with
equal ``page_id`` are records of their own, and of those that share a payload and the largest
``page_id`` one URL's is the response (wholly equal rows are all responses); null identifiers rank below all others. An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occspark.llm.files import Reader, Upload, make_folder
from occspark.llm.store import bound_batches, shared_folder, stored

REVISIT_BYTES = 1_000
ARCHIVE_BYTES = 1 << 28
READ_BYTES = 1 << 21
GAP_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id string, url string, file string, offset long, length long, digest string, record_type string"


def typed(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, record_type, refers_to) of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), payload.alias("html")
    ).withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html")})
    # Rows of the same page and payload are told apart by a number that a repeated task draws alike.
    base = base.withColumn("row", F.xxhash64("page_id", "url", "digest"))
    large = base.where(F.col("bytes") >= REVISIT_BYTES).select("digest", "page_id", "row")
    last = large.groupBy("digest").agg(
        F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "row")).alias("last"), F.max("page_id").alias("refers")
    )
    last = last.select("digest", F.col("last.row").alias("last_row"), "refers")
    revisit = F.col("last_row").isNotNull() & (F.col("row") != F.col("last_row")) & (F.col("bytes") >= REVISIT_BYTES)
    return base.join(last, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("refers")).alias("refers_to"),
    )


def record(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record with an HTTP response; a revisit has its head but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if kind == "revisit" else http + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Target-URI", url),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    fields.append(("Content-Length", str(len(body))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of a record, its payload's size and digest as read, and the payload of a response."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("Not a WARC record.")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"The payload of {fields['WARC-Record-ID']} doesn't match its digest.")
    number = lambda name: fields.get(name, "<urn:page:>")[10:-1] or None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": payload,
    }


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives to ``folder`` and return their index, a stored table."""
    make_folder(folder)
    bound_batches(pages.sparkSession)

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upload, index = None, []
        for batch in batches:
            for page in batch.itertuples(index=False):
                page_id, refers = page.page_id, page.refers_to
                url = "about:blank" if page.url is None else " ".join(page.url.split("\r\n"))
                plain = record(page_id, url, page.html.encode(), page.digest, page.record_type, refers)
                pack = zlib.compressobj(6, wbits=31)
                packed = pack.compress(plain) + pack.flush()
                if upload is None:
                    upload = Upload(folder, ".warc.gz")
                index.append((page_id, url, upload.name, upload.size, len(packed), page.digest, page.record_type))
                upload.write(packed)
                if upload.size >= archive_bytes:
                    upload.close()
                    yield _rows(index)
                    upload, index = None, []
        if upload is not None:
            upload.close()
            yield _rows(index)

    # Identifiers travel as text: a null beside it turns a long column into doubles in pandas.
    named = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    index = typed(pages).withColumns(named).mapInPandas(archive, INDEX)
    return stored(index.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType)))


def _rows(index: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(index, columns=[c.split()[0] for c in INDEX.split(", ")])


def ranges(offsets: np.ndarray, lengths: np.ndarray, gap: int, most: int) -> list[tuple[int, int]]:
    """Runs [first, past the last) of records, sorted by offset, that are read at once."""
    found, first = [], 0
    for at in range(1, len(offsets) + 1):
        if at == len(offsets):
            found.append((first, at))
        elif offsets[at] > offsets[at - 1] + lengths[at - 1] + gap or offsets[at] + lengths[at] - offsets[first] > most:
            found.append((first, at))
            first = at
    return found


def read(index: DataFrame, folder: str, read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the given index rows. Files are cut into stretches, so one large file is read by many tasks."""
    stretch = F.floor(F.col("offset") / (4 * read_bytes))
    # Rows are tiny but name much to read: a given number of tasks, which adaptive execution doesn't merge.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // (4 * read_bytes)))
    dealt = (
        index.select("file", "offset", "length")
        .withColumn("stretch", stretch)
        .repartition(tasks, "file", "stretch")
        .sortWithinPartitions("file", "stretch", "offset")
    )

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(folder)
        try:
            for batch in batches:
                for name, part in batch.groupby("file", sort=False):
                    offsets, lengths = part["offset"].to_numpy(), part["length"].to_numpy()
                    for a, b in ranges(offsets, lengths, gap_bytes, read_bytes):
                        base = int(offsets[a])
                        data = reader.read(name, base, int(offsets[b - 1] + lengths[b - 1]) - base)
                        cuts = zip((offsets[a:b] - base).tolist(), lengths[a:b].tolist(), strict=True)
                        found = [parsed(zlib.decompress(data[o : o + n], wbits=31)) for o, n in cuts]
                        yield pd.DataFrame(found)
        finally:
            reader.close()

    records = dealt.select("file", "offset", "length").mapInPandas(
        fetch,
        "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
        "payload binary",
    )
    kind = index.schema["page_id"].dataType
    return records.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive all pages and describe every record as read back."""
    folder = shared_folder(pages.sparkSession)
    index = write(pages, folder)
    return read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
