"""WARC files in Zstandard form: one frame per record, after a skippable frame that holds the dictionary.

Writing: each task turns its rows into frames (the dictionary frame first), and Spark's text writer joins
them into one archive per task, on any file system and with Spark's commit protocol, so a task that runs
again leaves no half-written archive. The separator that the writer puts after each frame is an empty
skippable frame, which every Zstandard reader passes over.

Reading: the dictionary comes from the leading skippable frame (itself maybe compressed), then each frame
is one record. Headers and lengths are checked; a record or file that fails is a row whose `error` says
why, never a missing row. An archive without a dictionary frame is read without one. No archives, or empty
ones, give no rows.

A record whose payload has MIN_REVISIT bytes or more and equals that of a smaller id is a revisit: its
block is the HTTP head only, which keeps the payload's length. Null payloads are empty ones. Rows that
repeat an id and its payload are written alike. Other columns are not archived.
"""

import hashlib
import struct
from datetime import UTC, datetime

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from parley.sources.workspace import new_path

MAGIC = 0x184D2A5D  # the dictionary's skippable frame
#: An empty skippable frame, in ASCII, so that it can be the text writer's line separator.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
MIN_REVISIT = 100
#: The dictionary is trained on at most so many payloads, cut to so many bytes each.
TRAIN_ROWS, TRAIN_BYTES, DICT_BYTES = 256, 8_192, 32_768
LEVEL = 3
FRAME_LIMIT = 1 << 31  # a record's frame may not say that it is longer
_DATE = datetime(2024, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary from sample payloads; empty where there are too few to learn from."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, payloads).as_bytes()
    except (zstandard.ZstdError, ValueError):  # the trainer refuses small samples
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", MAGIC, len(body)) + body


def record(page_id: str, url: str, kind: str, payload: bytes, digest: str, refers_to) -> bytes:
    """A response or revisit record, as WARC 1.1 lays it out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write (page_id, url, html) as archives under `path`, one per task."""
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                     F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    # a bounded sample by hash: only numbers are sorted, then the payloads under the last of them come back
    named = p.filter(F.length("payload") > 0).withColumn("h", F.xxhash64("digest", "page_id"))
    last = named.select("h").distinct().orderBy("h").limit(TRAIN_ROWS).agg(F.max("h")).first()[0]
    chosen = [] if last is None else named.filter(F.col("h") <= last).select(
        F.substring("payload", 1, TRAIN_BYTES).alias("b"), "h").limit(TRAIN_ROWS).orderBy("h").collect()
    sample = [bytes(r["b"]) for r in chosen]
    dictionary = train_dictionary(sample)
    # equal payloads: only those that occur twice move; partial sums make a hot payload cheap
    first = p.filter(F.octet_length("payload") >= min_revisit).groupBy(F.col("digest").alias("_digest")).agg(
        F.min("page_id").alias("first_id"), F.max("page_id").alias("_last")).filter("first_id < _last").drop("_last")
    x = p.join(first, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")).alias("refers_to"))

    def frames(batches):
        if not dictionary:
            zip_ = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        else:
            zip_ = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=zstandard.ZstdCompressionDict(dictionary))
        started = False
        for b in batches:
            out = [] if started or not dictionary else [dictionary_frame(dictionary)]
            started = True
            for page, url, payload, digest, ref in zip(b["page_id"], b["url"], b["payload"], b["digest"], b["refers_to"]):
                again = not pd.isna(ref)
                out.append(zip_.compress(record(page, url, "revisit" if again else "response", payload, digest, ref if again else None)))
            yield pd.DataFrame({"frame": out})

    # nullable ids stay whole: as text, they are not turned into floats
    x = x.withColumns({"page_id": F.coalesce(F.col("page_id").cast("string"), F.lit("")), "refers_to": F.col("refers_to").cast("string")})
    x.mapInPandas(frames, "frame binary").select(F.col("frame").cast("string").alias("frame")).write.option(
        "lineSep", SEPARATOR).option("compression", "none").text(path)


def _split_frames(data: bytes):
    """(dictionary, [(offset, bytes)]) of an archive; the frames of skippable data are left out."""
    at, dictionary, first = 0, b"", True
    rest = []
    while at + 8 <= len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            if at + 8 + size > len(data):
                raise ValueError(f"skippable frame at {at} is cut off")
            if magic == MAGIC and first:
                body = data[at + 8: at + 8 + size]
                if body[:4] == b"\x28\xb5\x2f\xfd":
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
                dictionary = body
            at += 8 + size
        else:
            end = _frame_end(data, at)
            rest.append((at, data[at:end]))
            at = end
        first = False
    if at != len(data):
        raise ValueError(f"{len(data) - at} bytes after the last frame")
    return dictionary, rest


def _frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame at `at` ends, from its header and the sizes of its blocks (RFC 8878)."""
    if data[at: at + 4] != b"\x28\xb5\x2f\xfd":
        raise ValueError(f"no Zstandard frame at {at}")
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    p = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
    while True:
        if p + 3 > len(data):
            raise ValueError(f"frame at {at} is cut off")
        head = int.from_bytes(data[p: p + 3], "little")
        kind, size = head >> 1 & 3, head >> 3
        p += 3 + (1 if kind == 1 else size)
        if head & 1:
            break
    p += 4 * checksum
    if p > len(data):
        raise ValueError(f"frame at {at} is cut off")
    return p


def parse_record(raw: bytes) -> dict:
    """Header fields and payload facts of one record; raises ValueError where something is wrong."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:40]!r}")
        fields[name.strip().lower()] = value.strip()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in fields:
            raise ValueError(f"no {need}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {size}, the block has {len(rest) - 4}")
    block = rest[:size]
    if fields.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
        raise ValueError("block digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    stated = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"]
    if not mark or not stated:
        raise ValueError("no HTTP head with a length")
    length = int(stated[0])
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields["warc-type"] == "response":
        if len(payload) != length:
            raise ValueError(f"payload has {len(payload)} bytes, the head says {length}")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload digest differs")
    elif fields["warc-type"] != "revisit" or payload:
        raise ValueError("neither a response nor an empty revisit")
    def page(x):
        number = (x or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return {"page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": length,
            "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": page(fields.get("warc-refers-to")),
            "payload": payload if fields["warc-type"] == "response" else None, "error": None}


RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary, error string")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives under `path`: RECORDS; without `payloads` they stay null."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    fault = lambda e: dict.fromkeys(names) | {"error": str(e)}

    def rows(batches):
        for b in batches:
            for data in b["content"]:
                try:
                    dictionary, frames = _split_frames(data)
                except (ValueError, zstandard.ZstdError) as e:
                    yield pd.DataFrame([fault(e)], columns=names)
                    continue
                given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
                unzip = zstandard.ZstdDecompressor(**given)
                for k in range(0, len(frames), 256):
                    out = []
                    for at, frame in frames[k: k + 256]:
                        try:
                            out.append(parse_record(unzip.decompress(frame, max_output_size=FRAME_LIMIT)))
                        except (ValueError, UnicodeDecodeError, zstandard.ZstdError) as e:
                            out.append(fault(f"frame at {at}: {e}"))
                    got = pd.DataFrame(out, columns=names)
                    for c in ("page_id", "payload_bytes", "refers_to"):
                        got[c] = got[c].astype("Int64")
                    if not payloads:
                        got["payload"] = None
                    yield got

    # a file holds what one task wrote; they are taken one at a time
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(rows, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, payloads=False).drop("payload")
