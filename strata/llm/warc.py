"""Web archives: a deterministic sharded writer, and a reader of what it committed."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import shuffle_width

#: Payloads below so many bytes are stored again instead of referred to.
LEAST_BYTES = 100
#: A file is closed once it has so many compressed bytes.
ROLL_BYTES = 8 << 20
#: Payload that a shard gets, and ranges of keys that are weighed for that.
SHARD_BYTES = 32 << 20
MOST_RANGES = 1 << 14
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "file string, shard int, records bigint, bytes bigint, sha256 string"
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "payload binary, file string"
)


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def revisits(pages: DataFrame, key: str, html: str, least: int = LEAST_BYTES) -> DataFrame:
    """(key, digest, refers_to) of records whose payload a record with a smaller key has.

    A key's payloads meet as digests only: the smallest key of each is a combined aggregate that is joined back.
    """
    small = pages.select(
        F.col(key).alias("key"), F.sha2(_payload(html), 256).alias("digest"), F.octet_length(_payload(html)).alias("n")
    ).where(F.col("n") >= least).select("key", "digest")
    first = small.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return small.join(first.drop("n"), "digest").where("refers_to is not null and not (key <=> refers_to)").distinct()


def _shards(pages: DataFrame, key: str, html: str, shard_bytes: int) -> tuple[DataFrame, Callable[[str], Column], int]:
    """Ranges of keys with their shard, the range of a row, and the number of shards.

    Ranges of equal width are joined in order until a shard has its bytes: the same for the same
    rows, on any cluster. The driver sees at most ``MOST_RANGES`` sums.
    """
    spark = pages.sparkSession
    low, high = pages.agg(F.min(key), F.max(key)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = -(-(high - low + 1) // MOST_RANGES)

    def of_row(column: str) -> Column:
        return F.coalesce(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(0)).cast("int")

    sums = pages.select(of_row(key).alias("range"), F.octet_length(_payload(html)).alias("n")).groupBy("range").agg(F.sum("n").alias("n"))
    rows, shard, held = [], 0, 0
    for r, n in sorted(map(tuple, sums.collect())):
        if held and held + n > shard_bytes:
            shard, held = shard + 1, 0
        rows.append((r, shard))
        held += n
    return spark.createDataFrame(rows, "range int, shard int"), of_row, shard + 1


def _quoted(url: str) -> str:
    """An address as one header line: controls, spaces and ``%`` are escaped, so that it can be read back exactly."""
    return "".join(c if c > " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in url)


def _unquoted(line: str) -> str:
    out, i, raw = bytearray(), 0, line.encode()
    while i < len(raw):
        if raw[i] == 0x25:
            out.append(int(raw[i + 1:i + 3], 16))
            i += 3
        else:
            out.append(raw[i])
            i += 1
    return out.decode()


def _head(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _name(key) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def record(key, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record; a revisit has the headers of its response but no payload."""
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(key)), ("WARC-Date", DATE),
        *([("WARC-Target-URI", _quoted(url))] if url is not None else []),
        *([("WARC-Refers-To", _name(refers_to)),
           ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if refers_to is not None else []),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return _head(fields, "WARC/1.1") + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _head([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", DATE), ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block))),
    ], "WARC/1.1") + block + b"\r\n\r\n"


def _zipped(data: bytes) -> bytes:
    """One gzip member without a time, so that equal records give equal bytes."""
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """One archive file under a temporary name until it is whole."""

    def __init__(self, root: str, shard: int, number: int):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(root)
        self.name = f"part-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f"{self.root}/_temporary/{self.name}-{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.shard, self.records, self.bytes, self.digest = shard, 0, 0, hashlib.sha256()
        self._add(_zipped(_info(self.name)))

    def _add(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self._add(_zipped(data))
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        target = f"{self.root}/{self.name}"
        # A second attempt at the task writes the same bytes under the same name. What stands there came by one
        # rename and is whole, so it is left alone.
        if self.fs.get_file_info(target).type != arrow_fs.FileType.NotFound:
            self.fs.delete_file(self.temporary)
        else:
            self.fs.move(self.temporary, target)
        return self.name, self.shard, self.records, self.bytes, self.digest.hexdigest()


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html",
          least: int = LEAST_BYTES, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Archive every row below ``root``, a folder that all executors reach, and return the manifest.

    Records are sorted by key (null first), digest and address. The payload is the html in UTF-8, null: empty. Of
    records with equal payloads of at least ``least`` bytes, the one with the smallest key is the
    response and the others are revisits of it; rows that repeat its key and payload are responses too, as are all rows of
    a payload that has no key but null. Other columns are not archived. No rows give an empty manifest.

    Shards are ranges of keys, filled by payload bytes; a task writes its shards one after the other
    and rolls to a new file by compressed size, so it holds one record at a time. Files appear under
    their names only when whole; the manifest, written last, says which belong to the archive. The same rows give
    the same files. Revisits travel as rows that sort before their page, so that payloads are shuffled once.
    """
    spark = pages.sparkSession
    ranges, of_row, shards = _shards(pages, key, html, shard_bytes)
    again = revisits(pages, key, html, least)
    rows = pages.select(
        F.col(key).alias("key"), F.lit(1).alias("kind"), F.col(url).alias("url"), _payload(html).alias("payload"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("bigint").alias("refers_to"), of_row(key).alias("range"),
    ).unionByName(again.select(
        "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        "digest", "refers_to", of_row("key").alias("range"),
    ))
    width = shuffle_width(spark, shards, 1)
    sorted_rows = (
        rows.join(F.broadcast(ranges), "range").drop("range")  # at most MOST_RANGES rows
        .repartitionByRange(width, "shard")
        .sortWithinPartitions("shard", "key", "kind", F.sha2(F.coalesce("payload", F.lit(b"")), 256), "url")
        # As texts: pandas would make doubles of whole numbers with nulls among them.
        .withColumns({c: F.col(c).cast("string") for c in ("key", "refers_to")})
    )

    def archive(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, number, known, key_now, done = None, 0, {}, object(), []
        for frame in frames:
            for row in frame.itertuples(index=False):
                name = None if row.key is None else int(row.key)
                if name != key_now:
                    key_now, known = name, {}
                if row.kind == 0:
                    known[row.digest] = int(row.refers_to)
                    continue
                if file and (file.shard != row.shard or file.bytes >= roll_bytes):
                    number = number + 1 if file.shard == row.shard else 0
                    done.append(file.close())
                    file = None
                if not file:
                    file = _File(root, int(row.shard), number)
                payload = bytes(row.payload)
                digest = hashlib.sha256(payload).hexdigest()
                file.add(record(name, row.url, payload, digest, known.get(digest)))
        if file:
            done.append(file.close())
        yield pd.DataFrame(done, columns=["file", "shard", "records", "bytes", "sha256"])

    sorted_rows.mapInPandas(archive, MANIFEST).write.parquet(f"{root}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record in a gzip archive, one member at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        member = zlib.decompressobj(31)
        parts, step = [], 1 << 16
        while not member.eof:
            if at >= len(view):
                raise ValueError("truncated archive")
            parts.append(member.decompress(view[at:at + step]))
            at += step
        at = min(at, len(view)) - len(member.unused_data)
        whole = b"".join(parts)
        end = whole.index(b"\r\n\r\n")
        lines = whole[:end].decode().split("\r\n")
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        size = int(fields["content-length"])
        yield fields, whole[end + 4:end + 4 + size]


def _page(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def read(spark: SparkSession, root: str) -> DataFrame:
    """Records of the archive that the manifest below ``root`` names, with their payloads.

    Every response's payload is hashed again and must match its header; a file that is not as the
    manifest says fails the job. A revisit has a null payload; its size and digest are the response's.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest").select("file", "sha256")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(root)
    whole = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(manifest, "file")

    def opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RECORD.split(", ")]
        for frame in frames:
            for name, content, digest in zip(frame["file"], frame["content"], frame["sha256"], strict=True):
                if hashlib.sha256(content).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file of the manifest")
                rows = []
                for fields, block in records(content):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.decode().rpartition("Content-Length: ")[2].split("\r\n")[0])
                    stated = fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != stated or len(payload) != size):
                        raise ValueError(f"{name}: {fields['warc-record-id']} is damaged")
                    target, refers = fields.get("warc-target-uri"), fields.get("warc-refers-to")
                    rows.append((
                        _page(fields["warc-record-id"]), None if target is None else _unquoted(target), size, stated, kind,
                        None if refers is None else _page(refers), payload if kind == "response" else None, name,
                    ))
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                        rows = []
                yield pd.DataFrame(rows, columns=columns, dtype=object)

    return whole.select("file", "content", "sha256").mapInPandas(opened, RECORD)
