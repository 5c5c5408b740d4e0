"""WARC archives: written as one gzip stream a file, normalised to one gzip member a record with an offset index, read by offset.

``write_archives`` writes one record a row through Spark's own text writer, whose line end completes each record; with gzip such a
file is a single stream, from which no record can be read alone. ``normalise`` inflates each file once as a stream, writes every record as a
member of its own, and puts the offsets beside it (``.idx``, one line a record). ``read_records`` reads records by offset, in any order.

Of rows with equal payloads of ``REVISIT_BYTES`` or more, those with the smallest id are responses; the others are revisits, which hold no
payload, only its length and digest and the id they refer to. The table of repeated payloads is sent to the tasks only if its measured
size allows it; otherwise the join takes hot payloads apart.

Archives lie in the shared work folder; tasks open them by pyarrow's file systems. A file is finished under the name of its attempt and
then renamed, so a task that runs again leaves the same file. Defined cases: a null payload is empty; a null id is kept as null, is
no one's original unless all rows with that payload have null ids, and then all of them are responses; rows that share the smallest id are all
responses; a null address is left out; an empty table gives no records; other columns are not read, so they can't clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize, work_path

REVISIT_BYTES = 100
RECORDS_A_FILE = 20_000
CHUNK = 1 << 20
HEADER_BYTES = 1 << 20
LEVEL = 6
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

# Field names and words of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_record_types(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(_id, _url, _payload, _bytes, _digest, _refers): _refers is the id of the response that a revisit refers to."""
    rows = pages.select(F.col(key).alias("_id"), F.col(url).cast("string").alias("_url"), F.coalesce(F.col(payload), F.lit("")).alias("_payload"))
    rows = rows.withColumns({"_bytes": F.octet_length("_payload").cast("long"), "_digest": F.sha2("_payload", 256)})
    large = rows.filter(F.col("_bytes") >= REVISIT_BYTES).groupBy("_digest")
    repeated = large.agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1 and _first is not null").drop("_n")
    joined = lookup_join(rows, materialize(repeated, "repeated"), ["_digest"])
    refers = F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first"))
    return joined.withColumn("_refers", refers).drop("_first")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null; line ends in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _coded(value: Column) -> Column:
    return F.url_encode(value.cast("string"))


def write_archives(typed: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write gzip files of records. ``date`` stands in every record, for the table has none."""
    revisit = F.col("_refers").isNotNull()
    row = F.md5(F.concat_ws("/", F.col("_id").cast("string"), "_digest", F.monotonically_increasing_id().cast("string")))
    uuid = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(row, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", uuid),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("_url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_digest")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("X-Row-Id", _coded(F.col("_id"))),
        _field("X-Refers-To-Row-Id", _coded(F.col("_refers"))),
        _field("X-Payload-Length", F.col("_bytes").cast("string")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("_bytes")).cast("string")),
    )
    # a record ends in two line ends; the second is the writer's
    record = F.concat(header, F.lit("\r\n"), F.when(revisit, "").otherwise(F.col("_payload")), F.lit("\r\n"))
    (typed.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(path))


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


class Header(NamedTuple):
    fields: dict[str, str]
    length: int

    @classmethod
    def parse(cls, raw: bytes) -> Header:
        first, *lines = raw.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        return cls(fields, int(fields["content-length"]))


def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a gzip file of one or several members, in bounded pieces."""
    inflate = zlib.decompressobj(31)
    while raw := stream.read(chunk):
        while raw:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            if out := inflate.decompress(raw, chunk):
                yield out
            raw = inflate.unconsumed_tail or inflate.unused_data
    if not inflate.eof:
        if out := inflate.flush():
            yield out
        if not inflate.eof:
            raise ValueError("the gzip stream ends too early")


class IndexRow(NamedTuple):
    offset: int
    length: int
    record_type: str
    record_id: str
    payload_digest: str


def rewrite(pieces: Iterator[bytes], out, level: int = LEVEL) -> Iterator[IndexRow]:
    """Copy records from a stream, each into a member of its own; one header and one piece are held at a time."""
    held, offset, pieces = b"", 0, iter(pieces)
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            more = next(pieces, b"")
            if not more:
                if held.strip(b"\r\n"):
                    raise ValueError("the archive ends inside a header")
                return
            held = held.lstrip(b"\r\n") + more if not held.strip(b"\r\n") else held + more
            if len(held) > HEADER_BYTES + 2 * CHUNK and held.find(b"\r\n\r\n") < 0:
                raise ValueError("a header is too long")
        if not end:  # line ends between records
            held = held[4:]
            continue
        header = Header.parse(held[:end])
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        size = out.write(deflate.compress(held[:end + 4]))
        held, left = held[end + 4:], header.length
        while left:
            if not held:
                held = next(pieces, b"")
                if not held:
                    raise ValueError("the archive ends inside a payload")
            size += out.write(deflate.compress(held[:left]))
            held, left = held[left:], left - min(left, len(held))
        size += out.write(deflate.compress(b"\r\n\r\n") + deflate.flush())
        while len(held) < 4 and (more := next(pieces, b"")):
            held += more
        if held[:4] != b"\r\n\r\n":
            raise ValueError("a record doesn't end in two line ends")
        held = held[4:]
        f = header.fields
        yield IndexRow(offset, size, f["warc-type"], f.get("warc-record-id", ""), f.get("warc-payload-digest", ""))
        offset += size


_INDEX = "file string, offset long, length long, record_type string, record_id string, payload_digest string"


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite all gzip files of a folder; returns the index, which also lies beside each file as ``.idx``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    files = files.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "path")
    folder, place = open_folder(target)
    folder.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for batch in batches:
            for path in batch.column("path").to_pylist():
                given, at = open_folder(path)
                written, base = open_folder(target)
                name = f"{base}/{at.rsplit('/', 1)[-1].removesuffix('.txt.gz').removesuffix('.gz')}.warc.gz"
                own = f"{name}.{task.taskAttemptId()}"
                with given.open_input_stream(at, compression=None) as stream, written.open_output_stream(own, compression=None) as out:
                    rows = list(rewrite(inflated(stream), out))
                with written.open_output_stream(f"{own}.idx", compression=None) as out:
                    out.write("".join("\t".join(map(str, r)) + "\n" for r in rows).encode())
                written.move(own, name)
                written.move(f"{own}.idx", f"{name}.idx")
                columns = [pa.array([x[i] for x in rows], t) for i, t in enumerate([pa.int64(), pa.int64(), *[pa.string()] * 3])]
                yield pa.RecordBatch.from_arrays([pa.array([name.rsplit("/", 1)[-1]] * len(rows), pa.string()), *columns],
                                                 names=["file", *IndexRow._fields])

    # written at once: the files come to be with it, one time
    return materialize(files.mapInArrow(run, _INDEX), "index")


class Record(NamedTuple):
    row_id: str | None
    url: str | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: str | None
    payload: bytes | None


def parse_member(raw: bytes) -> Record:
    """A record of one member; length and digest of a response are those of the payload read, of a revisit those that it states."""
    whole = zlib.decompress(raw, 31)
    end = whole.index(b"\r\n\r\n")
    header = Header.parse(whole[:end])
    payload = whole[end + 4:end + 4 + header.length]
    if len(whole) != end + 8 + header.length:
        raise ValueError("a record's length is wrong")
    f = header.fields
    stated = f["warc-payload-digest"].removeprefix("sha256:")
    if f["warc-type"] == "revisit":
        return Record(f.get("x-row-id"), f.get("warc-target-uri"), int(f["x-payload-length"]), stated, "revisit", f.get("x-refers-to-row-id"), None)
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError("a payload doesn't have its digest")
    return Record(f.get("x-row-id"), f.get("warc-target-uri"), len(payload), digest, f["warc-type"], None, payload)


_RECORD = "row_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records of an index by their offsets; one record is held at a time."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = open_folder(folder)
        name, stream = None, None
        for batch in batches:
            rows, size = [], 0
            names = Record._fields
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    name, stream = file, place.open_input_file(f"{base}/{file}")
                record = parse_member(stream.read_at(length, offset))
                rows.append(record if payloads else record._replace(payload=None))
                size += record.payload_bytes if payloads else 200
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                    rows, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return index.select("file", "offset", "length").mapInArrow(run, _RECORD)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", payloads: bool = True) -> DataFrame:
    """Write, normalise and read back one record a row: the key, then url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType
    whole, single = work_path(spark, "archives"), work_path(spark, "records")
    write_archives(with_record_types(pages, key, url, payload), whole)
    index = normalise(spark, whole, single)
    # ranges of files and offsets: neighbours are read together, and a file is shared by several tasks
    ordered = index.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "offset").sortWithinPartitions("file", "offset")
    records = read_records(ordered, single, payloads)
    decoded = lambda c: F.url_decode(c).cast(kind)
    return records.select(decoded("row_id").alias(key), *[c for c in ("url", "payload_bytes", "payload_digest", "record_type")],
                          decoded("refers_to").alias("refers_to"), "payload")
