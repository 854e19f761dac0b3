"""WARC archives: writing them, giving every record its own gzip member, reading back.

``write`` leaves whole-file gzip streams, as Spark's text writer makes them: such a
file can only be read from its start. ``normalise`` inflates each of them once, writes
every record again as a gzip member of its own and returns an index with the place of
each member, from which ``read`` fetches records singly.

Recovery: files are only known by the index, which Spark commits. A task that runs
again writes a new file, and what a lost one left is never read.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import working_folder

# Below this many bytes a record is never a revisit.
REVISIT_BYTES = 1000
LINE = "\r\n"
END = LINE + LINE
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Compressed bytes handed to the decompressor at once.
PIECE = 1 << 20
INDEX = "file string, offset long, length long, record string"


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, its digest, and which page a revisit refers to.

    Of pages with equal payloads of at least ``least`` bytes that with the largest
    page_id is the response, the others revisit it. A null page_id is smaller than any;
    where all are null, or rows repeat with the largest page_id, those are responses.
    A null html is an empty payload.
    """
    held = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").alias("size"), F.sha1("payload").alias("digest")
    )
    repeated = (
        held.filter(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
        .filter("copies > 1 and last is not null")
        .select("digest", "size", "last")
    )
    return held.join(repeated, ["digest", "size"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    )


def record() -> Column:
    """A WARC record of a row of ``with_revisits``, without the blank lines that end it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    address = F.regexp_replace(F.coalesce("url", F.lit("")), r"\p{Cntrl}", "")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.when(address != "", F.concat(F.lit("WARC-Target-URI: "), address)),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(
            F.lit("Content-Length: "),
            (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))).cast("string"),
        ),
    ]
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(F.concat_ws(LINE, *lines), F.lit(END), body)


def write(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> None:
    """A record for each page, in gzip files of one stream each."""
    (
        with_revisits(pages, least)
        .select(record().alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .text(folder)
    )


class _Records:
    """Cuts an inflated stream into records; holds no more than one record and a piece."""

    def __init__(self) -> None:
        self.held = bytearray()

    def add(self, piece: bytes) -> Iterator[bytes]:
        self.held += piece
        at = 0
        while True:
            head = self.held.find(b"\r\n\r\n", at)
            if head < 0:
                break
            end = head + 4 + _length(bytes(self.held[at:head]))
            if len(self.held) < end + 4:
                break
            yield bytes(self.held[at : end + 4])
            at = end + 4
        del self.held[:at]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(LINE)[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _length(head: bytes) -> int:
    return int(_fields(head)["content-length"])


def _inflated(data: bytes) -> Iterator[bytes]:
    """The inflated pieces of a gzip file, of one member or of several.

    A member that does not end, with its check sum, raises after what there is of it.
    """
    view = memoryview(data)
    stream, ended = zlib.decompressobj(31), True
    for at in range(0, len(view), PIECE):
        rest = bytes(view[at : at + PIECE])
        while rest:
            yield stream.decompress(rest)
            rest, ended = stream.unused_data, stream.eof
            if ended:
                stream = zlib.decompressobj(31)
    if not ended:
        raise EOFError("a gzip member is cut off")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Every record of the gzip files in ``source`` as a member of its own in ``target``.

    Returns the index: file, offset, length, record id. It is also written beside the
    archives as ``index``. ``target`` must be a folder pyarrow can open.
    """

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for content in batch.column("content"):
                name = f"{uuid.uuid4().hex}.warc.gz"
                offsets, lengths, ids, at, records = [], [], [], 0, _Records()
                with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                    for piece in _inflated(content.as_buffer().to_pybytes()):
                        for one in records.add(piece):
                            member = _member(one)
                            out.write(member)
                            offsets.append(at)
                            lengths.append(len(member))
                            ids.append(_fields(one[: one.find(b"\r\n\r\n")])["warc-record-id"])
                            at += len(member)
                if records.held:
                    raise ValueError(f"{len(records.held)} bytes after the last whole record")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(ids), pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.string()),
                    ],
                    names=["file", "offset", "length", "record"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    index = files.select("content").mapInArrow(rewritten, INDEX)
    index.write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


def _parsed(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """The row ``read`` gives for a record; checks the payload against its digest."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http)["content-length"])
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return _key(fields["warc-record-id"]), size, digest, kind, _key(fields.get("warc-refers-to"))


def _key(name: str | None) -> int | None:
    text = name[len("<urn:page:") : -1] if name else "null"
    return None if text == "null" else int(text)


READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read(index: DataFrame, target: str) -> DataFrame:
    """The records the index lists, each fetched from its place."""

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(target)
        opened = functools.lru_cache(maxsize=1)(lambda name: store.open_input_file(f"{root}/{name}"))
        for batch in batches:
            columns = batch.to_pydict()
            rows = [
                _parsed(zlib.decompress(opened(name).read_at(length, at), 31))
                for name, at, length in zip(columns["file"], columns["offset"], columns["length"])
            ]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = [part.split()[0] for part in READ.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names
            )

    return index.mapInArrow(fetched, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written as archives, normalised and read back. An empty table gives no row."""
    spark = pages.sparkSession
    raw, members = working_folder(spark, "warc-raw"), working_folder(spark, "warc")
    write(pages, raw)
    return read(normalise(spark, raw, members), members)
