"""WARC archives with an index made first, and coalesced byte-range reads.

Writing: every record is a gzip member of its own. Payloads of at least ``min_bytes`` bytes that are
equal (by SHA-256) are stored once, as the response with the largest id; the others become revisit
records that name it. Each task writes one archive and returns the index: for each record its file,
offset, length, URL and digest. Reading: the index alone decides which records are wanted; their
ranges are sorted by file and offset, ranges closer than GAP bytes are joined into reads of up to
READ bytes, and only those are fetched.

Headers are lines, so ids are percent-encoded in them, and a URL with line breaks or outer blanks is
stored in another header as well, from which it is read back as it was.

Cases: a null html is an empty payload, a null URL an empty one; a null id is stored as such; rows
equal in payload and in the largest id are all responses; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c
from .tokenfile import filesystem

GAP, READ = 64 << 10, 8 << 20
#: Most rows that are broadcast, of a digest and an id; part of all copies that one payload may have before its pages are joined apart.
BROADCAST_ROWS, HOT = 200_000, 0.001
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_NO_ID = "<urn:ranksieve:no-page>"


def _name(page_id) -> str:
    return _NO_ID if page_id is None else f"<urn:ranksieve:page:{quote(str(page_id), safe='')}>"


def _named(name: str | None, kind: Callable):
    """The id that ``_name`` gave its name to."""
    return None if name in (None, _NO_ID) else kind(unquote(name.removeprefix("<urn:ranksieve:page:").removesuffix(">")))


def record(page_id, url: str, payload: bytes, refers_to=None, revisit: bool = False) -> tuple[bytes, str]:
    """A WARC/1.1 record and its payload digest. A revisit keeps the HTTP headers only."""
    own, block = digest(payload), _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: " + url.strip().replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{own}", f"X-Payload-Length: {len(payload)}",
    ]
    if url != url.strip() or "\r" in url or "\n" in url:
        head.append("X-Target-URI: " + quote(url, safe=""))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", own


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a record and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(headers["Content-Length"])
    if rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, rest[:n]


def roles(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, first (the id that holds the payload; null for payloads that stand for themselves)."""
    own = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    own = own.withColumn("k", F.when(F.octet_length("html") >= min_bytes, F.unhex(F.sha2("html", 256))))
    first = own.where("k is not null").groupBy("k").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select(F.col("k").alias("of"), "first", "copies")
    few = c.Stage(first, "warc-copies").df
    columns = ["page_id", "url", "html", "first", F.col("of").isNotNull().alias("copied")]
    if c.sizes_within(few, BROADCAST_ROWS):
        return own.join(F.broadcast(few), own["k"] == few["of"], "left").select(*columns)
    # payloads of very many copies are looked up apart, so no task gets all pages of one; the rest is dealt by payload
    many = F.col("copies") > F.lit(HOT) * few.agg(F.sum("copies")).first()[0]
    hot, rest = F.broadcast(few.where(many)), few.where(~many)  # fewer than 1/HOT
    others = own.where("k is not null").join(hot, F.col("k") == F.col("of"), "left_anti")
    parts = [own.join(hot, F.col("k") == F.col("of")).select(*columns), others.join(rest, F.col("k") == F.col("of"), "left").select(*columns)]
    alone = own.where("k is null").select("page_id", "url", "html", F.lit(None).cast(own.schema["page_id"].dataType).alias("first"), F.lit(False).alias("copied"))
    return parts[0].unionByName(parts[1]).unionByName(alone)


def write(pages: DataFrame, folder: str, **names) -> DataFrame:
    """Writes archives into ``folder``; returns the index: file, offset, length, url, digest, page_id, type."""
    rows = roles(pages, **names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, sink, at = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz", None, 0
        fs, top = filesystem(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                fs.create_dir(top, recursive=True)
                sink = fs.open_output_stream(f"{top}/{name}", compression=None)
            out = []
            ids, urls, htmls, first, copied = (batch.column(k) for k in range(5))
            for k in range(batch.num_rows):
                page_id, holder = ids[k].as_py(), first[k].as_py()
                again = copied[k].as_py() and page_id != holder and holder is not None
                data, own = record(page_id, urls[k].as_py(), htmls[k].as_py().encode(), holder, again)
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = z.compress(data) + z.flush()
                sink.write(packed)
                out.append((name, at, len(packed), urls[k].as_py(), own, page_id, "revisit" if again else "response"))
                at += len(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), ids.type, pa.string()))],
                ["file", "offset", "length", "url", "digest", "page_id", "type"],
            )
        if sink is not None:
            sink.close()

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"file string, offset long, length long, url string, digest string, page_id {kind}, type string")


def ranges(index: DataFrame, gap: int = GAP, read: int = READ) -> DataFrame:
    """file, start, size, records (offset and length of each, in order): the reads that fetch an index's records.

    A read takes records whose starts fall into the same ``read`` bytes of a file, unless a gap parts them.
    """
    file = Window.partitionBy("file", "part").orderBy("offset")
    end = F.col("offset") + F.col("length")
    far = (F.col("offset") - F.lag(end).over(file) > gap).cast("int")
    runs = index.select("file", "offset", "length", F.floor(F.col("offset") / read).alias("part")).withColumn("far", F.coalesce(far, F.lit(0))).withColumn("run", F.sum("far").over(file))
    records = F.array_sort(F.collect_list(F.struct("offset", "length")))
    out = runs.groupBy("file", "part", "run").agg(F.min("offset").alias("start"), F.max(end).alias("stop"), records.alias("records"))
    return out.select("file", "start", (F.col("stop") - F.col("start")).alias("size"), "records")


def read(index: DataFrame, folder: str, page_type: str = "long") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, html of the records in ``index``.

    The payload of a response is checked against its digest; a revisit's html is null.
    """
    kind = pa.int64() if page_type in ("long", "bigint") else pa.int32() if page_type == "int" else pa.string()
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]

    of = str if kind == pa.string() else int

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = filesystem(folder)
        for batch in batches:
            for file, start, size, records in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                with fs.open_input_file(f"{top}/{file}") as f:
                    f.seek(start)
                    data, out = f.read(size), []
                for r in records:
                    at = r["offset"] - start
                    headers, block = parse(zlib.decompress(data[at : at + r["length"]], 31))
                    stored = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload, n = None, int(headers["X-Payload-Length"])
                    if headers["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        n = len(payload)
                        if digest(payload) != stored:
                            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
                    url = unquote(headers["X-Target-URI"]) if "X-Target-URI" in headers else headers["WARC-Target-URI"]
                    ids = (_named(headers.get(x), of) for x in ("WARC-Record-ID", "WARC-Refers-To"))
                    out.append((next(ids), url, n, stored, headers["WARC-Type"], next(ids), None if payload is None else payload.decode()))
                kinds = (kind, pa.string(), pa.int64(), pa.string(), pa.string(), kind, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)

    schema = f"page_id {page_type}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {page_type}, html string"
    reads = ranges(index).repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a row is little, its read is not
    return reads.mapInArrow(run, schema)
