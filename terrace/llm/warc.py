"""WARC archives with a two-level capture index (operator 8).

Writing: captures are range-partitioned and sorted by reversed-host URL key and id, and each task
writes one ``.warc.gz`` (a gzip member per record) and one index file beside it. An index file
holds its lines in compressed blocks of ``BLOCK_LINES``, then a sparse directory (first key and
place of every block), then the place of that directory. The first level, the key range of each
index file, is a stored table with one row per writing task.

Reading: keys are joined to the key ranges by sorting both together, then searched by bisection in
the directory of a file; blocks that can hold one are read by range, and so are the records their lines point at. One row
per (block, key) travels, so a URL with a third of all captures is read by as many tasks as it has
blocks.

A capture whose payload of at least ``LEAST_BYTES`` also belongs to a smaller id is a revisit record
without payload. Files are named by attempt, and only those that a finished task reports are ever
read, so repeated and lost tasks leave nothing behind that counts.

Defined cases: a NULL payload is empty; a NULL URL has the empty key; control characters and blanks
in URLs are percent-encoded; captures with a NULL id are written (as revisits where their payload
has an id) and read back with a NULL id. Rows with equal ids and payloads have the same type.
Looking up NULL keys finds nothing. An empty table gives an archive without files.
"""

import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.workspace import materialise, scratch

LEAST_BYTES = 100
BLOCK_LINES = 128
#: Blocks that one task reads in a lookup of all keys.
BLOCKS_READ = 32
#: Payload bytes that one task writes.
FILE_BYTES = 32 << 20
#: Ranges of one file closer than this are read together.
GAP = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)"


def url_key(url):
    """Reversed-host key of a URL column: ``http://www.b.com/x?y#z`` has ``com,b,www)/x?y``."""
    host = F.regexp_extract(url, PARTS, 1)
    rest = F.regexp_extract(url, PARTS, 2)
    turned = F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ",")
    return F.coalesce(F.when(host == "", url).otherwise(F.concat(turned, F.lit(")"), rest)), F.lit(""))


def _open(folder):
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def _clean(url):
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def _record(kind, fields, block):
    head = [f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page):
    return f"<urn:page:{'none' if page is None else page}>"


def _page(name):
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def capture(page, url, payload, digest, first):
    """The record of one capture; a revisit when ``first`` names the capture that has its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Record-ID", _name(page)), ("WARC-Target-URI", _clean(url)),
              ("WARC-Payload-Digest", "sha256:" + digest), ("Content-Type", "application/http;msgtype=response")]
    if first is None:
        return _record("response", fields, http + payload)
    return _record("revisit", [*fields, ("WARC-Refers-To", _name(first)), ("WARC-Profile", PROFILE),
                               ("X-Payload-Length", len(payload))], http)


def parse(data):
    """(type, fields, block) of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("a record is cut off")
    return fields["WARC-Type"], fields, rest[:size]


def _gzip(data):
    tool = zlib.compressobj(4, zlib.DEFLATED, 31)
    return tool.compress(data) + tool.flush()


def _captures(pages, id_column, url_column, payload_column):
    """Captures with the digest of their payload and the id they revisit."""
    rows = pages.select(F.col(id_column).cast("long").alias("page"), F.col(url_column).alias("url"),
                        F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    groups = rows.where(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    # Stored, so that its true size decides how payloads meet it: few repeated ones need no shuffle of payloads.
    shared = materialise(groups.where("n > 1").select("digest", "first"), "payloads")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    rows = rows.join(shared, "digest", "left")
    first = F.when((F.col("page") != F.col("first")) | F.col("page").isNull(), F.col("first"))
    return rows.select("page", "url", "payload", "digest", first.alias("first"), url_key(F.col("url")).alias("key")), total


def write_archive(pages, folder, id_column="page_id", url_column="url", payload_column="html"):
    """Write all captures; the first level of the index: a row per file with its key range."""
    rows, total = _captures(pages, id_column, url_column, payload_column)
    ordered = (rows.repartitionByRange(max(1, -(-total // FILE_BYTES)) + 1, "key", "page")
               .sortWithinPartitions("key", "page"))

    def write(parts):
        store, base = _open(folder)
        label = f"{base}/{uuid.uuid4().hex}"
        out = index = None
        place = written = 0
        lines, directory, last = [], [], None

        def flush():
            nonlocal written
            block = _gzip("\n".join(json.dumps(x) for x in lines).encode())
            directory.append((lines[0][0], written, len(block)))
            index.write(block)
            written += len(block)
            lines.clear()

        for part in parts:
            for row in part.to_pylist():
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(label + ".warc.gz", compression=None)
                    index = store.open_output_stream(label + ".cdx", compression=None)
                    info = _gzip(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                                      ("Content-Type", "application/warc-fields")], b"software: terrace\r\n"))
                    out.write(info)
                    place = len(info)
                data = _gzip(capture(row["page"], row["url"], row["payload"], row["digest"], row["first"]))
                out.write(data)
                lines.append((row["key"], place, len(data)))
                place += len(data)
                last = row["key"]
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            packed = _gzip(json.dumps(directory).encode())
            index.write(packed + struct.pack("<QQ", written, len(packed)))
            out.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{"file": label.rsplit("/", 1)[1], "first_key": directory[0][0],
                                               "last_key": last, "blocks": len(directory), "warc_bytes": place}])

    return materialise(ordered.mapInArrow(
        write, "file string, first_key string, last_key string, blocks long, warc_bytes long"), "archive")


class Directory:
    """The block directories of a few index files, read when needed."""

    def __init__(self, folder):
        self.store, self.base = _open(folder)
        self.known = {}

    def blocks(self, file):
        if file not in self.known:
            if len(self.known) >= 64:
                self.known.clear()
            with self.store.open_input_file(f"{self.base}/{file}.cdx") as source:
                size = source.size()
                place, length = struct.unpack("<QQ", source.read_at(16, size - 16))
                self.known[file] = json.loads(zlib.decompress(source.read_at(length, place), 31))
        return self.known[file]

    def search(self, file, key):
        """Numbers of the blocks of a file that can hold a key, by bisection."""
        starts = [b[0] for b in self.blocks(file)]
        return range(max(0, bisect.bisect_left(starts, key) - 1), bisect.bisect_right(starts, key))


def _files_of(archive, keys):
    """``file, key`` of every file whose key range holds one of the (distinct) keys.

    Ranges touch in their ends at most, so a key lies in the files that begin with it and in the last
    one that begins before it. The first are an equal join. For the others keys and beginnings are sorted
    together by range, and a pass over each sorted part remembers the last beginning; a key that comes
    before any in its part takes the last one of the parts before (one row per part is compared for that).
    """
    begins = archive.groupBy(F.col("first_key").alias("key")).agg(F.max(F.struct("last_key", "file")).alias("f"))
    both = keys.select("key", F.lit(None).cast("string").alias("last_key"), F.lit(None).cast("string").alias("file")).union(
        begins.select("key", "f.last_key", "f.file"))
    # A key before the beginning that equals it: that file is found by the equal join.
    ordered = both.repartitionByRange("key").sortWithinPartitions("key", F.col("file").asc_nulls_first())

    def follow(parts):
        number, file, last = TaskContext.get().partitionId(), None, None
        any_rows = False
        for part in parts:
            found = []
            for key, last_key, name in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if name is not None:
                    file, last = name, last_key
                elif file is None:
                    found.append((number, key, None, None))  # for the parts before
                elif last >= key:
                    found.append((None, key, file, last))
            any_rows = any_rows or part.num_rows > 0
            yield shown(found)
        if any_rows:
            yield shown([(number, None, file, last)])

    def shown(rows):
        types = pa.int32(), pa.string(), pa.string(), pa.string()
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "key", "file", "last_key"])

    seen = materialise(ordered.mapInArrow(follow, "part int, key string, file string, last_key string"), "places")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = seen.where("key IS NULL").select("part", *(F.last(c, True).over(before).alias(c) for c in ("file", "last_key")))
    early = seen.where("key IS NOT NULL AND file IS NULL").select("part", "key").join(ends, "part").where("last_key >= key")
    return (seen.where("key IS NOT NULL AND file IS NOT NULL").select("file", "key")
            .union(early.select("file", "key"))
            .union(archive.join(keys, F.col("first_key") == F.col("key")).select("file", "key")))


def lookup(archive, folder, keys, key_column="key"):
    """All captures of the keys: ``key, page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    ``archive`` is what ``write_archive`` returned: the stored first level, which is joined to the keys.
    """
    tasks = 1 + (archive.agg(F.sum("blocks")).first()[0] or 0) // BLOCKS_READ

    def find(parts):
        directory = Directory(folder)
        for part in parts:
            found = [(file, block, key) for file, key in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                     for block in directory.search(file, key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in ((0, pa.string()), (1, pa.int64()), (2, pa.string()))],
                names=["file", "block", "key"])

    def read(parts):
        directory = Directory(folder)
        at, wanted = None, set()
        for part in parts:
            for file, block, key in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if at is not None and at != (file, block):
                    yield _rows(directory, *at, wanted)
                    wanted = set()
                at = file, block
                wanted.add(key)
        if at is not None:
            yield _rows(directory, *at, wanted)

    wanted = keys.select(F.col(key_column).alias("key")).where("key IS NOT NULL").distinct()
    places = _files_of(archive, wanted).mapInArrow(find, "file string, block long, key string")
    return (places.repartition(tasks, "file", "block").sortWithinPartitions("file", "block")
            .mapInArrow(read, "key string, page_id long, url string, payload_bytes long, payload_digest string, "
                              "record_type string, refers_to long, payload binary"))


def _rows(directory, file, block, wanted):
    _, place, length = directory.blocks(file)[block]
    rows = []
    with directory.store.open_input_file(f"{directory.base}/{file}.cdx") as source:
        lines = [json.loads(x) for x in zlib.decompress(source.read_at(length, place), 31).split(b"\n")]
    lines = [line for line in lines if line[0] in wanted]
    with directory.store.open_input_file(f"{directory.base}/{file}.warc.gz") as source:
        while lines:
            n = 1
            while n < len(lines) and lines[n][1] - lines[n - 1][1] - lines[n - 1][2] <= GAP:
                n += 1
            start = lines[0][1]
            data = source.read_at(lines[n - 1][1] + lines[n - 1][2] - start, start)
            for key, at, size in lines[:n]:
                rows.append(_read(key, zlib.decompress(data[at - start:at - start + size], 31)))
            lines = lines[n:]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    types = pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()
    names = "key page_id url payload_bytes payload_digest record_type refers_to payload".split()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _read(key, data):
    kind, fields, block = parse(data)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    head = key, _page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"]
    if kind == "revisit":
        return *head, int(fields["X-Payload-Length"]), digest, kind, _page(fields["WARC-Refers-To"]), None
    payload = block.partition(b"\r\n\r\n")[2]
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return *head, len(payload), digest, kind, None, payload


@query("op8_warc", """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (
        SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (
        SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY ALL)
    SELECT d.page_id, d.payload_bytes, d.payload_digest,
           CASE WHEN f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)""")
def op8_warc(spark, sf):
    pages = table(spark, sf, "pages")
    folder = scratch(spark, "warc")
    archive = write_archive(pages, folder)
    found = lookup(archive, folder, pages.select(url_key(F.col("url")).alias("key")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
