"""WARC records, and resolution of not-modified revisits.

A revisit answered "not modified" has no body of its own. It is resolved by an as-of join: among the
records of its canonical URL, the latest full response (status 200) before it. If their validators agree
(entity tags by weak comparison, else the modification date), the record gets that response's body and status,
and its headers merged: the revisit's fields replace the stored ones, except those that describe the connection
(also by being named in its Connection field) or the stored body.

The join is a sorted stream: records are dealt by range over URL, time and id, so that one URL with a third
of all records spreads over many partitions; each partition carries only the last response seen. What a
partition needs from those before it is the last response of its first URL, from one summary row per
partition. Bodies are not moved; results name the response.

Defined results: records without URL or time, and revisits before any response, are "no_base". Validators
that differ give "etag_mismatch" or "date_mismatch", a pair without common validators "unchecked"; only
"resolved" gets a base. At equal times responses come before revisits, then the smaller record id (null first);
repeated records give repeated rows, and an empty table none. Null headers are none; of names that differ only
in case the one that sorts last counts, since a map has no order. Extra columns are left out; those asked for are found by name.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

# Header fields that a 304 response may not change in a stored response (HTTP caching).
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
RECORD = "record_id long, url string, ts long, warc_type string, status int, headers map<string,string>"
_SORTED = ("key", "ts", "revisit", "record_id", "status", "headers")
_OUT = "record_id long, key string, ts long, base_id long, verdict string, status int, headers map<string,string>"


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without default port, user and "www."; no fragment, tracking fields or closing slash; the query sorted."""
    text = F.regexp_replace(F.trim(url), "#.*$", "")
    place = F.lower(F.regexp_extract(text, "^([a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?@]*@)?[^/?]*)", 1))
    plain = F.regexp_replace(F.regexp_replace(place, "^(http://.*):80$", "$1"), "^(https://.*):443$", "$1")
    host = F.regexp_replace(F.regexp_replace(plain, "^[^:]*://(?:[^@]*@)?", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(text, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(text, r"\?(.*)$", 1)
    fields = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.lower(x).rlike("^(utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid)(=|$)")))
    rest = F.array_join(fields, "&")
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise("")))



def weak_tag(value: str | None) -> str | None:
    return None if value is None else value.strip().removeprefix("W/")


def judged(revisit: dict[str, str], base: dict[str, str]) -> str:
    """Whether the validators of a revisit and of the response before it agree."""
    for field, verdict in (("etag", "etag_mismatch"), ("last-modified", "date_mismatch")):
        a, b = weak_tag(revisit.get(field)), weak_tag(base.get(field))
        if a is not None and b is not None:
            return "resolved" if a == b else verdict
    return "unchecked"


def merged(revisit: dict[str, str], base: dict[str, str]) -> dict[str, str]:
    hop = {x.strip().lower() for x in (revisit.get("connection") or "").split(",")}
    return dict(sorted({**base, **{k: v for k, v in revisit.items() if k not in KEPT_FIELDS and k not in hop}}.items()))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            row["headers"] = dict(row["headers"] or [])
            yield row


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the partition's last URL and the last full response seen for it."""
    from pyspark import TaskContext

    key = base = None
    some = False
    for row in _rows(batches):
        if not some or row["key"] != key:
            key, base, some = row["key"], None, True
        if not row["revisit"]:
            base = row
    if some:
        response = json.dumps([base["record_id"], base["status"], base["headers"]]) if base else None
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([key], pa.string()), pa.array([response], pa.string())], names=["part", "key", "response"])


def _carried(tails: list) -> dict[int, tuple[str, list]]:
    """By partition: URL and last response that records of that URL at its start look back to."""
    out, key, base = {}, None, None
    for row in sorted(tails, key=lambda r: r["part"]):
        if key is not None and base is not None:
            out[row["part"]] = (key, base)
        if row["key"] != key:
            key, base = row["key"], None
        if row["response"] is not None:
            base = json.loads(row["response"])
    return out


def _joined(carried: dict) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key, base = carried.get(TaskContext.get().partitionId(), (None, None))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string())]
        names = [x.split()[0] for x in _OUT.split(", ")]
        for batch in batches:
            out = []
            for row in _rows([batch]):
                if row["key"] != key:
                    key, base = row["key"], None
                if not row["revisit"]:
                    base = [row["record_id"], row["status"], row["headers"]]
                    continue
                verdict = "no_base" if base is None else judged(row["headers"], base[2])
                if verdict == "resolved":
                    out.append((row["record_id"], key, row["ts"], base[0], verdict, base[1], list(merged(row["headers"], base[2]).items())))
                else:
                    out.append((row["record_id"], key, row["ts"], None, verdict, row["status"], list(row["headers"].items())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return run


def resolved(records: DataFrame) -> DataFrame:
    """A row per revisit of ``records`` (RECORD): record_id, key (canonical URL), ts, base_id, verdict, status, headers.

    Header names are compared in lower case, that of equal ones which sorts last counts. Responses are records of type
    response with status 200: a part is no body to fall back on.
    """
    key = canonical_url(F.col("url"))
    entries = F.transform(F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    lower = F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"]))
    base = records.select("record_id", key.alias("key"), "ts", (F.col("warc_type") == "revisit").alias("revisit"), "warc_type", "status", lower.alias("headers"))
    placed = F.col("key").isNotNull() & F.col("ts").isNotNull()
    full = F.col("revisit") | ((F.col("warc_type") == "response") & F.col("status").eqNullSafe(200))
    order = ["key", "ts", "revisit", "record_id"]
    n = common.partitions_for(records.sparkSession)
    dealt = common.checkpointed(base.where(placed & full).select(*_SORTED).repartitionByRange(n, *order).sortWithinPartitions(*order))
    carried = _carried(dealt.mapInArrow(_tails, "part long, key string, response string").collect())  # one row per partition
    out = dealt.mapInArrow(_joined(carried), _OUT)
    lost = base.where(F.col("revisit") & ~placed).select("record_id", "key", "ts", F.lit(None).cast("long").alias("base_id"), F.lit("no_base").alias("verdict"), "status", "headers")
    return out.unionByName(lost)


def written(headers: dict[str, str], block: bytes) -> bytes:
    """One WARC 1.1 record."""
    fields = {**headers, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + b"\r\n" + block + b"\r\n\r\n"


def read(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a WARC file, plain or of gzip members; a broken tail ends it."""
    data, at = _members(data), 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}
        size = fields.get("content-length", "")
        if not size.isdigit() or stop + 4 + int(size) > len(data):
            return
        yield fields, data[stop + 4 : stop + 4 + int(size)]
        at = stop + 4 + int(size)


def http_message(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, header fields (lower-case names) and body of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    status = first.split(" ")[1] if first.count(" ") else ""
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}
    return int(status) if status.isdigit() else None, fields, body


def _members(data: bytes) -> bytes:
    """The content of a file, whose records may be gzip members one after another; a broken one ends it."""
    if not data.startswith(b"\x1f\x8b"):
        return data
    out = []
    while data.startswith(b"\x1f\x8b"):
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(data))
        except zlib.error:
            break
        data = member.unused_data
    return b"".join(out)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_64_intdigest

    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for fields, block in read(content.as_buffer().to_pybytes()):
                status, headers, body = http_message(block)
                try:
                    ts = int(datetime.fromisoformat(fields.get("warc-date", "")).timestamp())
                except ValueError:
                    ts = None
                rows.append((xxh3_64_intdigest(fields.get("warc-record-id", "")) >> 1, fields.get("warc-target-uri"), ts, fields.get("warc-type"), status, list(headers.items()), body))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def records(files: DataFrame) -> DataFrame:
    """RECORD and payload of the records in WARC files (content), plain or of gzip members; a broken tail ends a file.

    record_id is a hash of the record's own id; ts is in seconds, null where the date cannot be read.
    """
    return common.small_batches(files).select("content").mapInArrow(_parsed, f"{RECORD}, payload binary")


def captures(pages: DataFrame) -> DataFrame:
    """A capture log (RECORD) of ``pages``, in which every verdict occurs: pages of one site section are captures of one URL.

    Each page gives a response and, a little later, a not-modified revisit. Times come from page_id. Of the
    responses every eleventh is partial and every thirteenth an error. A revisit names the page's entity tag,
    that of every seventh page another one; every fifth has only a date, of which every third differs; every
    seventeenth has no validator. Header names differ in case, every nineteenth response repeats one, and every
    fourth revisit has a field for its connection alone.
    """
    p = F.col("page_id")
    site = F.regexp_extract("url", "^([a-zA-Z]+://[^/?#]+/?[^/?#]*)", 1)
    url = F.concat(site, F.when(p % 3 == 0, "/").when(p % 3 == 1, "?utm_source=feed").otherwise("#top"))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    date = F.concat(F.lit("day "), F.floor(p / 100).cast("string"))
    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    field = lambda name, value, where=None: F.when(F.lit(True) if where is None else where, F.struct(F.lit(name).alias("key"), (F.lit(value) if isinstance(value, str) else value).alias("value")))
    headers = lambda *fields: F.map_from_entries(F.array_compact(F.array(*fields)))
    response = headers(field("ETAG", '"old"', p % 19 == 0), field("ETag", tag, p % 2 == 0), field("etag", tag, p % 2 != 0), field("Last-Modified", date), field("Content-Type", "text/html"), field("Content-Length", size), field("Cache-Control", "max-age=60"))
    bare, dated = p % 17 == 0, (p % 17 != 0) & (p % 5 == 0)
    tagged, traced = ~bare & ~dated, ~bare & ~dated & (p % 4 == 0)
    other = F.when(p % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))
    revisit = headers(field("Last-Modified", F.when(p % 3 == 0, "another day").otherwise(date), dated), field("ETag", other, tagged), field("Content-Length", "0"), field("Cache-Control", "max-age=3600", ~dated), field("Connection", "X-Trace", traced), field("X-Trace", p.cast("string"), traced))
    status = F.when(p % 11 == 0, 206).when(p % 13 == 0, 404).otherwise(200)
    one = lambda number, ts, kind, code, h: F.struct(number.alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit(kind).alias("warc_type"), code.alias("status"), h.alias("headers"))
    both = F.array(one(p * 2, p * 10, "response", status, response), one(p * 2 + 1, p * 10 + 25, "revisit", F.lit(304), revisit))
    return pages.select(F.explode(both).alias("r")).select("r.*")
