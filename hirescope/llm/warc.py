"""WARC archives: writing, normalising monolithic gzip files, reading by index.

Archives that were compressed as one gzip stream cannot be read from the
middle. The normaliser inflates such a file once, as a stream, writes every
record again as a gzip member of its own, and notes each member's place in a
sidecar index (JSON lines), by which single records can be read.

One task handles one bounded archive: rows are written as they come, and a
new archive begins once ``ARCHIVE_BYTES`` of records are in it. Archives and
sidecars are written under a temporary name and renamed when complete, so a
lost or repeated task leaves whole files only; a table of the archives that
counted makes files of other attempts unused.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, fresh_path, ship, stored

ship(__name__)

ARCHIVE_BYTES = 64 << 20
REVISIT_FROM = 1000  # bytes
_CHUNK = 1 << 20
_GZIP = 31  # zlib's window bits for a gzip stream


# ------------------------------------------------------------------ records --

def digest_field(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digest_hex(field: str) -> str:
    return base64.b32decode(field.partition(":")[2]).hex()


def record(kind: str, page_id, url, payload: bytes, length: int, sha1: str, refers_to=None) -> bytes:
    """One record of the WARC 1.1 format. A revisit has no block; its headers
    name the digest and length of the full payload and the page it repeats."""
    uri = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "about:blank")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}')}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": digest_field(sha1),
        "X-Payload-Length": str(length),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}')}>", "X-Refers-To-Page": str(refers_to)}
        payload = b""
    head |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + payload + b"\r\n\r\n"


def inflated(file) -> Iterator[bytes]:
    """The bytes of a gzip file, stream by stream, in pieces of bounded size."""
    d = zlib.decompressobj(_GZIP)
    while raw := file.read(_CHUNK):
        while raw:
            if piece := d.decompress(raw, _CHUNK):
                yield piece
            if d.eof:
                raw = d.unused_data
                d = zlib.decompressobj(_GZIP)
            else:
                raw = d.unconsumed_tail
    if piece := d.flush():
        yield piece


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict, bytes, bytes]]:
    """(headers, block, the record's bytes) of each record in a byte stream."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("archive ends within a record's headers")
                return
        lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(head["Content-Length"])
        total = end + 4 + size + 4
        while len(held) < total:
            if not more():
                raise ValueError("archive ends within a record")
        whole = bytes(held[:total])
        del held[:total]
        yield head, whole[end + 4:end + 4 + size], whole


def normalise(source, target) -> Iterator[dict]:
    """Copy the gzip file ``source`` to ``target`` with one member a record;
    yields each record's index entry."""
    at = 0
    for head, block, whole in records(inflated(source)):
        c = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
        member = c.compress(whole) + c.flush()
        target.write(member)
        yield {"offset": at, "length": len(member), "type": head["WARC-Type"], "id": head["WARC-Record-ID"],
               "page": head["X-Page-ID"], "uri": head["WARC-Target-URI"], "digest": head["WARC-Payload-Digest"]}
        at += len(member)


# ------------------------------------------------------------- Spark side ---

def _filesystem(uri: str):
    """A file system for the shared folder, from within a task."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.partition(":")[2].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame) -> DataFrame:
    """row, page_id, payload_bytes, payload_digest, record_type, refers_to for
    every page: of equal payloads of ``REVISIT_FROM`` bytes and more, that of
    the largest page_id is the response. Only digests are shuffled; repeated
    ones are counted where they are before they move."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    rows = stored(rows, "warc-digests")
    groups = rows.where(F.col("payload_bytes") >= REVISIT_FROM).groupBy("payload_digest", "payload_bytes").agg(
        F.count("*").alias("n"), F.max("page_id").alias("response"))
    groups = stored(groups.where("n > 1 and response is not null").drop("n"), "warc-groups")
    out = rows.join(groups, ["payload_digest", "payload_bytes"], "left")
    again = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return out.select("page_id", "payload_bytes", "payload_digest",
                      F.when(again, "revisit").otherwise("response").alias("record_type"),
                      F.when(again, F.col("response")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record into monolithic gzip archives below
    ``folder``; a row (archive, n_records) for each. Texts are not shuffled:
    revisits are found by their digest in a join that carries none, except
    where the repeated digests are too many to broadcast."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    plan = stored(plan_records(pages).where("record_type = 'revisit'")
                  .select("page_id", "payload_digest", "refers_to").distinct(), "warc-revisits")
    rows = pages.select("page_id", "url", F.col("html").alias("payload"), F.sha1(payload).alias("sha1"), F.length(payload).cast("long").alias("n"))
    rows = rows.join(plan.select(F.col("page_id").alias("p"), "payload_digest", "refers_to"),
                     F.expr("page_id <=> p and sha1 = payload_digest"), "left")
    rows = rows.select("page_id", "url", "payload", "sha1", "n", F.col("payload_digest").isNotNull().alias("again"), "refers_to")

    def write(batches):
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, state = [], None

        def begin():
            name = uuid.uuid4().hex
            return [name, fs.open_output_stream(f"{root}/{name}.tmp", compression=None), zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0, 0]

        def end(s):
            s[1].write(s[2].flush())
            s[1].close()
            fs.move(f"{root}/{s[0]}.tmp", f"{root}/{s[0]}.warc.gz")
            return s[0], s[3]

        for pdf in batches:
            for page, url, text, sha1, n, again, to in zip(*(pdf[c] for c in ("page_id", "url", "payload", "sha1", "n", "again", "refers_to"))):
                state = state or begin()
                whole = record("revisit" if again else "response", None if pd.isna(page) else int(page), url, (text or "").encode("utf-8", "replace"), n, sha1,
                               int(to) if again and not pd.isna(to) else None)
                state[1].write(state[2].compress(whole))
                state[3] += 1
                state[4] += len(whole)
                if state[4] >= ARCHIVE_BYTES:
                    out.append(end(state))
                    state = None
        if state:
            out.append(end(state))
        yield pd.DataFrame(out, columns=["archive", "n_records"])

    arrow_batches(pages.sparkSession)
    return stored(rows.mapInPandas(write, "archive string, n_records long"), "warc-archives")


def normalise_archives(archives: DataFrame, folder: str, target: str) -> DataFrame:
    """Normalise each archive of ``folder`` into ``target``; a row (archive,
    n_records, n_bytes) for each. The index is beside it as ``.idx``."""

    def run(batches):
        fs, root = _filesystem(folder)
        _, to = _filesystem(target)
        fs.create_dir(to, recursive=True)
        for pdf in batches:
            out = []
            for name in pdf["archive"]:
                own = uuid.uuid4().hex
                n, last = 0, None
                with fs.open_input_stream(f"{root}/{name}.warc.gz", compression=None) as src, \
                        fs.open_output_stream(f"{to}/{name}.{own}.tmp", compression=None) as dst, \
                        fs.open_output_stream(f"{to}/{name}.{own}.idx.tmp", compression=None) as idx:
                    for entry in normalise(src, dst):
                        idx.write(json.dumps(entry).encode() + b"\n")
                        n, last = n + 1, entry
                fs.move(f"{to}/{name}.{own}.tmp", f"{to}/{name}.warc.gz")
                fs.move(f"{to}/{name}.{own}.idx.tmp", f"{to}/{name}.idx")
                out.append((name, n, last["offset"] + last["length"] if last else 0))
            yield pd.DataFrame(out, columns=["archive", "n_records", "n_bytes"])

    spread = archives.repartition(archives.sparkSession.sparkContext.defaultParallelism, "archive")
    return stored(spread.mapInPandas(run, "archive string, n_records long, n_bytes long"), "warc-normalised")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record, each read by its place in the index, inflated alone, and - for
    responses - checked against the digest in its headers."""

    def run(batches):
        fs, root = _filesystem(folder)
        for pdf in batches:
            for name in pdf["archive"]:
                out = []
                with fs.open_input_stream(f"{root}/{name}.idx", compression=None) as idx, fs.open_input_file(f"{root}/{name}.warc.gz") as file:
                    for line in io.TextIOWrapper(io.BufferedReader(idx), "utf-8"):
                        entry = json.loads(line)
                        file.seek(entry["offset"])
                        head, block, _ = next(records(iter([zlib.decompress(file.read(entry["length"]), _GZIP)])))
                        sha1 = digest_hex(head["WARC-Payload-Digest"])
                        if head["WARC-Type"] == "response":
                            if hashlib.sha1(block).hexdigest() != sha1:
                                raise ValueError(f"{name}: payload of {head['WARC-Record-ID']} does not match its digest")
                        page, to = head["X-Page-ID"], head.get("X-Refers-To-Page")
                        out.append((int(page) if page else None, int(head["X-Payload-Length"]), sha1, head["WARC-Type"], int(to) if to else None))
                        if len(out) == 4096:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    spread = archives.repartition(archives.sparkSession.sparkContext.defaultParallelism, "archive")
    return spread.select("archive").mapInPandas(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _rows(out) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype(
        {"page_id": "Int64", "refers_to": "Int64"})


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them, and read
    them back by index. One row for each page. Null html is an empty payload,
    a null url ``about:blank``, a null page_id stays null (and never is the
    response of others); rows that repeat a page_id are records of their own,
    and of equal payloads under the largest page_id all are responses."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    archives = write_archives(pages, f"{folder}/monolithic")
    whole = normalise_archives(archives, f"{folder}/monolithic", f"{folder}/normalised")
    return read_archives(whole, f"{folder}/normalised")
