"""Content-addressed web archive: payload bytes once, exact record headers apart, records rebuilt by joins.

An archive folder has two tables. ``payloads``: ``sha256`` (the address), ``payload``. ``headers``:
one row per record with its number within the archive's order of ties, ``sha256`` and ``header``, the exact
header block of the WARC record (lines ending in CRLF). A record's bytes are its header, an empty
line, the payload (nothing for a revisit) and two line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlake.session import stage

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hex digest whose length is a multiple of five hex digits (SHA-1 has 40)."""
    letters = []
    for i in range(8):
        group = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(ALPHABET), F.shiftright(group, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, date: str = DATE) -> None:
    """Write one record per page to ``path``.

    Of the records with equal payloads of at least ``least_bytes`` bytes, the one with the
    smallest id is the response and the others are revisits of it; records with smaller payloads
    are all responses. Ties (repeated rows with one id) are ordered by url and then counted, so
    that exactly one is the response. A null id comes after all others, a null url is written as
    an empty target, a null payload as empty. Extra columns are ignored, an empty table makes an
    empty archive.

    Payloads are gathered once per distinct SHA-256 (each task sends a payload once at most), and
    the narrow record rows are reduced per (address, id, url) before they meet, so a payload that
    a third of all pages share costs one row per task.
    """
    body = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), body.alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    rows.groupBy("sha256").agg(F.first("payload").alias("payload")).write.mode("overwrite").parquet(f"{path}/payloads")

    narrow = rows.select("_id", "_url", "sha256", F.octet_length("payload").alias("_bytes"), base32_of_hex(F.sha1("payload")).alias("_sha1"))
    same = stage(narrow.groupBy("_id", "_url", "sha256", "_bytes", "_sha1").count(), "records")
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_url").alias("url"))
    firsts = same.groupBy("sha256").agg(F.min(place).alias("_first"))
    each = same.join(firsts, "sha256").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count"))))
    lead = (F.col("copy") == 1) & place.eqNullSafe(F.col("_first"))
    each = each.withColumn("_revisit", (F.col("_bytes") >= least_bytes) & ~lead)
    headers = each.select(
        F.col("_id").alias("record_key"),
        "copy",
        "sha256",
        header_block(date).alias("header"),
    )
    headers.write.mode("overwrite").parquet(f"{path}/headers")


def record_id(key: Column, url: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.coalesce(key.cast("string"), F.lit("null")), F.coalesce(url, F.lit("")), copy.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def header_block(date: str) -> Column:
    """The header lines of a record, each ended by CRLF, in a fixed order."""
    revisit = F.col("_revisit")
    first = F.col("_first")
    none = F.lit(None).cast("string")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    return F.concat_ws(
        "",
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("_id"), F.col("_url"), F.col("copy"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce(F.col("_url"), F.lit("")), "[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1"))),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(none),
        F.when(revisit, line("WARC-Refers-To", record_id(first["id"], first["url"], F.lit(1)))).otherwise(none),
        F.when(revisit, line("X-Refers-To-Key", F.coalesce(first["id"].cast("string"), F.lit("")))).otherwise(none),
        line("X-Record-Key", key),
        line("X-Payload-Length", F.col("_bytes").cast("string")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("_bytes").cast("string"))),
    )


def field(header: Column, name: str) -> Column:
    """Value of a header line; null if the header has no such line. Only a line feed begins a line: a URL may hold other separators."""
    found = F.regexp_extract(header, f"(?md)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(F.instr(header, f"{CRLF}{name}: ") > 0, found)


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    headers = spark.read.schema("record_key long, copy long, sha256 string, header string").parquet(f"{path}/headers")
    payloads = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    return headers, payloads


def verified(payloads: DataFrame) -> DataFrame:
    """Each stored payload once, with its length and SHA-1 taken from the stored bytes; a payload that does not match its address stops the job."""
    right = F.sha2("payload", 256) == F.col("sha256")
    checked = F.when(right, F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("sha256"))).cast("string"))
    return payloads.select(
        checked.alias("sha256"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        "payload",
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records as read back: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and, if wanted, ``record`` and ``payload``.

    Length and digest come from the stored bytes, which are checked against their address;
    the rest comes from the headers. ``payload`` is the full payload of every record, revisits
    included; ``record`` the exact bytes of the record. A header whose payload is missing, or
    whose digest differs from the stored bytes, stops the job.
    """
    headers, payloads = read_archive(spark, path)
    stored = verified(payloads)
    if not with_payload:
        stored = stored.drop("payload")
    joined = headers.join(stored, "sha256", "left")
    header = F.col("header")
    agrees = F.col("payload_digest").eqNullSafe(F.substring_index(field(header, "WARC-Payload-Digest"), ":", -1))
    digest = F.when(agrees, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("record does not match its payload: "), header)).cast("string"))
    kind = field(header, "WARC-Type")
    bytes_of = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload")) if with_payload else None
    more = [F.concat(F.encode(F.concat(header, F.lit(CRLF)), "UTF-8"), bytes_of, F.lit((CRLF * 2).encode())).alias("record"), "payload"] if with_payload else []
    return joined.select(
        F.col("record_key").alias("page_id"),
        field(header, "WARC-Target-URI").alias("url"),
        "payload_bytes",
        digest.alias("payload_digest"),
        kind.alias("record_type"),
        F.nullif(field(header, "X-Refers-To-Key"), F.lit("")).cast("long").alias("refers_to"),
        *more,
    )


def rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """``sha256`` and the exact bytes (``record``) of every record: a response's header joined with its payload, a revisit's header alone.

    Only responses meet payloads, and each payload has one response at most unless it is small, so
    a payload that many pages share is sent once. A response whose payload is missing stops the job.
    """
    headers, payloads = read_archive(spark, path)
    revisit = field(F.col("header"), "WARC-Type") == "revisit"
    head = F.encode(F.concat(F.col("header"), F.lit(CRLF)), "UTF-8")
    end = F.lit((CRLF * 2).encode())
    missing = F.raise_error(F.concat(F.lit("no payload for the address "), F.col("sha256"))).cast("binary")
    whole = headers.where(~revisit).join(payloads, "sha256", "left").select("sha256", F.concat(head, F.coalesce("payload", missing), end).alias("record"))
    return whole.unionByName(headers.where(revisit).select("sha256", F.concat(head, end).alias("record")))


def parsed(records: DataFrame) -> DataFrame:
    """Records as read from their bytes: the columns of ``records``, ``header`` and ``content``; a record of a wrong length stops the job."""
    flat = F.decode("record", "ISO-8859-1")  # one character a byte
    cut = records.withColumn("_end", F.instr(flat, CRLF * 2))
    cut = cut.withColumn("header", F.decode(F.substring("record", F.lit(1), F.col("_end") + 1), "UTF-8"))
    cut = cut.withColumn("_length", field(F.col("header"), "Content-Length").cast("int"))
    content = F.substring("record", F.col("_end") + 4, F.col("_length"))
    right = F.octet_length("record") == F.col("_end") + 3 + F.col("_length") + 4
    wrong = F.raise_error(F.concat(F.lit("record of a wrong length: "), F.col("header"))).cast("binary")
    return cut.withColumn("content", F.when(right, content).otherwise(wrong)).drop("_end", "_length", "record")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` from the rebuilt records of an archive.

    Every record is put together and parsed. A response's length and SHA-1 come from the content
    in its bytes, a revisit's from the stored payload at its address, and both must agree with
    the record's header.
    """
    records = parsed(rebuilt(spark, path))
    header = F.col("header")
    revisits = field(header, "WARC-Type") == "revisit"
    _, payloads = read_archive(spark, path)
    stored = verified(payloads).drop("payload")
    own = records.where(~revisits).withColumns({"payload_bytes": F.octet_length("content").cast("long"), "payload_digest": base32_of_hex(F.sha1("content"))}).drop("content")
    others = records.where(revisits).drop("content").join(stored, "sha256", "left")
    each = own.unionByName(others)
    agrees = F.concat(F.lit("sha1:"), F.col("payload_digest")).eqNullSafe(field(header, "WARC-Payload-Digest")) & F.col("payload_bytes").eqNullSafe(field(header, "X-Payload-Length").cast("long"))
    wrong = F.raise_error(F.concat(F.lit("record does not match its payload: "), header)).cast("string")
    return each.select(
        F.nullif(field(header, "X-Record-Key"), F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        F.when(agrees, F.col("payload_digest")).otherwise(wrong).alias("payload_digest"),
        field(header, "WARC-Type").alias("record_type"),
        F.nullif(field(header, "X-Refers-To-Key"), F.lit("")).cast("long").alias("refers_to"),
    )
