"""WARC archives (operator 1): writing, and boundary-chain verified reading.

Archives are plain WARC/1.0 records written by Spark's text writer (the line
separator is a record's last line break), so they split anywhere. Reading cuts
the files at the magic line ``WARC/1.0``: every piece is a candidate record.
Byte offsets are prefix sums of piece lengths (within a file's block, then
over the blocks), and each candidate points to the offset at which its
Content-Length says the next record starts. Only candidates reachable from the
file's start are records; a magic line inside a payload is not. Candidates
that follow each other without a gap are one run, and pointer jumping works on
the runs, so its rounds grow with the logarithm of the false candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skirmish.llm.storage import stored

MAGIC = "WARC/1.0\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BROADCAST_ROWS = 500_000  # repeated payloads (about 64 bytes each) that may be broadcast
END = "\r\n\r\n"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of a payload's SHA-1 (32 digits, five bits each)."""
    digest = F.sha1(payload)
    out = []
    for i in range(8):  # five hexadecimal digits make four of base32
        part = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(part, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> None:
    """One record per row, payload in UTF-8 (null: empty), below ``path``.

    Of the rows with equal payloads those with the largest id are responses
    (several if that id repeats, all if no id is known), the others are
    revisits that refer to it. A null id has an empty name, a null URL no
    header; other columns are not read; an empty table writes no record.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    digested = rows.select("id", sha1_base32(F.col("payload").cast("binary")).alias("digest"),
                           F.octet_length("payload").cast("long").alias("n"))
    repeated = stored(digested.groupBy("digest", "n").agg(F.max("id").alias("kept"), F.min("id").alias("least"),
                                                          F.count("*").alias("rows"), F.count("id").alias("named"))
                      .where("kept > least or (kept is not null and named < rows)").select("digest", "kept"), "repeated")
    # The largest ids of repeated payloads: broadcast while provably small, else joined by shuffle.
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    records = (rows.withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
               .join(repeated, "digest", "left")
               .withColumn("revisit", F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def name(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    # A line break cannot stand in a header.
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    n = F.octet_length("payload").cast("string")
    text = F.concat(
        F.lit(MAGIC),
        header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        header("WARC-Record-ID", name("id")),
        header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        F.coalesce(header("WARC-Target-URI", url), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(header("WARC-Refers-To", name("kept")), header("WARC-Profile", F.lit(PROFILE)),
                                          header("X-Payload-Length", n), header("Content-Length", F.lit("0"))))
        .otherwise(header("Content-Length", n)),
        F.lit("\r\n"), F.when(F.col("revisit"), "").otherwise(F.col("payload")), F.lit("\r\n"))
    records.select(text.alias("value")).write.option("lineSep", "\r\n").text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value", F.octet_length("value").cast("long").alias("n"))


def _with_offset(pieces: DataFrame) -> DataFrame:
    """``at``: byte offset of the magic line before each piece (negative for
    what stands before a file's first magic line)."""
    step = F.col("n") + len(MAGIC)
    inner = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = (pieces.groupBy("file", "block").agg(F.sum(step).alias("size"))
            .withColumn("base", F.coalesce(F.sum("size").over(outer), F.lit(0))).drop("size"))
    return (pieces.withColumn("inner", F.coalesce(F.sum(step).over(inner), F.lit(0)))
            .join(base, ["file", "block"])
            .withColumn("at", F.col("base") + F.col("inner") - len(MAGIC)).drop("base", "inner", "row", "block"))


def _field(name: str) -> Column:
    return F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1)


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields of each candidate; ``body`` is where its payload starts in
    the piece, ``size`` its Content-Length (null if the header is broken)."""
    return (pieces.withColumn("head", F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1)))
            .withColumn("body", F.octet_length("head").cast("long") + len(END))
            .withColumn("size", F.expr("try_cast(%s as bigint)" % "regexp_extract(head, '(?im)^Content-Length:[ \\\\t]*([0-9]+)[ \\\\t]*$', 1)"))
            .withColumn("type", F.lower(_field("WARC-Type")))
            .withColumn("name", F.regexp_extract(_field("WARC-Record-ID"), "<urn:page:(.*)>", 1))
            .withColumn("refers", F.regexp_extract(_field("WARC-Refers-To"), "<urn:page:(.*)>", 1))
            .withColumn("stated", F.regexp_extract(_field("WARC-Payload-Digest"), "(?i)sha1:(.*)", 1))
            .withColumn("stated_n", _field("X-Payload-Length")))


def _payload(value: str) -> Column:
    return F.substring(F.col(value).cast("binary"), (F.col("body") + 1).cast("int"), F.col("size").cast("int"))


def _reachable(candidates: DataFrame) -> DataFrame:
    """The candidates (file, at, succ, next) on the chain from their file's start."""
    ordered = Window.partitionBy("file").orderBy("at")
    jumps_to = candidates.where("succ is not null and succ <> next").select("file", F.col("succ").alias("at")).distinct()
    runs = (candidates.join(jumps_to.withColumn("target", F.lit(True)), ["file", "at"], "left")
            .withColumn("joined", F.coalesce(F.lag("succ").over(ordered) == F.col("at"), F.lit(False)))
            .withColumn("head", ~F.col("joined") | F.coalesce("target", F.lit(False)))
            .withColumn("run", F.sum(F.col("head").cast("long")).over(ordered)))
    runs = stored(runs.drop("joined", "head", "target"), "runs")
    ends = runs.groupBy("file", "run").agg(F.min("at").alias("at"), F.max_by("succ", "at").alias("to"))
    reached = ends.where("at = 0").select("file", "at")
    jump = stored(ends.alias("a").join(ends.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.at")))
                  .select("a.file", "a.at", "a.to"), "jump")
    known = -1
    while not jump.isEmpty():
        reached = stored(reached.union(reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), "reached")
        if (found := reached.count()) == known:
            break
        known = found
        jump = stored(jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.at")))
                      .select("a.file", "a.at", "b.to"), "jump")
    heads = ends.join(reached, ["file", "at"], "left_semi").select("file", "run")
    return runs.join(heads, ["file", "run"], "left_semi").drop("run")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: name, type, payload_bytes,
    payload_digest (of the bytes read; of a revisit, as its header states),
    refers and digest_ok (the header agrees with the bytes).

    Bytes before a file's first record, a record behind a broken header and a
    truncated last record are not returned.
    """
    parsed = _parsed(_pieces(spark, path))
    whole = F.col("n") == F.col("body") + F.col("size") + len(END)
    heads = stored(_with_offset(parsed.withColumn("digest", F.when(whole, sha1_base32(_payload("value")))).drop("head", "value")),
                   "candidates").where("at >= 0")
    candidates = (heads.withColumn("next", F.col("at") + len(MAGIC) + F.col("n"))
                  .withColumn("succ", F.col("at") + len(MAGIC) + F.col("body") + F.col("size") + len(END)))
    sizes = candidates.groupBy("file").agg(F.max("next").alias("eof"))
    records = _reachable(candidates).join(sizes, "file").where("succ <= eof")
    spanning = stored(records.where("succ <> next").select("file", "at", "succ", "body", "size"), "spanning")
    if not spanning.isEmpty():
        # Payloads that hold a magic line: their pieces, put together again.
        pieces = _with_offset(_pieces(spark, path).join(spanning.select("file").distinct(), "file", "left_semi"))
        behind = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        owned = pieces.join(spanning.withColumn("start", F.col("at")), ["file", "at"], "left")
        owned = owned.select("file", "at", "value", *[F.last(c, ignorenulls=True).over(behind).alias(c)
                                                      for c in ("start", "succ", "body", "size")])
        parts = (owned.where("at < succ").groupBy("file", "start", "body", "size")
                 .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts")))
        joined = (parts.withColumn("value", F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC))
                  .select("file", F.col("start").alias("at"), sha1_base32(_payload("value")).alias("joined")))
        records = (records.join(joined, ["file", "at"], "left")
                   .withColumn("digest", F.coalesce("joined", "digest")).drop("joined"))
    revisit = F.col("type") == "revisit"
    return records.select(
        "name", "type", F.when(revisit, F.expr("try_cast(stated_n as bigint)")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.col("stated")).otherwise(F.col("digest")).alias("payload_digest"),
        F.when(revisit, F.col("refers")).alias("refers"),
        (revisit | F.col("digest").eqNullSafe(F.col("stated"))).alias("digest_ok"))


def round_trip(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> DataFrame:
    """Write every row to archives below ``path`` and read them back: ``id_col``,
    payload_bytes, payload_digest, record_type, refers_to, digest_ok."""
    write_archives(df, path, id_col, url_col, payload_col)
    id_type = df.schema[id_col].dataType.simpleString()
    return read_archives(df.sparkSession, path).select(
        F.expr(f"try_cast(name as {id_type})").alias(id_col), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.expr(f"try_cast(refers as {id_type})").alias("refers_to"), "digest_ok")
