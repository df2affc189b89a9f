"""End-to-end jobs (K9, K10) over landed files, as Spark jobs.

Flight pipeline (K10), for all programs and pages at once:
  landed page files -> S1 read (declared schema) -> P5 validate (rejects
  kept aside) -> P1 flatten -> P10-P12 metadata -> F13 page-chain cut ->
  W1 latest version per key over all pages -> K3 merge into the table.
The N page-by-page merges of a fetch loop become one fold + one merge.

Hotel pipeline (K9):
  hotel details -> P2 -> K3 merge (key nid) -> S8 read back the key column ->
  J5 semi join with the calendars -> S7 -> P3 -> K3 merge (nid, date,
  is_points), partitioned coarsely by kind and month (Q5).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold import schemas as S
from lakefold.functions.hashing import content_hash_sql
from lakefold.operators import fold, select
from lakefold.operators.merge import ACTION, INSERT, UPDATE
from lakefold.operators.shape import availability_sql, flatten_availability, flatten_hotel_availability, flatten_hotels, hotel_url
from lakefold.operators.validate import availability_rules, split_valid, validate
from lakefold.plans import derive
from lakefold.session import ensure_checkpoint_dir, scratch_table, shuffles_end_with_queries
from lakefold.sources import html as H
from lakefold.sources import json_pages as J
from lakefold.storage.table import ArchiveTable

PAGE_SIZE = 5000
_SLICE_RECORDS = 2_000_000  # records that land, or rows that are written, together, about
_MOST_SLICES = 8       # landing slices: each reads the input again
_PAGES_A_FILE = 32     # landed pages of a file at most: gzip files are read by one task each
_PAGES_TOGETHER = 16   # neighbouring pages that land in one file: a stream takes a number of files at a time
_ROWS_A_FILE = 100_000  # parsed rows of a stored file: files are what the parts that are written are made of
_FEW_PAGES = 200_000   # kept pages that are broadcast at most
_FEW_MARKS = 1_000_000  # marks (of 64 stored rows each) that are broadcast at most
# A landed page: the API's object, the folder it landed in (run, program),
# and the text of an object that cannot be read.
LANDED_PAGE = T.StructType([*S.AVAILABILITY_PAGE.fields, T.StructField("program", T.StringType()),
                            T.StructField("run", T.LongType()), T.StructField("_corrupt", T.StringType())])
ENVELOPE = ["data", "count", "hasMore", "cursor"]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakefold/{name}-{uuid.uuid4().hex[:12]}"


def land_pages(records: DataFrame, path: str, page_size: int = PAGE_SIZE, part=None) -> None:
    """Write records as API page objects (JSON lines, one page per line,
    gzip), one folder a program, cursors 0, 1, ... in each.

    Records are spread over pages by a hash of their ID; a page holds at
    most ``page_size`` records on average, and is the unit that is collected,
    so nothing larger than a page is ever gathered in one row.  Pages land in
    slices, one after the other, so that only a part of the records is shuffled
    at a time; there are few slices, as the input is read for each of them.
    ``part(k, n)`` makes the records of slice ``k`` of ``n`` alone (None: they
    are filtered)."""
    spark = records.sparkSession
    cols = [F.col(f.name) for f in S.AVAILABILITY_RECORD.fields]
    of = F.col("Source").eqNullSafe(F.col("program"))
    counts = scratch_table(records.groupBy(F.col("Source").alias("program")).agg(F.count(F.lit(1)).alias("n")), "programs")
    n = min(_MOST_SLICES, max(1, -(-(counts.agg(F.sum("n").alias("n")).first().n or 0) // _SLICE_RECORDS)))
    sizes = counts.select("program", F.ceil(F.col("n") / (page_size * n)).alias("n_pages"))
    cursor = derive.slice_of("ID", n) * F.col("n_pages") + F.pmod(F.xxhash64("ID"), F.col("n_pages"))
    last = records.select("ID", "Source").join(sizes, of).groupBy("program", "n_pages").agg(F.max(cursor).alias("last"))
    last = scratch_table(last, "programs")  # a row a program
    for k in range(n):
        rows = records if n == 1 else part(k, n) if part else records.filter(derive.slice_of("ID", n) == k)
        paged = rows.join(last, of).withColumn("cursor", cursor).withColumn("_block", F.expr(f"cursor div {_PAGES_TOGETHER}"))
        grouped = paged.repartition("program", "_block").groupBy("program", "_block", "cursor", "last").agg(
            F.collect_list(F.struct(*cols)).alias("data"), F.count(F.lit(1)).cast("int").alias("count")
        )
        out = grouped.select(
            "data", "count", (F.col("cursor") < F.col("last")).alias("hasMore"), F.lit(None).cast("string").alias("moreURL"), "cursor", "program",
        )
        with shuffles_end_with_queries(spark):
            out.write.mode("append" if k else "overwrite").option("maxRecordsPerFile", _PAGES_A_FILE).partitionBy("program").json(path, compression="gzip")


def files_digest(*tables: DataFrame) -> int:
    """A number that changes with the files (path, size, time) of the tables."""
    total = 0
    for t in tables:
        m = t.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        total ^= m.agg(F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time")).alias("x")).first().x or 0
    return total


def landed_once(spark: SparkSession, key: str, writer, *inputs: DataFrame) -> str:
    """Folder of derived landed files for ``key`` and the files of ``inputs``
    under the shared checkpoint folder, written by ``writer(path)`` the first
    time only (a marker file is written last, so a half-written landing is
    redone; other input files are landed anew)."""
    import hashlib

    key = f"{key}:{files_digest(*inputs)}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakefold/landed-{hashlib.sha1(key.encode()).hexdigest()[:16]}"
    try:
        spark.read.text(f"{path}/_landed").take(1)
        return path
    except AnalysisException:
        pass
    writer(path)
    spark.createDataFrame([("done",)], "v string").coalesce(1).write.mode("overwrite").text(f"{path}/_landed")
    return path


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page files, one row a page.  ``run=`` and ``program=`` folders
    below ``path`` give these columns (else 0 and "")."""
    pages = spark.read.schema(LANDED_PAGE).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return named_pages(pages)


def named_pages(pages: DataFrame) -> DataFrame:
    return pages.withColumns({"program": F.coalesce("program", F.lit("")), "run": F.coalesce("run", F.lit(0))})


def page_rows(pages: DataFrame) -> DataFrame:
    """Landed pages -> one row a record (at ``_pos`` of its page), with what
    the rules say of it (``_reasons``) and, if that is nothing, the content
    hash of the flight that it becomes: no later step makes it again.

    A page without records, or one that cannot be read, is one row without
    ``_pos``; ``_told`` and ``_raw`` say why and what it held."""
    told = F.when(F.col("_corrupt").isNotNull(), F.array(F.lit("corrupt:page"))).otherwise(
        F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"missing:page.{c}")) for c in ENVELOPE))))
    raw = F.coalesce("_corrupt", F.to_json(F.struct(*ENVELOPE)))
    # What is told of a page is found before its records are dealt out: no row carries the page.
    paged = pages.select(
        "run", "program", "cursor", F.col("hasMore").alias("has_more"), F.size("data").alias("n_records"),
        F.when(~_readable(), told).alias("_told"), F.when(~_readable(), raw).alias("_raw"), F.when(_readable(), F.col("data")).alias("_data"))
    rows = paged.select(*(c for c in paged.columns if c != "_data"), F.posexplode_outer("_data").alias("_pos", "_rec"))
    rows = validate(rows.select("*", "_rec.*").drop("_rec"), availability_rules())
    content_hash = content_hash_sql(S.AVAILABILITY, exprs=availability_sql(S.AVAILABILITY_RECORD))
    return rows.withColumn(S.CONTENT_HASH, F.expr(f"CASE WHEN size(_reasons) = 0 THEN {content_hash} END"))


def placed(stored: DataFrame) -> DataFrame:
    """A frame of Parquet files with the file and number of each row."""
    return stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def page_facts(rows: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(run, program, cursor, n_records, kept) of each readable page of ``page_rows``.

    The fetch loop of a run and program reads its pages by cursor and stops
    before an empty page, after one that says it is the last, and after
    ``max_pages``.  The facts come from the pages themselves, so an empty page
    counts."""
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    facts = rows.filter(F.col("_told").isNull() & first).groupBy("run", "program", "cursor").agg(
        F.sum("n_records").alias("n_records"), F.bool_and("has_more").alias("has_more"))
    # One row a page; a run and program has as many as its fetch loop read.
    nth = F.row_number().over(Window.partitionBy("run", "program").orderBy("cursor"))
    return select.cut_page_chain(facts.withColumn("_no", nth), ["run", "program"], "_no", max_pages=max_pages).drop("_no")


def _readable():
    ok = F.col("_corrupt").isNull()
    for c in ENVELOPE:
        ok = ok & F.col(c).isNotNull()
    return ok


def marked_rows(rows: DataFrame, marked: DataFrame) -> list[DataFrame]:
    """The stored ``rows`` that ``marked`` names by file, place and action, read
    in place, in parts of about ``_SLICE_RECORDS`` rows.

    A part is some of the files, so that all parts together read each file
    once however many they are."""
    # One bit a stored row: 64 of them a mark.
    bit = "shiftleft(1L, CAST(_at % 64 AS INT))"
    marks = scratch_table(marked.groupBy("_file", F.expr("_at div 64").alias("_mark")).agg(
        F.expr(f"bit_or({bit})").alias("_bits"), F.expr(f"coalesce(bit_or(CASE WHEN {ACTION} = '{INSERT}' THEN {bit} END), 0L)").alias("_new")), "marks")
    # A row a stored file.
    files = marks.groupBy("_file").agg(F.count(F.lit(1)).alias("marks"), F.sum(F.bit_count("_bits")).alias("rows")).orderBy("_file").collect()
    groups: list[list] = [[]]
    for f in files:
        if groups[-1] and sum(g.rows for g in groups[-1]) + f.rows > _SLICE_RECORDS:
            groups.append([])
        groups[-1].append(f)
    parts = []
    for group in groups:
        own, at = rows, marks
        if len(groups) > 1:
            names = [f._file for f in group]
            own, at = rows.filter(F.col("_file").isin(names)), marks.filter(F.col("_file").isin(names))
        if sum(f.marks for f in group) <= _FEW_MARKS:
            at = F.broadcast(at)
        found = own.withColumn("_mark", F.expr("_at div 64")).join(at, ["_file", "_mark"]).filter("getbit(_bits, CAST(_at % 64 AS INT)) = 1")
        action = F.expr(f"CASE WHEN getbit(_new, CAST(_at % 64 AS INT)) = 1 THEN '{INSERT}' ELSE '{UPDATE}' END")
        parts.append(found.withColumn(ACTION, action).drop("_file", "_at", "_mark", "_bits", "_new"))
    return parts


def folded(rows: DataFrame, ingestion_ts: _dt.datetime | None = None, max_pages: int | None = None,
           keys=None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(valid flights with the file and place they are stored at, the last one
    of each key as keys, order, hash, file and place, rejects, page facts) of
    stored and ``placed`` ``page_rows``.

    The fold moves keys, order and hash of the rows and where they are stored,
    never the rows.  Rejects are invalid records of kept pages, and whole pages
    that cannot be read (``_raw`` holds their text)."""
    keys = list(keys or S.FLIGHT_KEYS)
    facts = page_facts(rows, max_pages)
    kept = facts.filter("kept").select("run", "program", "cursor")
    if kept.count() <= _FEW_PAGES:  # the records then stay where they are
        kept = F.broadcast(kept)
    records = rows.filter(F.col("_pos").isNotNull()).join(kept, ["run", "program", "cursor"], "left_semi").select(
        F.struct("run", "cursor").alias("_page"), "_pos", "_file", "_at", *(f.name for f in S.AVAILABILITY_RECORD.fields), S.CONTENT_HASH, "_reasons")
    valid, rejects = split_valid(records)
    unread = rows.filter(F.col("_told").isNotNull()).select(F.struct("run", "cursor").alias("_page"), F.col("_told").alias("_reasons"), "_raw")
    rejects = rejects.drop("_file", "_at", S.CONTENT_HASH).unionByName(unread, allowMissingColumns=True)
    ts = ingestion_ts or _dt.datetime.now(_dt.timezone.utc)
    ts = ts if ts.tzinfo else ts.replace(tzinfo=_dt.timezone.utc)
    flights = flatten_availability(valid, keep=(S.CONTENT_HASH, "_page", "_pos", "_file", "_at"))
    told = list(dict.fromkeys([*keys, "UpdatedAt", S.CONTENT_HASH]))
    latest = fold.latest_per_key(flights.select(*told, "_page", "_pos", "_file", "_at"), keys, "_page", "_pos").drop("_page", "_pos")
    flights = flights.select(*(f.name for f in S.AVAILABILITY.fields), F.lit(ts).cast("timestamp").alias(S.INGESTION_TS), S.CONTENT_HASH, "_file", "_at")
    return flights, scratch_table(latest, "latest"), rejects, facts


def flight_batch(rows: DataFrame, ingestion_ts: _dt.datetime | None = None, max_pages: int | None = None,
                 keys=None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(folded batch ready to merge, its keys, order and hash, rejects, page
    facts) of stored and ``placed`` ``page_rows``: the batch is those stored
    rows that the fold marks, read in place."""
    flights, latest, rejects, facts = folded(rows, ingestion_ts, max_pages, keys)
    parts = marked_rows(flights, latest.withColumn(ACTION, F.lit(INSERT)))
    return reduce(DataFrame.unionByName, parts).drop(ACTION), latest.drop("_file", "_at"), rejects, facts


def merge_pages(spark: SparkSession, pages: DataFrame, table_path: str, keys=None, ingestion_ts: _dt.datetime | None = None,
                partition_by=None, rejects_path: str | None = None, max_pages: int | None = None,
                replay: tuple[str, int] | None = None, parsed: bool = False) -> dict:
    """Cut, validate, fold and merge landed pages; the job's statistics.
    ``parsed``: they are stored and ``placed`` ``page_rows`` already.

    Invalid records are never dropped silently: they are counted, and with
    ``rejects_path`` appended there with their reasons and page."""
    # Parsing JSON is the expensive step: parse once, into columns (a tenth of
    # what cached page objects take on disk) for the page cut, the validation
    # split, the reject count and the batch, which is read from them in place.
    with shuffles_end_with_queries(spark):
        rows = pages if parsed else placed(scratch_table(page_rows(pages), "pages", _ROWS_A_FILE))
        flights, latest, rejects, facts = folded(rows, ingestion_ts, max_pages, keys)
        t = ArchiveTable(spark, table_path)
        stats = t.save(flights.drop("_file", "_at"), "merge", keys or S.FLIGHT_KEYS, partition_by or S.FLIGHT_PARTITIONS, add_meta=False,
                       replay=replay, cache_input=False, told=latest, taken=lambda changed: marked_rows(flights, changed))
        read = facts.agg(F.count_if("kept").alias("p"), F.sum(F.when(F.col("kept"), F.col("n_records"))).alias("r")).first()
        stats["pages_fetched"], stats["api_records"] = int(read.p), int(read.r or 0)
        stats["no_data"] = stats["api_records"] == 0
        stats["rejects"] = rejects.count()  # from the parsed rows: no re-parse
        if rejects_path:
            rejects.write.mode("append").parquet(rejects_path)
    return stats


def run_flight_pipeline(spark: SparkSession, landed: str, table_path: str, **options) -> dict:
    """Every landed page of every run and program into the table, one job."""
    return merge_pages(spark, read_landed_pages(spark, landed), table_path, **options)


def run_hotel_pipeline(spark: SparkSession, sf_dir: str, root: str, ingestion_ts: _dt.datetime | None = None) -> dict:
    """K9 over the derived hotel inputs."""
    hotels_t = ArchiveTable(spark, f"{root}/hotels")
    h_stats = hotels_t.save(flatten_hotels(derive.hotel_details(spark, sf_dir)), "merge", S.HOTEL_KEYS, S.HOTEL_PARTITIONS,
                            ingestion_ts=ingestion_ts)
    nids = hotels_t.current(["nid"])  # S8: key column only
    cals = derive.calendar_texts(spark, sf_dir).join(nids, "nid", "left_semi")  # J5
    rows = flatten_hotel_availability(J.calendar_rows(cals, "text", "nid", F.col("is_points")))
    rows = rows.withColumn("month", F.substring("date", 1, 7))
    avail_t = ArchiveTable(spark, f"{root}/hotel_availability")
    a_stats = avail_t.save(rows, "merge", S.HOTEL_AVAIL_KEYS, ["is_points", "month"], ingestion_ts=ingestion_ts,
                           hash_exclude=["month"])
    return {"hotels": h_stats, "availability": a_stats}


# The mark of a directory's link containers and of a hotel page's data.
LINK_BOX, PAGE_DATA = "directory-card__button__container", ("id", "__NEXT_DATA__")


def hotel_links(directory: DataFrame, site: str, html_col: str = "html") -> DataFrame:
    """S5 + P4: (url, title) of the first link of each container of the
    directory pages; each URL once."""
    found = H.hotel_links(directory, html_col, H.element_re("div", LINK_BOX)).filter("has_link")
    return found.select(hotel_url(F.lit(site), "path").alias("url"), "title").groupBy("url").agg(F.min("title").alias("title"))


def run_hotel_ingest(spark: SparkSession, directory: DataFrame, pages: DataFrame, calendars: DataFrame, root: str, site: str,
                     ingestion_ts: _dt.datetime | None = None) -> dict:
    """K9 over landed sources: directory pages (html) -> links -> hotel pages
    (url, html) -> their JSON -> hotels table -> rate calendars (nid,
    is_points, text) of stored hotels -> availability table.

    What cannot be stored is appended to ``<root>/rejects`` (url, nid,
    reasons): links without a page, pages without exactly one data script,
    JSON that breaks the rules, and calendars that do.  A page that landed
    several times counts once, by its least text."""
    links = hotel_links(directory, site)
    landed = pages.groupBy("url").agg(F.min("html").alias("html"), F.lit(True).alias("there"))
    found = links.join(landed, "url", "left")  # J7: misses stay
    script = H.marked_script(found, "html", *PAGE_DATA).drop("html")
    details = J.hotel_details(script.drop("title"), "script")
    why = F.when(F.col("there").isNull(), F.array(F.lit("missing:page"))).when(
        F.col("n_marked") != 1, F.array(F.concat(F.lit("scripts:"), F.col("n_marked").cast("string")))).otherwise(F.col("_reasons"))
    details = details.withColumn("_reasons", why).persist(StorageLevel.MEMORY_AND_DISK)  # parsed once: stored, rejected, counted
    cals = None
    try:
        hotels, bad = split_valid(details)
        hotels_t = ArchiveTable(spark, f"{root}/hotels")
        h_stats = hotels_t.save(flatten_hotels(hotels), "merge", S.HOTEL_KEYS, S.HOTEL_PARTITIONS, ingestion_ts=ingestion_ts)
        told = ["url", "nid", "_reasons"]
        cals = calendars.withColumn("_reasons", J.calendar_reasons(F.col("text")))
        cals = cals.join(hotels_t.current(["nid"]), "nid", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)  # S8, J5
        good, bad_cals = split_valid(cals)
        rejects = bad.select(*told).unionByName(bad_cals.select(F.lit(None).cast("string").alias("url"), "nid", "_reasons"))
        rejects.write.mode("append").parquet(f"{root}/rejects")
        rows = flatten_hotel_availability(J.calendar_rows(good, "text", "nid", F.col("is_points")))
        rows = rows.withColumn("month", F.substring("date", 1, 7))
        avail_t = ArchiveTable(spark, f"{root}/hotel_availability")
        a_stats = avail_t.save(rows, "merge", S.HOTEL_AVAIL_KEYS, ["is_points", "month"], ingestion_ts=ingestion_ts, hash_exclude=["month"])
        by = {r.reason: r["count"] for r in spark.read.schema(rejects.schema).parquet(f"{root}/rejects")
              .select(F.explode("_reasons").alias("reason")).groupBy("reason").count().collect()}  # one row a kind of reason
    finally:
        details.unpersist()
        if cals is not None:
            cals.unpersist()
    return {"hotels": h_stats, "availability": a_stats, "rejects": by}


def run_hotel_folder(spark: SparkSession, landed: str, root: str, site: str, **options) -> dict:
    """K9 over a folder: ``directory`` (HTML files), ``pages`` and
    ``calendars`` (JSON lines: url, html; nid, is_points, text)."""
    directory = spark.read.option("wholetext", True).text(f"{landed}/directory").withColumnRenamed("value", "html")
    pages = spark.read.schema("url string, html string").json(f"{landed}/pages")
    calendars = spark.read.schema("nid long, is_points boolean, text string").json(f"{landed}/calendars")
    return run_hotel_ingest(spark, directory, pages, calendars, root, site, **options)
