"""Per-asset CSV price files -> silver bars.

Columns are matched to the five-column contract *by header name* (strip,
case-insensitive; any header containing "date" is the date, exact
open/high/low/close; other columns are dropped).  Each asset names files or
folders.  One job reads the head of every file (its first line and first date);
files are grouped by header and date format and each group is one CSV scan with
an explicit all-string schema, so files with other column orders, in the same
folder too, never shift columns.  The asset comes from a join with the
(file, header, asset) table of the plan, in which every file that is read must
be found with the header that it was planned with.  A date format that is not
named is inferred: ISO by the first date, else the one pattern that parses all
dates of a path.  Values are coerced leniently (bad number -> row dropped) and
dates strictly by default (an unparsable date fails the load; blank dates drop
the row).  A report row per asset tells what was loaded or why it was skipped.
"""

from __future__ import annotations

import csv
import io
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import parse_number
from candlewick.operators.clean import dedup, union_all
from candlewick.session import scratch_path, written
from candlewick.sources import fs

REQUIRED = ("date", "open", "high", "low", "close")
DEFAULT_SOURCE = "local_csv"
ISO = "iso"  # the date format of ISO dates; others are patterns

REPORT_SCHEMA = T.StructType([
    T.StructField("coin_id", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("first_date", T.StringType()), T.StructField("last_date", T.StringType()),
])


class NoDataError(ValueError):
    """Raised when not a single asset file could be loaded."""


def split_header(line: str, sep: str = ",") -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep), [])


def header_map(header: Sequence[str]) -> tuple[dict[int, str], list[str]]:
    """Position -> contract name for the recognised headers, and the list
    of missing contract names."""
    found: dict[int, str] = {}
    for i, raw in enumerate(header):
        name = raw.strip().lower()
        if "date" in name:
            target = "date"
        elif name in ("open", "high", "low", "close"):
            target = name
        else:
            continue
        if target in found.values():
            raise ValueError(f"two columns map to {target!r}: {list(header)}")
        found[i] = target
    missing = [c for c in REQUIRED if c not in found.values()]
    return found, missing


def parse_date(text, strict: bool = True, date_format: str = ISO):
    """Date text -> DATE: ``yyyy-MM-dd`` with optional time, or the given
    pattern (e.g. ``MM/dd/yyyy``).  Strict: a non-blank unparsable value
    raises at run time; lenient: NULL."""
    t = F.trim(text)
    if date_format == ISO:
        parsed = F.coalesce(t.try_cast("date"), t.try_cast("timestamp_ntz").cast("date"))
    else:
        parsed = F.try_to_timestamp(t, F.lit(date_format)).cast("date")
    if not strict:
        return parsed
    bad = parsed.isNull() & t.isNotNull() & (t != "")
    return F.when(bad, F.raise_error(F.concat(F.lit("unparsable date: "), t)).cast("date")) \
        .otherwise(parsed)


def read_bars_csv(spark: SparkSession, files: Mapping[str, str | Sequence[str]], run_ts: str,
                  strict_dates: bool = True, source: str = DEFAULT_SOURCE, sep: str = ",",
                  date_format: str | Mapping[str, str] | None = None) -> tuple[DataFrame, dict]:
    """Load ``{asset_id: path(s)}`` into silver bars.

    Returns ``(silver, plan)``; :func:`ingest_report` makes the report of the
    plan from the silver rows, best from the table they were written to.
    ``silver`` has columns date (text yyyy-MM-dd), open, high, low, close
    (double), coin_id, source, extracted_at (``run_ts`` text) and one row per
    (coin_id, date).  ``date_format`` is the pattern of all sources (or
    ``ISO``), or by asset; it is inferred where none is named.  Lenient dates (``strict_dates=False``) drop rows whose date does
    not parse; :func:`rejected_dates` lists them.
    """
    plan = plan_csv_files(spark, files, sep, date_format, strict_dates)
    if not plan["groups"]:
        raise NoDataError(f"no OHLCV data could be loaded: {plan['skipped']}")
    raw = union_all([_read_group(spark, plan, key, strict_dates, sep) for key in plan["groups"]])
    clean = (raw.where(F.col("date").isNotNull())
             .select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                     *[F.col(c) for c in ("open", "high", "low", "close")],
                     "coin_id", "_file")
             .where(F.col("open").isNotNull() & F.col("high").isNotNull()
                    & F.col("low").isNotNull() & F.col("close").isNotNull()))
    one = dedup(clean, ["coin_id", "date"], ["_file", "open", "high", "low", "close"])
    silver = one.select("date", "open", "high", "low", "close", "coin_id",
                        F.lit(source).alias("source"), F.lit(run_ts).alias("extracted_at"))
    return silver, plan


def ingest_report(silver: DataFrame, plan: Mapping) -> DataFrame:
    """One row per asset of the plan: loaded (with the rows that survived,
    0 if none did), missing, or missing_columns with the reason."""
    spark = silver.sparkSession
    assets = sorted({a for paths in plan["groups"].values() for _, a in paths})
    read = spark.createDataFrame([(a,) for a in assets], "_asset string")
    per = silver.groupBy("coin_id").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                                        F.max("date").alias("last_date"))
    loaded = (read.join(per, F.col("_asset") == F.col("coin_id"), "left")
              .select(F.col("_asset").alias("coin_id"), F.lit("loaded").alias("status"),
                      F.lit(None).cast("string").alias("detail"),
                      F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "first_date", "last_date"))
    skipped = spark.createDataFrame([(a, s, d, 0, None, None) for a, s, d in plan["skipped"]], REPORT_SCHEMA)
    return loaded.unionByName(skipped)


def rejected_dates(spark: SparkSession, files: Mapping[str, str | Sequence[str]],
                   sep: str = ",", date_format: str | Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose non-blank date text does not parse (lenient mode)."""
    plan = plan_csv_files(spark, files, sep, date_format, strict=False)
    raw = union_all([_read_group(spark, plan, key, False, sep, keep_text=True) for key in plan["groups"]])
    t = F.trim("date_text")
    return raw.where(F.col("date").isNull() & t.isNotNull() & (t != "")).select(
        "coin_id", "_file", "date_text")


# The patterns that date inference tries, ISO first.
DATE_PATTERNS = (ISO, "M/d/yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "M-d-yyyy[ H:mm[:ss]]",
                 "d-M-yyyy[ H:mm[:ss]]", "d.M.yyyy[ H:mm[:ss]]", "yyyyMMdd", "MMM d, yyyy", "d MMM yyyy")
SAMPLE_LINES = 50  # lines of a file that are looked through for a date
WHOLE_FILE = 1 << 40  # bytes of a split when only heads are read

HEADS = "file string, line string, sample string"


def _heads(batches, sep: str):
    """(file, first line, first date text) of every file whose beginning is in
    the partition.  What follows the first batch of a file is not read."""
    file = None
    for batch in batches:
        names, starts, lines = batch.columns
        if len(batch) and names[0].as_py() == file:
            return
        out = []
        for k in range(len(batch)):
            name = names[k].as_py()
            if name == file or starts[k].as_py():
                continue
            file, line = name, (lines[k].as_py() or "").lstrip("\ufeff")
            out.append((file, line, _first_date(line, lines[k + 1:k + 1 + SAMPLE_LINES].to_pylist(), sep)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)],
                                             names=["file", "line", "sample"])


def _first_date(header: str, lines: Sequence[str], sep: str) -> str | None:
    at = next((i for i, h in enumerate(split_header(header, sep)) if "date" in h.lower()), None)
    if at is None:
        return None
    cells = (row[at].strip() for row in csv.reader([x for x in lines if x], delimiter=sep) if len(row) > at)
    return next(filter(None, cells), None)


def read_heads(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """(file, line, sample): first line and first date text of every file that
    is not empty, at any depth.  One task a file, which stops after its first
    batch of rows; the split size that this needs is set in a session of its
    own.  Should a task get several files all the same, those it leaves out
    fail the load (:func:`_read_group`)."""
    own = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{key}", str(WHOLE_FILE))
    lines = own.read.option("recursiveFileLookup", True).text(list(paths))
    heads = lines.select(F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("start"), "value").mapInArrow(
        lambda batches: _heads(batches, sep), HEADS)
    path = scratch_path(spark, "csv-heads")
    heads.write.parquet(path)
    return spark.read.schema(HEADS).parquet(path)


def _owned_heads(spark: SparkSession, named: Sequence[tuple[str, str]], sep: str) -> DataFrame | None:
    """(file, line, iso, coin_id, root): the files of every asset and the path
    as given under which they lie; None if no path is there."""
    there = fs.existing(spark, [p for _, p in named])
    if not there:
        return None
    heads = read_heads(spark, sorted(there), sep)
    own = [(there[p].rstrip("/"), p, a) for a, p in named if p in there]
    roots = spark.createDataFrame(own, "_path string, root string, coin_id string")
    # a file lies in the folder that holds it or in one above (partition
    # folders); a depth beyond its own gives the file again
    place = F.split(F.parse_url("file", F.lit("PATH")), "/")
    above = F.explode(F.array_distinct(F.array(*[
        F.array_join(F.slice(place, 1, d), "/") for d in sorted({r.count("/") + 1 for r, _, _ in own})])))
    iso = F.coalesce(F.col("sample").rlike(r"^\d{4}-\d{2}-\d{2}([ T]|$)"), F.lit(False))
    return written(heads.select("file", "line", iso.alias("iso"), above.alias("_at"))
                   .join(roots, F.col("_at") == F.col("_path"))
                   .select("file", "line", "iso", "coin_id", "root"), "csv-owners")


def plan_csv_files(spark: SparkSession, files: Mapping[str, str | Sequence[str]], sep: str = ",",
                   date_format: str | Mapping[str, str] | None = None, strict: bool = True) -> dict:
    """What to read and how, from one job over the heads of all files.

    ``groups``: (header, date format) -> [(path, asset)], the path as given if
    all files under it share header and format, else each file by itself;
    ``skipped``: (asset, status, detail); ``owners``: the (file, line, coin_id)
    table and ``lines``: header -> its first lines.  An asset without any of
    its paths, or with a file that lacks a column, is skipped entirely.  The
    driver holds a row per path and header, and names of files only where one
    path mixes headers."""
    listed = {a: list(dict.fromkeys([p] if isinstance(p, str) else p)) for a, p in files.items()}
    owners = _owned_heads(spark, [(a, p) for a, paths in listed.items() for p in paths], sep)
    kinds = [] if owners is None else sorted(
        owners.groupBy("coin_id", "root", "line", "iso").agg(F.count(F.lit(1)).alias("n")).collect())
    per_path = Counter((r.coin_id, r.root) for r in kinds)
    single = _files_of(spark, owners, [k for k, n in per_path.items() if n > 1])
    places = lambda r: single.get((r.coin_id, r.root, r.line, r.iso), [r.root])
    skipped = {a: ("missing", ", ".join(paths)) for a, paths in listed.items()
               if not any((a, p) in per_path for p in paths)}
    headers: dict[str, tuple[str, ...]] = {}
    for r in kinds:
        headers[r.line] = tuple(split_header(r.line, sep))
        _, missing = header_map(headers[r.line])
        if missing:
            skipped.setdefault(r.coin_id, ("missing_columns", f"missing columns {missing} in {places(r)[0]}"))
    kinds = [r for r in kinds if r.coin_id not in skipped]

    format_of = date_format.get if isinstance(date_format, Mapping) else lambda _: date_format
    unsure: dict[tuple, list[str]] = defaultdict(list)
    for r in kinds:
        if format_of(r.coin_id) is None and not r.iso:
            unsure[headers[r.line]] += places(r)
    inferred = _infer_formats(spark, unsure, owners, sep, strict) if unsure else {}
    groups: dict[tuple, dict[tuple[str, str], None]] = defaultdict(dict)
    for r in kinds:
        fmt = format_of(r.coin_id) or (ISO if r.iso else inferred.get((r.coin_id, r.root), ISO))
        groups[headers[r.line], fmt].update({(p, r.coin_id): None for p in places(r)})
    lines: dict[tuple, list[str]] = defaultdict(list)
    for line, header in headers.items():
        lines[header].append(line)
    return {"groups": {k: list(v) for k, v in groups.items()}, "owners": owners, "lines": dict(lines),
            "skipped": [(a, *skipped[a]) for a in listed if a in skipped]}


def _files_of(spark: SparkSession, owners: DataFrame | None, mixed: list[tuple[str, str]]) -> dict[tuple, list[str]]:
    """(asset, path, header line, ISO) -> files, of paths whose files differ."""
    out: dict[tuple, list[str]] = defaultdict(list)
    if mixed:
        keys = spark.createDataFrame(mixed, "coin_id string, root string")
        for r in owners.join(keys, ["coin_id", "root"]).orderBy("file").collect():
            out[r.coin_id, r.root, r.line, r.iso].append(r.file)
    return dict(out)


class DateFormatError(ValueError):
    """No pattern, or more than one, parses the dates of a path."""


def _infer_formats(spark: SparkSession, paths: Mapping[tuple, list[str]], owners: DataFrame, sep: str,
                   strict: bool) -> dict[tuple[str, str], str]:
    """(asset, path) -> the pattern of ``DATE_PATTERNS`` that parses every date
    (lenient: the most dates) of its files whose first date is not ISO.  All
    patterns are tried on the distinct texts in one pass, failures counted
    map-side.  Raises if none does, or several that differ in some date."""
    texts = union_all([_scan(spark, h, sorted(set(p)), sep).select("_file", F.trim("date").alias("t"))
                       for h, p in paths.items()])
    texts = texts.where("t <> ''").groupBy("_file", "t").agg(F.count(F.lit(1)).alias("n"))
    mine = owners.where(~F.col("iso")).select("file", "coin_id", "root")
    tried = range(len(DATE_PATTERNS))
    read = texts.join(mine, F.col("_file") == F.col("file")).select(
        "coin_id", "root", "n", *[parse_date(F.col("t"), False, f).alias(f"d{k}") for k, f in enumerate(DATE_PATTERNS)])
    counts = read.groupBy("coin_id", "root").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(f"d{k}").isNull(), F.col("n")).otherwise(0)).alias(f"bad{k}")
                                 for k in tried],
        *[F.count_if(~F.col(f"d{i}").eqNullSafe(F.col(f"d{k}"))).alias(f"differ{i}_{k}")
          for i in tried for k in tried if i < k])
    out: dict[tuple[str, str], str] = {}
    for r in counts.collect():
        least = min(r[f"bad{k}"] for k in tried)
        fit = [k for k in tried if r[f"bad{k}"] == least]
        if strict and least:
            raise DateFormatError(f"unparsable date: no known pattern parses all of {r.n} dates in {r.root} "
                                  f"({DATE_PATTERNS[fit[0]]} fails for {least}); name a date_format")
        if any(r[f"differ{fit[0]}_{k}"] for k in fit[1:]):
            raise DateFormatError(f"the dates in {r.root} fit {[DATE_PATTERNS[k] for k in fit]}: name a date_format")
        out[r.coin_id, r.root] = DATE_PATTERNS[fit[0]]
    return out


def _scan(spark: SparkSession, header: tuple, paths: Sequence[str], sep: str) -> DataFrame:
    """The contract columns of the files with a header, as text, and ``_file``."""
    positions, _ = header_map(header)
    # the header's own names where they can be compared: with enforceSchema off
    # Spark, too, fails the load if a file's header is another
    named = len({h.lower() for h in header}) == len(header) and all(header)
    names = header if named else [f"_c{i}" for i in range(len(header))]
    df = (spark.read.schema(T.StructType([T.StructField(h, T.StringType()) for h in names]))
          .option("header", True).option("sep", sep).option("enforceSchema", not named)
          .option("recursiveFileLookup", True).option("mode", "PERMISSIVE").csv(list(paths)))
    quoted = ["`" + h.replace("`", "``") + "`" for h in names]
    return df.select(*[F.col(quoted[i]).alias(c) for i, c in positions.items()],
                     F.col("_metadata.file_path").alias("_file"))


def _read_group(spark: SparkSession, plan: Mapping, key: tuple, strict_dates: bool, sep: str,
                keep_text: bool = False) -> DataFrame:
    header, date_format = key
    paths = plan["groups"][key]
    # a row per file and asset; a file that the plan does not know, or knows by
    # another header, fails the load
    mine = plan["owners"].select("file", F.col("coin_id").isin(sorted({a for _, a in paths})).alias("_own"),
                                 F.col("line").isin(plan["lines"][header]).alias("_planned"), "coin_id").distinct()
    other = F.raise_error(F.concat(F.lit("the header of this file is not the planned one: "), F.col("_file")))
    rows = _scan(spark, header, sorted({p for p, _ in paths}), sep).join(mine, F.col("_file") == F.col("file"), "left")
    rows = rows.withColumn("_own", F.when(F.coalesce("_planned", F.lit(False)), F.col("_own")).otherwise(
        other.cast("boolean"))).where("_own")
    return rows.select(
        parse_date(F.col("date"), strict_dates, date_format).alias("date"),
        *[parse_number(F.col(c)).alias(c) for c in ("open", "high", "low", "close")],
        "coin_id", "_file", *([F.col("date").alias("date_text")] if keep_text else []))


def write_bars_csv(silver: DataFrame, base_dir: str,
                   layouts: Sequence[Sequence[tuple[str, object]]],
                   layout_of, mode: str = "overwrite") -> dict[str, list[str]]:
    """Write silver bars as per-asset CSV folders, asset ``a`` using layout
    ``layout_of(coin_id)`` (a Column giving an index into ``layouts``);
    a layout is a list of (header text, Column) pairs; ``mode`` append adds to
    folders that are there.  Returns ``{asset: [folder]}`` for
    :func:`read_bars_csv`."""
    spark = silver.sparkSession
    tagged = silver.withColumn("_layout", layout_of)
    out: dict[str, list[str]] = {}
    for i, layout in enumerate(layouts):
        path = f"{base_dir.rstrip('/')}/layout{i}"
        (tagged.where(F.col("_layout") == i)
         .select(*[c.alias(h) for h, c in layout], "coin_id")
         .write.mode(mode).partitionBy("coin_id")
         .option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
        for folder in fs.subfolders(spark, path, "coin_id="):
            out.setdefault(folder.rsplit("=", 1)[1], []).append(folder)
    return out
