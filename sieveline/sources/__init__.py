"""Files into DataFrames and back. Paths are any that Spark reads; nothing here opens a file itself."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions.text import clean_headers

def _windows() -> tuple[str, str]:
    """Control characters of Latin-1 and what cp1252 has in their places; Spark reads the one and not the other."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    return "".join(a for a, b in pairs if b), "".join(b for _, b in pairs)


def sniffed(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(file, encoding, separator) of each CSV file: utf-8 unless its bytes aren't, else iso-8859-1; and whichever of , and ; its first line has more of. All files are read as text by the executors; one short row a file comes back."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    found = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"), F.max(~F.is_valid_utf8("value")).alias("odd"))
    count = lambda c: F.length("head") - F.length(F.replace("head", F.lit(c), F.lit("")))
    rows = found.select("file", F.when(F.col("odd"), "iso-8859-1").otherwise("utf-8"), F.when(count(";") > count(","), ";").otherwise(",")).collect()
    return sorted(map(tuple, rows))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, headers cleaned, '' as null; files that aren't UTF-8 are taken for cp1252; files of one kind are read together, kinds are united by name."""
    kinds: dict[tuple[str, str], list[str]] = {}
    for file, encoding, sep in sniffed(spark, path):
        kinds.setdefault((encoding, sep), []).append(file)
    frames = []
    for (encoding, sep), files in kinds.items():
        df = spark.read.csv(files, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"', nullValue="")
        df = df.toDF(*clean_headers(df.columns))
        frames.append(df if encoding == "utf-8" else df.select(*[F.translate(F.col(f"`{c}`"), *_windows()).alias(c) for c in df.columns]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames) if frames else spark.createDataFrame([], "value string")


def write_csv(df: DataFrame, path: str, columns: list[str], sep: str = ";", bom: bool = False) -> None:
    """Fixed column order; committed as a whole. With bom every file begins with a byte order mark, as spreadsheets want it."""
    out = df.select(*columns)
    out = out.toDF("\ufeff" + columns[0], *columns[1:]) if bom else out
    out.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"')


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Columns in the order in which they first appear; what a frame lacks is ''."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df.na.fill("")


def read_records(spark: SparkSession, path: str, fields: list[str], sep: str = "\t") -> DataFrame:
    """Records of a text file with so many fields; a line with fewer belongs to the last field of the record before it; lines before the first record are left out.

    A file is read in as many splits as Spark makes of it. Records are numbered within a split, and the lines with which a split begins belong
    to the last record that a split before it began; that takes one row a split.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"))
    lines = lines.withColumn("starts", (F.size(F.split("value", sep)) == len(fields)).cast("int"))
    numbered = lines.withColumn("record", F.sum("starts").over(Window.partitionBy("file", "split").orderBy("nth")))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begun = lines.groupBy("file", "split").agg(F.sum("starts").alias("n"))
    carried = begun.select("file", "split", F.last(F.when(F.col("n") > 0, F.struct(F.col("split").alias("of"), "n")), ignorenulls=True).over(before).alias("last"))
    own = F.when(F.col("record") > 0, F.struct(F.col("split").alias("of"), F.col("record").alias("n"))).otherwise(F.col("last"))
    runs = numbered.join(carried, ["file", "split"]).withColumn("record", own).where(F.col("record").isNotNull())
    parts = F.transform(F.array_sort(F.collect_list(F.struct("split", "nth", "value"))), lambda x: x["value"])
    whole = runs.groupBy("file", "record").agg(F.split(F.array_join(parts, "\n"), sep).alias("f"))
    return whole.select(*[F.get("f", F.lit(k)).alias(c) for k, c in enumerate(fields)])


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Broken lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def list_files(spark: SparkSession, path: str, suffixes: Iterable[str] = ()) -> DataFrame:
    """(path, size, modified, ext), found recursively; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    df = df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("ext"))
    return df.where(F.col("ext").isin(*suffixes)) if suffixes else df


def new_files(files: DataFrame, done: DataFrame, key: str = "hash") -> DataFrame:
    return files.join(done.select(key), key, "left_anti")


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, size, content) of all ZIP files under path; names that aren't marked as UTF-8 are tried as such."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for archive, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows = [(archive, _member_name(i), i.file_size, z.read(i)) for i in z.infolist() if not i.is_dir()]
                yield pd.DataFrame(rows, columns=["archive", "member", "size", "content"], dtype=object)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return found.select("path", "content").mapInPandas(run, "archive string, member string, size bigint, content binary")


def append_to_manifest(rows: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the manifest under path lacks; so a run that broke off goes on, and a repeated one adds nothing."""
    spark = rows.sparkSession
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        rows = rows.join(spark.read.parquet(path).select(key), key, "left_anti")
    rows.write.mode("append").parquet(path)


def _member_name(info: zipfile.ZipInfo) -> str:
    if info.flag_bits & 0x800:
        return info.filename
    try:
        return info.filename.encode("cp437").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return info.filename


class _Blocks(HTMLParser):
    """Text blocks in order, each with the headings above it."""

    def __init__(self):
        super().__init__()
        self.blocks: list[tuple[str, str, str]] = []
        self.stack: list[tuple[int, str]] = []
        self.kind, self.text, self.skip = "", [], 0

    def _close(self):
        text = " ".join("".join(self.text).split())
        if text and self.kind:
            if self.kind[0] == "h":
                level = int(self.kind[1])
                self.stack = [s for s in self.stack if s[0] < level] + [(level, text)]
            self.blocks.append((self.kind, " > ".join(t for _, t in self.stack), text))
        self.kind, self.text = "", []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "td", "th", "pre", "div"):
            self._close()
            self.kind = tag

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        if tag == self.kind:
            self._close()

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def html_blocks(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, nth, kind, headings, text) of each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, page in zip(b[key], b[html], strict=True):
                parser = _Blocks()
                parser.feed(page or "")
                parser._close()
                rows += [(k, n, *block) for n, block in enumerate(parser.blocks)]
            yield pd.DataFrame(rows, columns=[key, "nth", "kind", "headings", "text"], dtype=object)

    return pages.select(key, html).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, nth int, kind string, headings string, text string")


def write_years(df: DataFrame, path: str, year, years: list[int]) -> None:
    """The rows of the years that are asked for, one folder a year, in one pass."""
    df.withColumn("year", year).where(F.col("year").isin(*years)).write.mode("overwrite").partitionBy("year").parquet(path)
