"""Round trips through files, in the shared folder."""

from pyspark.sql import functions as F

from sieveline import sources as S
from sieveline.functions.text import clean_headers
from sieveline.plans.registry import query, table
from sieveline.streaming import root_of


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_round_trip(spark, sf):
    path = f"{root_of(spark, 'csv')}/customer"
    S.write_csv(table(spark, sf, "customer"), path, ["c_custkey", "c_name", "c_mktsegment"])
    return S.read_csv(spark, f"{path}/*.csv")


@query("SELECT r_name AS name, CAST(r_regionkey AS VARCHAR) AS region, '' AS nation FROM region UNION ALL SELECT n_name, CAST(n_regionkey AS VARCHAR), CAST(n_nationkey AS VARCHAR) FROM nation")
def csv_union(spark, sf):
    """Files with different columns, separators and encodings."""
    path = root_of(spark, "csvs")
    r = table(spark, sf, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region"))
    n = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("nation"))
    S.write_csv(r, f"{path}/r", r.columns)
    S.write_csv(n, f"{path}/n", n.columns, ",", bom=True)
    return S.union_by_name([S.read_csv(spark, f"{path}/r/*.csv"), S.read_csv(spark, f"{path}/n/*.csv")])


@query("SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS suppkey, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def catalogue_export(spark, sf):
    """A catalogue with a byte order mark and a fixed order of columns, read again."""
    path = root_of(spark, "catalogue")
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"))
    S.write_csv(s, path, ["name", "suppkey", "nation"], bom=True)
    return S.read_csv(spark, f"{path}/*.csv")


@query("SELECT 'name, name_2, column, a b, name_3' AS headers")
def header_sanitisation(spark, sf):
    return spark.createDataFrame([(", ".join(clean_headers(["\ufeffname", "name", " ", "a\x00 b", "name"])),)], "headers string")


@query("""
    WITH f AS (SELECT DISTINCT c_mktsegment AS seg FROM customer) SELECT lower(regexp_replace(seg, '[^A-Za-z]', '', 'g')) AS folder, count(*) AS files, bool_and(true) AS filled, 'parquet' AS ext FROM f GROUP BY ALL""")
def file_listing(spark, sf):
    """A folder for each market segment, one file in each, found again by walking."""
    path = root_of(spark, "walk")
    c = table(spark, sf, "customer").withColumn("folder", F.lower(F.regexp_replace("c_mktsegment", "[^A-Za-z]", "")))
    c.repartition("folder").write.partitionBy("folder").parquet(path)
    found = S.list_files(spark, path, ["parquet"]).withColumn("folder", F.regexp_extract("path", "folder=([a-z]+)/", 1))
    return found.groupBy("folder").agg(F.count("*").alias("files"), F.bool_and(F.col("size") > 0).alias("filled"), F.first("ext").alias("ext"))


@query("SELECT 'r' || r_regionkey || '/é.txt' AS member, strlen(r_name) AS size, r_name AS text FROM region")
def zip_listing(spark, sf):
    """Members of archives, which are made for this: one for each of the five regions."""
    import io
    import zipfile

    path = root_of(spark, "zips")
    for r in table(spark, sf, "region").collect():
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(f"r{r['r_regionkey']}/é.txt", r["r_name"])
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{r['r_regionkey']}.zip")
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        stream.write(bytearray(out.getvalue()))
        stream.close()
    return S.zip_members(spark, path).select("member", "size", F.col("content").cast("string").alias("text"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 3 = 1")
def resumed_manifest(spark, sf):
    """A run that broke off after a third of its work goes on from the manifest; a run of all that is there adds nothing."""
    path = root_of(spark, "manifest")
    d = table(spark, sf, "documents").select("doc_id")
    for part in (d.where("doc_id % 3 = 0"), d.where("doc_id % 3 < 2"), d.where("doc_id % 3 = 1")):
        S.append_to_manifest(part, path, "doc_id")
    return spark.read.parquet(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, text FROM documents")
def tsv_continuation(spark, sf):
    """Texts with line ends in a tab-separated file come back whole; tabs, carriage returns and backslashes in them are escaped."""
    path = root_of(spark, "tsv")
    escaped = F.replace(F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\r"), F.lit("\\r"))
    table(spark, sf, "documents").select(F.concat_ws("\t", F.col("doc_id").cast("string"), "source", escaped).alias("value")).write.mode("overwrite").text(path)
    found = S.read_records(spark, path, ["doc_id", "source", "text"])
    plain = F.replace(F.replace(F.replace("text", F.lit("\\\\"), F.lit("\x01")), F.lit("\\t"), F.lit("\t")), F.lit("\\r"), F.lit("\r"))
    return found.withColumn("text", F.replace(plain, F.lit("\x01"), F.lit("\\")))


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def jsonl_latest(spark, sf):
    """An append-only log with broken lines: the last entry of each user."""
    path = root_of(spark, "jsonl")
    e = table(spark, sf, "events").select(F.to_json(F.struct("event_id", "user_id")).alias("value"))
    e.unionByName(spark.createDataFrame([('{"event_id": 1, "user',), ("no json",)], "value string")).write.mode("overwrite").text(path)
    log = S.read_jsonl(spark, path, "event_id bigint, user_id bigint").where("user_id is not null")
    return log.groupBy("user_id").agg(F.max("event_id").alias("event_id"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) IN (1996, 1998)")
def year_partition_split(spark, sf):
    path = root_of(spark, "years")
    S.write_years(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), path, F.year("o_orderdate"), [1996, 1997, 1998])
    return spark.read.parquet(path).where(F.col("year").isin(1996, 1998)).select("o_orderkey", "year")


@query("SELECT page_id, md5(html) AS hash FROM pages WHERE page_id % 3 <> 0")
def new_files_only(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.md5("html").alias("hash"))
    return S.new_files(p, p.where("page_id % 3 = 0"), "hash").select("page_id", "hash")


@query("SELECT s_suppkey, s_name FROM supplier")
def column_exclusion(spark, sf):
    s = table(spark, sf, "supplier")
    return s.drop(*[c for c in s.columns if c.strip().lower() in ("s_acctbal", "s_nationkey")])


@query()
def html_block_scan(spark, sf):
    return S.html_blocks(table(spark, sf, "pages"), "page_id", "html")


@query("""
    WITH b AS (SELECT source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 40 AS b FROM documents)
    SELECT source, b + 1 AS block, count(*) AS rows FROM b GROUP BY source, b""")
def block_files(spark, sf):
    """Rows of a source written in blocks of forty, a folder each, and read again."""
    from pyspark.sql import Window

    path = root_of(spark, "blocks")
    nth = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    d = table(spark, sf, "documents").select("doc_id", "source", (F.floor(nth / 40) + 1).alias("block"))
    d.write.partitionBy("source", "block").parquet(path)
    found = spark.read.schema("doc_id bigint, source string, block bigint").parquet(path)
    return found.groupBy("source", "block").agg(F.count("*").alias("rows"))
