"""Snapshots, late rows, caches."""

from pyspark.sql import functions as F

from sieveline.operators import merge as M
from sieveline.plans.matching import NEW, OLD, order_snapshots
from sieveline.plans.registry import query, table

_SNAP = f"""o AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE {OLD}),
    n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE {NEW})"""

_STALE = """
    WITH c AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n FROM events GROUP BY 1), r AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n FROM events WHERE event_id % 1000 <> 7 OR ts < TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT c.week, c.n AS n_now, r.n AS n_then FROM c LEFT JOIN r USING (week) WHERE r.n IS NULL OR c.n <> r.n"""


@query(f"""
    WITH {_SNAP} SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
      coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, CASE WHEN o.o_orderkey IS NULL THEN 'inserted' WHEN n.o_orderkey IS NULL THEN 'archived'
      WHEN o.o_orderstatus = n.o_orderstatus AND o.o_totalprice = n.o_totalprice THEN 'kept' ELSE 'updated' END AS state FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey""")
def upsert_two_phase(spark, sf):
    return M.two_phase(*order_snapshots(spark, sf), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query(f"WITH {_SNAP} SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT * FROM n")
def insert_or_replace(spark, sf):
    old, new = (df.select("o_orderkey", "o_orderstatus", "o_totalprice") for df in order_snapshots(spark, sf))
    return M.upsert(old, new, "o_orderkey")


@query(f"WITH {_SNAP} SELECT n.o_orderkey, CASE WHEN n.o_orderkey % 10 = 0 THEN coalesce(o.o_orderstatus, NULL) ELSE n.o_orderstatus END AS o_orderstatus FROM n LEFT JOIN o USING (o_orderkey)")
def preserve_columns(spark, sf):
    old, new = order_snapshots(spark, sf)
    blank = new.select("o_orderkey", F.when(F.col("o_orderstatus") != "X", F.col("o_orderstatus")).otherwise("").alias("o_orderstatus"))
    return M.preserve(blank, old, "o_orderkey", ["o_orderstatus"])


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_wins(spark, sf):
    return M.latest(table(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""
    SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events WHERE ts < TIMESTAMP '2024-01-22' AND CAST(date_trunc('week', ts) AS DATE) NOT IN (DATE '2024-01-08')""")
def late_rows_side_list(spark, sf):
    redone = spark.createDataFrame([("2024-01-08",)], "week string").select(F.col("week").cast("date").alias("week"))
    return M.late_rows(table(spark, sf, "events"), "ts", F.lit("2024-01-22").cast("timestamp"), redone, "week").select("event_id", "week")


@query(_STALE)
def stale_windows(spark, sf):
    e = table(spark, sf, "events").withColumn("week", F.date_trunc("week", "ts").cast("date"))
    count = lambda df: df.groupBy("week").agg(F.count("*").alias("n"))
    return M.stale(count(e.where("event_id % 1000 <> 7 or ts < timestamp '2024-01-15'")), count(e), ["week"], "n")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'es') UNION ALL SELECT -1 - r_regionkey FROM region")
def guarded_purge(spark, sf):
    """A trusted snapshot purges; a snapshot that is nearly empty purges nothing."""
    d, r = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "region").select((-1 - F.col("r_regionkey")).cast("long").alias("doc_id"))
    trusted = table(spark, sf, "documents").where("lang <> 'es'").select("doc_id")
    return M.guarded_purge(d, trusted, "doc_id").unionByName(M.guarded_purge(r, r.limit(1), "doc_id"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def idempotent_append(spark, sf):
    d, done = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    first = M.not_done(d, done, "doc_id")
    return first.unionByName(M.not_done(d, done.unionByName(first), "doc_id"))


@query("SELECT d.doc_id, quality, quality IS NULL AS todo FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND d.n_chars > 500")
def delta_reuse(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"), "n_chars")
    cache = d.where("n_chars > 500").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "h", "quality")
    return M.reuse(d.drop("n_chars"), cache, ["doc_id", "h"], "quality").drop("h")


@query("SELECT event_id FROM events WHERE event_type IN ('purchase', 'signup') OR CAST(ts AS DATE) + 10 >= DATE '2024-01-25'")
def cache_ttl(spark, sf):
    return M.fresh(table(spark, sf, "events"), "event_type", "ts", F.lit("2024-01-25").cast("date"), ["purchase", "signup"], 10).select("event_id")


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def high_water_mark(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    mark = e.where("ts < timestamp '2024-01-20'").agg(F.max("ts")).scalar()
    return e.where(F.col("ts") >= mark)


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS n FROM events GROUP BY ALL")
def weekly_stream(spark, sf):
    """Weekly counts by type out of a stream of files, with all that is there now."""
    from sieveline.streaming import weekly_counts

    return weekly_counts(spark, sf)


@query(_STALE)
def stale_stream(spark, sf):
    """The weeks that late rows make stale, by a state for each week: two runs over one checkpoint."""
    from sieveline.streaming import stale_by_runs

    e, late = table(spark, sf, "events"), F.expr("event_id % 1000 = 7 and ts >= timestamp '2024-01-15'")
    return stale_by_runs(spark, e.where(~late), e.where(late), "ts", "event_id")


@query(f"WITH {_SNAP} SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) AND o_orderkey % 50 <> 0 UNION ALL SELECT * FROM n")
def stored_merge(spark, sf):
    """Orders stored in parts; those that differ are merged in, and one in fifty of those that the new snapshot lacks is deleted: three snapshots."""
    from sieveline.operators.stored import StoredTable
    from sieveline.streaming import root_of

    old, new = (df.select("o_orderkey", "o_orderstatus", "o_totalprice") for df in order_snapshots(spark, sf))
    stored = StoredTable(spark, root_of(spark, "stored"), old._jdf.schema().toDDL(), "o_orderkey", parts=32)
    stored.merge(old)
    stored.merge(new.exceptAll(old))
    stored.merge(new.limit(0), old.where("o_orderkey % 50 = 0").join(new, "o_orderkey", "left_anti"))
    return stored.read()
