"""Benchmark decontamination by template canonicalisation.

Numbers, names (several in a row as one) and units right after a number become typed placeholders, all else is words.
Case counts nowhere in a text, so copies in capitals, small letters or titles are found: a name is a word that
no benchmark item has in small letters, wherever it stands, at the start of a sentence too. Windows of five such tokens
of a document are hash-joined with those of the benchmark items. Hits of a document and an
item that lie on one diagonal (the same distance between their places) are one occurrence; it
counts only if its slots are consistent, that is, each value of the item always meets the same
value in the document. A document leaks an item when consistent occurrences cover at least
three quarters of the item's distinct windows.

A window needs three tokens that aren't placeholders, else it says nothing. Items without such
windows (fewer than five tokens, or nearly all placeholders) leak where all their words, case
folded, stand in a row; they are a window of their own size, verbatim if found. A name that is also a word of
the benchmark in small letters (Rose, Mark) is a word: where a copy changes it, the windows that hold it don't meet.

Windows meet by 64-bit hashes of their tokens; a document needs three quarters of an item's. Few
benchmark windows are broadcast, many are joined by a shuffle, in which Spark splits a window that very many
documents hold; the benchmark's small words are part of the plan up to VOCABULARY, and joined beyond. Null and empty texts, and null and empty items, leak nothing; equal rows are judged
each on its own, and rows with one id are rows of their own; a text of any length is read whole by
one task; clashing columns of either table are not
looked at; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import dealt, new_root, stash, text_of

WIDTH, LITERAL, COVER = 5, 3, 0.75
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
# Units.
UNITS = "mm cm m km inches feet miles mg g kg tons ml l liters litres s seconds minutes hours days weeks months years percent usd eur dollars euros cents degrees".split()
#: Of a folded text: numbers, ends of sentences, words. WORD: of a text as it is.
TOKEN = NUMBER + r"|[.!?]+|[^\x00-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows of the benchmark up to this number are broadcast (each row has at most a few hundred bytes); more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000
#: Small words of the benchmark up to this number are a set in the plan (a few MB); more are joined.
VOCABULARY = 200_000


def folded(col: Column) -> Column:
    """Without case; by way of capitals, since some small letters share one."""
    return F.lower(F.upper(col))


def small_words(benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(w): the words that the benchmark has in small letters, folded."""
    words = benchmark.select(F.explode(F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))).alias("w"))
    return words.where(F.lower("w") == F.col("w")).select(folded(F.col("w")).alias("w")).distinct()


def _number(x: Column) -> Column:
    return (x >= "0") & (x < ":")


def _end(x: Column) -> Column:
    return (x >= "!") & ((x < "0") | ((x >= ":") & (x < "A")))


def _marked(x: Column, before: Column, known: Column) -> Column:
    """Units with a mark before them, names between marks, and the rest as it is."""
    unit = F.coalesce(x.isin(*UNITS) & _number(before), F.lit(False))
    return F.when(unit, F.concat(F.lit("\x03"), x)).when(_number(x) | _end(x) | known, x).otherwise(F.concat(F.lit("\x02"), x, F.lit("\x04")))


def canonical(df: DataFrame, known: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """(*keep, a): of each row's tokens, c, their canonical form, and s, the token if it is in a slot. Names in a row, within a sentence, are one token."""
    rows = df.select(*keep, F.regexp_extract_all(folded(text_of(text)), F.lit(TOKEN), F.lit(0)).alias("a"))
    words = [r[0] for r in known.limit(VOCABULARY + 1).collect()]
    if len(words) <= VOCABULARY:
        marked = F.transform("a", lambda x, i: _marked(x, F.get("a", i - 1), x.isin(*words)))
        rows = rows.select(*keep, marked.alias("a"))
    else:
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
        each = rows.select("_row", *keep, F.posexplode_outer("a").alias("_at", "w")).join(known.withColumn("known", F.lit(True)), "w", "left")
        own = each.groupBy("_row", *keep).agg(F.array_sort(F.collect_list(F.when(F.col("w").isNotNull(), F.struct("_at", "w", F.coalesce("known", F.lit(False)).alias("known"))))).alias("a"))
        rows = own.select(*keep, F.transform("a", lambda x, i: _marked(x["w"], F.get("a", i - 1)["w"], x["known"])).alias("a"))
    joined = F.replace(F.array_join("a", " "), F.lit("\x04 \x02"), F.lit("\x05"))
    rows = rows.select(*keep, F.explode(F.array(F.filter(F.split(joined, " "), lambda x: ~_end(x)))).alias("a"))

    def one(x: Column) -> Column:
        number, name, unit = _number(x), x.startswith("\x02"), x.startswith("\x03")
        return F.struct(F.when(number, "\x01").when(name, "\x02").when(unit, "\x03").otherwise(x).alias("c"), F.when(number | name | unit, x).alias("s"))

    return rows.select(*keep, F.explode(F.array(F.transform("a", one))).alias("a"))


def windows(df: DataFrame, known: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """(*keep, at, h, slots): the place and the hash of each window of canonical tokens, and what stands in its slots."""
    literal = lambda i: sum((F.get("a", i + k)["s"].isNull().cast("int") for k in range(WIDTH)), F.lit(0)) >= LITERAL
    starts = F.when(F.size("a") >= WIDTH, F.sequence(F.lit(0), F.size("a") - WIDTH)).otherwise(F.array().cast("array<int>"))
    rows = canonical(df, known, *keep, text=text).select(*keep, "a", F.explode(starts).alias("at")).where(literal(F.col("at")))
    at = lambda k: F.get("a", F.col("at") + k)
    return rows.select(*keep, "at", F.xxhash64(*[at(k)["c"] for k in range(WIDTH)]).alias("h"), F.array(*[at(k)["s"] for k in range(WIDTH)]).alias("slots"))


def leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, coverage, first_token, verbatim): the items that each row of docs leaks."""
    root = new_root(docs.sparkSession, "leaks")
    known = stash(small_words(benchmark), root, "known")
    items = stash(windows(benchmark, known, "item_id"), root, "items")
    small = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    side_of = F.broadcast if small else dealt
    # a table by now: a small side that Spark finds out about while the texts are read would wait behind them to be broadcast, beyond spark.sql.broadcastTimeout
    totals = stash(items.groupBy("item_id").agg(F.count_distinct("h").alias("item_windows")), root, "totals")
    side = items.select("item_id", "h", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))

    rows = windows(docs.withColumn("row", F.monotonically_increasing_id()), known, "row", "doc_id")
    hits = rows.join(side_of(side), "h")
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")), lambda p: p["i"].isNotNull())
    placed = (
        hits.select("row", "doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "at", "h", pairs.alias("pairs"))
        .groupBy("row", "doc_id", "item_id", "shift")
        .agg(F.collect_set("h").alias("hs"), F.min("at").alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
        .where(F.size(F.array_distinct(F.col("pairs.i"))) == F.size("pairs"))
    )
    found = placed.groupBy("row", "doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hs")))).cast("long").alias("n_windows"),
        F.min("at").cast("long").alias("first_token"),
        F.bool_and(F.forall("pairs", lambda p: p["i"] == p["d"])).alias("verbatim"),
    )
    coverage = F.col("n_windows") / F.col("item_windows")
    by_windows = found.join(side_of(totals), "item_id").withColumn("coverage", coverage).where(F.col("coverage") >= cover)
    by_windows = by_windows.select("doc_id", "item_id", "n_windows", "item_windows", "coverage", "first_token", "verbatim")
    whole = stash(benchmark.select("item_id", plain_words().alias("ws")).where(F.size("ws") > 0).join(items.select("item_id").distinct(), "item_id", "left_anti"), root, "whole")
    sizes = sorted(r[0] for r in whole.select(F.size("ws")).distinct().collect())  # of the few items without windows
    return by_windows.unionByName(whole_items(docs, whole, sizes)) if sizes else by_windows


def plain_words(text: str = "text") -> Column:
    return F.regexp_extract_all(folded(text_of(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def whole_items(docs: DataFrame, whole: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows of leaks() for items (item_id, ws) whose words stand in a row in a document; sizes are those of ws."""
    words = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.explode(F.array(plain_words())).alias("ws"))
    firsts = [r[0] for r in whole.select(F.element_at("ws", 1)).distinct().limit(VOCABULARY + 1).collect()]
    starts = lambda i: F.get("ws", i).isin(*firsts) if len(firsts) <= VOCABULARY else F.lit(True)
    places = lambda n: F.filter(F.sequence(F.lit(0), F.size("ws") - n), starts)
    at = lambda n: F.when(F.size("ws") >= n, F.transform(places(n), lambda i: F.struct(i.alias("at"), F.slice("ws", i + 1, n).alias("ws"))))
    runs = words.select("row", "doc_id", F.explode(F.flatten(F.array_compact(F.array(*[at(n) for n in sizes])))).alias("w")).select("row", "doc_id", F.col("w.at").alias("at"), F.col("w.ws").alias("ws"))
    one = runs.join(whole, "ws").groupBy("row", "doc_id", "item_id").agg(F.min("at").cast("long").alias("first_token"))
    return one.select("doc_id", "item_id", F.lit(1).cast("long").alias("n_windows"), F.lit(1).cast("long").alias("item_windows"), F.lit(1.0).alias("coverage"), "first_token", F.lit(True).alias("verbatim"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that leak no item."""
    return docs.join(dealt(leaks(docs, benchmark).select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)


def leaks_sql() -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    fold = "lower(upper(coalesce(text, '')))"
    number, end = "({0} >= '0' AND {0} < ':')", "({0} >= '!' AND ({0} < '0' OR ({0} >= ':' AND {0} < 'A')))"

    def windowed(table: str, key: str, name: str) -> str:
        return rf"""
        {name}0 AS (SELECT {key}, row_number() OVER () AS rid, regexp_extract_all({fold}, '{TOKEN}') AS a FROM {table}),
        {name}1 AS (SELECT {key}, rid, generate_subscripts(a, 1) AS p, unnest(a) AS x FROM {name}0),
        {name}2 AS (SELECT {key}, rid, p, x, v.w, lag(x) OVER (PARTITION BY rid ORDER BY p) AS y FROM {name}1 LEFT JOIN known v ON x = v.w),
        {name}3 AS (SELECT {key}, rid, p, CASE WHEN x IN ({units}) AND {number.format("y")} THEN chr(3) || x WHEN {number.format("x")} OR {end.format("x")} OR w IS NOT NULL THEN x ELSE chr(2) || x || chr(4) END AS x FROM {name}2),
        {name}4 AS (SELECT {key}, rid, list_filter(string_split(replace(string_agg(x, ' ' ORDER BY p), chr(4) || ' ' || chr(2), chr(5)), ' '), lambda x: NOT {end.format("x")}) AS a FROM {name}3 GROUP BY {key}, rid),
        {name}5 AS (SELECT {key}, rid, list_transform(a, lambda x: CASE WHEN {number.format("x")} THEN chr(1) WHEN x < chr(4) THEN x[1] ELSE x END) AS c, list_transform(a, lambda x: CASE WHEN {number.format("x")} OR x < chr(4) THEN x END) AS s, unnest(range(0, len(a) - {WIDTH - 1})) AS pos FROM {name}4 WHERE len(a) >= {WIDTH}),
        {name}6 AS (SELECT {key}, rid, pos, list_aggregate(c[pos + 1 : pos + {WIDTH}], 'string_agg', ' ') AS h, s[pos + 1 : pos + {WIDTH}] AS s FROM {name}5),
        {name} AS (SELECT * FROM {name}6 WHERE len(list_filter(s, lambda x: x IS NULL)) >= {LITERAL})"""

    return rf"""
        WITH words AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w FROM benchmark), known AS (SELECT DISTINCT lower(upper(w)) AS w FROM words WHERE lower(w) = w),
        {windowed("documents", "doc_id", "d")}, {windowed("benchmark", "item_id", "b")},
        hit AS (SELECT d.rid, doc_id, item_id, d.pos - b.pos AS shift, d.pos AS pos, d.h AS h, list_filter(list_zip(b.s, d.s), lambda p: p[1] IS NOT NULL) AS pairs FROM d JOIN b ON d.h = b.h),
        p AS (SELECT rid, doc_id, item_id, shift, list(DISTINCT h) AS hs, min(pos) AS pos, list_distinct(flatten(list(pairs))) AS pairs FROM hit GROUP BY ALL),
        f AS (SELECT rid, doc_id, item_id, len(list_distinct(flatten(list(hs)))) AS n_windows, min(pos) AS first_token, bool_and(len(list_filter(pairs, lambda p: p[1] <> p[2])) = 0) AS verbatim
              FROM p WHERE len(list_distinct(list_transform(pairs, lambda p: p[1]))) = len(pairs) GROUP BY rid, doc_id, item_id),
        t AS (SELECT item_id, count(DISTINCT h) AS item_windows FROM b GROUP BY item_id)
        SELECT doc_id, item_id, CAST(n_windows AS BIGINT) AS n_windows, item_windows, n_windows / item_windows AS coverage, CAST(first_token AS BIGINT) AS first_token, verbatim
        FROM f JOIN t USING (item_id) WHERE n_windows / item_windows >= {COVER}"""
