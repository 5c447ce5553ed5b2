"""Dates, numbers, lists and scores as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.text import clean, col, let, match_key

# Month names.
MONTHS_PT = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")


def any_date(c: str | Column, day_first: bool = True) -> Column:
    """ISO first; else a/b/year, where a part over 12 is the day and day_first decides the rest. Null if invalid."""
    v = F.trim(col(c))
    iso = F.try_to_date(F.regexp_extract(v, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), "yyyy-MM-dd")
    part = lambda k: F.regexp_extract(v, r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})$", k)
    a, b, y = (F.nullif(part(k), F.lit("")).cast("int") for k in (1, 2, 3))
    day = F.when(a > 12, a).when(b > 12, b).otherwise(a if day_first else b)
    month = F.when(a > 12, b).when(b > 12, a).otherwise(b if day_first else a)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.coalesce(iso, F.try_to_date(text, "yyyy-MM-dd"))


def detected_date(df, c: str):
    """df with c as a date, day or month first as the column itself tells: month first if some value has a second part over 12 and none a first one. One aggregate decides it."""
    part = lambda k: F.try_to_number(F.regexp_extract(F.trim(c), r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-][0-9]{4}$", k), F.lit("99"))
    month = df.agg((F.coalesce(F.max(part(2)), F.lit(0)) > 12) & (F.coalesce(F.max(part(1)), F.lit(0)) <= 12)).scalar()
    return df.withColumn(c, F.when(month, any_date(c, False)).otherwise(any_date(c, True)))


def month_first(c: str | Column, day_first: bool = True) -> Column:
    """M/D/YYYY, or the value as it is where it isn't a date."""
    d = any_date(c, day_first)
    return F.coalesce(F.when(d.isNotNull(), F.concat_ws("/", F.month(d), F.day(d), F.year(d))), col(c))


def written_date(c: str | Column) -> Column:
    """'12 de março de 1935' and the like."""
    v = F.lower(col(c))
    found = lambda k: F.nullif(F.regexp_extract(v, r"([0-9]{1,2})\S? de (\p{L}+) de ([0-9]{4})", k), F.lit(""))
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS_PT) for x in (m, k + 1)])
    return F.try_to_date(F.concat_ws("-", found(3), F.lpad(F.try_element_at(months, found(2)).cast("string"), 2, "0"), F.lpad(found(1), 2, "0")), "yyyy-MM-dd")


def week_start(c: str | Column) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", col(c)).cast("date")


def week_end(c: str | Column) -> Column:
    return F.date_add(week_start(c), 6)


def year_in(c: str | Column, first: int, last: int) -> Column:
    """The first year of the range that the text names."""
    years = F.transform(F.regexp_extract_all(col(c), F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.get(F.filter(years, lambda y: y.between(first, last)), F.lit(0))


def digits(c: str | Column) -> Column:
    """Digits only; the trimmed value where there are none."""
    return F.coalesce(F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit("")), F.trim(col(c)))


def case_number(c: str | Column) -> Column:
    """Twenty digits as NNNNNNN-DD.YYYY.J.TR.OOOO; anything else as it is."""
    d = F.regexp_replace(col(c), "[^0-9]", "")
    cut = lambda a, n: F.substring(d, a, n)
    text = F.concat(cut(1, 7), F.lit("-"), cut(8, 2), F.lit("."), cut(10, 4), F.lit("."), cut(14, 1), F.lit("."), cut(15, 2), F.lit("."), cut(17, 4))
    return F.when(F.length(d) == 20, text).otherwise(col(c))


def thousands(c: str | Column) -> Column:
    """9504 as 9.504."""
    return F.regexp_replace(col(c).cast("string"), r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ".")


def clamp(c: str | Column, low, high) -> Column:
    return F.greatest(F.least(col(c), F.lit(high)), F.lit(low))


def band(c: str | Column, steps: list[tuple[float, str]], rest: str) -> Column:
    """The label of the first step that the value reaches."""
    return reduce(lambda out, s: out.when(col(c) >= s[0], s[1]), steps[1:], F.when(col(c) >= steps[0][0], steps[0][1])).otherwise(rest)


def first_rule(c: str | Column, rules: list[tuple[str, str]], rest: str) -> Column:
    """The label of the first pattern found."""
    return reduce(lambda out, r: out.when(col(c).rlike(r[0]), r[1]), rules[1:], F.when(col(c).rlike(rules[0][0]), rules[0][1])).otherwise(rest)


def rank_of(c: str | Column, order: list[str], rest: int = 99) -> Column:
    """Where a value stands in a custom order."""
    return reduce(lambda out, x: out.when(col(c) == x[1], x[0]), list(enumerate(order))[1:], F.when(col(c) == order[0], 0)).otherwise(rest)


def label(*cs: str | Column, between: str = "/", rest: str = "-") -> Column:
    """What is filled, joined; rest if nothing is."""
    return F.coalesce(F.nullif(F.concat_ws(between, *[clean(c) for c in cs]), F.lit("")), F.lit(rest))


def listed(c: str | Column, separators: str = "[,;|]") -> Column:
    """A list in one text: split, trimmed, repeats by match key left out, first spelling kept."""
    items = F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), separators), lambda x: F.trim(x)), lambda x: x != "")
    return unique(items)


def unique(items: Column) -> Column:
    """An array without items whose match key an earlier one has."""
    return let(items, lambda own: let(F.transform(own, match_key), lambda keys: F.filter(own, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)))


def merged(*lists: Column) -> Column:
    return unique(F.concat(*lists))


def urls(c: str | Column) -> Column:
    found = F.regexp_extract_all(col(c), F.lit(r"(https?://[^\s\"'<>]+)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:)]+$", "")))


def prefixes(c: str | Column, separator: str = "/") -> Column:
    """All ancestors of a path, and the path."""
    parts = F.filter(F.split(col(c), separator), lambda x: x != "")
    return F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), separator))).otherwise(F.array())


def first_object(c: str | Column) -> Column:
    """The first balanced {...} of a text; null if none closes. Braces inside strings count like others."""
    pieces = F.split(F.coalesce(F.regexp_extract(col(c), r"(?s)(\{.*)", 1), F.lit("")), r"(?=[{}])")
    depth = lambda d, p: d + F.when(p.startswith("{"), 1).when(p.startswith("}"), -1).otherwise(0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done"))
    step = lambda s, p: F.when(s["done"] | (p == ""), s).otherwise(F.struct(depth(s["depth"], p).alias("depth"), (s["n"] + F.length(p)).alias("n"), (depth(s["depth"], p) == 0).alias("done")))
    found = F.aggregate(pieces, start, step)
    closing = F.regexp_extract(col(c), r"(?s)(\{.*)", 1)
    whole = F.substring(closing, F.lit(1), found["n"])
    return F.when(found["done"], F.regexp_extract(whole, r"(?s)^(.*\})", 1))


def json_in(c: str | Column, schema: str) -> Column:
    """The first balanced object in a text, parsed; null if there is none or it is broken."""
    return F.from_json(first_object(c), schema)


def dot(a: str | Column, b: str | Column) -> Column:
    product = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def cosine(a: str | Column, b: str | Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(1e-9))


def recency(weight: Column, quality: str | Column, year: str | Column, now: int) -> Column:
    """0.85 of the weight unless the quality is ok, and up to 8 % more for recent years."""
    return weight * F.when(col(quality) == "ok", 1.0).otherwise(0.85) * (1 + 0.08 * F.exp(-F.greatest(F.lit(now) - col(year), F.lit(0)) / 6.0))


def hamming(a: str | Column, b: str | Column) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


def content_hash(*cs: str) -> Column:
    """SHA-256 of a JSON with sorted keys; nulls are left out."""
    return F.sha2(F.to_json(F.struct(*sorted(cs))), 256)
