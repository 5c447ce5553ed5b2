"""What a text names or is made of, as Column functions: references, numbers, dates, labelled blocks, parties, headlines, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.functions.text import clean, col, fold, let, match_key, squeeze, truncated

# Kinds of norms, classes of decisions, honorifics, bullets, noise.
NORM = r"(Lei Complementar|Lei|Decreto-Lei|Decreto|Resolução|Emenda Constitucional|Constituição Federal|Constituição|CF|Código Eleitoral|Código Civil|CPC)"
LEGAL_REFERENCE = r"(?:[Aa]rts?\.?|[Aa]rtigos?)\s*([0-9]+[0-9.]*)[ºo°]?(-[A-Z]\b)?(?:,\s*§+\s*([0-9]+)[ºo°]?)?,?\s*(?:d[aoe]s?\s+)?" + NORM + r"(?:\s*n?[.º°]*\s*([0-9]+[0-9.]*)(?:(?:/|,?\s+de\s+)([0-9]{2,4}))?)?"
DECISION = r"\b(AgR-REspe|AgR-AI|ADI|ADC|ADPF|ARE|REspe|REsp|RMS|RHC|HC|MS|Rcl|RO|RE|Súmula)\s*(?:n?[.º°]*)\s*([0-9]+[0-9.]*)"
HONORIFICS = r"(?iu)^(?:(?:(?:o|a)\s+)?(?:exm[oa]\.?|min(?:istr[oa])?\.?|des(?:embargador[a]?)?\.?|dr[a]?\.?|ju[íi]z[a]?|relator[a]?|prof(?:essor[a]?)?\.?|sr[a]?\.?)\s*:?\s+)+"
REGISTRATION = r"(?iu)[\s,;(–-]*(?:OAB|CPF|CNPJ|RG)\b.*$"
NOISE_LINE = r"(?iu)^\s*(?:p[áa]gina\s+[0-9]+.*|[0-9\s./-]+|[-–—_=*.\s]*|conclusos.*|juntada.*|publicado em.*|vistos\.?)\s*$"
DEVICE = r"(?iu)^\s*(artigo|art\.?|par[áa]grafo|§|inciso|al[íi]nea)\s*([0-9]+|[úuÚU]nico|[IVXLCDM]+|[a-z])\s*[ºo°]?\s*(?:-\s*([a-z])\b)?"
ROMAN = (("M", 1000), ("D", 500), ("C", 100), ("L", 50), ("X", 10), ("V", 5), ("I", 1))
DATE = r"\b[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4}\b|\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"


def groups_of(c: Column, pattern: str, n: int) -> Column:
    """Each match of a pattern as an array of its groups 1 to n; groups that don't take part are ''."""
    found = [F.regexp_extract_all(c, F.lit(pattern), F.lit(k)) for k in range(1, n + 1)]
    return F.transform(F.arrays_zip(*found), lambda m: F.array(*[m[str(k)] for k in range(n)]))


def _lead(sign: str, c: Column) -> Column:
    return F.when(c == "", "").otherwise(F.concat(F.lit(sign), c))


def legal_references(*texts: str | Column) -> Column:
    """'art. 5º, § 2º, Lei nº 9.504/1997' and the like in one form each, in the order they are named, none twice."""

    def one(g: Column) -> Column:
        article, suffix, paragraph, norm, number, year = (F.get(g, F.lit(k)) for k in range(6))
        ordinal = F.when(F.length(article) == 1, F.concat(article, F.lit("º"))).otherwise(article)
        digits = F.regexp_replace(number, "[^0-9]", "")
        plain = F.when(digits == "", "").otherwise(V.thousands(digits))
        return F.concat(F.lit("art. "), ordinal, suffix, _lead(", § ", F.when((paragraph != "") & (F.length(paragraph) == 1), F.concat(paragraph, F.lit("º"))).otherwise(paragraph)), F.lit(", "), norm, _lead(" nº ", plain), _lead("/", F.when(plain == "", "").otherwise(year)))

    found = [F.transform(groups_of(F.coalesce(col(t), F.lit("")), LEGAL_REFERENCE, 6), one) for t in texts]
    return F.array_distinct(F.concat(*found))


def decisions(c: str | Column) -> Column:
    """Classes of decisions and their numbers without dots, in order, none twice."""
    return F.array_distinct(F.transform(groups_of(F.coalesce(col(c), F.lit("")), DECISION, 2), lambda g: F.concat_ws(" ", F.get(g, F.lit(0)), F.regexp_replace(F.get(g, F.lit(1)), "[.]", ""))))


def fuzzy_case_numbers(c: str | Column) -> Column:
    """Runs of twenty digits with whatever spaces, dots and dashes between, in the usual form; other runs are none."""
    runs = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"([0-9](?:[ .–/-]{0,3}[0-9])+)"), F.lit(1))
    found = F.filter(F.transform(runs, lambda r: F.regexp_replace(r, "[^0-9]", "")), lambda d: F.length(d) == 20)
    return F.array_distinct(F.transform(found, V.case_number))


def roman(c: str | Column) -> Column:
    """The number a Roman numeral stands for; null for anything else."""
    v = F.upper(F.trim(col(c)))
    value = lambda x: reduce(lambda out, r: out.when(x == r[0], r[1]), ROMAN[1:], F.when(x == ROMAN[0][0], ROMAN[0][1])).otherwise(0)
    digits = F.transform(F.split(v, ""), value)
    signed = F.transform(digits, lambda d, i: F.when(d < F.coalesce(F.get(digits, i + 1), F.lit(0)), -d).otherwise(d))
    return F.when(v.rlike("^M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})$") & (v != ""), F.aggregate(signed, F.lit(0), lambda s, x: s + x))


def device_label(c: str | Column) -> Column:
    """'ARTIGO 5o - a', 'Art. V' and the like as 'Art. 5º-A', 'Art. 5º': one spelling of each provision's label; null if there is none."""
    part = lambda k: F.regexp_extract(col(c), DEVICE, k)
    kind, number, suffix = F.lower(fold(part(1))), part(2), F.upper(part(3))
    name = F.when(kind.startswith("art"), "Art.").when(kind.isin("paragrafo", "§"), F.when(F.lower(fold(number)) == "unico", "Parágrafo").otherwise("§")).when(kind == "inciso", "Inciso").otherwise("Alínea")
    plain = F.when(number.rlike("^[IVXLCDMivxlcdm]+$") & name.isin("Art.", "§"), roman(number).cast("string")).otherwise(number)
    shown = F.when(name.isin("Art.", "§") & plain.rlike("^[1-9]$"), F.concat(plain, F.lit("º"))).when(F.lower(fold(plain)) == "unico", "único").when(name == "Alínea", F.lower(plain)).when(name == "Inciso", F.upper(plain)).otherwise(plain)
    return F.when(part(1) != "", F.concat(name, F.lit(" "), shown, _lead("-", suffix)))


def dates_rewritten(c: str | Column, day_first: bool = True) -> Column:
    """The text with every date in it as M/D/YYYY; what isn't a date stays."""
    marked = F.regexp_replace(F.regexp_replace(col(c), "\x01", ""), f"({DATE})", "\x01$1\x01")
    return F.array_join(F.transform(F.split(marked, "\x01"), lambda p, i: F.when(i % 2 == 1, V.month_first(p, day_first)).otherwise(p)), "")


def spans(c: str | Column, strict: str, fuzzy: str) -> Column:
    """(kind, text) of the matches of a strict pattern, and of a fuzzy one in what lies between them, in order; so no two overlap. Patterns without groups."""
    marked = F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[\x01\x02]", ""), f"({strict})", "\x01\x02$1\x01")

    def one(p: Column) -> Column:
        loose = F.transform(F.regexp_extract_all(p, F.lit(f"({fuzzy})"), F.lit(1)), lambda x: F.struct(F.lit("fuzzy").alias("kind"), x.alias("text")))
        return F.when(p.startswith("\x02"), F.array(F.struct(F.lit("strict").alias("kind"), F.substring(p, F.lit(2), F.length(p)).alias("text")))).otherwise(loose)

    return F.flatten(F.transform(F.split(marked, "\x01"), one))


def bare_name(c: str | Column) -> Column:
    """A person's name without honorifics before and registrations behind."""
    return clean(F.regexp_replace(F.regexp_replace(squeeze(c), HONORIFICS, ""), REGISTRATION, ""))


def bullets(c: str | Column, n: int = 3, rest: str = "-") -> Column:
    """Exactly n items from the lines (or sentences, where there is one line) of a text, without their marks."""
    v = F.coalesce(col(c), F.lit(""))
    parts = F.when(v.contains("\n"), F.split(v, "\n")).otherwise(F.split(v, r"(?<=[.;!?])\s+"))
    items = F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:[-*•–]|[0-9]+[.)])\s*", ""))), lambda x: x != "")
    return F.slice(F.concat(items, F.array_repeat(F.lit(rest), n)), 1, n)


def limited(items: Column, most: int, drop: list[str] = (), forced: dict[str, str] | None = None) -> Column:
    """At most so many items, none twice, without those to drop; an item of forced brings its pair in behind it."""
    kept = V.unique(F.filter(items, lambda x: ~match_key(x).isin(*drop) if drop else F.lit(True)))
    pair = lambda x: reduce(lambda out, kv: F.when(match_key(x) == kv[0], F.array(x, F.lit(kv[1]))).otherwise(out), (forced or {}).items(), F.array(x))
    return F.slice(V.unique(F.flatten(F.transform(kept, pair))), 1, most)


def label_blocks(c: str | Column, labels: list[str]) -> Column:
    """(label, text) of each block between labels like 'Relator:'; text before the first label is left out, empty blocks too."""
    marked = F.regexp_replace(F.regexp_replace(col(c), "[\x01\x02]", ""), "(?iu)\\b(" + "|".join(labels) + r")\s*:\s*", "\x01$1\x02")
    blocks = F.transform(F.filter(F.split(marked, "\x01"), lambda b: b.contains("\x02")), lambda b: F.struct(F.lower(F.substring_index(b, "\x02", 1)).alias("label"), F.trim(F.substring_index(b, "\x02", -1), F.lit(" \n\t;,")).alias("text")))
    return F.filter(blocks, lambda b: b["text"] != "")


def sections(c: str | Column, heading: str) -> Column:
    """(title, text) of each section that a line matching heading begins; what stands before the first has the title ''."""
    marked = F.regexp_replace(F.regexp_replace(col(c), "[\x01\x02]", ""), f"(?m)^({heading})$", "\x01$1\x02")
    parts = F.transform(F.split(marked, "\x01"), lambda b, i: F.struct(F.when(b.contains("\x02"), F.trim(F.substring_index(b, "\x02", 1))).otherwise("").alias("title"), F.trim(F.substring_index(b, "\x02", -1), F.lit(" \n")).alias("text")))
    return F.filter(parts, lambda p: (p["title"] != "") | (p["text"] != ""))


def parties(entries: Column, known: list[str], region: str | Column) -> Column:
    """Parties of entries like 'Partido X (ABC)': the acronym in parentheses, else a known one among the words, else the first letters; with '/region' where the entry names a regional organ."""

    def one(e: Column) -> Column:
        words = F.split(F.upper(e), r"[^\p{L}]+")
        acronym = F.nullif(F.regexp_extract(e, r"\(([A-ZÀ-Ü]{2,})[^)]*\)", 1), F.lit(""))
        token = F.get(F.filter(words, lambda w: w.isin(*known)), F.lit(0))
        prefix = F.get(F.filter(F.array(*[F.lit(k) for k in known]), lambda k: F.exists(words, lambda w: (F.length(w) >= 4) & k.startswith(w))), F.lit(0))
        found = F.coalesce(acronym, token, prefix)
        return F.when(found.isNotNull(), F.concat(found, F.when(fold(F.lower(e)).rlike("diretorio (?:regional|estadual)|comissao provisoria"), F.concat(F.lit("/"), col(region))).otherwise("")))

    return F.array_distinct(F.filter(F.transform(entries, one), lambda x: x.isNotNull()))


def composition(*texts: str | Column) -> Column:
    """Names listed behind 'Composição:' or 'Presentes:'; of several texts, the list with most names counts (the first of equals), and names of the others that it lacks are put behind."""
    def names(t: str | Column) -> Column:
        listed = F.regexp_extract(F.coalesce(col(t), F.lit("")), r"(?iu)(?:composição|presentes)\s*:\s*((?:\b(?:Min|Des|Dra?|Sra?|Exm[oa]|Prof)\.|[^.\n])*)", 1)
        return F.filter(F.transform(F.split(listed, r"\s*(?:,|;|\be\b)\s*"), lambda x: F.coalesce(bare_name(x), F.lit(""))), lambda x: x.rlike(r"\p{Lu}"))

    one = lambda t, k: let(names(t), lambda own: F.struct((-F.size(own)).alias("score"), F.lit(k).alias("nth"), own.alias("names")))
    lists = F.array_sort(F.array(*[one(t, k) for k, t in enumerate(texts)]))
    return V.unique(F.flatten(F.transform(lists, lambda x: x["names"])))


def whole_entities(items: Column) -> Column:
    """Entities without fragments: one whose words all stand, in a row, in a longer one goes; so do repeats."""
    kept = V.unique(F.filter(F.transform(items, squeeze), lambda x: x != ""))
    key = lambda x: F.concat(F.lit(" "), F.regexp_replace(match_key(x), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    told = lambda k: F.struct(k.alias("key"), F.length(k).alias("n"), F.regexp_replace(k, "^ +| +$", " ").alias("words"))

    def whole(own: Column, keys: Column) -> Column:
        part = lambda k: F.exists(keys, lambda y: (y["n"] > k["n"]) & y["key"].contains(k["words"]))
        return F.filter(own, lambda x, i: ~let(F.get(keys, i), part))

    return let(kept, lambda own: let(F.transform(own, lambda x: let(key(x), told)), lambda keys: whole(own, keys)))


def packed_clauses(c: str | Column, most: int) -> Column:
    """Heads of a text: its first clause, its first two, and so on, as long as they fit."""
    clauses = F.filter(F.transform(F.split(squeeze(c), r"(?<=[,;:.])\s+"), lambda x: F.trim(x)), lambda x: x != "")
    heads = let(clauses, lambda own: F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.size(own), F.lit(12)), F.lit(1))), lambda k: F.regexp_replace(F.array_join(F.slice(own, 1, k), " "), r"[,;:.\s]+$", "")))
    return F.filter(heads, lambda h: (F.length(h) <= most) & (F.length(h) > 0))


def heading_score(h: Column, most: int) -> Column:
    """2 for a length from half of the limit on, 1 for a verb-like end in the middle, 1 for a capital or number at the beginning; 2 less where it breaks off."""
    ok = lambda c, n: F.when(c, n).otherwise(0)
    return ok(F.length(h) * 2 >= most, 2) + ok(h.rlike(r"\b\p{L}+(?:ou|eu|iu|ed|ar|er|ir|es)\b"), 1) + ok(h.rlike(r"^[\p{Lu}0-9]"), 1) - ok(F.lower(h).rlike(r"\b(?:de|da|do|the|of|and|e|a|o)$"), 2)


def best_heading(c: str | Column, most: int) -> Column:
    """The head with the best score, the longest of equals; a truncated beginning where none fits."""
    scored = F.transform(packed_clauses(c, most), lambda h: F.struct(heading_score(h, most).alias("score"), F.length(h).alias("n"), h.alias("h")))
    return F.coalesce(F.array_max(scored)["h"], truncated(c, most))


def local_title(c: str | Column, most: int, least: int = 20) -> Column:
    """The first informative line or sentence, trimmed: long enough and no noise."""
    units = F.transform(F.split(F.coalesce(col(c), F.lit("")), r"\n+|(?<=[.!?])\s+"), squeeze)
    unit = F.get(F.filter(units, lambda u: (F.length(u) >= least) & ~u.rlike(NOISE_LINE)), F.lit(0))
    return let(F.regexp_replace(unit, r"[.;:,]+$", ""), lambda u: truncated(u, most))


def lookup_terms(parts: list[str | Column], budget: int) -> Column:
    """What is filled of the parts, in order and none twice, as long as all together stay within so many characters."""
    terms = V.unique(F.array_compact(F.array(*[clean(p) for p in parts])))
    upto = lambda own, i: F.aggregate(F.slice(own, 1, i + 1), F.lit(0), lambda s, x: s + F.length(x) + 1)
    return let(terms, lambda own: F.filter(own, lambda t, i: upto(own, i) <= budget))


def weighted(*features: tuple[Column, float]) -> Column:
    """The weights of the features that hold, added up; null holds not."""
    return reduce(lambda a, b: a + b, [F.when(F.coalesce(c, F.lit(False)), F.lit(w)).otherwise(F.lit(type(w)(0))) for c, w in features])


def is_noise(c: str | Column, least: int = 0) -> Column:
    """Lines that say nothing: page marks, figures, rules, housekeeping, or fewer than so many characters."""
    v = F.coalesce(col(c), F.lit(""))
    return v.rlike(NOISE_LINE) | (F.length(F.trim(v)) < least)


def renamed(folder: str | Column, name: str | Column, rules: list[tuple[str, list[tuple[str, str]]]]) -> Column:
    """A file's name by the rules of the first folder (a prefix) that holds it; each rule is (pattern, replacement)."""
    out = col(name)
    for prefix, own in reversed(rules):
        out = F.when(col(folder).startswith(prefix), F.trim(reduce(lambda v, r: F.regexp_replace(v, *r), own, col(name)))).otherwise(out)
    return out


def shortened(folder: str | Column, name: str | Column, most: int = 259, suffix: str | Column = "") -> Column:
    """A path of at most so many characters: the stem is cut, its trailing case number and the extension stay. A suffix that isn't empty stands after the cut stem."""
    mark = F.lit(suffix) if isinstance(suffix, str) else suffix
    parts = lambda end: let(F.substring(col(name), F.lit(1), F.length(col(name)) - F.length(end)), lambda stem: let(F.regexp_extract(stem, r"([ _-]*[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4})$", 1), lambda number: fitted(stem, number, end)))

    def fitted(stem: Column, number: Column, end: Column) -> Column:
        head = F.substring(stem, F.lit(1), F.length(stem) - F.length(number))
        room = F.lit(most) - F.length(col(folder)) - 1 - F.length(number) - F.length(end) - F.length(mark)
        return F.concat(col(folder), F.lit("/"), F.rtrim(F.substring(head, F.lit(1), F.greatest(room, F.lit(1)))), mark, number, end)

    whole = F.concat(col(folder), F.lit("/"), col(name))
    return F.when((F.length(whole) <= most) & (mark == ""), whole).otherwise(let(F.regexp_extract(col(name), r"(\.[A-Za-z0-9]{1,5})$", 1), parts))
