"""Personal data by patterns, and information-theoretic sanitisation of the terms that reveal it.

Patterns find the protected entities (e-mail and IP addresses, card and phone numbers). Corpus co-occurrence then
estimates how strongly a term t reveals an entity e: PMI(t; e) = log2(p(t, e) / (p(t) p(e))), as a share of all that
there is to know of e, its information content -log2 p(e). p(e) and p(t, e) count the distinct contexts (words
around a mention) of e and those with t, p(t) the documents with t. Terms whose share exceeds ``disclosure`` are
generalised to a tag wherever they stand, and removed from ``removal`` on. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# The contract's patterns. Runs are possessive, and start where a run starts or the match before ended: the same
# matches, in time linear in the text, without recursion.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to be searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = [*PATTERNS, "term"]
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
DISCLOSURE = 0.9
REMOVAL = 0.98
SUPPORT = 3  # distinct contexts of an entity that a term must stand in
REACH, WORDS = 120, 10  # characters and words on each side of a mention
TERM = r"\p{L}{3,}"
BESIDE = r"[\p{L}\p{M}\p{N}_]"


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the Luhn check."""
    padded = F.lpad(digits, 19, "0")

    def add(total: Column, k: Column) -> Column:
        value = F.ascii(padded.substr(k, F.lit(1))) - 48
        twice = value * 2 - F.when(value > 4, 9).otherwise(0)
        return total + F.when(k % 2 == 0, twice).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.translate(match, " ().+-", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int") <= 255, p.rlike("^0+$")))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def matches(kind: Column | str, text: Column, pattern: Column, own: Column, keep) -> Column:
    """array<struct<kind, start, end, value>> of ``own``, all matches of ``pattern`` in ``text``, that pass ``keep``."""
    gaps = F.split(text, pattern, -1)

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + F.length(m["gap"])
        end = start + F.length(m["match"])
        found = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), m["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(keep(m["match"]), F.concat(s["out"], F.array(found))).otherwise(s["out"]).alias("out"))

    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    folded = F.aggregate(F.arrays_zip(F.slice(gaps, 1, F.size(own)).alias("gap"), own.alias("match")),
                         F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(own) > 0, folded).otherwise(none)


def with_base(rows: DataFrame) -> DataFrame:
    """``rows`` (with text, not null) and the column base: the spans of the patterns, by kind as listed, then start.
    Places are code points, ends exclusive."""
    hits = rows.withColumns({f"hit_{kind}": F.when(
        F.contains("text", F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True),
        F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")) for kind, p in PATTERNS.items()})
    spans = [matches(kind, F.col("text"), F.lit(p), F.col(f"hit_{kind}"), lambda m, kind=kind: valid(kind, m)) for kind, p in PATTERNS.items()]
    return hits.withColumn("base", F.concat(*spans)).drop(*[f"hit_{kind}" for kind in PATTERNS])


def disclosing(rows: DataFrame, based: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(term, share): the terms that reveal an entity, with the largest share revealed. ``rows``: text; ``based``:
    text and base of the same rows."""
    mention = based.where(F.size("base") > 0).select("text", F.explode("base").alias("b"))
    left = F.col("text").substr(F.greatest(F.col("b.start") - REACH, F.lit(0)) + 1, F.least(F.col("b.start"), F.lit(REACH)))
    right = F.col("text").substr(F.col("b.end") + 1, F.lit(REACH))
    before, after = (F.regexp_extract_all(F.lower(side), F.lit(TERM), F.lit(0)) for side in (left, right))
    before = F.when(F.size(before) > WORDS, F.slice(before, -WORDS, WORDS)).otherwise(before)
    # A context that is copied counts once: copies are combined before any shuffle.
    contexts = written(mention.select(
        F.concat_ws(":", "b.kind", F.lower("b.value")).alias("entity"),
        F.concat(before, F.slice(after, 1, WORDS)).alias("words")).distinct(), "contexts")
    entities = contexts.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    pairs = contexts.select("entity", F.explode(F.array_distinct("words")).alias("term")).groupBy("entity", "term").agg(
        F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    pairs = written(pairs.join(entities, "entity"), "term_pairs")
    words = rows.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    total = rows.count()
    counts = words.groupBy("term").agg(F.count("*").alias("n_t"))
    n = F.lit(float(max(total, 1)))
    known = F.log2(n / F.col("n_e"))  # 0 for an entity of every document: there is nothing to reveal
    share = F.log2(F.col("n_te") * n / (F.col("n_t") * F.col("n_e"))) / known
    return (pairs.join(counts, "term").where(F.col("n_e") < n).withColumn("share", F.least(share, F.lit(1.0)))
            .where(F.col("share") >= disclosure).groupBy("term").agg(F.max("share").alias("share")))


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, removal: float = REMOVAL, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base and spans (array<struct<kind, start, end, value>>; spans adds
    those of kind ``term``), sanitised (the text with tags for what is protected, without what is removed).

    Null counts as the empty text, which has no spans. Null and repeated ids are passed through, each row judged by its own
    text; other columns are ignored. Of overlapping spans the one that starts first gives the tag for all. A term
    within a protected span is no span of its own. Spans are ordered by kind as listed, then start.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    terms = written(disclosing(rows.select("text"), with_base(rows.select("text")), disclosure, support), "disclosing_terms")
    # The documents' own disclosing terms, by a hash of the text (copies have the same).
    words = rows.select(F.xxhash64("text").alias("key"), "text").select("key", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    own = written(words.join(terms, "term").groupBy("key").agg(F.collect_set(F.struct("term", "share")).alias("terms")), "document_terms")
    based = with_base(rows.withColumn("key", F.xxhash64("text")).join(own, "key", "left").drop("key"))
    pattern = F.concat(F.lit(f"(?iu)(?<!{BESIDE})(?:"), F.array_join(F.transform("terms", lambda t: t["term"]), "|"), F.lit(f")(?!{BESIDE})"))
    based = based.withColumn("pattern", pattern).withColumn("hit_term", F.when(
        F.col("terms").isNotNull(), F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.array().cast("array<string>")))
    found = matches("term", F.col("text"), F.coalesce("pattern", F.lit("$^")), F.col("hit_term"), lambda m: F.lit(True))
    clear = F.filter(found, lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    based = based.withColumn("spans", F.concat("base", F.when(F.size("hit_term") > 0, clear).otherwise(
        F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>"))))
    tags = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])
    gone = F.filter("terms", lambda t: t["share"] >= removal)

    def put(s: Column, b: Column) -> Column:
        tag = F.when((b["kind"] == "term") & F.exists(gone, lambda t: t["term"] == F.lower(b["value"])), F.lit("")).otherwise(F.element_at(tags, b["kind"]))
        new = F.concat(s["out"], F.col("text").substr(s["at"] + 1, b["start"] - s["at"]), tag)
        return F.struct(F.greatest(s["at"], b["end"]).alias("at"), F.when(b["start"] >= s["at"], new).otherwise(s["out"]).alias("out"))

    by_start = F.array_sort(F.transform("spans", lambda b: F.struct(b["start"], b["end"], b["kind"], b["value"])))
    rest = lambda s: F.concat(s["out"], F.col("text").substr(s["at"] + 1, F.length("text")))
    clean = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put, rest)
    return based.select("doc_id", "base", "spans", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")).alias("sanitised"))


def spelled(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def brute_force(text: str | None) -> list[tuple[str, int, int]]:
    """The contract's base spans of one text, said plainly; for tests."""
    import re
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind: str, match: str) -> bool:
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            own = [int(d) for d in digits[::-1]]
            return 13 <= len(own) <= 19 and sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(own)) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(kind, m.start(), m.end()) for kind, p in plain.items() for m in re.finditer(p, text or "") if passes(kind, m.group())]
