"""Personal data by patterns, and terms that give protected values away.

Built of DataFrame functions only. A protected entity is a value found by the
base patterns. A term (a word of letters) discloses it if the two co-occur in
the corpus's documents almost as tightly as the term occurs at all: pointwise
mutual information over the entity's information content, 1 when every document
with the term holds the entity. Terms over the upper threshold are removed
wherever they occur, those over the lower are generalised: cut to the longest
prefix that is common enough in the corpus to fall under it, and removed if
none is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialise

_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# The kinds of personal data and their patterns. Runs are possessive, and may begin
# only where a run begins or the last match ended, which changes no match and keeps the search linear.
# A card's digits are a longest chain of digits with single blanks or hyphens; chains of other lengths
# than 16 to 19 digits fail as a whole, so they are passed over here.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))" + _EMAIL,
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{4,}"
_SPAN = "struct<start:int,end:int,value:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once (what a lambda names is worked out for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(items: Column) -> Column:
    """(start, end, value) of (gap, value) in order, places counted from 0."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def add(acc: Column, item: Column) -> Column:
        start = (acc["at"] + F.length(item["gap"])).cast("int")
        end = (start + F.length(item["value"])).cast("int")
        one = F.struct(start.alias("start"), end.alias("end"), item["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    return F.aggregate(items, zero, add)


def match_spans(text: Column, pattern: Column | str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value) in code points.

    The text between matches (split) and the matches give every place by sums.
    An array that grows by one element is copied each time, so the sums are
    taken in blocks of about the square root of their number, then over blocks.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    zipped = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    found = F.filter(zipped, lambda x: x["value"].isNotNull())
    spans = f"array<{_SPAN}>"

    def blocks(items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(items))).cast("int")
        count = F.ceil(F.size(items) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda b: _placed(F.slice(items, b * width + 1, width)))

    def shifted(acc: Column, block: Column) -> Column:
        moved = F.transform(block["found"], lambda s: F.struct((s["start"] + acc["at"]).cast("int").alias("start"), (s["end"] + acc["at"]).cast("int").alias("end"), s["value"].alias("value")))
        return F.struct((acc["at"] + block["at"]).cast("int").alias("at"), F.concat(acc["found"], F.array(moved)).alias("found"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("found"))
    whole = lambda items: F.when(F.size(items) > 0, F.flatten(F.aggregate(blocks(items), zero, shifted)["found"])).otherwise(F.array().cast(spans))
    return let(found, whole)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda p: F.coalesce(F.when(p.rlike("^0*[0-9]{1,3}$"), F.regexp_extract(p, "^0*([0-9]{1,3})$", 1).try_cast("int")), F.lit(999)) <= 255
        return F.forall(F.split(value, r"\.", -1), small)
    if kind == "card":
        back = F.reverse(_digits(value))
        digit = lambda k: F.substr(back, k, F.lit(1)).cast("int")
        doubled = lambda k: F.when(k % 2 == 0, 2 * digit(k) - F.when(digit(k) > 4, 9).otherwise(0)).otherwise(digit(k))
        total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda s, k: (s + doubled(k)).cast("int"))
        return F.when(F.length(back).between(16, 19), total % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


# A character that every match of a kind holds, or a pattern.
_SIGNS = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def base_spans(text: Column, kind: str) -> Column:
    """A kind's spans; texts without the kind's sign are not searched."""
    found = F.filter(match_spans(text, PATTERNS[kind]), lambda s: _passes(kind, s["value"]))
    sign = F.contains(text, F.lit(_SIGNS[kind])) if _SIGNS[kind] else text.rlike(PATTERNS[kind])
    return F.when(sign, found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _labelled(kind: str) -> Column:
    """A kind's column of spans as (kind, start, end, value)."""
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): rows that repeat id and text have one key and count as one document."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def scan(docs: DataFrame) -> DataFrame:
    """(key, doc_id, spans) of every row: base spans (kind, start, end, value) by kind and place."""
    found = _keyed(docs).select("key", "doc_id", *(base_spans(F.col("text"), k).alias(k) for k in PATTERNS))
    return found.select("key", "doc_id", F.concat(*(_labelled(k) for k in PATTERNS)).alias("spans"))


def _terms(docs: DataFrame) -> DataFrame:
    """(key, term): the different terms of every document, addresses left out."""
    text = F.lower(F.regexp_replace("text", PATTERNS["email"], " "))
    return _keyed(docs).dropDuplicates(["key"]).select("key", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))).alias("term"))


def disclosures(terms: DataFrame, scanned: DataFrame, support: int = 3, generalise_at: float = 0.8) -> DataFrame:
    """(entity, term, n_both, n_entity, n_term, n_docs, disclosure) of the pairs at ``generalise_at`` or over.

    Documents are counted: with the entity, with the term, with both, and all.
    Pairs in fewer than ``support`` documents are no evidence. A term that too
    many documents have for the threshold, whatever it shares with the entity,
    is not paired: n_both is at most n_entity.
    """
    rows = scanned.dropDuplicates(["key"])
    held = rows.select("key", F.explode("spans").alias("s")).select("key", F.concat("s.kind", F.lit(":"), F.lower("s.value")).alias("entity")).distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(f"n_entity >= {support}")
    known = materialise(held.join(entities, "entity").withColumn("n_docs", F.lit(rows.count())), "entities")
    counts = terms.groupBy("term").agg(F.count("*").alias("n_term")).where(f"n_term >= {support}")
    near = terms.join(known.select("key").distinct(), "key", "left_semi").join(counts, "term").join(known, "key")
    content = F.log2(F.col("n_docs") / F.col("n_entity"))
    near = near.where((content > 0) & (F.log2(F.col("n_docs") / F.col("n_term")) >= generalise_at * content - 1e-9))
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"), F.first("n_docs").alias("n_docs"))
    mutual = F.log2(F.col("n_both") * F.col("n_docs") / (F.col("n_entity") * F.col("n_term")))
    return pairs.where(f"n_both >= {support}").withColumn("disclosure", mutual / content).where(f"disclosure >= {generalise_at}")


def actions(terms: DataFrame, risky: DataFrame, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """(term, action, general): what becomes of each disclosing term, by the entity it discloses most.

    ``general`` is the longest prefix under which the term's evidence, spread
    over all documents' different terms with that prefix, falls under
    ``generalise_at`` for every entity.
    """
    prefixes = risky.select("*", F.explode(F.sequence(F.lit(1), F.length("term") - 1)).alias("size")).withColumn("prefix", F.expr("left(term, size)"))
    wanted = prefixes.select("prefix").distinct()
    words = terms.groupBy("term").agg(F.count("*").alias("n"))
    common = words.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("term")), lambda k: F.substr("term", F.lit(1), k))).alias("prefix"))
    common = common.join(wanted, "prefix", "left_semi").groupBy("prefix").agg(F.sum("n").alias("n_prefix"))
    content = F.log2(F.col("n_docs") / F.col("n_entity"))
    left = F.log2(F.col("n_both") * F.col("n_docs") / (F.col("n_entity") * F.col("n_prefix"))) / content
    safe = prefixes.join(common, "prefix").withColumn("left", left).groupBy("term", "prefix").agg(F.max("left").alias("left")).where(f"left < {generalise_at}")
    general = safe.groupBy("term").agg(F.max_by("prefix", F.length("prefix")).alias("general"))
    worst = risky.groupBy("term").agg(F.max("disclosure").alias("worst")).join(general, "term", "left")
    removed = (F.col("worst") >= remove_at) | F.col("general").isNull()
    return worst.select("term", F.when(removed, "remove").otherwise("generalise").alias("action"), F.when(~removed, F.col("general")).alias("general"))


def find(docs: DataFrame, support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """(key, doc_id, spans, terms) of every row; terms are (start, end, action, general).

    Every occurrence of a disclosing term counts, in all texts, whether they
    hold the entity or not; those within addresses are part of the base spans.
    Entities and terms in fewer than ``support`` documents, and terms under four
    letters, give no evidence. Null text counts as empty and has no spans.
    Repeated rows stay, each with its own spans. An empty table gives no row;
    other columns are ignored.
    """
    scanned = materialise(scan(docs), "pii")
    terms = materialise(_terms(docs), "terms")
    risky = materialise(disclosures(terms, scanned, support, generalise_at), "risky")
    todo = materialise(actions(terms, risky, generalise_at, remove_at), "actions")
    in_rows = terms.join(todo, "term").groupBy("key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("term", F.struct("action", "general"))))).alias("todo"))
    rows = _keyed(docs).select("key", "text").dropDuplicates(["key"]).join(in_rows, "key")
    pattern = F.concat(F.lit(PATTERNS["email"] + r"|(?<!\p{L})(?iu:"), F.array_join(F.map_keys("todo"), "|"), F.lit(r")(?!\p{L})"))
    hits = F.filter(match_spans(F.col("text"), pattern), lambda s: ~F.contains(s["value"], F.lit("@")))
    other = F.struct(F.lit("remove").alias("action"), F.lit(None).cast("string").alias("general"))  # a letter whose lower case is not its own
    meant = lambda s: F.coalesce(F.element_at("todo", F.lower(s["value"])), other)
    spans = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), meant(s)["action"].alias("action"), meant(s)["general"].alias("general")))
    found = rows.select("key", spans.alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,action:string,general:string>>")
    return scanned.join(found, "key", "left").select("key", "doc_id", "spans", F.coalesce("terms", none).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text; a term's kind is what becomes of it."""
    named = lambda s, kind: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform("spans", lambda s: named(s, s["kind"]))
    of_action = lambda a: F.transform(F.filter("terms", lambda t: t["action"] == a), lambda t: named(t, t["action"]))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    count = [of_kind(k).alias(f"n_{k}") for k in PATTERNS]
    return found.select("doc_id", *count, F.size("terms").cast("long").alias("n_term"), F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"), F.concat_ws(",", base, of_action("generalise"), of_action("remove")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with spans (start, end, label), in order and apart, replaced by their labels."""

    def pieces(kept: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(kept, lambda s: s["end"]))
        starts = F.concat(F.transform(kept, lambda s: s["start"]), F.array(F.length(text)))
        labels = F.concat(F.transform(kept, lambda s: s["label"]), F.array(F.lit("")))
        plain = F.zip_with(ends, starts, lambda a, b: F.substr(text, a + 1, b - a))
        return F.array_join(F.zip_with(plain, labels, lambda a, b: F.concat(a, b)), "")

    return let(spans, pieces)


def sanitise(docs: DataFrame, **params) -> DataFrame:
    """(doc_id, text): base spans become ``[KIND]``, disclosing terms their prefix and ``*``, or nothing.

    Where base spans of two kinds overlap, the one that begins first stands.
    Every row of the input gives one row.
    """
    found = find(docs, **params)
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label")))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.coalesce(F.concat(t["general"], F.lit("*")), F.lit("")).alias("label")))
    row = "array<struct<start:int,end:int,label:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(row).alias("kept"))
    apart = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["kept"], F.array(s)).alias("kept"))).otherwise(acc)
    spans = F.aggregate(F.array_sort(F.concat(base, terms).cast(row)), zero, apart, lambda acc: acc["kept"])
    texts = _keyed(docs).select("key", "text").dropDuplicates(["key"])
    return found.select("key", "doc_id", spans.alias("spans")).join(texts, "key").select("doc_id", redact(F.col("text"), F.col("spans")).alias("text"))
