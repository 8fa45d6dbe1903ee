"""Text normalisation: columns where built-in functions reach, Arrow batches where not."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Greek letters in symbols, and characters that look like plain ones.
GREEK = {"α": "A", "β": "B", "γ": "G", "δ": "D", "ε": "E", "κ": "K", "λ": "L", "μ": "M", "σ": "S", "ω": "O"}
DASHES = "‐‑‒–—−"
# Names of preprint servers as journals carry them, and quotes that stand for none.
PREPRINT_SERVERS = ("arxiv", "biorxiv", "chemrxiv", "eartharxiv", "medrxiv", "osf preprints", "preprints", "psyarxiv", "research square", "socarxiv", "ssrn")
PLACEHOLDERS = ("n/a", "pending", "placeholder", "tbd")
# Misspelt symbols, whole and by how they begin, and what is meant.
MISSPELT = {"GPIBB": "GP1BB", "NROB1": "NR0B1", "PDCH15": "PCDH15", "PI3KR1": "PIK3R1", "SMARCAL": "SMARCAL1", "SR5A2": "SRD5A2", "SSPL2C": "SPPL2C", "VSP33B": "VPS33B", "WSF1": "WFS1"}
MISSPELT_BEGINNINGS = {"ERRC": "ERCC", "SERBIN": "SERPIN", "TBCID": "TBC1D", "ZYFVE": "ZFYVE"}


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_tags(c: Column) -> Column:
    """Tags become spaces; white space is squeezed."""
    return squeeze(F.regexp_replace(c, r"<[^>]+>", " "))


def is_placeholder(c: Column) -> Column:
    """Fewer than two letters or digits, or a word that stands in for a quote."""
    return (F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", "")) < 2) | F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")).isin(*PLACEHOLDERS)


def shorten(c: Column, most: int) -> Column:
    """At most ``most`` characters, then an ellipsis."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def code_point(n: Column) -> Column:
    """The character of a Unicode code point (``F.char`` takes it modulo 256); a surrogate is an error."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n), 8, "0"))), "UTF-32")


def normal_symbol(c: Column) -> Column:
    """A gene symbol in upper case, with plain dashes and Latin for Greek letters."""
    c = F.translate(c, DASHES + "".join(GREEK), "-" * len(DASHES) + "".join(GREEK.values()))
    return F.upper(F.replace(F.trim(c), F.lit("."), F.lit("-")))


def respelt(symbol: Column) -> Column:
    """What a normal symbol that is known to be misspelt means; others as they are."""
    out = symbol
    for wrong, right in MISSPELT_BEGINNINGS.items():
        out = F.when(symbol.startswith(wrong), F.concat(F.lit(right), F.substr(symbol, F.lit(len(wrong) + 1)))).otherwise(out)
    for wrong, right in MISSPELT.items():
        out = F.when(symbol == wrong, right).otherwise(out)
    return out


def chromosome(c: Column) -> Column:
    """The chromosome at the head of a location, MT for mitochondria, else null."""
    found = F.regexp_extract(c, r"^(\d+|X|Y)", 1)
    return F.when(F.lower(c).startswith("mitochond"), "MT").when(found != "", found)


def is_preprint(pmid: Column, journal: Column) -> Column:
    """No PubMed id, or a journal that names a preprint server."""
    low = F.lower(F.coalesce(journal, F.lit("")))
    named = F.lit(False)
    for s in PREPRINT_SERVERS:
        named = named | F.contains(low, F.lit(s))
    return pmid.isNull() | named


def percent_encode(c: Column) -> Column:
    """RFC 3986 with no character exempt but the unreserved."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def percent_encode_exact(text: str) -> str:
    return quote(text, safe="")


def strip_boolean_words(c: Column) -> Column:
    """A title without the search words AND, OR and NOT."""
    return squeeze(F.regexp_replace(c, r"(?i)\b(AND|OR|NOT)\b", " "))


# What a DOI looks like in text, and one with a preprint's version behind digits and dots.
DOI = r"10\.\d{4,9}/[^\s\"<>,]+"
VERSIONED = r"^(10\.\d{4,9}/[\d.]*\d)v\d+(?:\.[\w-]+)*$"


def clean_doi(found: Column) -> Column:
    """A DOI as matched, without query, marks and unbalanced brackets at its end, and preprint version."""
    count = lambda c, sign: F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))
    closes = lambda c, a, b: c.endswith(b) & (count(c, b) > count(c, a))
    spare = lambda c: c.rlike(r"[.;:'\"]$") | closes(c, "(", ")") | closes(c, "[", "]")
    bare = F.regexp_extract(found, r"^[^?#]*", 0)
    bare = F.aggregate(F.sequence(F.lit(1), F.length(bare) + 1), bare, lambda c, _: F.when(spare(c), F.left(c, F.length(c) - 1)).otherwise(c))
    version = F.regexp_extract(bare, VERSIONED, 1)
    return F.when(version != "", version).otherwise(bare)


def dois(text: Column) -> Column:
    """The DOIs of a text in order, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?i)" + DOI), F.lit(0)), clean_doi))


# Words that name the number after them as a PubMed id.
PUBMED_LABELS = ("pmid", "pmids", "pubmed")


def pmids(text: Column) -> Column:
    """Numbers of 5 to 8 digits without a leading 0 that stand behind no word, a PubMed label, or "pubmed id"; each once.

    DOIs, and the tokens they are part of, are passed over; a PubMed address counts as a labelled number.
    """
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)[^\s,]*pubmed\.ncbi\.nlm\.nih\.gov/(\d+)[^\s,]*", " PMID $1 ")
    text = F.regexp_replace(text, r"(?i)[^\s,]*" + DOI, " doi ")
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z]+|\d+"), F.lit(0))
    before = F.struct(F.lit("").alias("last"), F.lit("").alias("other"), F.array().cast("array<string>").alias("found"))

    def read(acc: Column, word: Column) -> Column:
        labelled = (acc["last"] == "") | acc["last"].isin(*PUBMED_LABELS) | ((acc["last"] == "id") & (acc["other"] == "pubmed"))
        found = F.when(labelled & word.rlike(r"^[1-9]\d{4,7}$"), F.concat(acc["found"], F.array(word))).otherwise(acc["found"])
        number, low = word.rlike(r"^\d"), F.lower(word)
        return F.struct(F.when(number, acc["last"]).otherwise(low).alias("last"), F.when(number, acc["other"]).otherwise(acc["last"]).alias("other"), found.alias("found"))

    return F.array_distinct(F.aggregate(words, before, read, lambda acc: acc["found"]))


def author_key(authors: str | None) -> str:
    """The first author's last name in the letters A to Z, words capitalised; "Unknown" without a name."""
    last = (authors or "").split(";")[0].split(",")[0].strip()
    plain = "".join(c for c in unicodedata.normalize("NFKD", last) if not unicodedata.combining(c))
    return "".join(re.sub("[^A-Za-z]", "", w).capitalize() for w in plain.split()) if last else "Unknown"


@F.pandas_udf(StringType())
def author_keys(authors: pd.Series) -> pd.Series:
    return authors.map(author_key)


def ascii_fold(text: str | None) -> str:
    """NFKD without what is not ASCII."""
    return unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()


@F.pandas_udf(StringType())
def ascii_folded(texts: pd.Series) -> pd.Series:
    return texts.map(ascii_fold)


def _folds() -> tuple[str, str]:
    """Characters whose compatibility decomposition leaves one ASCII character, and these."""
    pairs = [(chr(k), a) for k in range(128, 0x10000) if len(a := ascii_fold(chr(k))) == 1]
    return "".join(c for c, _ in pairs), "".join(a for _, a in pairs)


def folded(c: Column) -> Column:
    """Accented letters as plain ones, all else outside ASCII left out. ``ascii_fold`` for what
    decomposes to one character; ligatures, which decompose to several, are left out."""
    return F.regexp_replace(F.translate(c, *_folds()), r"[^\x00-\x7f]", "")


def replace_symbols(c: Column, renames: dict[str, str]) -> Column:
    """Whole symbols renamed, longest first; neighbours that are letters, digits or dashes bar a match."""
    for old in sorted(renames, key=lambda s: (-len(s), s)):
        c = F.regexp_replace(c, rf"(?U)(?<![\w-]){re.escape(old)}(?![\w-])", renames[old].replace("$", r"\$"))
    return c


def display_ids(mapping: dict[str, str]):
    """A column function that puts display ids for keys, in one pass, longest key first."""
    pattern = re.compile("|".join(map(re.escape, sorted(mapping, key=lambda s: (-len(s), s))))) if mapping else None

    @F.pandas_udf(StringType())
    def swap(texts: pd.Series) -> pd.Series:
        return texts if pattern is None else texts.map(lambda t: None if t is None else pattern.sub(lambda m: mapping[m[0]], t))

    return swap
