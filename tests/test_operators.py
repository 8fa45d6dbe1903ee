"""Text, rules, graphs, documents, sources: small literal cases."""

from __future__ import annotations

import gzip
import json

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium import registry
from scriptorium.functions import rules as R
from scriptorium.functions import text as T
from scriptorium.operators import documents as D
from scriptorium.operators import graph as G
from scriptorium.operators.resolve import resolve
from scriptorium.operators.search import search
from scriptorium.operators.select import stratified_split, tournament
from scriptorium.sources import bibliography as B
from scriptorium.sources import knowledge as N
from scriptorium.sources import sinks


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


def test_dois(spark):
    cases = {
        "10.1000/ab(1)c).": ["10.1000/ab(1)c"], "10.1101/2020.01.02.3v4": ["10.1101/2020.01.02.3"], "10.1000/x?y=1#z": ["10.1000/x"], "10.1000/x; 10.1000/X; 10.1000/x.": ["10.1000/x", "10.1000/X"],
        "10.5555/12.3v1.full.pdf": ["10.5555/12.3"], "10.5555/abv1": ["10.5555/abv1"], "(10.1000/a[1])": ["10.1000/a[1]"], "none": [], None: [], "": [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", T.dois(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


def test_pubmed_ids(spark):
    cases = {
        "12345678": ["12345678"], "PMID: 1234567": ["1234567"], "OMIM 123456": [], "PubMed ID 123456": ["123456"], "0123456": [], "1234": [], "10.1000/7654321": [], "https://pubmed.ncbi.nlm.nih.gov/7654321/": ["7654321"],
        "PMIDs: 12345678, 23456789": ["12345678", "23456789"], "Corpus ID: 245670502 or ID 12345": [], "see PubMed 12345 and 54321": ["12345"], "type 1, 130070": [], "12345, 12345": ["12345"], None: [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", T.pmids(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


@pytest.mark.parametrize("name, want", [("Müller, A; B", "Muller"), ("van der Berg, C", "VanDerBerg"), ("", "Unknown"), (None, "Unknown"), ("123", ""), ("Łukasz Żółć, A", "UkaszZoc"), (" ; B", "Unknown")])
def test_author_key(name, want):
    assert T.author_key(name) == want


def test_folding_and_respelling(spark):
    assert one(spark, T.folded(F.col("t")), t="Ångström naïve ② β-x Ⅴ") == T.ascii_fold("Ångström naïve ② β-x Ⅴ")
    for wrong, right in (("SERBINB7", "SERPINB7"), ("NROB1", "NR0B1"), ("SMARCAL", "SMARCAL1"), ("SMARCAL1", "SMARCAL1"), ("BRCA1", "BRCA1")):
        assert one(spark, T.respelt(F.col("t")), t=wrong) == right


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab /*~+%é?#", max_size=12))
def test_percent_encoding(spark, text):
    assert one(spark, T.percent_encode(F.col("t")), t=text) == T.percent_encode_exact(text)


def test_text_columns(spark):
    assert one(spark, T.strip_tags(F.col("t")), t="<p>a <b>b</b>\n c</p>") == "a b c"
    assert one(spark, T.chromosome(F.col("t")), t="Mitochondria") == "MT"
    assert one(spark, T.chromosome(F.col("t")), t="17q21") == "17"
    assert one(spark, T.chromosome(F.col("t")), t="unplaced") is None
    assert one(spark, T.normal_symbol(F.col("t")), t=" igα–1.2 ") == "IGA-1-2"
    assert one(spark, T.replace_symbols(F.col("t"), {"AB": "X", "AB1": "Y"}), t="AB AB1 AB-1 (AB)") == "X Y AB-1 (X)"
    assert all(one(spark, T.is_placeholder(F.col("t")), t=x) for x in (" TBD\n", "Pending", "n/a", "-x", ""))
    assert not any(one(spark, T.is_placeholder(F.col("t")), t=x) for x in ("NR", "none", "Not reported"))
    assert not one(spark, T.is_placeholder(F.col("t")), t="p.Arg1")
    assert one(spark, T.display_ids({"10.1/1": "A", "10.1/12": "B"})(F.col("t")), t="10.1/12,10.1/1") == "B,A"


def test_code_points(spark):
    points = [97, 255, 256, 402, 0x3042, 0xD7FF, 0xE000, 0xFEFF, 0x10FFFF]
    got = spark.createDataFrame([(n,) for n in points], "n int").select("n", T.code_point(F.col("n")).alias("x")).collect()
    assert {r["n"]: r["x"] for r in got} == {n: chr(n) for n in points}


def test_display_ids_of_many_papers(spark, tmp_path):  # 1,200 of one month: more than a byte can number
    papers = spark.range(0, 8400, 7).selectExpr("id o_orderkey", "1L o_custkey", "'F' o_orderstatus", "1D o_totalprice", "timestamp '1998-02-06 00:00:00' o_orderdate", "'5-LOW' o_orderpriority")
    papers.write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.QUERIES["w7_disambiguated_ids"](spark, str(tmp_path)).collect()
    dois = sorted(f"10.1/{k}" for k in range(0, 8400, 7))
    assert {r["doi"]: r["display"] for r in got} == {d: "5-LOW19982" + chr(97 + k) for k, d in enumerate(dois)}


def test_ambiguous_previous_symbol_ends_the_search(spark):
    name = lambda *rows: spark.createDataFrame(list(rows), "gene long, symbol string")
    asked = spark.createDataFrame([("CUR",), ("OLD",), ("TWO",), ("ALI",), ("NO",), ("ERRC2",), ("WSF1",)], "symbol string")
    got = resolve(asked, name((1, "CUR"), (7, "ERCC2"), (8, "WFS1")), name((2, "OLD"), (3, "TWO"), (4, "TWO")), name((5, "ALI"), (6, "TWO")))
    assert {r["symbol"]: r["gene"] for r in got.collect()} == {"CUR": 1, "OLD": 2, "TWO": None, "ALI": 5, "NO": None, "ERRC2": 7, "WSF1": 8}


def test_rules(spark):
    lit = lambda v: F.lit(v).cast("int") if v is None or type(v) is int else F.lit(v)
    rate = lambda *v: one(spark, R.association_rating(*map(F.lit, v[:5]), lit(v[5])))
    assert rate(True, False, False, True, True, None) == 3
    assert rate(True, False, False, True, False, 2) == 2
    assert rate(False, False, False, True, True, None) == 1
    mode = lambda *m: one(spark, R.mode_of_inheritance(F.array(*map(F.lit, m))))
    assert [mode("NR"), mode("NR", "Other"), mode("Other", "BIALLELIC"), mode("MONOALLELIC", "BIALLELIC"), mode("X-LINKED", "BIALLELIC")] == ["Unknown", "Other", "BIALLELIC", "BOTH", "Other"]
    assert one(spark, R.frequency_flag(F.lit("BIALLELIC"), F.lit(99), F.lit(15), F.lit(0))) is None
    assert one(spark, R.frequency_flag(F.lit("BIALLELIC"), F.lit(0), F.lit(16), F.lit(0))) == "hom"


def test_folds_within_documents(spark):
    items = F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(p).cast("long").alias("pages"), F.lit(p).cast("long").alias("bytes")) for k, p in enumerate([10, 25, 20, 15, 15, 5])))
    assert one(spark, D.greedy_budget(items, 20, 50)) == [0, 2, 3, 5]
    assert one(spark, D.greedy_batches(items, 2, 40)) == [0, 0, 1, 1, 2, 2]
    with pytest.raises(Exception, match="unknown k"):
        spark.createDataFrame([("z",)], "k string").select(D.through("k", {"a": "b"})).collect()


def test_graph(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "b")], "child string, parent string")
    up = G.ancestors(edges, spark.createDataFrame([("e",)], "root string"))
    assert {(r["node"], r["distance"]) for r in up.collect()} == {("e", 0), ("d", 1), ("b", 1), ("c", 2), ("a", 2)}
    eligible = spark.createDataFrame([("b",), ("d",), ("e",)], "node string")
    down = G.levels(edges, spark.createDataFrame([("a",)], "root string"), eligible)
    assert {(r["node"], r["level"]) for r in down.collect()} == {("b", 1), ("d", 2), ("e", 2)}
    assert {r["node"] for r in G.descendants(edges, spark.createDataFrame([("c",)], "root string")).collect()} == {"c", "d", "e"}


def test_deep_graph(spark, tmp_path):  # over checkpoints each step took twice the time of the one before
    spark.range(24).selectExpr("2 * cast(power(3, id) as long) p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.QUERIES["g1_descendants"](spark, str(tmp_path)).collect()
    assert sorted(r["node"] for r in got) == sorted([5, *(2 * 3**k for k in range(24))])


def test_search_tiers(spark):
    names = spark.createDataFrame([(1, "Rare disease", 0), (2, "rare-disease", 2), (3, "Rare muscle disease", 0), (4, "Other", 0)], "term long, name string, kind int")
    got = search(names, spark.createDataFrame([("rare disease",)], "query string")).orderBy("rank").collect()
    assert [(r["term"], r["tier"]) for r in got] == [(1, 0), (2, 2), (3, 3)]
    assert round(got[2]["precision"], 6) == round(2 / 3, 6)  # a share of tokens, not of weights


def test_search_words_registries_and_ties(spark):
    names = spark.createDataFrame([(1, "Zeta disease", 0), (2, "Alpha disease", 0), (3, "disease of the Naïve type", 0), (4, "x", 0)], "term long, name string, kind int")
    xrefs = spark.createDataFrame([("ORPHANET:12", 4), ("ORPHANET:12", 2), ("OMIM:12", 1)], "xref string, term long")
    asked = spark.createDataFrame([("disease",), ("naive DISEASE",), (" orpha:12",), ("OMIM: 12 ",), ("of the",)], "query string")
    got: dict = {}
    for r in search(names, asked, xrefs).orderBy("rank").collect():
        got.setdefault(r["query"], []).append((r["term"], r["tier"]))
    assert got == {"disease": [(2, 3), (3, 3), (1, 3)], "naive DISEASE": [(3, 3), (2, 3), (1, 3)], " orpha:12": [(2, 0), (4, 0)], "OMIM: 12 ": [(1, 0)]}


def test_tournament_goes_on_until_one_chunk(spark, tmp_path):
    """Four rounds (its SQL writes out three): 20 of every 100 in order of papers, until one chunk has been judged."""
    rows = spark.range(15_000).selectExpr("id l_partkey", "id % 2 * 7 l_suppkey", "(id * 7919) % 997 l_orderkey", "cast((id * 31) % 50 as double) l_quantity")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    want = set()
    for group in (0, 7):
        entries = [(k, (k * 31) % 50 * 1000 + (k * 7919) % 997) for k in range(15_000) if k % 2 * 7 == group]
        rounds, one = 0, False
        while not one:
            one, rounds = len(entries) <= 100, rounds + 1
            chunks = [entries[a : a + 100] for a in range(0, len(entries), 100)]
            entries = [e for c in chunks for e in sorted(sorted(c, key=lambda x: (-x[1], x[0]))[:20])]
        assert rounds == 4
        want |= {(group, k) for k, _ in entries}
    got = registry.QUERIES["g7_tournament"](spark, str(tmp_path)).collect()
    assert {(r["gene"], r["paper"]) for r in got} == want and len(got) == 40


def test_token_weights_of_all_words(spark, tmp_path):  # stop words, accents and null keys, as in the SQL
    rows = [(1, "Ring of the TYPE", "large"), (2, "ring-ring", "naïve İx K"), (3, "", None), (None, "lone ring", "large"), (3, "a", "large")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.QUERIES["a15_inverse_document_frequency"](spark, str(tmp_path)).collect()
    part = duckdb.connect()
    part.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    want = part.execute(registry.ORACLES["a15_inverse_document_frequency"]).fetchall()
    assert sorted((r["token"], r["df"], r["idf"]) for r in got) == sorted(want)


@pytest.mark.parametrize("n, cuts", [(10, (7, 9)), (30, (21, 26)), (100, (70, 89))])
def test_split_sizes(spark, n, cuts):
    rows = stratified_split(spark.range(n).withColumn("label", F.lit(1)), "id", "label").groupBy("split").count().collect()
    got = {r["split"]: r["count"] for r in rows}
    assert (got["train"], got["train"] + got["val"]) == cuts


def test_tournament(spark):
    rows = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").alias("i")).union(spark.range(3).select(F.lit("small"), F.col("id")))
    got = tournament(rows, "g", "i", 20, 100, 20, lambda df: F.col("i"), [F.asc("i")])
    by = {}
    for r in got.collect():
        by.setdefault(r["g"], []).append(r["i"])
    assert sorted(by["g"]) == list(range(980, 1000)) and sorted(by["small"]) == [0, 1, 2]


ARTICLE = """<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><Title>J</Title><ISSN>1234</ISSN></Journal>
<ArticleTitle>A <i> b </i>c &amp; d</ArticleTitle>{abstract}<AuthorList><Author><LastName>L</LastName><ForeName>F</ForeName></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList>
{language}<ArticleDate><Year>2024</Year><Month>02</Month><Day>{day}</Day></ArticleDate></Article></MedlineCitation>
<PubmedData><ArticleIdList>{doi}</ArticleIdList></PubmedData></PubmedArticle>"""


def test_article_sets(spark, tmp_path):
    def article(pmid, doi='<ArticleId IdType="doi">10.1/{}</ArticleId>', day="03", abstract="<Abstract><AbstractText>x</AbstractText></Abstract>", language="<Language>eng</Language>"):
        return ARTICLE.format(pmid=pmid, doi=doi.format(pmid), day=day, abstract=abstract, language=language)

    xml = "<PubmedArticleSet>\n" + "\n".join([article(1), article(2, doi=""), article(3, day="31"), article(4, abstract=""), article(5, language="<Language>fre</Language>"), article(6, language=""), article(7, doi="", day="31")]) + "\n</PubmedArticleSet>\n"
    with gzip.open(tmp_path / "pubmed24n0001.xml.gz", "wt") as f:
        f.write(xml)
    papers, skipped = B.read_article_sets(spark, str(tmp_path / "pubmed24n0001.xml.gz"))
    rows = {r["pmid"]: r for r in papers.collect()}
    assert set(rows) == {1, 6}
    assert rows[1]["title"].replace(" ", "") == "Abc&d" and rows[1]["authors"] == "L, F; Group" and str(rows[1]["source_date"]) == "2024-02-03"
    assert {r["reason"]: r["n"] for r in skipped.collect()} == {"no_doi": 2, "no_date": 1, "no_abstract": 1, "non_english": 1}
    assert B.read_article_sets(spark, str(tmp_path / "pubmed24n0001.xml.gz"), min_year=2025)[0].count() == 0


def test_versions_and_files(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 0, 4)], "doi string, version int, seq int")
    assert [tuple(r) for r in B.highest_versions(rows).collect()] == [("a", 2, 2)]
    listing = spark.createDataFrame([("<a>pubmed24n0002.xml.gz</a> pubmed24n0002.xml.gz.md5",), ("pubmed24n0001.xml.gz",)], "line string")
    assert [tuple(r) for r in B.update_files(listing).collect()] == [("pubmed24n0001.xml.gz", 2024, 1), ("pubmed24n0002.xml.gz", 2024, 2)]
    files = spark.createDataFrame([("/x/a.gz", bytearray(b"1")), ("/x/b.gz", bytearray(b"2"))], "path string, content binary")
    sums = spark.createDataFrame([("a.gz", "C4CA4238A0B923820DCC509A6F75849B"), ("b.gz", "0" * 32)], "name string, md5 string")
    assert [r["name"] for r in B.verified(files, sums).collect()] == ["a.gz"]


OBO = """format-version: 1.2

[Term]
id: M:1
name: root

[Term]
id: M:2
name: child
synonym: "kid \\"x\\"" EXACT [r]
xref: OMIM:1
is_a: M:1 ! root

[Term]
id: M:3
name: gone
is_a: M:1 ! root
is_obsolete: true
replaced_by: M:2

[Term]
id: M:4
name: barred
is_a: M:2 ! child

[Typedef]
id: part_of
"""


def test_ontology(spark, tmp_path):
    (tmp_path / "o.obo").write_text(OBO)
    terms = N.read_ontology(spark, str(tmp_path / "o.obo"))
    rows = {r["id"]: r for r in terms.collect()}
    assert set(rows) == {"M:1", "M:2", "M:3", "M:4"}
    assert rows["M:2"]["synonyms"][0]["scope"] == "EXACT" and rows["M:2"]["xrefs"] == ["OMIM:1"] and rows["M:3"]["replaced_by"] == "M:2"
    assert {r["id"] for r in N.eligible(terms, ["M:1"], ["M:4"]).collect()} == {"M:1", "M:2"}


def test_panels_and_genes(spark, tmp_path):
    gene = lambda n, level, evaluations: {"gene_data": {"hgnc_id": f"HGNC:{n}", "gene_symbol": f"G{n}"}, "confidence_level": level, "evaluations": evaluations}
    panels = {"7": {"id": 7, "name": "P", "child_panel_ids": [], "genes": [gene(1, "3", []), gene(2, "1", None)], "strs": [gene(1, "2", [{"rating": "GREEN"}])]}}
    (tmp_path / "p.json").write_text(json.dumps(panels))
    rows = N.entries(N.read_panels(spark, str(tmp_path / "p.json"))).collect()
    assert {(r["kind"], r["hgnc_id"], r["colour"], r["reviewed"]) for r in rows} == {("gene", 1, "GREEN", False), ("gene", 2, "RED", None), ("str", 1, "AMBER", True)}
    (tmp_path / "g.json").write_text(json.dumps({"response": {"docs": [{"hgnc_id": "HGNC:5", "symbol": "abc", "prev_symbol": ["old"], "alias_symbol": None}]}}))
    current, previous, alias = N.read_genes(spark, str(tmp_path / "g.json"))
    assert [tuple(r) for r in current.collect()] == [(5, "ABC")] and [tuple(r) for r in previous.collect()] == [(5, "OLD")] and not alias.collect()


def test_submissions_and_lists(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('gene\ttitle\n"1"\t"two\nlines ""q"""\n')
    assert N.read_submissions(spark, str(tmp_path / "s.tsv")).collect()[0]["title"] == 'two\nlines "q"'
    (tmp_path / "l.txt").write_text(" a \n\na\nb\n")
    assert sorted(r["value"] for r in N.line_list(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]


def test_sinks(spark, tmp_path):
    quotes = spark.createDataFrame([("d", "b", True, [1]), ("d", "a", True, [2]), ("d", "c", False, None), ("d", "a", False, None)], "doi string, quote string, own boolean, boxes array<int>")
    doc = json.loads(sinks.quote_documents(quotes, spark.createDataFrame([("d", "T")], "doi string, title string")).first()["document"])
    assert [(q["quote"], q["bboxes"]) for q in doc["quotes"]] == [("a", [2]), ("b", [1]), ("c", [])]
    path = sinks.write_snapshot(spark.range(2), str(tmp_path / "snap"), "2024-01-01")
    assert spark.read.json(path).count() == 2
    sinks.write_lines(spark.range(3), "id", str(tmp_path / "lines"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "lines")).orderBy("value").collect()] == ["0", "1", "2"]
