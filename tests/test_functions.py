"""Column functions and guards on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from strandloom.functions import guards, scalars


def of(spark, values, kind, *columns):
    """The value of each column for each input value."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *[c(F.col("x")) for c in columns]).orderBy("i").collect()]


def test_numbers(spark):
    assert of(spark, ["12.0", "12.6", "1e3", "-", "x", "", None], "string", lambda c: scalars.number(c, "int")) == [12, 13, 1000, None, None, None, None]
    assert of(spark, [" a ", "nan", "NaN", "", "\t", None], "string", scalars.blank_to_null) == ["a", None, None, None, None, None]
    assert of(spark, [1.5, math.nan, math.inf, -math.inf, None], "double", scalars.finite) == [1.5, None, None, None, None]
    assert of(spark, [" Private", "phagescope", "nan", "", None], "string", scalars.source_type, scalars.source_label) == [("private", "private"), ("public", "phagescope"), ("public", "public"), ("public", "public"), ("public", "public")]


def test_composition(spark):
    assert of(spark, ["GGCC", "aAtT", "GSN", "", None], "string", scalars.gc_percent, lambda c: scalars.gc_percent(c, "remove")) == [(100.0, 100.0), (0.0, 0.0), (33.33, 100.0), (0.0, 0.0), (None, None)]
    parts = lambda name: lambda c: scalars.composition(c)[name]
    assert of(spark, ["AACGTN", "", None], "string", *[parts(n) for n in ("a_count", "gc_pct", "at_pct", "purine_pct", "pyrimidine_pct")]) == [(2, 33.33, 50.0, 50.0, 33.33), (0, None, None, None, None), (None,) * 5]
    assert of(spark, [9_999, 10_000, 99_999, 100_000], "int", scalars.size_class) == ["Small (<10kb)", "Medium (10-100kb)", "Medium (10-100kb)", "Large (>100kb)"]
    assert of(spark, [10_000, 10_001, 50_001, 200_001], "int", scalars.size_category) == ["small", "medium", "large", "jumbo"]


def test_headers(spark):
    assert of(spark, ["P1 x y", " P2", "", None], "string", scalars.first_token) == ["P1", "P2", "", None]
    ids = lambda rule: lambda c: scalars.header_ids(c)[rule]
    assert of(spark, ["gb|P1|rest x", "P2 y"], "string", *[ids(r) for r in ("first_word", "before_pipe", "after_pipe", "middle_pipe", "full")]) == [("gb|P1|rest", "gb", "rest x", "P1", "gb|P1|rest x"), ("P2", "P2 y", "P2 y", None, "P2 y")]
    part = lambda k: lambda c: scalars.protein_header(c)[k]
    assert of(spark, ["P1 P1_1 tail fiber", "P1"], "string", *[part(k) for k in ("phage_id", "protein_id", "description")]) == [("P1", "P1_1", "tail fiber"), ("P1", None, "")]
    assert of(spark, ["/x/DB_phages.tsv", "a_b_c", "none.tsv"], "string", scalars.source_from_path) == ["DB", "a", "none.tsv"]


HOSTS = {
    "NA;GCA 900066335.1;UBA9502;Blautia obeum": [("GCA_900066335.1", "assembly_accession", 2), ("UBA9502", "other", 3), ("Blautia obeum", "species_name", 4)],
    "Bacteroides dorei;Bacteroides vulgatus": [("Bacteroides dorei", "species_name", 1), ("Bacteroides vulgatus", "species_name", 2)],
    "NA;Escherichia coli": [("Escherichia coli", "species_name", 2)],
    **dict.fromkeys(("-", "", "NA", "unknown host", "unidentified bacterium", None), []),
}


def test_host_tokens(spark):
    assert [[tuple(t) for t in found] for found in of(spark, list(HOSTS), "string", scalars.host_tokens)] == list(HOSTS.values())


def test_identifiers(spark):
    values = ["GCF_000005845.2", "GCA_000001405.29", "SAMN02604091", "PRJNA224116", "562", "Escherichia coli", "Staphylococcus", "x1", " "]
    assert of(spark, values, "string", scalars.identifier_type) == ["assembly_accession"] * 2 + ["biosample", "bioproject", "taxid", "species_name", "species_name", "unknown", None]
    found = of(spark, ["Escherichia coli;SAMN02604091;GCF_000005845.2", "x;y1", None], "string", scalars.prioritized_identifiers)
    assert [[(p["token"], p["priority"]) for p in f] for f in found] == [[("GCF_000005845.2", 1), ("SAMN02604091", 2), ("Escherichia coli", 5)], [], []]
    assert of(spark, ["Escherichia coli;GCA_000001405.29", "x;Bacillus", "-"], "string", scalars.best_identifier) == ["GCA_000001405.29", "Bacillus", None]


def test_species(spark):
    hosts = ["Escherichia coli K12 substr;x", "Bacillus", "unknown", "Vibrio sp. strain 7B", None]
    assert of(spark, hosts, "string", scalars.species_name, scalars.strain_name) == [("Escherichia coli", "K12 substr"), ("Bacillus", None), (None, None), ("Vibrio sp.", "7B"), (None, None)]
    assert of(spark, [" Escherichia  coli K12", "escherichia coli", "Vibrio", ""], "string", scalars.normalized_species) == ["Escherichia coli", "", "", ""]
    assert [tuple(x) for x in of(spark, ["Escherichia coli", "", "coli x", None], "string", scalars.species_check)] == [(True, None), (False, "empty"), (False, "genus not capitalized"), (False, "empty")]


def test_assemblies(spark):
    data = spark.createDataFrame([("reference genome", "Complete Genome", True), ("na", "Contig", None), (None, None, False)], "c string, l string, t boolean")
    scores = [tuple(r) for r in data.select(scalars.assembly_score(F.col("c"), F.col("l"), F.col("t")), scalars.legacy_assembly_score(F.col("c"), F.col("l"))).collect()]
    assert scores[0][0] > scores[1][0] >= scores[2][0] == 0 and scores[0][1] > scores[1][1] >= scores[2][1]
    assert of(spark, ["GCF_1.2", "GCA_1.2"], "string", scalars.is_refseq, scalars.link_quality, scalars.host_id) == [(True, "direct", "GCF_1_2"), (False, "genbank", "GCA_1_2")]
    assert of(spark, [1, 2, 99], "int", lambda c: scalars.confidence(F.lit(0.9), c))[0] == 0.9 and of(spark, [99], "int", lambda c: scalars.confidence(F.lit(0.9), c)) == [0.0]


def test_dates_and_fingerprints(spark):
    assert of(spark, ["2026-01-02 03:04:05"], "string", lambda c: scalars.utc_seconds(c.cast("timestamp"))) == ["2026-01-02T03:04:05Z"]
    data = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>")
    found = [r[0] for r in data.select(scalars.column_fingerprint(F.col("x"))).collect()]
    assert len(found[0]) == 16 and found[1] == ""


@pytest.mark.parametrize("sql", ["SELECT 1", " with x as (select 1) select * from x ; ", "SHOW TABLES", "SELECT ';' AS a"])
def test_reading_queries(sql):
    assert guards.check_query(sql)


@pytest.mark.parametrize("sql", ["DROP TABLE x", "", "SELECT 1; DROP TABLE x", "INSERT INTO x SELECT 1", "selection"])
def test_other_queries(sql):
    with pytest.raises(ValueError, match="reading|one statement"):
        guards.check_query(sql)


@pytest.mark.parametrize("fragment", ["a = 1; x", "a = 1 -- x", "a /* x */ = 1", "a = 1 OR drop table", "EXEC x", "x = 1 truncate"])
def test_bad_fragments(fragment):
    with pytest.raises(ValueError, match="forbidden"):
        guards.check_fragment(fragment)


def test_fragments():
    assert guards.check_fragment("  ") is None and guards.check_fragment(" dropped = 1 ") == "dropped = 1"
    assert guards.split_fragment("WHERE a = 1\n AND b LIKE 'x%' limit 5 OFFSET 10") == ("a = 1 AND b LIKE 'x%'", 5, 10)
    assert guards.split_fragment("LIMIT 3") == ("", 3, None) and guards.split_fragment(None) == ("", None, None)
    assert guards.split_fragment("a > 1 OFFSET 2") == ("a > 1 OFFSET 2", None, None)
