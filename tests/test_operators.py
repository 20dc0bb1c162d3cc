"""Operators of sequences, pairs, negatives, resolution, quality and reshaping that the catalog's SQL does not reach."""

import time

import pytest
from pyspark.sql import functions as F

from strandloom.operators import features, negatives, pairs, quality, resolve, reshape, sequences, views
from strandloom.schemas import CONTRACTS


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def contigs(spark):
    data = [("g", 1, "contig_medium", "ACGTACGT"), ("g", 2, "contig_long", "AAACCCGGGTTT"), ("g", 3, "contig_short", "TTTT"), ("h", 1, "contig1", "ACGTACGT"), ("t", 1, "b", "CC"), ("t", 2, "a", "GG")]
    return spark.createDataFrame(data, "genome_id string, file_pos int, contig_id string, sequence string").repartition(3)


def test_assembly(contigs):
    one = lambda g, **o: rows(sequences.host_genome(contigs, g, **o), "genome")[0][0]
    assert one("g", mode="first") == "AAACCCGGGTTT" and one("g", mode="first", order="file") == "ACGTACGT"
    assert one("g", gap=2) == "AAACCCGGGTTTNNACGTACGTNNTTTT" and one("g", gap=0, order="file") == "ACGTACGTAAACCCGGGTTTTTTT"
    assert one("g", mode="list") == ["AAACCCGGGTTT", "ACGTACGT", "TTTT"] and one("g", mode="dict") == {"contig_long": "AAACCCGGGTTT", "contig_medium": "ACGTACGT", "contig_short": "TTTT"}
    assert one("h") == one("h", mode="first") == "ACGTACGT" and one("t", gap=0) == "GGCC"
    assert rows(sequences.host_genome(contigs, "none")) == []
    assert rows(sequences.genome_stats(contigs), "genome_id", "contig_count", "lengths", "total_length", "longest")[0] == ("g", 3, [12, 8, 4], 24, 12)
    assert rows(sequences.genome_stats(contigs, "file"), "lengths")[0] == ([8, 12, 4],) or ([8, 12, 4],) in rows(sequences.genome_stats(contigs, "file"), "lengths")
    for bad in ({"mode": "x"}, {"gap": -1}, {"order": "x"}):
        with pytest.raises(ValueError, match="must"):
            sequences.assemble_genomes(contigs, **bad)
    assert rows(sequences.weighted_gc(contigs)) == [("g", 41.67), ("h", 50.0), ("t", 100.0)]


def test_sequences_by_id(spark, contigs):
    ids = spark.createDataFrame([("g",), ("g",), ("x",)], "Host_ID string")
    assert rows(sequences.host_sequences(contigs, ids)) == [("g", "AAACCCGGGTTT", 12, 50.0)]
    table = spark.createDataFrame([(f"p{i}", "ACGT"[i % 4] * i) for i in range(9)], "id string, sequence string")
    asked = spark.createDataFrame([(f"p{i}", i) for i in (5, 2, 11, 7, 2)], "Protein_ID string, n int").coalesce(1)
    found = sequences.by_query(asked, table, "Protein_ID")
    assert [(r["Protein_ID"], r["Sequence"]) for r in found.collect()] == [("p5", "C" * 5), ("p2", "GG"), ("p11", None), ("p7", "T" * 7), ("p2", "GG")]
    with pytest.raises(ValueError, match="Host_ID"):
        sequences.by_query(asked, table, "Host_ID")
    assert [r["id"] for r in sequences.by_ids(table, ["p7", "p1", "zz", "p3"]).collect()] == ["p7", "p1", "p3"]
    proteins = spark.createDataFrame([("P", "p1"), ("P", "p1"), ("P", "none"), ("Q", "p2")], "Phage_ID string, Protein_ID string")
    assert rows(sequences.proteins_of_phage(proteins, table, "P")) == [("p1", "C")]


def test_routing(spark):
    public = spark.createDataFrame([("PUB", "GGGG"), ("X", "public")], "id string, sequence string")
    private = spark.createDataFrame([("PRIV", "Test_Private", "ATAT"), ("X", "Test_Private", "own"), ("ONLY", "other", "last")], "id string, source_db string, sequence string")
    wanted = spark.createDataFrame([("PRIV", "test_private", "private"), ("PUB", "PhagesDB", "phagescope"), ("X", " TEST_private ", None), ("X", "PhagesDB", "public"), ("ONLY", "PhagesDB", None), ("NONE", "a", "b")], "id string, source_db string, source_type string")
    assert rows(sequences.routed(public, private, wanted)) == [("ONLY", "PhagesDB", "last"), ("PRIV", "test_private", "ATAT"), ("PUB", "PhagesDB", "GGGG"), ("X", " TEST_private ", "own"), ("X", "PhagesDB", "public")]


def test_protein_lookup(spark):
    headers = spark.createDataFrame([(0, "P1 A1 tail"), (1, "A2"), (2, "A3_full name"), (3, "P2 A4 x"), (4, "P9 A4 y")], "pos int, header string")
    wanted = spark.createDataFrame([("A2",), ("A3_full",), ("A4",), ("P7 A1",), ("none",)], "id string")
    assert rows(sequences.protein_lookup(wanted, headers)) == [("A2", "A2", 1), ("A3_full", "A3_full name", 2), ("A4", "P2 A4 x", 3), ("P7 A1", "P1 A1 tail", 3)]


def test_qc(spark):
    data = [("ok", "a", "ACGT"), ("ok", "b", "GG"), ("twice", "a", "A"), ("twice", "a", "C"), ("twice", "b", "C"), ("same", "a", "acgt"), ("same", "b", "ACGT"), ("same", "c", "TT")]
    records = spark.createDataFrame(data, "file string, id string, sequence string").withColumn("header", F.col("id"))
    assert rows(sequences.run_qc(records)) == [
        ("ok", 2, "accepted", 0, "", "ok", 0, ""),
        ("same", 3, "accepted", 0, "", "duplicates_found", 1, "a, b"),
        ("twice", 3, "rejected", 1, "a", "skipped", 0, ""),
    ]
    assert rows(sequences.audit_headers(records.filter("file = 'twice'"))) == [("a", 2)] and rows(sequences.audit_headers(records.filter("file = 'ok'"))) == []
    with pytest.raises(ValueError, match="no records"):
        sequences.audit_headers(records.filter("file = 'none'"))
    same = records.filter("file = 'same'")
    assert rows(sequences.identical_groups(same, "id", "sequence")) == [] and rows(sequences.identical_groups(same, "id", "sequence", fold_case=True), "n", "first_id") == [(2, "a")]
    files = spark.createDataFrame([("ok",), ("twice",), ("same",), ("gone",)], "file string")
    done = spark.createDataFrame([("same",)], "file string")
    assert rows(sequences.index_status(files, sequences.run_qc(records), done)) == [("gone", "failed"), ("ok", "indexed"), ("same", "already_indexed"), ("twice", "rejected_duplicate_headers")]


def test_host_places(spark):
    shape = "Host_ID string, path string"
    public, private = spark.createDataFrame([("H1", "/pub/1"), ("H2", " ")], shape), spark.createDataFrame([("H1", "/priv/1"), ("H2", "/priv/2")], shape)
    assert rows(sequences.host_mapping(public, private)) == [("H1", "/pub/1"), ("H2", "/priv/2")]
    with pytest.raises(ValueError, match="no host"):
        sequences.host_mapping(public.limit(0), private.limit(0))
    records = spark.createDataFrame([("H1", "A"), ("H1", "A"), ("H2", "A"), ("H2", "C"), ("H3", "G"), ("H4", "T")], "Host_ID string, sequence string")
    wanted = spark.createDataFrame([("H1",), ("H2",), ("H3",)], "Host_ID string")
    chosen, states = sequences.private_artifacts(records, wanted)
    assert chosen.count() == 5 and rows(states) == [("H1", 2, "identical"), ("H2", 2, "conflicting"), ("H3", 1, "single")]
    assert rows(sequences.artifact_counts(states)) == [(3, 1, 1, 1, 5)]
    named = spark.createDataFrame([("file:/x/DB1/a.fasta", 1, "h1"), ("file:/x/DB2/b.fa", 2, "h2")], "file string, pos int, header string").withColumn("sequence", F.lit("A"))
    assert [r["header"] for r in sequences.named_by_folder(named).orderBy("kind", "file", "pos").collect()] == ["DB2 h2", "DB1 h1"]


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame([("PRIV", "test_private", 1000, 50.0, "V", "Complete", "private"), ("PUB", "PhagesDB", 1200, 40.0, "V", "Partial", "phagescope"), ("NOGC", "PhagesDB", None, None, "V", None, None)], "Phage_ID string, Source_DB string, Length int, GC_content double, Taxonomy string, Completeness string, source_type string")
    hosts = spark.createDataFrame([("H1", "E coli", "Complete Genome", 10, 50.0, "ref"), ("H2", "B sub", "Contig", 20, 45.0, "na"), ("H3", "V ch", None, None, None, None)], "Host_ID string, Species_Name string, Assembly_Level string, Genome_Length bigint, GC_Content double, RefSeq_Category string")
    for c in ("Lifestyle", "Cluster", "Subcluster", "Host"):
        fact = fact.withColumn(c, F.lit(None).cast("string"))
    return {"fact_phages": fact, "dim_hosts": hosts}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([("PRIV", "H1"), ("PUB", "H2"), ("PUB", "H3"), ("GONE", "H1")], "Phage_ID string, Host_ID string")


def test_pairs(spark, star, edges):
    phage = spark.createDataFrame([("PRIV", "ATAT"), ("PUB", "GGGG"), ("X", "A")], "id string, sequence string")
    host = spark.createDataFrame([("H1", "AAAA"), ("H2", "CCCC"), ("D", "TTTT")], "id string, sequence string")
    meta = pairs.pair_metadata(star, edges)
    whole = pairs.pairs_with_sequences(meta, phage, host)
    assert rows(whole, "Phage_ID", "Host_ID", "Phage_Sequence", "Host_Sequence", "Phage_Source_Type") == [("PRIV", "H1", "ATAT", "AAAA", "private"), ("PUB", "H2", "GGGG", "CCCC", "public")]
    assert rows(pairs.missing_sequences(meta, phage, host)) == [("host", "H3")]
    assert rows(pairs.missing_host_pairs(meta, host.unionAll(spark.createDataFrame([("H3", "")], host.schema))), "Host_ID", "Species_Name", "Failure_Reason") == [("H3", "V ch", "empty sequence")]
    assert rows(pairs.missing_host_pairs(meta, host), "Phage_ID", "Failure_Reason") == [("PUB", "no sequence")]
    assert rows(pairs.hosts_of_phage(star, edges, "PUB"), "Host_ID") == [("H2",), ("H3",)]
    assert rows(pairs.table_metadata(star["dim_hosts"], ["Host_ID"], "WHERE GC_Content > 40 LIMIT 1", order=["Host_ID"])) == [("H1",)]
    assert rows(pairs.table_metadata(star["dim_hosts"], ["Host_ID"], "GC_Content > 40 LIMIT 1", limit=5, order=["Host_ID"])) == [("H1",), ("H2",)]
    why = pairs.diagnose_empty(star, edges, "p.Length > 5000")
    assert (why["edges"], why["matching"]) == (4, 0) and why["Completeness"] == ["Complete", "Partial", None]
    with pytest.raises(ValueError, match="unknown filter column"):
        pairs.pair_metadata(star, edges, phage_filters={"password": 1})


def test_batches_and_transform(spark):
    data = spark.range(7).select("id", (F.col("id") * 2).alias("d"))
    parts = list(pairs.batches(data.orderBy("id"), 3))
    assert [len(p) for p in parts] == [3, 3, 1] and pairs.collate(parts[0]) == {"id": [0, 1, 2], "d": [0, 2, 4]} and pairs.collate([]) == {}
    assert rows(pairs.transformed(data, lambda r: {"s": r["id"] + r["d"]}, "s long")) == sorted([(3 * i,) for i in range(7)], key=str)


def test_datasets(spark, contigs):
    some = spark.createDataFrame([("g", "h"), ("t", "e"), ("g", "t"), ("x", "h")], "Phage_ID string, Host_ID string")
    both = contigs.unionByName(spark.createDataFrame([("e", 1, "c", "")], contigs.schema))
    assert rows(pairs.streamed(some, both, both)) == [("g", "h", "ACGTACGT", "ACGTACGT"), ("g", "t", "ACGTACGT", "CC")] or rows(pairs.streamed(some, both, both), "Phage_ID", "Host_ID", "Phage_Sequence", "Host_Sequence") == [("g", "h", "ACGTACGT", "ACGTACGT"), ("g", "t", "ACGTACGT", "CC")]
    table = spark.createDataFrame([("g", "G"), ("t", ""), ("h", "H")], "id string, sequence string")
    placed = pairs.indexed(some, table, table)
    assert placed.count() == 4
    got = pairs.at_indexes(placed, [2, 0])
    assert [(r["Phage_ID"], r["Host_ID"], r["Phage_Sequence"], r["Host_Sequence"]) for r in got] == [("t", "e", "", None), ("g", "h", "G", "H")]
    with pytest.raises(IndexError):
        pairs.at_indexes(placed, [4])
    many = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    found = {r["k"]: r["idx"] for r in pairs.dense_index(many, ["k"]).collect()}
    assert [k for k, _ in sorted(found.items(), key=lambda x: x[1])] == sorted(found) and sorted(found.values()) == list(range(1000))


def test_negatives(spark, star):
    phages = spark.createDataFrame([(f"P{i}",) for i in range(12)], "Phage_ID string")
    hosts = spark.createDataFrame([(f"H{i}",) for i in range(9)], "Host_ID string")
    good = phages.crossJoin(hosts).filter(F.crc32(F.concat("Phage_ID", "Host_ID").cast("binary")) % 4 == 0)
    found = rows(negatives.negatives_for(phages, hosts, good, ratio=1.5))
    assert len(found) == int(good.count() * 1.5) == len(set(found)) and not set(found) & set(rows(good))
    assert found == rows(negatives.negatives_for(phages.repartition(5), hosts, good, ratio=1.5))
    assert len(rows(negatives.negatives_for(phages, hosts, good, ratio=50))) <= 108 - good.count()
    assert rows(negatives.negatives_for(phages, hosts, good.limit(0))) == []
    everything = phages.crossJoin(hosts)
    assert rows(negatives.sample_by_hash(everything, ["Phage_ID", "Host_ID"], 17)) == rows(negatives.shuffled(everything, ["Phage_ID", "Host_ID"]).limit(17))
    assert negatives.sample_by_hash(everything, ["Phage_ID", "Host_ID"], 1000).count() == 108 and negatives.sample_by_hash(everything, ["Phage_ID", "Host_ID"], 0).count() == 0
    part = negatives.percent_sample(spark.range(5000), ["id"], 10)
    assert 400 < part.count() < 600 and rows(part) == rows(negatives.percent_sample(spark.range(5000).repartition(3), ["id"], 10))
    mixed = negatives.balanced_dataset(good, [found_df := negatives.random_negatives(phages, hosts, good, 3), found_df, found_df])
    counts = dict(rows(mixed.groupBy("label").count()))
    assert counts[1] == good.count() and 0 < counts[0] <= counts[1]
    p, h = negatives.candidate_caches(star)
    assert rows(p, "Phage_ID") == [("PRIV",), ("PUB",)] and rows(h, "Host_ID") == [("H1",), ("H2",)]


CATALOG = [("Escherichia coli", "GCF_1.1", "complete genome", True), ("Escherichia coli", "GCF_2.1", "contig", True), ("Escherichia coli", "GCA_3.1", "complete genome", True), ("UBA9502", "GCA_4.1", "contig", False), ("Mus musculus", "GCF_5.1", "chromosome", True)]


def test_resolution(spark):
    phages = spark.createDataFrame([("P1", "NA;Escherichia coli;UBA9502"), ("P2", "Mus musculus"), ("P3", "-"), ("P4", " Escherichia coli K12")], "Phage_ID string, Host string")
    found = resolve.candidates(phages)
    assert set(rows(resolve.unique_tokens(found))) == {("Escherichia coli", "species_name"), ("Escherichia coli K12", "species_name"), ("Mus musculus", "species_name"), ("UBA9502", "other")}
    data = [(t, a, "n", t, 562, "s", lvl, "na", latest, t != "Mus musculus") for t, a, lvl, latest in CATALOG]
    catalog = spark.createDataFrame(data, "token string, assembly_accession string, assembly_name string, organism_name string, species_taxid int, strain string, assembly_level string, refseq_category string, is_latest boolean, is_bacterial boolean")
    kept, lost = resolve.bacterial_only(catalog)
    assert kept.count() == 4 and rows(lost) == [("Mus musculus",)]
    ranked = resolve.ranked_assemblies(kept)
    assert rows(ranked, "token", "assembly_accession", "Resolution_Rank") == [("Escherichia coli", "GCF_1.1", 1), ("Escherichia coli", "GCF_2.1", 2), ("UBA9502", "GCA_4.1", 1)]
    assert resolve.ranked_assemblies(kept, 1).count() == 2
    assert rows(resolve.unique_assemblies(ranked), "assembly_accession", "token") == [("GCA_4.1", "UBA9502"), ("GCF_1.1", "Escherichia coli"), ("GCF_2.1", "Escherichia coli")]
    links = resolve.assembly_links(found, ranked)
    assert rows(resolve.best_per_token(links), "Phage_ID", "Assembly_Accession", "Ambiguous") == [("P1", "GCA_4.1", False), ("P1", "GCF_1.1", True)]
    assert rows(resolve.phage_host_links(links), "Phage_ID", "Host_Species", "Assembly_Accession", "Link_Quality") == [("P1", "Escherichia coli", "GCF_1.1", "direct"), ("P1", "Escherichia coli", "GCF_2.1", "direct"), ("P1", "UBA9502", "GCA_4.1", "genbank")]
    assert rows(resolve.unique_hosts(phages)) == [("Escherichia coli K12",), ("Mus musculus",), ("NA;Escherichia coli;UBA9502",)]
    assert rows(resolve.best_identifiers(phages)) == sorted([("Escherichia coli",), ("Escherichia coli K12",), ("Mus musculus",)], key=str)
    hosts = spark.createDataFrame([("Escherichia coli", "H1")], "Species_Name string, Host_ID string")
    assert rows(resolve.links_by_species(phages, hosts)) == [("P4", "H1")]
    assert rows(resolve.unresolved(resolve.unique_tokens(found), catalog), "Host_Token") == [("Escherichia coli K12",)]
    record = rows(resolve.host_records(catalog.limit(1).withColumn("strain", F.lit(None).cast("string")), "2026-01-01"), "Host_ID", "Strain_Name", "Download_Date")
    assert record[0][1:] == ("-", "2026-01-01")
    files = spark.createDataFrame([("/x/GCF_1.1_genomic.fna", 10), ("/x/GCA_4.1.fna", 0), ("/x/other.fna", 5)], "path string, size long")
    assert rows(resolve.downloads(files), "Host_ID", "Assembly_Accession", "status") == [("GCA_4_1", "GCA_4.1", "failed"), ("GCF_1_1", "GCF_1.1", "success"), ("other", None, "success")]
    wanted = ranked.select(F.col("assembly_accession").alias("Assembly_Accession"))
    assert rows(resolve.to_download(wanted, resolve.downloads(files))) == [("GCA_4.1",), ("GCF_2.1",)]
    cache = spark.createDataFrame([("H1", "a", "success"), ("H2", "b", "failed")], "Host_ID string, Species_Name string, status string")
    newer = resolve.upsert(cache, spark.createDataFrame([("H2", "b", "success")], cache.schema), ["Host_ID"])
    assert rows(resolve.cached_genomes(newer, "b"), "Host_ID") == [("H2",)] and resolve.cached_genomes(cache).count() == 1


def test_reshaping(spark):
    wide = spark.createDataFrame([(1, "a", None), (2, "", "c")], "id int, x string, y string")
    long = reshape.melt(wide, ["id"])
    assert rows(long) == [(1, "x", "a"), (2, "y", "c")]
    assert rows(reshape.pivot(long, "id", "attribute_key", "attribute_value", ["x", "y"])) == [(1, "a", None), (2, None, "c")]
    other = spark.createDataFrame([("z", 3)], "y string, id int")
    assert rows(reshape.union_all([wide, other])) == sorted([(1, "a", None), (2, "", "c"), (3, None, "z")], key=str)
    positional = reshape.insert_positional(wide, spark.createDataFrame([(9, "p", "q")], "a int, b string, c string"))
    assert (9, "p", "q") in rows(positional) and positional.columns == wide.columns
    with pytest.raises(ValueError, match="columns"):
        reshape.insert_positional(wide, other)
    table = spark.createDataFrame([("P", "A", "private"), ("Q", "A", "public"), ("R", "B", "private"), ("S", "A", None)], "Phage_ID string, Source_DB string, source_type string")
    assert rows(reshape.replace_sources(table, spark.createDataFrame([("N", "A", "private")], table.schema), ["A"]), "Phage_ID") == [("N",), ("Q",), ("R",), ("S",)]
    a, b = reshape.split_entity(F.col("e"))
    assert rows(spark.createDataFrame([("P|H|x",), ("P",)], "e string").select(a, b)) == sorted([("P", "H|x"), ("P", None)], key=str)
    manifest = spark.createDataFrame([("f", "k", "1", "aa", "success"), ("f", "k", "2", "bb", "failed"), ("f", "k", "3", "bb", "success"), ("f", "k", "4", "bb", "success")], "feature string, source_key string, retrieved_at string, schema_fingerprint string, status string")
    assert rows(reshape.fingerprint_drift(manifest), "retrieved_at", "previous") == [("3", "aa")]
    frame = reshape.normalize(spark.createDataFrame([(" P1", "D", " 5 ", "x")], "Phage_id string, Source_DB string, Length string, zz string"), CONTRACTS["phages"])
    assert rows(frame, "Phage_ID", "Length", "zz", "Taxonomy") == [(" P1", 5.0, "x", None)]
    reshape.register({"some_rows": wide})
    assert spark.sql("SELECT count(*) FROM some_rows").first()[0] == 2


def test_quality(spark, star):
    left, right = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("b",), ("c",)], "k string")
    assert [rows(x) for x in quality.mismatches(left, right, "k")] == [[("a",)], [("c",)]]
    status = spark.createDataFrame([("success",), (" success ",), ("failed",), ("",), (None,)], "status string")
    assert rows(quality.failed(status)) == sorted([("failed",), ("",), (None,)], key=str)
    profile = rows(quality.table_profile({"hosts": star["dim_hosts"]}), "column_name", "data_type", "n_rows", "n_nulls")
    assert ("GC_Content", "double", 3, 1) in profile and ("Host_ID", "string", 3, 0) in profile
    assert quality.gate_passes({"fact_phages": star["fact_phages"]})
    assert not quality.gate_passes({"fact_phages": star["fact_phages"].unionAll(star["fact_phages"])})
    assert rows(quality.type_breakdown(star["fact_phages"])) == sorted([("private", "test_private", 1), ("phagescope", "PhagesDB", 1), (None, "PhagesDB", 1)], key=str)
    summary = rows(quality.described(spark.createDataFrame([(1, 2.0, "x"), (3, None, "y")], "a int, b double, c string")), "column_name", "n", "mean", "min", "p50", "max")
    assert summary == [("a", 2, 2.0, 1.0, 2.0, 3.0), ("b", 1, 2.0, 2.0, 2.0, 2.0)]
    dims = {"d": spark.createDataFrame([("PRIV",), ("PRIV",)], "Phage_ID string")}
    assert rows(quality.coverage(star["fact_phages"], dims, approximate=True)) == rows(quality.coverage(star["fact_phages"], dims)) == [("d", 1, 33.33)]


def test_associations(spark):
    link = spark.createDataFrame([("P1", "GCF_1.1")], "Phage_ID string, Assembly_Accession string")
    hosts = spark.createDataFrame([("H1", "GCF_1.1")], "Host_ID string, Assembly_Accession string")
    private = spark.createDataFrame([("P1", "H1"), ("P2", "H2")], "Phage_ID string, Host_ID string")
    full = {"dim_phage_host_links": link, "dim_hosts": hosts, "private_phage_host_associations": private}
    assert rows(views.phage_host_associations(full), "Phage_ID", "Host_ID") == [("P1", "H1"), ("P2", "H2")]
    for gone, expected in (("dim_phage_host_links", [("P1", "H1"), ("P2", "H2")]), ("private_phage_host_associations", [("P1", "H1")])):
        assert rows(views.phage_host_associations({k: v for k, v in full.items() if k != gone}), "Phage_ID", "Host_ID") == expected


def test_features(spark):
    data = spark.createDataFrame([("GGCC", "AT"), ("A", ""), (None, "C")], "Phage_Sequence string, Host_Sequence string")
    assert rows(features.sequence_features(data), "phage_seq_length", "host_seq_length", "length_ratio", "phage_gc", "host_gc") == sorted([(4, 2, 2.0, 100.0, 0.0), (1, 0, None, 0.0, 0.0), (None, 1, None, None, 100.0)], key=str)
    texts = spark.createDataFrame([("a", "ACGT"), ("b", "ACGA"), ("c", "TT"), ("d", "A"), ("e", "ACGT")], "id string, s string")
    pairs_ = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("a", "e")], "a string, b string")
    found = {r["b"]: round(r["cosine"], 4) for r in features.kmer_cosine(features.kmer_counts(texts, 2, "id", "s"), pairs_, "id").collect()}
    assert found == {"b": 0.6667, "c": 0.0, "d": 0.0, "e": 1.0}


def test_kmers(spark):
    texts = [("x", "aé😀a\0é😀a"), ("x", "ab"), ("x", None), ("y", "abcabc"), (None, "abcd"), ("y", "")]
    data = spark.createDataFrame(texts, "g string, s string").coalesce(1)
    for k in (1, 3, 8):
        every = [(g, s[i : i + k]) for g, s in texts if s for i in range(len(s) - k + 1)]
        of = {g: sum(1 for h, _ in every if h == g) for g, _ in every}
        expected = sorted(((g, x, every.count((g, x)), every.count((g, x)) / of[g]) for g, x in set(every)), key=str)
        assert rows(features.kmer_totals(data, k, "s", "g")) == expected, k
        assert rows(features.kmer_counts(data.filter("g is not null"), k, "g", "s")) == sorted((r[:3] for r in expected if r[0]), key=str), k
    # More characters and places than 63 bits have numbers for.
    letters = "".join(map(chr, range(0x4E00, 0x4E00 + 2_000)))
    found = rows(features.kmer_totals(spark.createDataFrame([(1, letters * 2)], "g long, s string"), 12, "s", "g"), "kmer", "n")
    assert len(found) == 2_000 and (letters[:12], 2) in found and (letters[-5:] + letters[:7], 1) in found


def test_kmers_of_a_long_text(spark):
    """The time grows with the text, not with its square."""
    text = "".join("ACGT"[i * i % 7 % 4] for i in range(400_000))
    data = spark.createDataFrame([("x", text)], "g string, s string")
    began = time.monotonic()
    assert sum(r[1] for r in rows(features.kmer_totals(data, 4, "s", "g"), "kmer", "n")) == 399_997
    assert sum(r[1] for r in rows(features.kmer_counts(data, 4, "g", "s"), "kmer", "n")) == 399_997
    assert time.monotonic() - began < 40


def test_phage_host_genomes(spark):
    fact = spark.createDataFrame([("P1", "Escherichia coli K12"), ("P2", "-"), ("P3", None), ("P4", "Vibrio x")], "Phage_ID string, Host string").withColumns({"Length": F.lit(1), "GC_content": F.lit(1.0), "Source_DB": F.lit("D")})
    hosts = spark.createDataFrame([("H1", "Escherichia coli"), ("H2", "Escherichia coli"), ("H3", "Esch"), ("H4", "Bacillus")], "Host_ID string, Species_Name string").withColumns({"Strain_Name": F.lit("s"), "Assembly_Accession": F.lit("a"), "Genome_Length": F.lit(1), "GC_Content": F.lit(1.0)})
    assert rows(views.phage_host_genomes({"fact_phages": fact, "dim_hosts": hosts}), "Phage_ID", "Host_ID") == [("P1", "H1"), ("P1", "H2"), ("P1", "H3")]
