"""Readers, writers and whole files: quoting, FASTA, GFF3, JSON, contracts and merged feature files."""

import csv
import gzip
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from strandloom import schemas
from strandloom.operators import reshape
from strandloom.sources import files, readers, writers


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file://{path}"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*(columns or df.columns)).collect()]


def test_delimited_quotes_and_short_rows(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'Phage_ID,Note,N\nP1,"a, ""b""\nc",1\nP2,,\nP3,x\n')
    assert readers.header(spark, path) == ["Phage_ID", "Note", "N"]
    assert rows(readers.delimited(spark, path)) == [("P1", 'a, "b"\nc', "1"), ("P2", None, None), ("P3", "x", None)]
    assert rows(readers.delimited(spark, path, keep_empty=True))[1] == ("P2", "", "")
    tsv = put(tmp_path, "b.tsv", 'A\tB\n1,5\t"x\ty"\n')
    assert rows(readers.delimited(spark, tsv, "\t")) == [("1,5", "x\ty")]


def test_empty_or_invalid(spark, tmp_path):
    assert files.is_empty_or_invalid(spark, f"file://{tmp_path}/none.tsv")
    assert files.is_empty_or_invalid(spark, put(tmp_path, "zero.tsv", ""))
    assert files.is_empty_or_invalid(spark, put(tmp_path, "blank.tsv", "\nA\tB\n"))
    assert not files.is_empty_or_invalid(spark, put(tmp_path, "good.tsv", "A\tB\n"))
    assert readers.header(spark, put(tmp_path, "zero2.tsv", "")) == [] == readers.header(spark, f"file://{tmp_path}/none.tsv")
    with pytest.raises(ValueError, match="no header"):
        readers.delimited(spark, put(tmp_path, "zero3.tsv", ""))


def test_feature_files(spark, tmp_path):
    # Three frames, columns in different orders, one without its source, one with an alias, one without rows to read.
    a = put(tmp_path, "DB1_crispr.tsv", "Phage_ID\tCRISPR_ID\tCRISPR_Start\nP1\tC1\t12.0\nP2\tC2\t-\n")
    b = put(tmp_path, "x_crispr.tsv", "Source_DB\tCRISPR_Start\tCRISPR_ID\tPhage_id\nDB2\t7\tC3\tP3\nDB2\tjunk\tC4\tP4\n")
    c = put(tmp_path, "DB3_crispr.tsv", "")
    put(tmp_path, "DB1_crispr.provenance.json", json.dumps({"retrieved_at": " 2026-01-02T03:04:05Z "}))
    merged = readers.feature_files(spark, [a, b, c], "crispr_arrays", provider={"Provider_Name": "prov", "Provider_Release": "r1"})
    found = sorted(rows(merged, "Phage_ID", "CRISPR_ID", "CRISPR_Start", "Source_DB", "Provider_Name", "Provider_Snapshot_Date", "Input_Source_Key", "Input_File", "Input_Retrieved_At"))
    assert found == [
        ("P1", "C1", 12.0, "DB1", "prov", "", "DB1_crispr", "DB1_crispr.tsv", "2026-01-02T03:04:05Z"),
        ("P2", "C2", None, "DB1", "prov", "", "DB1_crispr", "DB1_crispr.tsv", "2026-01-02T03:04:05Z"),
        ("P3", "C3", 7.0, "DB2", "prov", "", "x_crispr", "x_crispr.tsv", ""),
        ("P4", "C4", None, "DB2", "prov", "", "x_crispr", "x_crispr.tsv", ""),
    ]
    star = readers.star_table(readers.feature_files(spark, [a, b], "crispr_arrays"), "dim_crispr_arrays")
    assert star.schema.names == schemas.schema("dim_crispr_arrays").names
    assert sorted(rows(star, "crispr_id", "crispr_start", "source_type")) == [("C1", 12, "public"), ("C2", None, "public"), ("C3", 7, "public"), ("C4", None, "public")]
    with pytest.raises(ValueError, match="no file"):
        readers.feature_files(spark, [c], "crispr_arrays")
    with pytest.raises(ValueError, match="missing columns: Phage_ID"):
        readers.feature_files(spark, [put(tmp_path, "d_x.tsv", "CRISPR_ID\nC\n")], "crispr_arrays")


def test_contracts():
    contract = schemas.CONTRACTS["phages"]
    plan = reshape.plan_columns([" Phage_id ", "GC%", "GC_content", "Source_DB", "Source_DB", "zz", "aa"], contract)
    assert plan.renamed == {"Phage_id": "Phage_ID"} and plan.duplicates == ["Source_DB"] and plan.missing == []
    assert plan.unknown == ["GC%", "aa", "zz"] and plan.drifted
    assert [n for n, _ in plan.columns][:4] == ["Phage_ID", "Source_DB", "Length", "GC_content"]
    report = reshape.drift_report(["Length"], contract)
    assert report["missing"] == ["Phage_ID", "Source_DB"] and not report["ok"]
    exact = reshape.plan_columns([*contract.required, *contract.optional], contract)
    assert not exact.drifted
    assert {n for n, c in schemas.CONTRACTS.items() if "Protein_ID" in c.required} == {"proteins", "anti_crispr", "virulent_factors", "transmembrane_proteins", "antimicrobial_resistance_genes"}
    assert "CRISPR_ID" in schemas.CONTRACTS["crispr_arrays"].required and len(schemas.CONTRACTS) == 9
    for table in schemas.TABLES:
        assert schemas.schema(table).names


def test_fasta(spark, tmp_path):
    a = put(tmp_path, "db1_a.fasta", ">P1 first phage\r\nACGT\r\nAC GT\r\n>P2\nTT\n>\nGG\n>P1 again\nCC\n")
    b = put(tmp_path, "db2_b.fasta", ">P3 ä x\nAAAA\n>P2 other\nGGGG")
    records = readers.fasta(spark, [a, b])
    assert sorted(rows(records, "id", "header", "sequence")) == [("P1", "P1 again", "CC"), ("P1", "P1 first phage", "ACGTACGT"), ("P2", "P2", "TT"), ("P2", "P2 other", "GGGG"), ("P3", "P3 ä x", "AAAA")]
    assert dict(rows(readers.sequence_table(records))) == {"P1": "ACGTACGT", "P2": "TT", "P3": "AAAA"}
    assert rows(readers.fasta_headers(records, 2)) == [("P1", "P1 first phage", "first phage"), ("P2", "P2", "")]
    numbered = readers.newest_sequence(records)
    assert sorted(rows(numbered.filter("file LIKE '%db1_a%'"), "file_pos", "header")) == [(1, "P1 first phage"), (2, "P2"), (3, "P1 again")]
    zipped = put(tmp_path, "z.fasta.gz", gzip.compress(b">Z1 d\nAC\nGT\n"))
    assert rows(readers.fasta(spark, zipped), "id", "sequence") == [("Z1", "ACGT")]
    assert rows(readers.fasta(spark, put(tmp_path, "none.fasta", ""))) == []


def test_fasta_round_trip(spark, tmp_path):
    data = spark.createDataFrame([("a", "a some text", "ACGT" * 50), ("b", "b", "A" * 80), ("c", "c", ""), ("d", "d", None)], "id string, header string, sequence string")
    writers.write_fasta(data, f"file://{tmp_path}/out")
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    assert max(map(len, lines)) == 80 and ">a some text" in lines
    assert sorted(rows(readers.fasta(spark, f"file://{tmp_path}/out"), "header", "sequence")) == [("a some text", "ACGT" * 50), ("b", "A" * 80)]
    writers.write_fasta(data.drop("header"), f"file://{tmp_path}/ids")
    assert sorted(rows(readers.fasta(spark, f"file://{tmp_path}/ids"), "header")) == [("a",), ("b",)]


def test_gff3(spark, tmp_path):
    one = '# Sequence Data: seqnum=1;seqhdr="P1"\nP1\tsrc\tCDS\t10\t30\t.\t+\t0\tID=g1;product=Ätherase = x;ID=g2; note = y\n# comment\nP1\tsrc\tgene\tbad\t5\t.\t-\t.\tprotein_id=q\nshort\tline\n'
    two = '# Sequence Data: seqhdr="P2"\n'
    a = put(tmp_path, "DBA_x.gff3", one + two)
    b = put(tmp_path, "DBB_x.gff3", '# Sequence Data: seqhdr="P1"\nP1\tnew\tCDS\t1\t2\t.\t+\t0\tID=last\n')
    blocks = readers.gff3_blocks(spark, [a])
    assert sorted(rows(blocks, "phage_id", "source_db", "copies")) == [("P1", "DBA_x", 1), ("P2", "DBA_x", 1)]
    found = rows(readers.gff3_features(blocks), "phage_id", "type", "start", "end", "ID", "product", "protein_id", "length")
    assert sorted(found, key=str) == [("P1", "CDS", 10, 30, "g2", "Ätherase = x", None, 21), ("P1", "gene", None, 5, None, None, "q", None)]
    assert readers.gff3_has(blocks, "P2") and not readers.gff3_has(blocks, "P9")
    assert readers.gff3_get(blocks, "P9") == "" and readers.gff3_source(blocks, "P9") is None and readers.gff3_source(blocks, "P2") == "DBA_x"
    assert len(readers.gff3_lines(blocks, "P1")) == 3 and readers.gff3_lines(blocks, "P2") == []
    both = readers.gff3_blocks(spark, [a, b])
    assert rows(readers.gff3_list(both)) == [("P1",), ("P2",)] and rows(readers.gff3_list(both, "DBB_x")) == [("P1",)]
    assert rows(both.filter("phage_id = 'P1'"), "source_db", "copies") == [("DBB_x", 2)]
    assert rows(readers.gff3_stats(both)) == [(None, 2), ("DBA_x", 1), ("DBB_x", 1)]


def test_json(spark, tmp_path):
    assert sorted(rows(readers.json_map(spark, put(tmp_path, "m.json", json.dumps({"H1": "/a", "H2": "/b"}))))) == [("H1", "/a"), ("H2", "/b")]
    paths = [put(tmp_path, f"{i}.provenance.json", json.dumps({"feature": "phages", "source_key": k, "file_size": 5}, indent=1)) for i, k in enumerate("ab")]
    found = readers.json_sidecars(spark, paths)
    assert found.columns == schemas.schema("dataset_provenance").names
    assert rows(found, "source_key", "file_size", "etag") == [("a", "5", None), ("b", "5", None)]
    nested = spark.createDataFrame([([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}],)], "sources array<struct<a:int,b:string>>")
    assert rows(reshape.flatten(nested, "sources")) == [(1, "x"), (2, "y")]
    assert json.loads(writers.manifest_json([{"b": 1, "a": 2}])) == [{"a": 2, "b": 1}]


@pytest.mark.parametrize("quote_all", [True, False])
def test_csv_round_trip(spark, tmp_path, quote_all):
    data = spark.createDataFrame([("a,b", 1, 1.5), ('say "x"', None, 2.0), ("line\nbreak", 3, None)], "t string, n int, d double")
    writers.write_csv(data.coalesce(1), f"file://{tmp_path}/csv", quote_all)
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")))
    assert text.startswith('"t","n","d"\n') and ('"a,b",1,1.5' in text) == (not quote_all)
    assert [tuple(r) for r in csv.reader(io.StringIO(text))] == [("t", "n", "d"), ("a,b", "1", "1.5"), ('say "x"', "", "2.0"), ("line\nbreak", "3", "")]


def test_tables_and_digests(spark, tmp_path):
    data = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    writers.write_table(data, f"file://{tmp_path}/t", cluster_by="id", partition_by=["g"])
    assert spark.read.parquet(f"file://{tmp_path}/t").count() == 100 and (tmp_path / "t/g=1").is_dir()
    writers.write_table(data, f"file://{tmp_path}/u", cluster_by="id")
    assert spark.read.parquet(f"file://{tmp_path}/u").filter("id = 7").count() == 1
    path = put(tmp_path, "f.bin", b"\x00\x01abc")
    assert rows(files.file_digests(spark, [path]), "size", "sha256") == [(5, hashlib.sha256(b"\x00\x01abc").hexdigest())]
    assert files.listed(spark, f"file://{tmp_path}/absent") == []
    assert [x.name for x in files.listed(spark, f"file://{tmp_path}")] == ["f.bin", "t", "u"]


def test_header_by_the_rules_of_csv(spark, tmp_path):
    """Separators, doubled quotes and blanks inside quoted names; each value stays in its column."""
    path = put(tmp_path, "q.csv", '"a, b",c,"d ""e""", f \n1,2,3,4\n"x,y",,"",z\n')
    assert readers.header(spark, path) == ["a, b", "c", 'd "e"', "f"]
    assert rows(readers.delimited(spark, path)) == [("1", "2", "3", "4"), ("x,y", None, None, "z")]


def test_first_of_repeated_columns_counts(spark, tmp_path):
    path = put(tmp_path, "DB_phages.tsv", "Phage_ID\tLength\tLength \tSource_DB\tPhage_ID\nP1\t5\t9\tDB\tother\n")
    assert rows(readers.delimited(spark, path, "\t")) == [("P1", "5", "DB")]
    assert rows(readers.feature_files(spark, [path], "phages"), "Phage_ID", "Length", "Source_DB") == [("P1", 5.0, "DB")]
    assert reshape.drift_report(readers.header(spark, path, "\t"), schemas.CONTRACTS["phages"])["duplicates"] == ["Length", "Phage_ID"]


def test_files_without_line_breaks_are_split(spark, tmp_path):
    """Many tasks read a plain file; one quoted line break makes it a whole again, with the same rows."""
    lines = [f'P{i},"x, {i}"' for i in range(2_000)]
    plain = put(tmp_path, "plain.csv", "id,note\n" + "\n".join(lines) + "\n")
    broken = put(tmp_path, "broken.csv", "id,note\n" + "\n".join([*lines, 'P,"two\nlines"']) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = readers.delimited(spark, plain)
        assert found.rdd.getNumPartitions() > 4 and found.count() == 2_000
        assert sorted(rows(found)) == sorted((f"P{i}", f"x, {i}") for i in range(2_000))
        whole = readers.delimited(spark, broken)
        assert whole.rdd.getNumPartitions() == 1 and whole.count() == 2_001 and ("P", "two\nlines") in rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("feature", list(schemas.CONTRACTS))
def test_every_feature_is_merged(spark, tmp_path, feature):
    """Two files in different orders, one with aliases and an unknown column: contract columns first, numbers coerced in each, sources from names."""
    contract = schemas.CONTRACTS[feature]
    known = (*contract.required, *contract.optional)
    value = lambda c, k: str(k) if c in contract.numeric else f"{c}{k}"
    first = [c for c in known if c != "Source_DB"]
    other_name = {real: alias for alias, real in contract.aliases.items()}
    second = [*reversed(known), "Extra"]
    a = put(tmp_path, f"DB1_{feature}.tsv", "\t".join(first) + "\n" + "\t".join(value(c, 1) for c in first) + "\n" + "\t".join("junk" if c in contract.numeric else value(c, 3) for c in first) + "\n")
    b = put(tmp_path, f"DB2_{feature}.tsv", "\t".join(other_name.get(c, c) for c in second) + "\n" + "\t".join(value(c, 2) for c in second) + "\n")
    merged = readers.feature_files(spark, [a, b], feature)
    assert merged.columns == [*known, "Extra"]
    assert all(t == ("double" if c in contract.numeric else "string") for c, t in merged.dtypes)
    found = {r[known[0]]: r.asDict() for r in merged.collect()}
    want = lambda k: {c: float(k) if c in contract.numeric else value(c, k) for c in known}
    assert found[value(known[0], 1)] == want(1) | {"Source_DB": "DB1", "Extra": None}
    assert found[value(known[0], 2)] == want(2) | {"Extra": "Extra2"}
    assert found[value(known[0], 3)] == want(3) | {c: None for c in contract.numeric} | {"Source_DB": "DB1", "Extra": None}
    table = {"phages": "fact_phages", "trna_tmrna": "dim_trna_tmrna"}.get(feature, f"dim_{feature}")
    star = readers.star_table(merged, table)
    assert star.schema.fieldNames() == schemas.schema(table).fieldNames() and star.count() == 3
    assert {f.dataType for f in star.schema} <= {f.dataType for f in schemas.schema(table)}
