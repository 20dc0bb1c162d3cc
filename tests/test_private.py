"""Private sources: validation, discovery, manifest, and ingest."""

import pytest

from strandloom.operators import private

HEAD = "Phage_ID,Host_ID,Host_name,Source_DB,interaction"


def source(root, name, lines, phages, hosts=(), head=HEAD):
    folder = root / name
    (folder / "hosts").mkdir(parents=True)
    (folder / "metadata.csv").write_text("\n".join([head, *lines]) + "\n")
    (folder / "phage.fasta").write_text("".join(f">{p} x\nACGT\n" for p in phages))
    for host, ids in dict(hosts).items():
        (folder / "hosts" / host).write_text("".join(f">{i}\nAC\n" for i in ids))
    if not hosts:
        (folder / "hosts").rmdir()
    return f"file://{folder}"


GOOD = ["P1,H1,Ecoli,A,virulent", "P2,H2,Ecoli B,A,Temperate"]
FILES = {"H1.fna": ["H1"], "H2.fa": ["H2"]}


def test_valid(spark, tmp_path):
    found = private.validate_source(spark, source(tmp_path, "A", [*GOOD, GOOD[0]], ["P1", "P2", "P3"], FILES))
    assert found.valid, found.errors
    assert found.stats == {"rows": 3, "phages": 2, "hosts": 2, "extra_attributes": 0, "sequences": 3}
    assert found.warnings == ["1 sequences without metadata: P3", "1 repeated interactions"]


@pytest.mark.parametrize(
    ("lines", "phages", "hosts", "head", "error"),
    [
        (["P1,H1,E,A"], ["P1"], FILES, "Phage_ID,Host_ID,Host_name,Source_DB", "missing columns: interaction"),
        ([], ["P1"], FILES, HEAD, "no rows"),
        ([GOOD[0], "P2,H2,,A,virulent"], ["P1", "P2"], FILES, HEAD, "1 empty values in Host_name in lines 3"),
        (["P1,H1,E,A,lytic"], ["P1"], FILES, HEAD, "1 unknown kinds of interaction: lytic in lines 2"),
        (["P1,H1,E,B,virulent"], ["P1"], FILES, HEAD, "1 rows of another source: B in lines 2"),
        (GOOD, ["P1"], FILES, HEAD, "1 phages without a sequence: P2 in lines 3"),
        (GOOD, ["P1", "P2", "P2"], FILES, HEAD, "1 repeated sequence ids: P2"),
        (GOOD, ["P1", "P2"], {"H1.fna": ["H1"]}, HEAD, "1 hosts without a file: H2 in lines 3"),
        (GOOD, ["P1", "P2"], {"H1.fna": ["H1", "H1"], "H2.fna": ["H2"]}, HEAD, "1 host files with repeated sequence ids: H1"),
        (GOOD, ["P1", "P2"], {"H1.fna": ["H9"], "H2.fna": ["H2"]}, HEAD, "1 host files without a record of their host: H1"),
        (["P1,unknown,E,A,virulent", "P2,H2,E,A,virulent"], ["P1", "P2"], FILES, HEAD, "known and unknown hosts are mixed"),
        (GOOD, ["P1", "P2"], {}, HEAD, "no folder of host sequences"),
    ],
)
def test_findings(spark, tmp_path, lines, phages, hosts, head, error):
    assert error in private.validate_source(spark, source(tmp_path, "A", lines, phages, hosts, head)).errors


def test_unknown_hosts_need_no_files(spark, tmp_path):
    found = private.validate_source(spark, source(tmp_path, "A", ["P1,unknown,E,A,virulent"], ["P1"]))
    assert found.valid and found.warnings == ["no folder of host sequences; all hosts are unknown"]


def test_roots_and_manifest(spark, tmp_path):
    a = source(tmp_path / "r1", "A", GOOD, ["P1", "P2"], FILES)
    source(tmp_path / "r1", "B", ["P1,unknown,E,B,virulent"], ["P1"])
    source(tmp_path / "r2", "B", ["P1,unknown,E,B,virulent"], ["P1"])
    (tmp_path / "r2" / "C").mkdir()
    (tmp_path / "r2" / "note.txt").write_text("x")
    roots = [f"file://{tmp_path}/{r}" for r in ("r1", "r2", "none", "r1")]
    assert [x.rsplit("/", 2)[1:] for x in private.discover_sources(spark, roots)] == [["r1", "A"], ["r1", "B"], ["r2", "B"], ["r2", "C"]]
    assert len(private.discover_sources(spark, roots, excluded=[a])) == 3
    manifest = private.build_manifest(spark, roots)
    assert (manifest["sources_found"], manifest["sources_valid"], manifest["sources_invalid"]) == (4, 1, 3)
    by = {x["source_dir"].rsplit("/", 2)[1] + "/" + x["source_db"]: x for x in manifest["sources"]}
    assert by["r1/B"]["errors"] == by["r2/B"]["errors"] == ["several sources are named B"]
    assert by["r2/C"]["errors"] == ["missing files: metadata.csv, phage.fasta"]
    assert by["r1/B"]["fingerprint"] == by["r2/B"]["fingerprint"] != by["r1/A"]["fingerprint"]
    (tmp_path / "r1/A/hosts/H1.fna").write_text(">H1\nACC\n")
    assert private.source_fingerprint(spark, a) != by["r1/A"]["fingerprint"]


def test_ingest(spark):
    fact = spark.createDataFrame([("PUB", "D", "temperate", "h", "public"), ("OLD", "Z", "virulent", "h", "private"), ("N", "D", None, None, None)], "Phage_ID string, Source_DB string, Lifestyle string, Host string, source_type string")
    hosts = spark.createDataFrame([("HP", "pub", "public"), ("HO", "old", "private")], "Host_ID string, Species_Name string, source_type string")
    stale = spark.createDataFrame([("Z", "private", "interaction", "OLD|HO", "Note", "x", "string")], "Source_DB string, source_type string, entity_type string, entity_id string, attribute_key string, attribute_value string, value_type string")
    star = {"fact_phages": fact, "dim_hosts": hosts, "private_entity_attributes": stale}
    shape = "_row long, Phage_ID string, Host_ID string, Host_name string, Source_DB string, interaction string, Note string"
    both = spark.createDataFrame([(0, "PA", "HA", "Zed", "A", "Temperate", "n1"), (1, "PA", "HA", "Alpha", "A", "virulent", "n2"), (2, "PB", "HP", "x", "B", "virulent", "")], shape).repartition(3)
    one = private.ingest(star, both)
    get = lambda s, t, *c: sorted((tuple(r) for r in s[t].select(*c).collect()), key=str)
    # Of rows with equal keys the first counts, whole.
    assert get(one, "fact_phages", "Phage_ID", "Lifestyle", "Host", "source_type") == sorted([("N", None, None, None), ("PA", "temperate", "Zed", "private"), ("PB", "virulent", "x", "private"), ("PUB", "temperate", "h", "public")], key=str)
    assert get(one, "private_interactions", "Phage_ID", "Host_name", "interaction") == [("PA", "Zed", "temperate"), ("PB", "x", "virulent")]
    assert get(one, "private_entity_attributes", "entity_id", "attribute_key", "attribute_value") == [("PA|HA", "Note", "n1")]
    assert get(one, "dim_hosts", "Host_ID", "Species_Name") == [("HA", "Zed"), ("HP", "pub")]
    # A second run with B alone, and without extra columns, leaves nothing of A.
    two = private.ingest(one, both.filter("Source_DB = 'B'").drop("Note"))
    assert get(two, "fact_phages", "Phage_ID") == [("N",), ("PB",), ("PUB",)]
    assert get(two, "private_entity_attributes", "entity_id") == [] and get(two, "dim_hosts", "Host_ID") == [("HP",)]
    assert get(two, "private_phage_host_associations", "Phage_ID", "Host_ID") == [("PB", "HP")]
    again = private.ingest(two, both.filter("Source_DB = 'B'").drop("Note"))
    assert all(get(again, t, "*") == get(two, t, "*") for t in two)
