"""Tables on disk: offset indexes, parts and keys that are replaced, incremental ingest, buckets and shards."""

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from strandloom.operators import pairs, private, resolve, sequences, views
from strandloom.operators.prefixes import first_with_prefix
from strandloom.sources import files, offsets, readers, versions, writers
from strandloom.sources.readers import json_map


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: [(x is None, x) for x in r])


def put(tmp_path, name, text):
    place = tmp_path / name
    place.parent.mkdir(parents=True, exist_ok=True)
    place.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file://{place}"


# Offsets


def fasta_text(n, seed):
    rng = random.Random(seed)
    return "".join(f">id{i} über {i}\n" + "".join("".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 80))) + rng.choice(["\n", "\r\n", "\n\n"]) for _ in range(rng.randrange(0, 6))) for i in range(n))


@pytest.mark.parametrize("split", ["128m", "997"])
def test_fasta_offsets(spark, tmp_path, split):
    """Places are those of the bytes, however a file is cut into blocks; fetched records are those of a full read."""
    paths = [put(tmp_path, "a b.fa", fasta_text(120, 1)), put(tmp_path, "b.fa", ">only x\nAC GT\n"), put(tmp_path, "c.fa", fasta_text(7, 2).encode()[:-1])]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        index = offsets.fasta_index(spark, paths)
        found = index.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 121 and {r["copies"] for r in found} == {1, 2}
    for r in found:
        data = open(files_path(r["file"]), "rb").read()
        assert data[r["offset"] : r["offset"] + r["size"]].lstrip(b">").startswith(f"{r['id']} ".encode()) and r["offset"] >= 0
        assert r["offset"] == 0 or data[r["offset"] - 2 : r["offset"]] == b"\n>"
    wanted = ["id3", "id77", "only", "nobody"]
    got = offsets.fetch_fasta(index, wanted)
    whole = readers.sequence_table(readers.fasta(spark, paths))
    assert rows(got, "id", "sequence") == rows(whole.filter(F.col("id").isin(wanted)))
    # No more is read than the wanted records.
    assert got.agg(F.sum("n_bytes")).first()[0] == sum(r["size"] for r in found if r["id"] in wanted)


def files_path(uri):
    from urllib.parse import unquote, urlparse

    return unquote(urlparse(uri).path)


def test_stored_index_and_scans(spark, tmp_path):
    """An index is stored by id; a file system without byte ranges is scanned for the same records."""
    path = put(tmp_path, "p.faa", "".join(f">prot {i}|x\nMK{'A' * (i % 9)}\n" for i in range(200)))
    index = offsets.fasta_index(spark, path, whole_header=True)
    writers.write_table(index, f"{tmp_path}/index", cluster_by="id")
    stored = spark.read.parquet(f"{tmp_path}/index")
    wanted = [f"prot {i}|x" for i in (5, 17, 199)]
    assert "PushedFilters: [In(id" in offsets.wanted_places(stored, wanted)._jdf.queryExecution().toString()
    ids = spark.createDataFrame([(w,) for w in wanted], "id string")
    assert rows(offsets.fetch_fasta(stored, ids)) == rows(offsets.fetch_fasta(stored, wanted, ranged=())) and offsets.fetch_fasta(stored, ids).count() == 3


def test_gff3_offsets(spark, tmp_path):
    block = lambda i, n: f'# Sequence Data: seqnum=1;seqhdr="{i}"\n' + "".join(f"{i}\tx\tCDS\t{k}\t{k + 9}\t.\t+\t0\tID={k}\n" for k in range(n))
    one = put(tmp_path, "A.gff3", "##gff-version 3\n" + block("P1", 2) + block("P2", 0) + block("P1", 3))
    two = put(tmp_path, "B.gff3", block("P3", 1) + block("P2", 4))
    index = offsets.gff3_index(spark, [one, two])
    assert rows(index, "id", "source_db", "copies") == [("P1", "A", 2), ("P2", "B", 2), ("P3", "B", 1)]
    got = offsets.fetch_gff3(index, ["P1", "P2", "P3"])
    assert rows(got, "phage_id", "block_text") == [("P1", block("P1", 3)), ("P2", block("P2", 4)), ("P3", block("P3", 1).removesuffix("\n"))]


# Beginnings


def brute_first(ids, texts):
    out = []
    for i in set(ids) - {None}:
        found = [(p, t) for t, p in texts if t is not None and t.startswith(i)]
        if found:
            out.append((i, min(found)[1]))
    return sorted(out)


def test_first_with_prefix(spark):
    """Ids that begin each other, intervals over many ranges, equal texts, and one beginning that all share."""
    rng = random.Random(3)
    texts = [("common__" + "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9))), rng.randrange(10**6)) for _ in range(3_000)] + [("zü😀x", 1), ("zü￿x", 2), ("", 3), (None, 4)]
    ids = ["common__", "common__a", "common__ab", "common__abba", "common__bbbbbbbbbb", "comm", "zü", "zü😀", "zü￿", "zzz", "a", None, *{t for t, _ in texts[:50]}]
    found = first_with_prefix(spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(texts, "text string, pos long").repartition(7))
    assert rows(found) == brute_first(ids, texts)
    assert first_with_prefix(spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([], "text string, pos long")).count() == 0


def test_lookup_of_headers_with_one_beginning(spark):
    """No key gathers what begins alike: the most rows a task gets do not grow to all."""
    headers = spark.range(4_000).select(F.concat(F.lit("PHAGE_00"), F.lpad("id", 6, "0"), F.lit(" protein")).alias("header"), F.col("id").alias("pos"))
    ids = spark.range(0, 4_000, 7).select(F.concat(F.lit("PHAGE_00"), F.lpad("id", 6, "0")).alias("id"))
    found = sequences.protein_lookup(ids, headers)
    assert found.count() == 572 and {r[0] for r in found.select("tier").distinct().collect()} == {2}
    assert found.filter("header != concat(id, ' protein')").count() == 0


# Parts and keys


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    table = versions.PartitionedTable(spark, f"file://{tmp_path}/t")
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    assert table.read() is None and table.version == 0
    table.replace(frame(("a", 1), ("b", 2), ("b", 3)), F.col("k"), ["a", "b"], {"b": "note"})
    first = table.parts()
    table.replace(frame(("b", 4), ("c", 5)), F.col("k"), ["b", "c"])
    now = table.parts()
    assert rows(table.read()) == [("a", 1), ("b", 4), ("c", 5)] and rows(table.read(["c"])) == [("c", 5)] and table.read([]).count() == 0
    assert now["a"] == first["a"] and now["b"] != first["b"] and table.version == 2 and table.notes() == {}
    with pytest.raises(ValueError, match="other parts"):
        table.replace(frame(("d", 4)), F.col("k"), ["a"])
    table.replace(frame(), F.col("k"), ["c"])
    assert rows(table.read()) == [("a", 1), ("b", 4)]
    # A version that is cut off is not seen; neither is one that another run took.
    (tmp_path / "t/versions/000000000004.json").write_text('{"parts": {')
    assert rows(table.read()) == [("a", 1), ("b", 4)] and table.version == 3
    with pytest.raises(Exception, match="000000000004"):
        table.replace(frame(("a", 9)), F.col("k"), ["a"])
    assert rows(table.read()) == [("a", 1), ("b", 4)]
    assert table.vacuum() >= 3 and rows(table.read()) == [("a", 1), ("b", 4)]


def test_rows_are_replaced_by_key(spark, tmp_path):
    table = versions.KeyedTable(spark, f"file://{tmp_path}/k", ["id"], buckets=8)
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v int")
    assert table.lookup(frame(("a", 1))) is None and table.upsert(frame()) == 0
    table.upsert(frame(*[(f"i{k}", k) for k in range(50)]))
    before = table.table.parts()
    assert table.upsert(frame(("i7", 700), ("i7", 701), ("new", 1))) <= 2
    after = table.table.parts()
    assert sum(before.get(p) != f for p, f in after.items()) <= 2
    want = {f"i{k}": k for k in range(50)} | {"i7": 701, "new": 1}
    assert dict(rows(table.read())) == want
    assert rows(table.lookup(spark.createDataFrame([("i7",), ("i8",), ("no",)], "id string"))) == [("i7", 701), ("i8", 8)]
    with pytest.raises(ValueError, match="null"):
        table.upsert(frame((None, 1)))


CATALOG = "token string, assembly_accession string, assembly_level string, refseq_category string, is_latest boolean"


def test_resolution_cache_survives_runs(spark, tmp_path):
    catalog = spark.createDataFrame([("E coli", "GCF_1.1", "Contig", "na", True), ("E coli", "GCF_2.1", "Complete Genome", "na", True), ("B x", "GCA_3.1", "Contig", "na", True)], CATALOG)
    tokens = lambda *t: spark.createDataFrame([(x, "species_name") for x in t], "Host_Token string, Token_Type string")
    cache = resolve.resolution_cache(spark, f"file://{tmp_path}/c", buckets=4)
    first = resolve.resolve_tokens(tokens("E coli", "nobody", "E coli"), catalog, cache)
    assert rows(first, "token", "assembly_accession", "Resolution_Rank") == [("E coli", "GCF_1.1", 2), ("E coli", "GCF_2.1", 1)]
    # Known tokens, even those without assemblies, are not looked up again: another catalog changes nothing for them.
    other = spark.createDataFrame([("E coli", "GCF_9.1", "Contig", "na", True), ("nobody", "GCF_8.1", "Contig", "na", True), ("B x", "GCA_3.1", "Contig", "na", True)], CATALOG)
    again = resolve.resolution_cache(spark, f"file://{tmp_path}/c", buckets=4)
    assert rows(resolve.resolve_tokens(tokens("E coli", "nobody", "B x"), other, again), "token", "assembly_accession") == [("B x", "GCA_3.1"), ("E coli", "GCF_1.1"), ("E coli", "GCF_2.1")]
    version = again.table.version
    resolve.resolve_tokens(tokens("B x"), other, again).collect()
    assert again.table.version == version == 2


def test_genome_cache(spark, tmp_path):
    assemblies = spark.createDataFrame([("GCF_1.1", "E coli"), ("GCF_2.1", "B x")], "assembly_accession string, organism_name string").withColumns({c: F.lit(None).cast("string") for c in ("strain", "assembly_name", "assembly_level", "refseq_category")})
    records = resolve.host_records(assemblies, "2024-01-01")
    assert {r["Source"] for r in records.collect()} == {"assembly_resolver"}
    cache = resolve.genome_cache(spark, f"file://{tmp_path}/g", buckets=4)
    done = spark.createDataFrame([("GCF_1_1", "/g/1.fna", "success"), ("GCF_2_1", "", "failed")], "Host_ID string, path string, status string")
    resolve.record_downloads(cache, records, done)
    assert rows(resolve.cached_genomes(cache.read()), "Host_ID", "path") == [("GCF_1_1", "/g/1.fna")]
    assert resolve.record_downloads(cache, records, done.filter("status = 'failed'").select("Host_ID", F.lit("/g/2.fna").alias("path"), F.lit("success").alias("status"))) == 1
    assert rows(resolve.cached_genomes(cache.read(), "B x"), "Host_ID") == [("GCF_2_1",)] and cache.read().count() == 2


def test_assembly_records(spark):
    assemblies = spark.createDataFrame([("GCF_1.1", "n", "E coli", 562, None, "Complete Genome", "reference genome", True), ("GCA_2.1", "m", "B x", None, "s", None, None, None)], "assembly_accession string, assembly_name string, organism_name string, species_taxid int, strain string, assembly_level string, refseq_category string, is_latest boolean")
    downloads = spark.createDataFrame([("GCF_1.1", "failed"), ("GCF_1.1", "success")], "Assembly_Accession string, status string")
    found = resolve.assembly_records(assemblies, downloads, "2024-01-01")
    assert len(found.columns) == 17
    assert rows(found, "Assembly_Accession", "Strain", "Assembly_Level", "BioSample", "Is_RefSeq", "Download_Status", "Metadata_Only") == [("GCA_2.1", "s", "Contig", "-", False, "failed", False), ("GCF_1.1", "-", "Complete Genome", "-", True, "success", False)]
    assert {r["Download_Status"] for r in resolve.assembly_records(assemblies, downloads.limit(0), "d", metadata_only=True).collect()} == {"success"}


# Private sources


def source(tmp_path, name, phages, host="H1", sequence="ACGT"):
    folder = tmp_path / "private" / name
    put(folder, "metadata.csv", "Phage_ID,Host_ID,Host_name,Source_DB,interaction,note\n" + "".join(f"{p},{host},E coli,{name},Virulent,n{p}\n" for p in phages))
    put(folder, "phage.fasta", "".join(f">{p} x\n{sequence}\n" for p in phages) + ">spare\nAC\n")
    put(folder, f"hosts/{host}.fna", f">{host}\n{sequence}\n")
    return folder


def test_only_changed_sources_are_written(spark, tmp_path):
    roots, path = [f"file://{tmp_path}/private"], f"file://{tmp_path}/store"
    source(tmp_path, "one", ["A", "B"])
    source(tmp_path, "two", ["C"])
    source(tmp_path, "bad", ["D"]).joinpath("phage.fasta").unlink()
    first = private.sync_sources(spark, path, roots)
    assert first["written"] == ["one", "two"] and [s["source_db"] for s in first["skipped"]] == ["bad"]
    parts = private.stored_private(spark, path)["fact_phages"].parts()
    assert private.sync_sources(spark, path, roots)["written"] == [] and private.stored_private(spark, path)["fact_phages"].version == 1
    shutil.rmtree(tmp_path / "private/two")
    source(tmp_path, "two", ["C", "E"])
    second = private.sync_sources(spark, path, roots)
    assert (second["written"], second["unchanged"]) == (["two"], ["one"])
    now = private.stored_private(spark, path)["fact_phages"].parts()
    assert sum(parts.get(p) != f for p, f in now.items()) == 1
    public = spark.createDataFrame([("P", "ncbi", "public"), ("A", "one", "private")], "Phage_ID string, Source_DB string, source_type string")
    hosts = spark.createDataFrame([("H9", "public")], "Host_ID string, source_type string")
    star = private.with_private({"fact_phages": public, "dim_hosts": hosts}, private.stored_rows(spark, path))
    whole = private.ingest({"fact_phages": public, "dim_hosts": hosts}, private.union_all([private.read_source(spark, f"{roots[0]}/{n}")[0] for n in ("one", "two")]))
    for name in ("fact_phages", "dim_hosts", "private_interactions", "private_phage_host_associations", "private_entity_attributes"):
        assert rows(star[name], *sorted(star[name].columns)) == rows(whole[name], *sorted(whole[name].columns))
    shutil.rmtree(tmp_path / "private/one")
    assert private.sync_sources(spark, path, roots)["removed"] == ["one"]
    assert rows(private.stored_rows(spark, path)["fact_phages"], "Phage_ID") == [("C",), ("E",)]
    private.remove_source(spark, path, "two")
    assert all(t.count() == 0 for t in private.stored_rows(spark, path).values())


def test_sequence_artifacts(spark, tmp_path):
    source(tmp_path, "one", ["A", "B"])
    source(tmp_path, "two", ["C"], sequence="GGGG")
    source(tmp_path, "three", ["F"])
    manifest = private.build_manifest(spark, [f"file://{tmp_path}/private"])
    assert manifest["sources_valid"] == 3
    stats = private.write_artifacts(spark, manifest, f"file://{tmp_path}/out")
    assert stats == {"sources_processed": 3, "phages_written": 4, "hosts_written": 1, "host_duplicates_identical": 1, "host_duplicates_conflicting": 1, "missing_phage_ids": 0, "missing_host_ids": 0}
    mapping = json.loads((tmp_path / "out/phage_mapping.json").read_text())
    assert sorted(mapping) == ["one", "three", "two"]
    assert rows(readers.fasta(spark, mapping["one"]), "id", "sequence") == [("A", "ACGT"), ("B", "ACGT")]
    assert list(json.loads((tmp_path / "out/host_mapping.json").read_text())) == ["H1"]
    assert rows(json_map(spark, f"file://{tmp_path}/out/phage_mapping.json"))[0][0] == "one"
    assert private.write_artifacts(spark, {"sources": []}, f"file://{tmp_path}/none")["sources_processed"] == 0


def test_links_lead_to_one_source(spark, tmp_path):
    place = source(tmp_path, "one", ["A"])
    (tmp_path / "other").mkdir()
    (tmp_path / "other/alias").symlink_to(place)
    roots = [f"file://{tmp_path}/private", f"file://{tmp_path}/other"]
    assert [p.rsplit("/", 1)[1] for p in private.discover_sources(spark, roots)] == ["one"]
    assert private.discover_sources(spark, roots, [f"file://{tmp_path}/other/alias"]) == []


# Buckets and shards


def test_bucketed_star_joins_without_a_shuffle(spark):
    from strandloom.plans.adapters import star

    tables = star(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = writers.write_star(tables, "bucketed_", buckets=4)
        profile = views.complete_profile(stored)
        plan = profile._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 8 and "Exchange" not in plan
        assert "Exchange" in views.complete_profile(tables)._jdf.queryExecution().executedPlan().toString()
        assert rows(profile) == rows(views.complete_profile(tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


@pytest.mark.parametrize("readers_", [1, 3, 25])
def test_shards_are_disjoint_and_whole(spark, tmp_path, readers_):
    edges = spark.range(20).select(F.concat(F.lit("P"), "id").alias("Phage_ID"), F.concat(F.lit("H"), (F.col("id") % 3).cast("string")).alias("Host_ID"))
    sequences_ = lambda c: edges.select(F.col(c).alias("id")).distinct().withColumn("sequence", F.lit("ACGT"))
    path = f"file://{tmp_path}/samples"
    pairs.write_samples(pairs.indexed(edges, sequences_("Phage_ID"), sequences_("Host_ID")), path)
    parts = [[r["idx"] for b in pairs.shard_batches(spark, path, 4, k, readers_) for r in b] for k in range(readers_)]
    assert [i for p in parts for i in p] == list(range(20)) and max(map(len, parts)) - min(map(len, parts)) <= 1
    assert parts == [[r["idx"] for r in pairs.shard(spark, path, k, readers_).collect()] for k in range(readers_)]
    with pytest.raises(ValueError, match="reader"):
        pairs.shard(spark, path, readers_, readers_)


def test_whole_small_files(spark, tmp_path):
    files.write_text(spark, f"file://{tmp_path}/x/y.json", "ä")
    files.write_text(spark, f"file://{tmp_path}/x/y.json", "ö")
    assert files.read_text(spark, f"file://{tmp_path}/x/y.json") == "ö"
    with pytest.raises(ValueError, match="no file"):
        readers.merged_fasta(spark, [f"file://{tmp_path}/none.fa", put(tmp_path, "empty.fa", "")])
    assert readers.merged_fasta(spark, [f"file://{tmp_path}/none.fa", put(tmp_path, "a.fa", ">a\nC\n")]).count() == 1
