"""Private sources: discovery, validation, manifest, and the ingest that makes the star agree with the sources there are."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin
from ..sources import files, readers
from ..sources.versions import PartitionedTable
from ..sources.writers import fasta_text
from .reshape import entity_attributes, union_all

# What a private source must have.
MANDATORY = ("Phage_ID", "Host_ID", "Host_name", "Source_DB", "interaction")
KINDS = ("temperate", "virulent")
UNKNOWN_HOST = "unknown"
METADATA, SEQUENCES, HOSTS = "metadata.csv", "phage.fasta", "hosts"
HOST_SUFFIXES = (".fna", ".fasta", ".fa")
EXAMPLES = 20
#: Column that numbers the rows of a metadata file from 0; ``read_source`` adds it.
ROW = "_row"


@dataclass
class Validation:
    source: str
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    stats: dict[str, int] = field(default_factory=dict)

    @property
    def valid(self) -> bool:
        return not self.errors


def _examples(rows: DataFrame, column: str) -> tuple[int, str]:
    """(how many distinct, the first few) of a column."""
    ids = rows.select(F.col(column).cast("string")).distinct()
    return ids.count(), ", ".join(str(r[0]) for r in ids.orderBy(column).limit(EXAMPLES).collect())


def _at(rows: DataFrame) -> str:
    """Line numbers of the first few rows, the header being line 1."""
    if ROW not in rows.columns:
        return ""
    return f" in lines {', '.join(str(r[0] + 2) for r in rows.select(ROW).orderBy(ROW).limit(EXAMPLES).collect())}"


def validate(name: str, metadata: DataFrame, phage_ids: DataFrame, host_records: DataFrame, has_hosts: bool = True) -> Validation:
    """Checks of one source: ``metadata`` as text, its FASTA records (id) and those of its host files (Host_ID, id).

    Missing columns and an empty table stop it; every other finding is reported
    with examples, and with lines if ``metadata`` numbers its rows.
    """
    out = Validation(name)
    missing = [c for c in MANDATORY if c not in metadata.columns]
    if missing:
        out.errors.append(f"missing columns: {', '.join(missing)}")
        return out
    extras = [c for c in metadata.columns if c not in (*MANDATORY, ROW)]
    text = lambda c: F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c)
    rows = metadata.select(*[text(c) for c in (*MANDATORY, *extras)], *[ROW] * (ROW in metadata.columns))
    filled = sum((F.coalesce(F.sum((F.col(f"`{c}`") != "").cast("long")), F.lit(0)) for c in extras), F.lit(0))
    facts = rows.agg(F.count("*").alias("rows"), F.countDistinct("Phage_ID").alias("phages"), F.countDistinct("Host_ID").alias("hosts"), filled.alias("extras"), *[F.sum((F.col(c) == "").cast("long")).alias(f"_{c}") for c in MANDATORY]).first()
    out.stats = {"rows": facts["rows"], "phages": facts["phages"], "hosts": facts["hosts"], "extra_attributes": facts["extras"]}
    if not facts["rows"]:
        out.errors.append("no rows")
        return out
    out.errors += [f"{facts[f'_{c}']} empty values in {c}{_at(rows.filter(F.col(c) == ''))}" for c in MANDATORY if facts[f"_{c}"]]
    is_unknown = F.lower("Host_ID") == UNKNOWN_HOST
    ids = host_records.select("Host_ID").distinct()
    checks = [
        ("unknown kinds of interaction", rows.filter(~F.lower("interaction").isin(*KINDS) & (F.col("interaction") != "")), "interaction"),
        ("rows of another source", rows.filter((F.col("Source_DB") != name) & (F.col("Source_DB") != "")), "Source_DB"),
        ("phages without a sequence", rows.join(phage_ids.select(F.col("id").alias("Phage_ID")), "Phage_ID", "left_anti"), "Phage_ID"),
        ("repeated sequence ids", phage_ids.groupBy("id").count().filter("count > 1"), "id"),
    ]
    if has_hosts:
        checks += [
            ("hosts without a file", rows.filter(~is_unknown & (F.col("Host_ID") != "")).join(ids, "Host_ID", "left_anti"), "Host_ID"),
            ("host files with repeated sequence ids", host_records.groupBy("Host_ID", "id").count().filter("count > 1"), "Host_ID"),
            ("host files without a record of their host", ids.join(host_records.filter("id = Host_ID"), "Host_ID", "left_anti").join(rows.select("Host_ID"), "Host_ID", "left_semi"), "Host_ID"),
        ]
    for what, bad, column in checks:
        n, some = _examples(bad, column)
        if n:
            out.errors.append(f"{n} {what}: {some}{_at(bad)}")
    unknown = rows.filter(is_unknown).count()
    if 0 < unknown < facts["rows"]:
        out.errors.append("known and unknown hosts are mixed")
    elif not has_hosts and unknown == 0:
        out.errors.append("no folder of host sequences")
    elif not has_hosts:
        out.warnings.append("no folder of host sequences; all hosts are unknown")
    spare, some = _examples(phage_ids.join(rows.select(F.col("Phage_ID").alias("id")), "id", "left_anti"), "id")
    if spare:
        out.warnings.append(f"{spare} sequences without metadata: {some}")
    repeats = facts["rows"] - rows.select("Phage_ID", "Host_ID", "Source_DB").distinct().count()
    if repeats:
        out.warnings.append(f"{repeats} repeated interactions")
    out.stats["sequences"] = phage_ids.count()
    return out


def discover_sources(spark: SparkSession, roots: list[str], excluded: list[str] = ()) -> list[str]:
    """Folders right below the roots, sorted within each root; each place once, however links lead to it; roots that are absent skipped."""
    out: dict[str, None] = {}
    away = {files.resolved(spark, p) for p in excluded}
    for root in roots:
        for x in files.listed(spark, root):
            place = files.resolved(spark, x.path)
            if x.is_folder and place not in away:
                out.setdefault(place)
    return list(out)


def host_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Host -> its file; of several the first suffix counts."""
    found, chosen = files.listed(spark, f"{folder}/{HOSTS}"), {}
    for suffix in HOST_SUFFIXES:
        for x in found:
            if x.name.endswith(suffix):
                chosen.setdefault(x.name.removesuffix(suffix), x.path)
    return chosen


def read_source(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """(metadata with numbered rows, sequence ids, host records (Host_ID, id), whether there is a folder of hosts).

    The metadata file is read in one piece, for its fields may hold line
    breaks; so its rows come in order. Of several files of a host the first
    suffix counts.
    """
    metadata = readers.delimited(spark, f"{folder}/{METADATA}", keep_empty=True, line_breaks=True).withColumn(ROW, F.monotonically_increasing_id())
    ids = readers.fasta(spark, f"{folder}/{SEQUENCES}").select("id")
    chosen = host_files(spark, folder)
    if chosen:
        stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.(fna|fasta|fa)$", "")
        hosts = readers.fasta(spark, list(chosen.values())).select(F.url_decode(stem).alias("Host_ID"), "id")
    else:
        hosts = spark.createDataFrame([], "Host_ID string, id string")
    return metadata, ids, hosts, any(x.name == HOSTS and x.is_folder for x in files.listed(spark, folder))


def validate_source(spark: SparkSession, folder: str) -> Validation:
    """``validate`` of a folder; missing files and a metadata file without a header stop it."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    have = {x.name for x in files.listed(spark, folder)}
    missing = [f for f in (METADATA, SEQUENCES) if f not in have]
    if missing:
        return Validation(name, [f"missing files: {', '.join(missing)}"])
    if not readers.header(spark, f"{folder}/{METADATA}"):
        return Validation(name, [f"{METADATA} has no header"])
    return validate(name, *read_source(spark, folder))


def validate_roots(spark: SparkSession, roots: list[str], excluded: list[str] = ()) -> dict[str, Validation]:
    """Folder -> validation of every source below the roots; a name that several folders have is an error of each."""
    out = {folder: validate_source(spark, folder) for folder in discover_sources(spark, roots, excluded)}
    names = [v.source for v in out.values()]
    for v in out.values():
        if names.count(v.source) > 1:
            v.errors.append(f"several sources are named {v.source}")
    return out


def source_fingerprint(spark: SparkSession, folder: str) -> str:
    """SHA-256 over the names and SHA-256 digests of metadata, sequences and host files, by name. The files are read and digested by tasks."""
    paths = [x.path for x in files.listed(spark, folder) if x.name in (METADATA, SEQUENCES) and not x.is_folder]
    paths += [x.path for x in files.listed(spark, f"{folder}/{HOSTS}") if not x.is_folder]
    return files.joint_digest(spark, paths)


def build_manifest(spark: SparkSession, roots: list[str], excluded: list[str] = ()) -> dict:
    """What validation found of every source, with its fingerprint."""
    found = validate_roots(spark, roots, excluded)
    sources = [
        {"source_db": v.source, "source_dir": folder, "is_valid": v.valid, "errors": v.errors, "warnings": v.warnings, "stats": v.stats, "fingerprint": source_fingerprint(spark, folder)}
        for folder, v in found.items()
    ]
    n = sum(v.valid for v in found.values())
    return {"roots": list(roots), "sources_found": len(found), "sources_valid": n, "sources_invalid": len(found) - n, "sources": sources}


PRIVATE_TABLES = ("private_interactions", "private_phage_host_associations", "private_entity_attributes", "private_hosts", "fact_phages")


def private_rows(metadata: DataFrame) -> dict[str, DataFrame]:
    """The rows that sources add to each of PRIVATE_TABLES.

    Of rows with equal keys the first counts, whole: by the row number if
    ``metadata`` has one, else by all columns.
    """
    extras = [c for c in metadata.columns if c not in (*MANDATORY, ROW)]
    rows = metadata.withColumn("interaction", F.lower("interaction"))
    order = F.struct(*[ROW] * (ROW in metadata.columns), *[F.col(f"`{c}`") for c in (*MANDATORY, *extras)])

    def first(table: DataFrame, keys: list[str]) -> DataFrame:
        rest = [c for c in (*MANDATORY, *extras) if c not in keys]
        best = table.groupBy(*keys).agg(F.min(order.alias("o")).alias("_f"))
        return best.select(*keys, *[F.col(f"_f.`{c}`").alias(c) for c in rest])

    private = F.lit("private").alias("source_type")
    known = rows.filter(F.lower("Host_ID") != UNKNOWN_HOST)
    whole = first(rows, ["Phage_ID", "Host_ID", "Source_DB"])
    return {
        "fact_phages": first(rows, ["Phage_ID", "Source_DB"]).select("Phage_ID", "Source_DB", F.col("interaction").alias("Lifestyle"), F.col("Host_name").alias("Host"), private),
        "private_hosts": first(known, ["Host_ID"]).select("Host_ID", F.col("Host_name").alias("Species_Name"), F.col("Source_DB").alias("Source"), private),
        "private_interactions": whole.select("Phage_ID", "Host_ID", "Host_name", "interaction", "Source_DB", private),
        "private_phage_host_associations": known.select("Phage_ID", "Host_ID", "Source_DB", private).distinct(),
        "private_entity_attributes": entity_attributes(whole, extras),
    }


def with_private(star: dict[str, DataFrame], rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with exactly the private rows of ``private_rows``; a host that is public stays so."""
    out = dict(star)
    public = lambda t: star[t].filter(F.coalesce("source_type", F.lit("")) != "private")
    out["fact_phages"] = public("fact_phages").unionByName(rows["fact_phages"], allowMissingColumns=True)
    if "dim_hosts" in star:
        hosts = rows["private_hosts"].groupBy("Host_ID").agg(F.min(F.struct("Source", "Species_Name", "source_type")).alias("h")).select("Host_ID", "h.Species_Name", "h.Source", "h.source_type")
        out["dim_hosts"] = public("dim_hosts").unionByName(hosts.join(public("dim_hosts").select("Host_ID"), "Host_ID", "left_anti"), allowMissingColumns=True)
    return out | {t: rows[t] for t in ("private_interactions", "private_phage_host_associations", "private_entity_attributes")}


def ingest(star: dict[str, DataFrame], metadata: DataFrame) -> dict[str, DataFrame]:
    """The star with exactly the private rows that ``metadata`` describes: gone sources vanish, and nothing doubles.

    A pure function: run it again and the result is the same.
    """
    return with_private(star, private_rows(metadata))


def _part(name: str) -> str:
    return hashlib.md5(name.encode()).hexdigest()


def stored_private(spark: SparkSession, path: str) -> dict[str, PartitionedTable]:
    """The private tables on disk, a part per source."""
    return {t: PartitionedTable(spark, f"{path}/{t}") for t in PRIVATE_TABLES}


def sync_sources(spark: SparkSession, path: str, roots: list[str], excluded: list[str] = ()) -> dict[str, list]:
    """Make the stored private tables agree with the sources there are: {"written", "removed", "unchanged", "skipped"}.

    A source whose fingerprint is the stored one is not read again; parts of
    changed and new sources are written, those of gone ones and of sources that
    are no longer valid dropped. ``fact_phages`` keeps the fingerprints and goes
    last, so a run that dies is made up for by the next one.
    """
    manifest = build_manifest(spark, roots, excluded)
    valid = {s["source_db"]: s for s in manifest["sources"] if s["is_valid"]}
    tables = stored_private(spark, path)
    before = dict(json.loads(note) for note in tables["fact_phages"].notes().values())
    changed = [n for n, s in valid.items() if before.get(n) != s["fingerprint"]]
    gone = sorted(set(before) - set(valid))
    out = {
        "written": sorted(changed),
        "removed": gone,
        "unchanged": sorted(set(valid) - set(changed)),
        "skipped": [{"source_db": s["source_db"], "source_dir": s["source_dir"], "errors": s["errors"]} for s in manifest["sources"] if not s["is_valid"]],
    }
    if not changed and not gone:
        return out
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in MANDATORY))
    each = [private_rows(read_source(spark, valid[n]["source_dir"])[0]) for n in changed] or [private_rows(empty)]
    for name in PRIVATE_TABLES:
        rows = union_all([e[name] for e in each])
        source = F.col("Source" if name == "private_hosts" else "Source_DB")
        tables[name].replace(rows, F.md5(source.cast("binary")), [*map(_part, changed), *map(_part, gone)], {_part(n): json.dumps([n, valid[n]["fingerprint"]]) for n in changed})
    return out


def remove_source(spark: SparkSession, path: str, name: str) -> None:
    """Drop a source's part of every stored private table; other parts are not touched."""
    for table in stored_private(spark, path).values():
        if (rows := table.read([])) is not None:
            table.replace(rows, F.lit(""), [_part(name)])


def stored_rows(spark: SparkSession, path: str) -> dict[str, DataFrame] | None:
    """What ``with_private`` takes, from the stored tables; None if nothing was stored yet."""
    rows = {name: table.read() for name, table in stored_private(spark, path).items()}
    return None if any(r is None for r in rows.values()) else rows


def write_artifacts(spark: SparkSession, manifest: dict, folder: str) -> dict[str, int]:
    """Sequence files for lookups in the valid sources of a manifest, and seven counters.

    ``folder``/phages/source=<name>/ gets the records of each source's phages as
    FASTA; ``folder``/phage_mapping.json names them by source, and
    ``folder``/host_mapping.json the file of each host. Of sources with a file
    for one host the first counts; the others are identical to it or conflicting,
    by the files' SHA-256. Records are copied in one job for all sources.
    """
    sources = [s for s in manifest["sources"] if s["is_valid"]]
    stats = dict.fromkeys(("sources_processed", "phages_written", "hosts_written", "host_duplicates_identical", "host_duplicates_conflicting", "missing_phage_ids", "missing_host_ids"), 0)
    stats["sources_processed"] = len(sources)
    phage_mapping, host_mapping = {}, {}
    if sources:
        read = [(i, s["source_db"], readers.delimited(spark, f"{s['source_dir']}/{METADATA}", keep_empty=True, line_breaks=True)) for i, s in enumerate(sources)]
        wanted = pin(union_all([m.select(F.lit(i).alias("_at"), F.lit(n).alias("source"), F.trim("Phage_ID").alias("id"), F.trim("Host_ID").alias("Host_ID")) for i, n, m in read]))
        records = union_all([readers.fasta(spark, f"{s['source_dir']}/{SEQUENCES}").withColumn("source", F.lit(s["source_db"])) for s in sources])
        phages = wanted.select("source", "id").distinct()
        chosen = pin(records.join(phages, ["source", "id"], "left_semi").select("source", "id", "header", "sequence"))
        chosen.select("source", fasta_text(F.col("header"), F.col("sequence")).alias("value")).write.mode("overwrite").partitionBy("source").text(f"{folder}/phages")
        stats["phages_written"] = chosen.count()
        stats["missing_phage_ids"] = phages.join(chosen.select("source", "id"), ["source", "id"], "left_anti").count()
        phage_mapping = {s["source_db"]: f"{folder}/phages/source={s['source_db']}" for s in sources}
        there = [(i, s["source_db"], stem, path) for i, s in enumerate(sources) for stem, path in host_files(spark, s["source_dir"]).items()]
        with_hosts = [s["source_db"] for s in sources if any(x.name == HOSTS and x.is_folder for x in files.listed(spark, s["source_dir"]))]
        hosts = wanted.select("_at", "source", "Host_ID").distinct().filter(F.col("source").isin(with_hosts))
        found = pin(hosts.join(spark.createDataFrame(there, "_at int, source string, Host_ID string, path string"), ["_at", "source", "Host_ID"], "left"))
        stats["missing_host_ids"] = found.filter("path IS NULL").count()
        if paths := sorted({p for *_, p in there}):
            digests = files.file_digests(spark, paths).select(F.url_decode("path").alias("path"), "sha256")
            digested = found.filter("path IS NOT NULL").join(digests, F.url_decode(found["path"]) == digests["path"]).select("_at", "Host_ID", found["path"], "sha256")
            first = digested.groupBy("Host_ID").agg(F.min(F.struct("_at", "path", "sha256")).alias("f"))
            kinds = digested.join(first, "Host_ID").groupBy(F.when(F.col("_at") == F.col("f._at"), "hosts_written").when(F.col("sha256") == F.col("f.sha256"), "host_duplicates_identical").otherwise("host_duplicates_conflicting").alias("kind")).count()
            stats |= {r["kind"]: r["count"] for r in kinds.collect()}
            host_mapping = {r[0]: r[1] for r in first.select("Host_ID", "f.path").collect()}  # no more rows than files that were listed
    files.write_text(spark, f"{folder}/phage_mapping.json", json.dumps(dict(sorted(phage_mapping.items())), indent=2))
    files.write_text(spark, f"{folder}/host_mapping.json", json.dumps(dict(sorted(host_mapping.items())), indent=2))
    return stats
