"""Column expressions: casts with sentinels, normalizers, composition, classifiers, scores. No Python UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for "no host".
INVALID_HOSTS = ("-", "na", "none", "null", "nan", "unknown", "unidentified", "uncultured")
# Fixed patterns: identifiers.
ACCESSION = r"^(GCF|GCA)_\d{9}\.\d+$"
SPACED_ACCESSION = r"\b(GCF|GCA)\s+(\d{9}\.\d+)\b"
BIOSAMPLE = r"^SAM(N|D|EA?)\d+$"
BIOPROJECT = r"^PRJ(NA|EA|DB)\d+$"
TAXID = r"^\d+$"
GTDB_SPECIES = r"(?i)\bsp\d{9}\b"
# Scores of assemblies.
CATEGORY_SCORE = {"reference genome": 10000, "representative genome": 5000}
LEVEL_SCORE = {"Complete Genome": 1000, "Chromosome": 500, "Scaffold": 100, "Contig": 50}
LEGACY_CATEGORY_SCORE = {"reference genome": 1000, "representative genome": 500}
LEGACY_LEVEL_SCORE = {"Complete Genome": 100, "Chromosome": 50, "Scaffold": 25}
LATEST_SCORE = 10
# Fixed values: (label, base confidence) by token type, and what each further rank costs.
RESOLUTION = {"assembly_accession": ("accession_in_host_field", 0.95), "species_name": ("species_to_taxid_to_assembly", 0.70), "other": ("fallback", 0.30)}
CONFIDENCE_STEP = 0.10
# Fixed patterns: the census of identifier shapes.
ID_SHAPES = {
    "NCBI_RefSeq": r"^(NC_|NZ_|NP_|YP_|WP_)",
    "GenBank": r"^[A-Z]{1,2}_?\d+\.\d+$",
    "UniProt": r"^[A-Z0-9]{6,10}$",
    "Custom": r"^[A-Za-z0-9_-]+$",
    "Has_Version": r"\.\d+$",
    "Underscore_Separated": r"_",
    "Dot_Separated": r"\.",
    "Pipe_Separated": r"\|",
}


def strip(c: Column) -> Column:
    """Without white space of any kind at either end (SQL ``trim`` only removes spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Null for null, blank and the text ``nan``; otherwise stripped."""
    s = strip(c)
    return F.when((s != "") & (F.lower(s) != "nan"), s)


def number(c: Column, kind: str = "double") -> Column:
    """Text to number: ``-`` and junk become null, integers accept ``12.0``, ``12.6`` and ``1e3``."""
    value = F.nullif(c, F.lit("-")).try_cast("double")
    return value if kind == "double" else F.round(value).try_cast(kind)


def source_type(c: Column) -> Column:
    """``private`` or ``public``."""
    return F.when(F.lower(F.trim(F.coalesce(c, F.lit("")))) == "private", "private").otherwise("public")


def source_label(c: Column) -> Column:
    """Like source_type, but other labels stay as they are."""
    return F.coalesce(F.nullif(F.nullif(F.lower(F.trim(c)), F.lit("nan")), F.lit("")), F.lit("public"))


def finite(c: Column) -> Column:
    """Null instead of NaN and the infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def letters(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``; never through upper(), which can change lengths."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def gc_percent(sequence: Column, ambiguous: str = "count") -> Column:
    """GC share in percent, 2 digits, 0 when empty. ``remove`` leaves ambiguous letters out of the length and counts S as GC."""
    if ambiguous == "count":
        gc, n = letters(sequence, "GCgc"), F.length(sequence)
    else:
        gc, n = letters(sequence, "GCSgcs"), letters(sequence, "ACGTSWUacgtswu")
    return F.when(n > 0, F.round(gc * 100.0 / n, 2)).otherwise(F.when(sequence.isNotNull(), 0.0))


def composition(sequence: Column) -> dict[str, Column]:
    count = {x: letters(sequence, x + x.lower()) for x in "ACGT"}
    n = F.nullif(F.length(sequence), F.lit(0))
    share = lambda *xs: F.round(reduce(lambda a, b: a + b, (count[x] for x in xs)) * 100.0 / n, 2)
    return {f"{x.lower()}_count": c for x, c in count.items()} | {"gc_pct": share("G", "C"), "at_pct": share("A", "T"), "purine_pct": share("A", "G"), "pyrimidine_pct": share("C", "T")}


def size_class(length: Column) -> Column:
    """Small below 10 kb, Medium below 100 kb, else Large."""
    return F.when(length < 10_000, "Small (<10kb)").when(length < 100_000, "Medium (10-100kb)").otherwise("Large (>100kb)")


def size_category(length: Column) -> Column:
    return F.when(length > 200_000, "jumbo").when(length > 50_000, "large").when(length > 10_000, "medium").otherwise("small")


def first_token(header: Column) -> Column:
    """The first word of a header, the whole header if it is blank."""
    word = F.split(strip(header), r"\s+")[0]
    return F.when(word != "", word).otherwise(header)


def header_ids(header: Column) -> dict[str, Column]:
    """The id of a FASTA header by five rules."""
    return {
        "first_word": first_token(header),
        "before_pipe": F.substring_index(header, "|", 1),
        "after_pipe": F.substring_index(header, "|", -1),
        "middle_pipe": F.get(F.split(header, r"\|"), F.lit(1)),
        "full": header,
    }


def protein_header(header: Column) -> dict[str, Column]:
    """Phage id, protein id and the rest of a protein header."""
    parts = F.split(strip(header), r"\s+", 3)
    return {"phage_id": F.get(parts, F.lit(0)), "protein_id": F.get(parts, F.lit(1)), "description": F.coalesce(F.get(parts, F.lit(2)), F.lit(""))}


def valid_host(c: Column) -> Column:
    """Whether a raw host value names any host."""
    return F.coalesce((strip(c) != "") & (strip(c) != "-") & ~c.rlike(r"(?i)unknown|unidentified"), F.lit(False))


def token_type(token: Column) -> Column:
    """assembly_accession, species_name (two words or more, the first capitalized) or other."""
    return F.when(token.rlike(ACCESSION), "assembly_accession").when(token.rlike(r"^\p{Lu}\S*\s+\S"), "species_name").otherwise("other")


def host_tokens(host: Column) -> Column:
    """ARRAY<STRUCT<token, token_type, token_order>> of a raw host field; orders count skipped parts too."""
    fixed = F.regexp_replace(host, SPACED_ACCESSION, "$1_$2")
    parts = F.transform(F.split(fixed, ";"), lambda p, i: F.struct(strip(p).alias("token"), (i + 1).alias("token_order")))
    named = F.filter(parts, lambda p: (p["token"] != "") & ~F.lower(p["token"]).isin(*INVALID_HOSTS) & ~p["token"].rlike(r"(?i)unknown|unidentified"))
    typed = F.transform(named, lambda p: F.struct(p["token"].alias("token"), token_type(p["token"]).alias("token_type"), p["token_order"].alias("token_order")))
    return F.coalesce(typed, F.array().cast("array<struct<token:string,token_type:string,token_order:int>>"))


def identifier_type(c: Column) -> Column:
    """accession, sample, project, taxon, species name or unknown; null for blank text."""
    s = strip(c)
    return (
        F.when(s.rlike(ACCESSION), "assembly_accession")
        .when(s.rlike(BIOSAMPLE), "biosample")
        .when(s.rlike(BIOPROJECT), "bioproject")
        .when(s.rlike(TAXID), "taxid")
        .when(s.rlike(r" |^\p{Lu}"), "species_name")
        .when(s != "", "unknown")
    )


# Which kind of identifier is tried first.
IDENTIFIER_PRIORITY = ("assembly_accession", "biosample", "bioproject", "taxid", "species_name")


def prioritized_identifiers(host: Column) -> Column:
    """ARRAY<STRUCT<priority, position, token, token_type>>, best kind first, unknown kinds dropped."""
    parts = F.transform(host_tokens(host), lambda t: F.struct(identifier_type(t["token"]).alias("kind"), t["token_order"].alias("position"), t["token"].alias("token")))
    order = F.array(*[F.lit(x) for x in IDENTIFIER_PRIORITY])
    ranked = F.transform(parts, lambda p: F.struct(F.array_position(order, p["kind"]).alias("priority"), p["position"].alias("position"), p["token"].alias("token"), p["kind"].alias("token_type")))
    return F.array_sort(F.filter(ranked, lambda p: p["priority"] > 0))


def best_identifier(host: Column) -> Column:
    """The first accession, else the first part of more than one character."""
    tokens = host_tokens(host)
    pick = lambda f: F.get(F.filter(tokens, f), F.lit(0))["token"]
    return F.coalesce(pick(lambda t: t["token"].rlike(ACCESSION)), pick(lambda t: F.length(t["token"]) > 1))


def _first_host(host: Column) -> tuple[Column, Column]:
    usable = valid_host(host) & ~host.rlike(GTDB_SPECIES)
    return usable, F.split(strip(F.split(host, ";")[0]), r"\s+")


def species_name(host: Column) -> Column:
    """Genus and species of the first host; a lone genus stays; placeholders and numbered species give null."""
    usable, words = _first_host(host)
    return F.when(usable & (words[0] != ""), F.array_join(F.slice(words, 1, 2), " "))


def strain_name(host: Column) -> Column:
    """What follows the species; from the word ``strain`` on, without it, if it is there."""
    usable, words = _first_host(host)
    rest = F.array_join(F.slice(words, 3, 10_000), " ")
    marked = strip(F.regexp_replace(F.regexp_extract(rest, r"(?i)strain.*$", 0), "strain", ""))
    return F.when(usable & (F.size(words) > 2), F.when(rest.rlike("(?i)strain"), marked).otherwise(rest))


def normalized_species(c: Column) -> Column:
    """The first two words if the first is capitalized, else an empty text."""
    words = F.split(strip(c), r"\s+")
    return F.when((F.size(words) >= 2) & words[0].rlike(r"^\p{Lu}"), F.array_join(F.slice(words, 1, 2), " ")).otherwise("")


def species_check(c: Column) -> Column:
    """STRUCT<ok, reason>."""
    reason = F.when(F.coalesce(strip(c), F.lit("")) == "", "empty").when(c.rlike(GTDB_SPECIES), "numbered species").when(~strip(c).rlike(r"^\p{Lu}"), "genus not capitalized")
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def _points(c: Column, table: dict[str, int]) -> Column:
    return reduce(lambda acc, kv: acc.when(F.lower(c) == kv[0].lower(), kv[1]), table.items(), F.when(F.lit(False), 0)).otherwise(0)


def assembly_score(category: Column, level: Column, is_latest: Column) -> Column:
    return _points(category, CATEGORY_SCORE) + _points(level, LEVEL_SCORE) + F.when(F.coalesce(is_latest, F.lit(False)), LATEST_SCORE).otherwise(0)


def legacy_assembly_score(category: Column, level: Column) -> Column:
    return _points(category, LEGACY_CATEGORY_SCORE) + _points(level, LEGACY_LEVEL_SCORE)


def is_refseq(accession: Column) -> Column:
    return accession.startswith("GCF_")


def link_quality(accession: Column) -> Column:
    return F.when(is_refseq(accession), "direct").otherwise("genbank")


def host_id(accession: Column) -> Column:
    return F.translate(accession, ".", "_")


def resolution_source(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, v[0]) for k, v in RESOLUTION.items()], F.lit("fallback"))


def base_confidence(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, v[1]) for k, v in RESOLUTION.items()], F.lit(0.30))


def confidence(base: Column, rank: Column) -> Column:
    """Base confidence less a step for each rank after the first, at least 0, 3 digits."""
    return F.round(F.greatest(F.lit(0.0), base - (rank - 1) * CONFIDENCE_STEP), 3)


def column_fingerprint(columns: Column) -> Column:
    """16 hex digits of the SHA-256 of column names joined by bars; empty for no columns."""
    return F.when(F.size(columns) > 0, F.substring(F.sha2(F.concat_ws("|", columns), 256), 1, 16)).otherwise("")


def utc_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stem_of_path(path: Column) -> Column:
    """A file's name without its last ending, which is the source of an annotation file."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def source_from_path(path: Column) -> Column:
    """The part of a file name before the first underscore."""
    return F.split(F.element_at(F.split(path, "/"), -1), "_")[0]
