"""Star tables, provenance tables and ingest contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Names, order and types of the star tables' columns.
TABLES: dict[str, str] = {
    "fact_phages": (
        "Phage_ID string, Source_DB string, Length int, GC_content double, Taxonomy string, Completeness string, Host string, "
        "Lifestyle string, Cluster string, Subcluster string, Provider_Name string, Provider_Release string, "
        "Provider_Snapshot_Date string, Provider_Schema_Profile string, Input_Source_Key string, Input_File string, "
        "Input_Retrieved_At string, source_type string"
    ),
    "dim_proteins": (
        "Phage_ID string, Protein_ID string, Protein_source string, Function_prediction_source string, Start int, Stop int, "
        "Strand string, Product string, Protein_classification string, Molecular_weight double, Aromaticity double, "
        "Instability_index double, Isoelectric_point double, Helix_fraction double, Turn_fraction double, Sheet_fraction double, "
        "Reduced_coefficient double, Oxidized_coefficient double, Source_DB string, source_type string"
    ),
    "dim_terminators": (
        "Phage_ID string, terminator_type string, terminator_start int, terminator_end int, confidence_score double, "
        "Sense string, Loc string, Source_DB string, source_type string"
    ),
    "dim_anti_crispr": "Phage_ID string, Protein_ID string, Source string, Source_DB string, source_type string",
    "dim_virulent_factors": "Phage_ID string, Protein_ID string, aligned_protein_vfdb string, Source_DB string, source_type string",
    "dim_transmembrane_proteins": (
        "Phage_ID string, Protein_ID string, protein_length int, predicted_tmhs_number int, exp_aa_in_tmhs double, "
        "exp_first_60_aa double, total_prob_n_in double, possible_n_term string, inside_source string, inside_start int, "
        "inside_end int, tm_helix_source string, tm_helix_start int, tm_helix_end int, outside_source string, "
        "outside_start int, outside_end int, Source_DB string, source_type string"
    ),
    "dim_trna_tmrna": (
        "Phage_ID string, trna_tmrna_id string, source string, trna_type string, start_pos int, stop_pos int, Strand string, "
        "length int, permuted string, sequence string, Source_DB string, source_type string"
    ),
    "dim_antimicrobial_resistance_genes": "Phage_ID string, Protein_ID string, aligned_protein_card string, Source_DB string, source_type string",
    "dim_crispr_arrays": (
        "Phage_ID string, crispr_id string, duplicated_spacers int, crispr_start int, crispr_end int, crispr_length int, "
        "potential_orientation_at_percent string, crispr_direction string, consensus_repeat string, repeat_id_crisprdb string, "
        "nb_crisprs_same_repeat int, repeat_length int, spacers_count int, mean_spacer_size double, std_dev_spacers double, "
        "repeats_matching_consensus int, ratio_repeats_match_total double, conservation_repeats_pct double, ebcons_repeats double, "
        "conservation_spacers_pct double, ebcons_spacers double, repeat_plus_spacer_length double, ratio_repeat_spacer_length double, "
        "crispr_found_in_db string, evidence_level int, Source_DB string, source_type string"
    ),
    "dim_hosts": (
        "Host_ID string, Species_Name string, Strain_Name string, Assembly_Accession string, Assembly_Name string, "
        "Assembly_Level string, Genome_Length bigint, GC_Content double, RefSeq_Category string, Download_Date string, "
        "Source string, source_type string"
    ),
    "dim_assembly_metadata": (
        "Assembly_Accession string, Assembly_Name string, Organism_Name string, Species_TaxID int, Strain string, "
        "Assembly_Level string, RefSeq_Category string, BioSample string, BioProject string, FTP_Path string, "
        "Submission_Date string, Is_Latest boolean, Quality_Score int, Is_RefSeq boolean, Download_Status string, "
        "Download_Date string, Metadata_Only boolean"
    ),
    "dim_phage_host_links": (
        "Phage_ID string, Host_Species string, Host_Full_Name string, Assembly_Accession string, Assembly_Level string, "
        "RefSeq_Category string, Link_Quality string"
    ),
    "private_interactions": "Phage_ID string, Host_ID string, Host_name string, interaction string, Source_DB string, source_type string",
    "private_entity_attributes": (
        "Source_DB string, source_type string, entity_type string, entity_id string, attribute_key string, attribute_value string, value_type string"
    ),
    "private_phage_host_associations": "Phage_ID string, Host_ID string, Source_DB string, source_type string",
    "dataset_provenance": (
        "provider_name string, provider_release string, provider_snapshot_date string, provider_schema_profile string, "
        "feature string, source_key string, normalized_source_db string, source_url string, local_path string, "
        "retrieved_at string, file_size string, sha256 string, etag string, last_modified string, "
        "detected_tabular_columns string, schema_fingerprint string, status string, error_message string"
    ),
    # "pbi_version" is a column name of existing tables, so it is fixed.
    "pipeline_run_provenance": (
        "pipeline_run_timestamp string, provider_name string, provider_release string, provider_snapshot_date string, "
        "provider_schema_profile string, provider_api_base_url string, provider_provenance_mode string, pbi_version string, "
        "git_commit string, download_records_count string"
    ),
}

DIMENSIONS = tuple(t for t in TABLES if t.startswith("dim_") and t not in ("dim_hosts", "dim_assembly_metadata", "dim_phage_host_links"))


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


@dataclass(frozen=True)
class Contract:
    """Which columns a feature file must and may have, other names for them, and which are numbers."""

    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    numeric: tuple[str, ...] = ()


# The columns of the nine feature files.
_PHAGE = {"Phage_id": "Phage_ID", "source_db": "Source_DB"}
_PROTEIN = {**_PHAGE, "Protein_id": "Protein_ID"}
CONTRACTS: dict[str, Contract] = {
    "phages": Contract(
        ("Phage_ID", "Source_DB"),
        (
            "Length", "GC_content", "Taxonomy", "Completeness", "Host", "Lifestyle", "Cluster", "Subcluster", "Provider_Name",
            "Provider_Release", "Provider_Snapshot_Date", "Provider_Schema_Profile", "Input_Source_Key", "Input_File", "Input_Retrieved_At",
        ),
        {**_PHAGE, "phage_id": "Phage_ID", "Phage_Source": "Source_DB", "Phage_source": "Source_DB", "GC%": "GC_content"},
        numeric=("Length", "GC_content"),
    ),
    "proteins": Contract(
        ("Phage_ID", "Protein_ID", "Source_DB"),
        (
            "Protein_source", "Function_prediction_source", "Start", "Stop", "Strand", "Product", "Protein_classification",
            "Molecular_weight", "Aromaticity", "Instability_index", "Isoelectric_point", "Helix_fraction", "Turn_fraction",
            "Sheet_fraction", "Reduced_coefficient", "Oxidized_coefficient",
        ),
        _PROTEIN,
        numeric=(
            "Start", "Stop", "Molecular_weight", "Aromaticity", "Instability_index", "Isoelectric_point", "Helix_fraction",
            "Turn_fraction", "Sheet_fraction", "Reduced_coefficient", "Oxidized_coefficient",
        ),
    ),
    "terminators": Contract(("Phage_ID", "Source_DB"), ("Terminator", "Start", "Stop", "Sense", "Loc", "Confidence"), _PHAGE, numeric=("Start", "Stop", "Confidence")),
    "anti_crispr": Contract(("Phage_ID", "Protein_ID", "Source_DB"), ("Source",), _PROTEIN),
    "virulent_factors": Contract(("Phage_ID", "Protein_ID", "Source_DB"), ("Aligned_Protein_in_VFDB",), _PROTEIN),
    "transmembrane_proteins": Contract(
        ("Phage_ID", "Protein_ID", "Source_DB"),
        (
            "Length", "PredictedTMHsNumber", "ExpnumberofAAsinTMHs", "Expnumberfirst60AAs", "TotalprobofNin", "POSSIBLENterm",
            "Insidesource", "Insidestart", "Insideend", "TMhelixsource", "TMhelixstart", "TMhelixend", "Outsidesource",
            "Outsidestart", "Outsideend",
        ),
        _PROTEIN,
        numeric=(
            "Length", "PredictedTMHsNumber", "ExpnumberofAAsinTMHs", "Expnumberfirst60AAs", "TotalprobofNin", "Insidestart",
            "Insideend", "TMhelixstart", "TMhelixend", "Outsidestart", "Outsideend",
        ),
    ),
    "trna_tmrna": Contract(("Phage_ID", "Source_DB"), ("t(m)RNA_ID", "Source", "t(m)RNA", "Start", "Stop", "Strand", "Length", "Permuted", "Sequence"), _PHAGE, numeric=("Start", "Stop", "Length")),
    "antimicrobial_resistance_genes": Contract(("Phage_ID", "Protein_ID", "Source_DB"), ("Aligned_Protein_in_CARD",), _PROTEIN),
    "crispr_arrays": Contract(
        ("Phage_ID", "CRISPR_ID", "Source_DB"),
        (
            "Duplicated_Spacers", "CRISPR_Start", "CRISPR_End", "CRISPR_Length", "Potential_Orientation (AT%)", "CRISPRDirection",
            "Consensus_Repeat", "Repeat_ID (CRISPRdb)", "Nb_CRISPRs_with_same_Repeat (CRISPRdb)", "Repeat_Length", "Spacers_Nb",
            "Mean_size_Spacers", "Standard_Deviation_Spacers", "Nb_Repeats_matching_Consensus", "Ratio_Repeats_match/TotalRepeat",
            "Conservation_Repeats (% identity)", "EBcons_Repeats", "Conservation_Spacers (% identity)", "EBcons_Spacers",
            "Repeat_Length_plus_mean_size_Spacers", "Ratio_Repeat/mean_Spacers_Length",
            "CRISPR_found_in_DB (if sequence IDs are similar)", "Evidence_Level",
        ),
        _PHAGE,
        numeric=(
            "Duplicated_Spacers", "CRISPR_Start", "CRISPR_End", "CRISPR_Length", "Nb_CRISPRs_with_same_Repeat (CRISPRdb)",
            "Repeat_Length", "Spacers_Nb", "Mean_size_Spacers", "Standard_Deviation_Spacers", "Nb_Repeats_matching_Consensus",
            "Ratio_Repeats_match/TotalRepeat", "Conservation_Repeats (% identity)", "EBcons_Repeats",
            "Conservation_Spacers (% identity)", "EBcons_Spacers", "Repeat_Length_plus_mean_size_Spacers",
            "Ratio_Repeat/mean_Spacers_Length", "Evidence_Level",
        ),
    ),
}

# Which file column feeds which star column, where the names differ.
RENAMED: dict[str, dict[str, str]] = {
    "dim_terminators": {"terminator_type": "Terminator", "terminator_start": "Start", "terminator_end": "Stop", "confidence_score": "Confidence"},
    "dim_virulent_factors": {"aligned_protein_vfdb": "Aligned_Protein_in_VFDB"},
    "dim_antimicrobial_resistance_genes": {"aligned_protein_card": "Aligned_Protein_in_CARD"},
    "dim_transmembrane_proteins": {
        "protein_length": "Length", "predicted_tmhs_number": "PredictedTMHsNumber", "exp_aa_in_tmhs": "ExpnumberofAAsinTMHs",
        "exp_first_60_aa": "Expnumberfirst60AAs", "total_prob_n_in": "TotalprobofNin", "possible_n_term": "POSSIBLENterm",
        "inside_source": "Insidesource", "inside_start": "Insidestart", "inside_end": "Insideend", "tm_helix_source": "TMhelixsource",
        "tm_helix_start": "TMhelixstart", "tm_helix_end": "TMhelixend", "outside_source": "Outsidesource",
        "outside_start": "Outsidestart", "outside_end": "Outsideend",
    },
    "dim_trna_tmrna": {"trna_tmrna_id": "t(m)RNA_ID", "trna_type": "t(m)RNA", "start_pos": "Start", "stop_pos": "Stop"},
    "dim_crispr_arrays": {
        "potential_orientation_at_percent": "Potential_Orientation (AT%)", "crispr_direction": "CRISPRDirection",
        "repeat_id_crisprdb": "Repeat_ID (CRISPRdb)", "nb_crisprs_same_repeat": "Nb_CRISPRs_with_same_Repeat (CRISPRdb)",
        "spacers_count": "Spacers_Nb", "mean_spacer_size": "Mean_size_Spacers", "std_dev_spacers": "Standard_Deviation_Spacers",
        "repeats_matching_consensus": "Nb_Repeats_matching_Consensus", "ratio_repeats_match_total": "Ratio_Repeats_match/TotalRepeat",
        "conservation_repeats_pct": "Conservation_Repeats (% identity)", "conservation_spacers_pct": "Conservation_Spacers (% identity)",
        "repeat_plus_spacer_length": "Repeat_Length_plus_mean_size_Spacers", "ratio_repeat_spacer_length": "Ratio_Repeat/mean_Spacers_Length",
        "crispr_found_in_db": "CRISPR_found_in_DB (if sequence IDs are similar)",
    },
}
