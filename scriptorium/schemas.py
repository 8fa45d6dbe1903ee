"""Schemas of the engine's tables and of the nested documents in their columns.

Columns that hold JSON are strings; ``DOCUMENTS`` has the types to parse them
with. ``ALLOWED`` lists what enumerated columns may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns and types of the tables.
_PAPER = "doi string, pmid long, title string, abstract string, authors string, journal string, journal_issn string, source string, source_date date, source_metadata string"
TABLES = {
    "papers": _PAPER + ", source_type string, source_details string, download_status string, relevance_assessment_raw string, relevance_assessment_json string, evidence_extraction_raw string, evidence_extraction_json string",
    "gene_mentions": "hgnc_id long, paper_gene_symbol string, paper_doi string, source string",
    "tournament_results": "hgnc_id long, selected_dois_json string, tournament_raw_responses_json string",
    "expansion_triage": "hgnc_id long, associations_json string, triage_raw string",
    "panelapp_citations": "hgnc_id long, paper_doi string",
    "journal_metrics": "issn string, openalex_source_id string, openalex_display_name string, two_year_mean_citedness double, fetched_at string",
    "gene_aggregations": "hgnc_id long, assessment_raw string, paper_id_mapping string, filtered_papers_json string, panelapp_context_json string, existing_panel_reviews_json string, unassessed_reports_json string",
    "associations": "id long, hgnc_id long, position long, assessment_json string, mondo_id string, mondo_label string, mondo_match string, mondo_raw string, matched_panels_json string, matched_panels_raw string",
    "variant_frequencies": "variant_id string, hgnc_id long, paper_doi string, quote string, normalization string, gnomad string",
    "llm_batches": "batch_id string, stage string, round int, model string, submitted_at string, ended_at string, collected_at string",
    "llm_requests": "custom_id string, batch_id string, stage string, subject string, round int, model string, status string, stop_reason string, refusal_category string, error_type string, service_tier string, input_tokens long, cache_write_5m_tokens long, cache_write_1h_tokens long, cache_read_tokens long, output_tokens long, rejection string, rejected_answer string, completed_at string",
    "llm_conversations": "stage string, subject string, round int, messages_json string",
    "uploaded_files": "doi string, file_id string, sha256 string, uploaded_at string, expires_at string",
    "pdf_page_limits": "doi string, sha256 string, total_pages int, pages int, input_tokens long, counted_at string",
    "citation_locations": "paper_doi string, quote string, bboxes_json string",
    "ledger": _PAPER + ", relevance_assessment_json string, relevant boolean, download_status string, reported_run string, first_seen date, last_seen date",
    "sync_state": "baseline_year int, last_applied_file_number int, updated_at string",
    "training": "doi string, title string, abstract string, is_relevant boolean, split string",
}

# The keys of the tables.
KEYS = {
    "papers": ("doi",), "gene_mentions": ("paper_doi", "hgnc_id", "source"), "tournament_results": ("hgnc_id",), "expansion_triage": ("hgnc_id",),
    "panelapp_citations": ("hgnc_id", "paper_doi"), "journal_metrics": ("issn",), "gene_aggregations": ("hgnc_id",), "associations": ("hgnc_id", "position"),
    "variant_frequencies": ("variant_id", "paper_doi", "hgnc_id"), "llm_batches": ("batch_id",), "llm_requests": ("custom_id",), "llm_conversations": ("stage", "subject", "round"),
    "uploaded_files": ("doi",), "pdf_page_limits": ("doi",), "citation_locations": ("paper_doi", "quote"), "ledger": ("doi",), "training": ("doi",),
}

# What enumerated columns hold.
ALLOWED = {
    ("papers", "download_status"): ("scheduled", "downloaded", "manual_required"),
    ("ledger", "download_status"): ("scheduled", "downloaded", "manual_required"),
    ("gene_mentions", "source"): ("recent_evidence", "expansion_evidence", "relevance_assessment"),
    ("associations", "mondo_match"): ("gencc", "exact", "broader"),
    ("llm_requests", "status"): ("pending", "succeeded", "refused", "errored", "expired", "canceled"),
    ("training", "split"): ("train", "val", "test"),
}

DOCUMENTS = {
    "relevance": "relevant boolean, screen struct<relevant:boolean,confidence:string,rationale:string,associations:array<struct<gene_symbol:string,disease:string>>>, refused struct<model:string,category:string>",
    "extraction": "gene_evaluations array<struct<hgnc_id:long,paper_gene_symbol:string,disease_entities:array<struct<description:string,inheritance_mode:string,patient_count:long,family_count:long,independent_family_count:long,variants:array<struct<variant:string,quote:string>>,citations:array<struct<quote:string,commentary:string>>,previously_reported_sources:array<struct<title:string,context:string>>>>>>",
    "triage": "array<struct<disease:string,pursued:boolean>>",
}


def of(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def checked(df: DataFrame, table: str) -> DataFrame:
    """The rows in the table's columns; a value that an enumerated column may not hold fails the query."""
    for (name, column), values in ALLOWED.items():
        if name == table:
            bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
            df = df.withColumn(column, F.when(bad, F.raise_error(F.concat(F.lit(f"{table}.{column}: "), F.col(column)))).otherwise(F.col(column)))
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in of(table)))
