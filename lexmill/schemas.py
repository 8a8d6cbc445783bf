"""Descriptive schemas of the outputs: a leaf names its type, or its values parted by bars; a list holds the schema of its elements."""

# The shipped schemas.
ENTITY_TYPES = (
    "Product", "ComponentType", "Component", "ParameterSpec", "Unit", "FailureMode", "RepairAction", "MaintenanceTask", "Tool", "Consumable", "ProcessStep", "State", "MachineMode", "TestSpec", "RatingPlate", "Document",
)
RELATION_TYPES = (
    "hasPart", "belongsTo", "instanceOf", "hasSpec", "hasUnit", "affects", "mitigatedBy", "requiresTool", "requiresConsumable", "precedes", "appliesDuring", "verifies", "hasRatingPlate", "connectedTo",
)
DOCUMENT = {
    "document_code": "string", "title": "string", "datasource_code": "string", "language": "string", "ingestion_id": "string", "created_utc": "string",
    "source": {"uri": "string", "filename": "string", "mime_type": "string", "checksum_sha256": "string", "page_count": "integer"},
    "metadata": {"product_hint": "string", "model_hint": "string", "brand_hint": "string", "doc_type": "string", "version": "string", "year": "integer"},
    "sections": [
        {
            "section_id": "string", "parent_id": "string", "title": "string", "title_normalized": "string", "role": "main|toc|header|footer|warning|table|figure|suspicious", "level": "integer", "language": "string",
            "language_confidence": "number", "page_start": "integer", "page_end": "integer", "char_start": "integer", "char_end": "integer", "text": "string", "is_suspect": "boolean",
            "tables": [{"table_id": "string", "page": "integer", "caption": "string", "n_rows": "integer", "n_cols": "integer", "csv": "string"}],
            "figures": [{"figure_id": "string", "page": "integer", "caption": "string"}],
            "tags": ["string"],
        }
    ],
    "extraction_constraints": {"skip_patterns": ["string"], "max_chars_per_section": "integer", "allowed_entities": ["string"], "allowed_relations": ["string"]},
    "quality": {"text_coverage_ratio": "number", "tables_extracted": "integer", "figures_detected": "integer", "notes": "string"},
    "discarded_blocks": [{"reason": "toc|header|non_en|too_short|pattern_match", "text": "string", "page": "integer"}],
}
GRAPH = {
    "document_code": "string", "ingestion_id": "string", "extraction_version": "string", "datasource_code": "string",
    "extractor": {"model": "string", "prompt_id": "string", "temperature": "number", "max_tokens": "integer"},
    "entities": [
        {
            "id": "string", "type": "|".join(ENTITY_TYPES), "name": "string", "aliases": ["string"], "notes": "string",
            "spans": [{"section_id": "string", "page": "integer", "char_start": "integer", "char_end": "integer", "source_text": "string"}],
            "confidence": "number", "ofType_ref": "string", "unit_raw": "string", "nominal_value": "number", "min_value": "number", "max_value": "number", "tolerance": "number", "machine_mode_ref": "string",
        }
    ],
    "relations": [{"type": "|".join(RELATION_TYPES), "from_ref": "string", "to_ref": "string", "spans": [{"section_id": "string", "page": "integer", "source_text": "string"}], "confidence": "number"}],
    "provenance": {"overall_confidence": "number", "sections_used": ["string"], "notes": "string"},
    "quality": {"json_valid": "boolean", "entities_count": "integer", "relations_count": "integer", "warnings": ["string"]},
}
