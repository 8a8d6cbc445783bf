"""Rules of the document structurer, as data."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any

# The shipped rule set.
SKIP = {"footer": "citiz service manual\\s+\\d+$", "header": "^[A-Z\\s]+\\|$", "page_number": "^\\s*\\d+\\s*$", "decoration": "^[\\-|\\s─═]+$"}
SECTIONS = {"level1": "^\\d+\\s+[A-Z][A-Z\\s&]+$", "level2": "^\\d+\\.\\d+\\s+.+$", "level3": "^\\d+\\.\\d+\\.\\d+\\s+.+$"}
FIGURE_WORDS = ("diagram", "view", "schematic", "overview")
WARNING_WORDS = ("warning", "caution", "danger", "note", "important")
DIMENSION_WORDS = ("mm", "kg", "width", "height", "depth", "dimension")
ELECTRICAL_WORDS = ("voltage", "hz", "amp", "watt", "v ")
MODEL_CODES = ("c110", "d120", "c170")
BRAND_WORDS = ("delonghi", "krups", "magimix", "nespresso")
PLATE_BRANDS = ("nespresso", "delonghi", "koenig", "krups", "magimix", "turmix")
PLATE_REGIONS = ("eu", "ch", "at", "us", "uk", "apac", "me")
IMPLICIT_HEADINGS = ("^([A-Z][A-Za-z0-9\\s,&-]+):?$", "^([A-Z][A-Z\\s/&-]+)$")
WARNING_PATTERNS = (
    "(WARNING|CAUTION|DANGER|IMPORTANT|ATTENTION)", "(not compatible|incompatible)", "(do not|never|avoid).{0,50}(mix|combine|use with)",
    "(must not|cannot be used|will not work)", "^Note:?|^Nota:?",
)


@dataclass(frozen=True)
class RatingPlate:
    enabled: bool = True
    title_keywords: tuple[str, ...] = ("rating plate", "rating plates")
    brands: tuple[str, ...] = PLATE_BRANDS
    region_tokens: tuple[str, ...] = PLATE_REGIONS
    default_tags: tuple[str, ...] = ("rating_plate", "brand_specific")


@dataclass(frozen=True)
class Implicit:
    enabled: bool = True
    heading_patterns: tuple[str, ...] = IMPLICIT_HEADINGS
    max_heading_words: int = 8
    min_block_chars: int = 40


@dataclass(frozen=True)
class Warnings:
    enabled: bool = True
    snippet_window: int = 120
    promote_role_max_chars: int = 600
    patterns: tuple[str, ...] = WARNING_PATTERNS


@dataclass(frozen=True)
class RuleConfig:
    """One vertical's rules; the defaults are the product manuals' rules."""

    name: str = "product_technical"
    enabled: bool = True
    datasource_code: str = "SRC_DOCS_PIPELINE5"
    language: str = "en"
    skip_start_pages: int = 1
    skip_end_pages: int = 1
    skip: dict[str, str] = field(default_factory=lambda: dict(SKIP))
    section_patterns: dict[str, str] = field(default_factory=lambda: dict(SECTIONS))
    figure_keywords: tuple[str, ...] = FIGURE_WORDS
    warning_keywords: tuple[str, ...] = WARNING_WORDS
    component_list_pattern: str = "^\\s*\\d+\\)"
    dimensions: tuple[str, ...] = DIMENSION_WORDS
    electrical: tuple[str, ...] = ELECTRICAL_WORDS
    model_codes: tuple[str, ...] = MODEL_CODES
    brand: tuple[str, ...] = BRAND_WORDS
    dotted_leader_threshold: int = 3
    min_pipe_columns: int = 3
    min_consistent_rows: int = 3
    max_separator_variance: int = 2
    min_text_coverage: float = 0.7
    max_chars_per_section: int | None = 10000
    rating_plate: RatingPlate = RatingPlate()
    implicit: Implicit = Implicit()
    warnings: Warnings = Warnings()
    allowed_entities: tuple[str, ...] = ()
    allowed_relations: tuple[str, ...] = ()
    source_dir: str | None = None
    output_dir: str | None = None
    document_glob: str = "*.pdf"
    json_indent: int = 2
    json_ascii: bool = False

    def require_dirs(self) -> tuple[str, str]:
        if not self.source_dir or not self.output_dir:
            raise ValueError(f"pipeline {self.name} needs source_dir and output_dir")
        return self.source_dir, self.output_dir


def _fill(base: Any, values: dict) -> Any:
    known = {f.name for f in fields(base)}
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known and not is_dataclass(getattr(base, k))})


def from_mapping(tree: dict, name: str = "product_technical") -> RuleConfig:
    """Rules from a configuration tree (a parsed YAML file); missing keys keep their fallback values."""
    pipe = (tree.get("pipelines") or {}).get(name)
    if not pipe or not pipe.get("enabled", False):
        raise ValueError(f"pipeline {name} is missing or disabled")
    sym, pdf, out = pipe.get("symbolic") or {}, tree.get("pdf_processing") or {}, tree.get("output") or {}
    roles, tags, tables = sym.get("role_heuristics") or {}, sym.get("tagging_keywords") or {}, sym.get("table_detection") or {}
    plate = _fill(RatingPlate(title_keywords=("rating plate",), brands=(), region_tokens=(), default_tags=()), sym.get("rating_plate") or {})
    brands, regions = plate.brands or tuple(tags.get("brand") or ()), plate.region_tokens
    plate = replace(plate, title_keywords=tuple(w.lower() for w in plate.title_keywords), brands=tuple(b.strip() for b in brands), region_tokens=tuple(t.lower().strip() for t in regions))
    structural = ((tree.get("filtering") or {}).get("structural_filtering")) or {}
    return RuleConfig(
        name=name, datasource_code=pdf.get("datasource_code", ""), language=pdf.get("default_language", "en"), skip_start_pages=int(pdf.get("skip_start_pages", 0)), skip_end_pages=int(pdf.get("skip_end_pages", 0)),
        skip=dict(sym.get("skip_header_footer_patterns") or {}), section_patterns=dict(sym.get("section_patterns") or {}), figure_keywords=tuple(roles.get("figure_keywords") or ()), warning_keywords=tuple(roles.get("warning_keywords") or ()),
        component_list_pattern=tags.get("component_list_pattern") or "", dimensions=tuple(tags.get("dimensions") or ()), electrical=tuple(tags.get("electrical") or ()), model_codes=tuple(tags.get("model_codes") or ()), brand=tuple(tags.get("brand") or ()),
        dotted_leader_threshold=tables.get("dotted_leader_threshold", 3), min_pipe_columns=tables.get("min_pipe_columns", 3), min_consistent_rows=tables.get("min_consistent_rows", 3), max_separator_variance=tables.get("max_separator_variance", 2),
        min_text_coverage=float((sym.get("quality_thresholds") or {}).get("min_text_coverage", 0.0)), max_chars_per_section=structural.get("max_chars_per_section"), rating_plate=plate, implicit=_fill(Implicit(), sym.get("implicit_subsections") or {}), warnings=_fill(Warnings(), sym.get("warning_detection") or {}),
        allowed_entities=tuple(sym.get("allowed_entities") or ()), allowed_relations=tuple(sym.get("allowed_relations") or ()), source_dir=pipe.get("source_dir"), output_dir=pipe.get("output_dir"), document_glob=pipe.get("document_glob", "*.pdf"), json_indent=out.get("indent", 2), json_ascii=out.get("ensure_ascii", False),
    )
