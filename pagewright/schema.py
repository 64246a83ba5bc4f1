"""Table schemas and the pipeline's configuration."""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction

from pagewright.functions.patterns import DEFAULT_RULES, RuleSet

PAGES = "doc_id string, page_idx int, text string"
OVERRIDES = "doc_id string, page_idx int, seq int, text string"
GROUND_TRUTH = "doc_id string, bab bigint, pasal bigint"

#: Members stand in alphabetical order, so that JSON made from it has sorted keys.
DOCUMENT_META = (
    "doc_id string, engine string, "
    "found struct<bab: bigint, mengingat: boolean, menimbang: boolean, pasal: bigint, penjelasan: boolean>, "
    "metrics struct<character_coverage: double, coverage_pages: double, leak_rate: double, split_violations: bigint>, "
    "ocr struct<dpi: int, enabled: boolean, lang: string, ocr_run_pages: array<int>, oem: int, psm: int, ran: boolean, skipped_reason: string>, "
    "p95_latency_ms_per_page bigint, page_count int, "
    "stats struct<hyphens_fixed: bigint, removed_footer: bigint, removed_header: bigint, removed_lines_sample: array<string>, suppressor_overrun: bigint>, "
    "suspect_pages array<int>, timing_ms_per_page array<bigint>, timestamps struct<finished_ms: bigint, started_ms: bigint>"
)


@dataclass(frozen=True)
class SuppressorConfig:
    """``ratio`` is exact: a line must recur on at least that share of the pages."""

    ratio: Fraction = Fraction(3, 5)
    keep_lines: str | None = None
    most_per_page: int = 5
    sample: int = 5
    min_bytes: int = 3
    max_bytes: int = 120


@dataclass(frozen=True)
class OcrConfig:
    requested: bool | None = None
    lang: str = "ind+eng"
    dpi: int = 300
    psm: int = 4
    oem: int = 1

    def __post_init__(self) -> None:
        object.__setattr__(self, "dpi", max(72, self.dpi))


@dataclass(frozen=True)
class PipelineConfig:
    suppressor: SuppressorConfig | None = field(default_factory=SuppressorConfig)
    ocr: OcrConfig = field(default_factory=OcrConfig)
    rules: RuleSet = DEFAULT_RULES
    min_chars: int = 64
    law_mode: str = "auto"
    strict: bool = False
    sample_suspects: int | None = None
