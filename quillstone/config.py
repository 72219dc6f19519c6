"""Settings of a run, read from the environment once."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import get_type_hints

_TRUE = ("1", "true", "yes")


@dataclass(frozen=True)
class Settings:
    """Each field is read from the variable of its name in capitals; what is not set keeps its default. Text for a
    number that is none raises ValueError."""

    # Names and defaults of the variables.
    ncbi_base: str = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"
    ncbi_email: str = ""
    ncbi_tool: str = "quillstone"
    ncbi_api_key: str | None = None
    database_url: str | None = None
    request_timeout: int = 30
    request_sleep: float = 0.34
    search_limit: int = 50
    target_csv_path: str = "config/target_ingredients.csv"
    bronze_root_dir: str = "bronze"
    bronze_domain_dir: str = "pubmed"
    enable_db_upsert: bool = True
    silver_root_dir: str = "silver"
    silver_domain_dir: str = "paper"
    enable_chunk_db_upsert: bool = False
    silver_batch_id: str | None = None
    gold_root_dir: str = "gold"
    gold_domain_dir: str = "claim"
    enable_claim_db_upsert: bool = False
    gold_test_chunk_limit: int = 100_000
    gold_debug_print_limit: int = 10
    extractor_version: str = "llm_claim_extractor_v1"
    validator_version: str = "claim_validator_v1"
    mapping_version: str = "taxonomy_mapping_v1"
    chunk_max_chars: int = 1000
    chunk_overlap_chars: int = 150
    chunk_version: str = "abstract_char_window_v1"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        kinds = get_type_hints(cls)
        read = {bool: lambda t: t.strip().lower() in _TRUE, int: int, float: float}
        return cls(**{f.name: read.get(kinds[f.name], str)(env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env})

    def folder(self, stage: str, base: str = ".") -> str:
        """Where the batches of a stage ('bronze', 'silver' or 'gold') are."""
        return f"{base.rstrip('/')}/{getattr(self, f'{stage}_root_dir')}/{getattr(self, f'{stage}_domain_dir')}"

    def request(self, **more: str) -> dict[str, str]:
        """The parameters every request carries, then those given; ones without a value are left out."""
        own = {"tool": self.ncbi_tool, "email": self.ncbi_email, "api_key": self.ncbi_api_key, **more}
        return {k: v for k, v in own.items() if v}
