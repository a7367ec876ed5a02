"""Settings of a run, in one frozen object. Nothing here is global state."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# The verdicts of the match ladder, the methods and the error types.
VERIFIED, FRAGMENTED, FUZZY, NEAR = "verified", "verified_fragmented", "verified_fuzzy", "near_match"
NOT_FOUND, NO_TEXT_LAYER, MISSING = "not_found", "no_text_layer", "pdf_missing"
STATUSES = (VERIFIED, FRAGMENTED, FUZZY, NEAR, NOT_FOUND, NO_TEXT_LAYER, MISSING)
VERIFIED_GROUP = (VERIFIED, FRAGMENTED, FUZZY)
METHODS = ("exact", "fragmented", "fuzzy", "none")
ERROR_TYPES = ("api_error", "no_text", "json_parse_failed", "invalid_structure", "invalid_finding_item", "missing_fields", "hallucinated_code")
# Column order of the deliverables.
FINDING_COLUMNS = ("snippet_id", "filename", "label_category", "label_code", "snippet", "page_number", "reasoning", "confidence", "timestamp", "finding_hash")
ERROR_COLUMNS = ("filename", "label_category", "error_type", "error_message", "raw_text", "timestamp")
AUDIT_COLUMNS = ("verification_status", "match_score", "match_method", "matched_text")
# Document kinds that a folder is searched for.
NATIVE_SUFFIXES, OFFICE_SUFFIXES = (".pdf",), (".docx", ".doc", ".pptx", ".ppt")


@dataclass(frozen=True)
class Settings:
    fuzzy_threshold: float = 97.0
    near_threshold: float = 93.0
    min_fuzzy_length: int = 40
    min_text_length: int = 50
    strip_boilerplate: bool = True
    margin: float = 0.12
    boilerplate_share: float = 0.25
    include_confidence: bool = True
    max_documents: int | None = None
    dry_run: bool = False
    provider: str = "fake"
    model: str = ""
    max_answer_tokens: int = 8192
    tokens_per_minute: int = 667_000
    safety_margin: float = 0.9
    window_seconds: int = 60
    history: int = 5
    poll_seconds: float = 30.0
    poll_deadline_seconds: float = 48 * 3600.0
    request_timeout_seconds: float = 300.0
    download_timeout_seconds: float = 600.0
    upload_attempts: int = 3
    upload_wait_seconds: float = 5.0
    throttled_attempts: int = 5
    throttled_wait_seconds: float = 60.0
    #: True: matched_text slices the display text at case-folded offsets; False: offsets are mapped first.
    compat_matched_text: bool = True

    @property
    def token_budget(self) -> int:
        return max(int(self.tokens_per_minute * self.safety_margin), 1)

    @classmethod
    def from_env(cls, **given) -> Settings:
        """Every setting from QUOTARIUM_<NAME> where that is set, unless given."""
        env = {f.name: os.environ[f"QUOTARIUM_{f.name.upper()}"] for f in fields(cls) if os.environ.get(f"QUOTARIUM_{f.name.upper()}")}
        return cls(**(cls.parsed(env) | given))

    @classmethod
    def parsed(cls, texts: dict[str, str]) -> dict:
        """Settings as text, each in its own type; an unknown name or a value of another type is refused."""
        kinds, out = {f.name: f.type for f in fields(cls)}, {}
        for name, text in texts.items():
            if name not in kinds:
                raise ValueError(f"no setting {name!r}; there are {sorted(kinds)}")
            kind = kinds[name].split(" ")[0]
            if kind == "bool":
                if text.lower() not in ("true", "false", "1", "0", "yes", "no"):
                    raise ValueError(f"{name} is true or false, not {text!r}")
                out[name] = text.lower() in ("true", "1", "yes")
            else:
                out[name] = {"int": int, "float": float, "str": str}[kind](text)
        return out
