"""Options of a run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class EngineConfig:
    """What is read, how duplicates and mailboxes are treated, and where results go.

    Worker counts and batch sizes are Spark's business and have no option here.
    """

    root: str = "."
    output_dir: str = "out"
    rules: str = ""
    email_suffixes: list[str] = field(default_factory=list)
    person_tables: list[str] = field(default_factory=list)
    person_key: list[str] = field(default_factory=lambda: ["ID", "id", "student_id", "person_id"])
    exclude: list[str] = field(default_factory=list)
    include_hidden: bool = False
    file_hash: str = "sha256"
    duplicate_files: str = "collapse"
    duplicate_evidence: str = "collapse"
    max_findings_per_file: int = 0
    #: Fields of a record and levels of an object that are read at most; 0: all.
    xml_max_fields: int = 0
    structured_max_depth: int = 0
    #: fast: scopes by tags alone; structured: records of the parsed tree.
    xml_mode: str = "fast"
    hub_limit: int = 200
    person_evidence: bool = False
    html_report: bool = False
    profile: bool = False
    resume: str = ""
    output_format: str = "parquet"

    def __post_init__(self) -> None:
        choices = {
            "file_hash": ("sha256", "md5"), "duplicate_files": ("scan", "report", "collapse"), "duplicate_evidence": ("scan", "report", "collapse"),
            "resume": ("", "scanning", "clustering", "reidentification", "reporting"), "xml_mode": ("fast", "structured"), "output_format": ("parquet", "csv", "json", "orc"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
