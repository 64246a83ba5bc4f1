"""Job files, tools on the path, and command-line flags."""

from __future__ import annotations

import json
import re
import shutil
from dataclasses import dataclass

from pagewright.schema import OcrConfig, PipelineConfig, SuppressorConfig

NEEDED_TOOLS = ("check_deps", "enumerate_pdfs")

# Exit codes of the command line.
EXIT_CODES = {"no_files": 1, "extraction": 1, "dependencies": 2, "config": 3, "structure": 5, "write": 6}


class ConfigError(Exception):
    """kind is read, parse or invalid."""

    def __init__(self, kind: str, message: str) -> None:
        super().__init__(f"{kind}: {message}")
        self.kind = kind


@dataclass(frozen=True)
class Job:
    id: str
    input_glob: str
    output_dir: str
    artifacts_dir: str | None
    tools: tuple[str, ...]


def _parse(raw: str) -> object:
    try:
        import yaml
    except ImportError:
        yaml = None
    try:
        return yaml.safe_load(raw) if yaml else json.loads(raw)
    except Exception as e:
        raise ConfigError("parse", str(e)) from e


def load_job(source: str | dict) -> Job:
    """A validated job from a file (YAML where its parser is installed, else JSON) or a mapping. The first data source counts."""
    if isinstance(source, dict):
        got = source
    else:
        try:
            with open(source, encoding="utf-8") as f:
                raw = f.read()
        except OSError as e:
            raise ConfigError("read", str(e)) from e
        got = _parse(raw)
    if not isinstance(got, dict) or not isinstance(got.get("id"), str):
        raise ConfigError("parse", "a mapping with a text id is needed")
    if not got["id"].strip():
        raise ConfigError("invalid", "missing id")
    first = (got.get("datasources") or [{}])[0] or {}
    outputs = got.get("outputs") or {}
    if first.get("path") is None or outputs.get("dir") is None:
        raise ConfigError("invalid", "missing datasources.path or outputs.dir")
    tools = tuple(t.get("name") for t in got.get("tools") or [])
    for name in NEEDED_TOOLS:
        if name not in tools:
            raise ConfigError("invalid", f"missing tool: {name}")
    return Job(got["id"], first["path"], outputs["dir"], outputs.get("artifacts_dir"), tools)


def check_tools(which=shutil.which) -> tuple[bool, list[str]]:
    """(whether extraction and rendering can run, the tools that are missing)."""
    missing = [t for t in ("pdftotext", "pdftoppm", "tesseract") if which(t) is None]
    return not {"pdftotext", "pdftoppm"} & set(missing), missing


# The packages that bring a tool, and the hint's wording.
PACKAGES = {"pdftotext": ("poppler-utils", "pkg-config", "clang"), "tesseract": ("tesseract-ocr", "tesseract-ocr-ind")}
HINT = "Dependency missing. Install via Nala:\n  sudo nala install "


def install_hint(missing: list[str]) -> str:
    """How to install missing tools; empty if pdftoppm alone is missing."""
    packages = [p for tool, names in PACKAGES.items() if tool in missing for p in names]
    return HINT + " ".join(packages) if packages else ""


@dataclass(frozen=True)
class Flags:
    config: PipelineConfig
    dump_steps: bool
    artifacts: bool
    per_doc_dir: bool


def parse_flags(args: list[str]) -> Flags:
    """The command line: presence flags, ``--name value`` and ``--name=value``, each in its one form; others are ignored."""

    def value(name: str) -> str | None:
        at = args.index(name) + 1 if name in args else len(args)
        return args[at] if at < len(args) and not args[at].startswith("--") else None

    forced = None
    for a in args:
        if a.startswith("--with-ocr"):
            forced = {"--with-ocr": True, "--with-ocr=on": True, "--with-ocr=off": False}.get(a)
            break
    dpi = value("--ocr-dpi")
    keep = value("--keep-lines")
    if keep is not None:
        try:
            re.compile(keep)
        except re.error:
            keep = None
    ocr = OcrConfig(requested=forced, lang=value("--ocr-lang") or "ind+eng", dpi=int(dpi) if dpi and dpi.isdigit() else 300)
    config = PipelineConfig(suppressor=SuppressorConfig(keep_lines=keep), ocr=ocr, law_mode=(value("--law-mode") or "auto").lower(), strict="--strict" in args)
    return Flags(config, "--dump-steps" in args, "--artifacts=on" in args, "--per-doc-dir=off" not in args)
