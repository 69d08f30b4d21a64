"""Configurations: small JSON files that the driver reads."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

# Sections that a configuration has to have, and words that no key of a collector's may hold.
SECTIONS = ("paths", "pipeline", "asr", "llm")
SECRETS = ("sessionid", "cookie", "cookies", "token", "password", "secret")


def fingerprint(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def secret_paths(config, path: str = "") -> list[str]:
    """Where keys tell credentials, at any depth."""
    if isinstance(config, dict):
        own = [f"{path}.{k}".lstrip(".") for k in config if any(s in str(k).lower() for s in SECRETS)]
        return own + [p for k, v in config.items() for p in secret_paths(v, f"{path}.{k}".lstrip("."))]
    return [p for n, v in enumerate(config) for p in secret_paths(v, f"{path}[{n}]")] if isinstance(config, list) else []


def load(path: str, sections: tuple[str, ...] = SECTIONS, secrets: bool = False) -> dict:
    """A configuration with all sections and, unless they are allowed, no credentials."""
    config = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(config, dict) or (missing := [s for s in sections if s not in config]):
        raise ValueError(f"the configuration lacks {', '.join(missing) if isinstance(config, dict) else 'an object'}")
    if not secrets and (found := secret_paths(config)):
        raise ValueError(f"credentials don't belong in a configuration: {', '.join(found)}")
    return config
