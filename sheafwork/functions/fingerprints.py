"""Fingerprints of evidence manifests and chunk documents, and a small JSON schema check, as Arrow-batched functions.

The digests are over JSON texts as Python writes them (sorted keys, ", " and ": "), which no built-in function makes.
"""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _spelt(value) -> bytes:
    return json.dumps(value, sort_keys=True, ensure_ascii=False).encode()


def _object(text: str | None) -> dict | None:
    try:
        found = json.loads(text) if text else None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def manifest_digest(m: dict) -> str:
    parts = [str(m.get("canonical_id", "")).encode(), _spelt(m.get("source_metadata", {})), _spelt((m.get("formal_asset") or {}).get("artifacts", [])), _spelt((m.get("processing_provenance") or {}).get("model_provenance", {}))]
    return hashlib.sha256(b"".join(parts + [_spelt(item) for item in m.get("evidence_items", [])])).hexdigest()


CHUNK_KEYS = ("chunk_id", "canonical_id", "content_type", "sequence_order", "modalities", "evidence_ids", "overlap_evidence_ids", "temporal_range", "image_sequence_range", "source_artifacts", "verification_status")


def chunk_digest(c: dict) -> str:
    empty = {"modalities": [], "evidence_ids": [], "overlap_evidence_ids": [], "source_artifacts": [], "canonical_id": "", "content_type": "", "verification_status": "not_checked"}
    told = {k: c.get(k, empty.get(k)) for k in CHUNK_KEYS}
    told["modalities"] = sorted(told["modalities"])
    told["source_artifacts"] = sorted(told["source_artifacts"], key=lambda a: str(a.get("file_name", "")))
    return hashlib.sha256(_spelt(told)).hexdigest()


def chunks_digest(d: dict, prints: list[str]) -> str:
    return hashlib.sha256(str(d.get("source_manifest_fingerprint", "")).encode() + _spelt(d.get("chunking_policy", {})) + "".join(prints).encode()).hexdigest()


@F.pandas_udf(StringType())
def manifest_fault(text: pd.Series) -> pd.Series:
    """First fault of an evidence manifest (JSON text): json, schema_version, verification_status, fingerprint; null if sound."""

    def one(t):
        m = _object(t)
        if m is None:
            return "json"
        if m.get("schema_version") != "evidence-manifest-v1":
            return "schema_version"
        if (m.get("evidence_summary") or {}).get("verification_status") != "not_checked" or any(i.get("verification_status") != "not_checked" for i in m.get("evidence_items", [])):
            return "verification_status"
        return None if m.get("manifest_fingerprint") == manifest_digest(m) else "fingerprint"

    return text.map(one)


@F.pandas_udf(StringType())
def chunks_fault(text: pd.Series) -> pd.Series:
    """First fault of a chunk document (JSON text): json, schema_version, verification_status, totals, order, chunk_fingerprint, fingerprint."""

    def one(t):
        d = _object(t)
        if d is None:
            return "json"
        if d.get("schema_version") != "evidence-chunks-v1":
            return "schema_version"
        summary, chunks = d.get("summary") or {}, d.get("chunks", [])
        if summary.get("verification_status") != "not_checked" or any(c.get("verification_status") != "not_checked" for c in chunks):
            return "verification_status"
        ids = [i for c in chunks for i in c.get("evidence_ids", [])]
        if chunks and (summary.get("total_evidence_referenced"), summary.get("unique_evidence_referenced")) != (len(ids), len(set(ids))):
            return "totals"
        if any(c.get("chunk_id") != f"chk_{n:06d}" or c.get("sequence_order") != n for n, c in enumerate(chunks, 1)):
            return "order"
        prints = [chunk_digest(c) for c in chunks]
        if any(c.get("chunk_fingerprint") != p for c, p in zip(chunks, prints, strict=True)):
            return "chunk_fingerprint"
        return None if d.get("chunks_fingerprint") == chunks_digest(d, prints) else "fingerprint"

    return text.map(one)


_KINDS = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}


def schema_violation(value, schema: dict, path: str = "$") -> str | None:
    """The first place where a value isn't as a JSON schema says; of its words: type, enum, const, pattern, minimum, minLength,
    required, properties, additionalProperties, items, anyOf."""
    kinds = schema.get("type")
    if kinds:
        allowed = [kinds] if isinstance(kinds, str) else kinds
        if not any(isinstance(value, _KINDS[k]) and not (k in ("integer", "number") and isinstance(value, bool)) for k in allowed):
            return f"{path}: type"
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        return f"{path}: enum"
    if "anyOf" in schema and all(schema_violation(value, s, path) for s in schema["anyOf"]):
        return f"{path}: anyOf"
    if isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{path}: pattern"
        if len(value) < schema.get("minLength", 0):
            return f"{path}: minLength"
    if isinstance(value, (int, float)) and not isinstance(value, bool) and value < schema.get("minimum", float("-inf")):
        return f"{path}: minimum"
    if isinstance(value, dict):
        if missing := [k for k in schema.get("required", []) if k not in value]:
            return f"{path}.{missing[0]}: required"
        known = schema.get("properties", {})
        for k in sorted(value):
            if k in known:
                found = schema_violation(value[k], known[k], f"{path}.{k}")
            else:
                found = f"{path}.{k}: additional" if schema.get("additionalProperties") is False else None
            if found:
                return found
    if isinstance(value, list) and "items" in schema:
        return next((v for n, x in enumerate(value) if (v := schema_violation(x, schema["items"], f"{path}[{n}]"))), None)
    return None


def schema_faults(schema: dict):
    """A function of a JSON text column: the first violation of the schema, null if there is none."""

    @F.pandas_udf(StringType())
    def fault(text: pd.Series) -> pd.Series:
        def one(t):
            try:
                return schema_violation(json.loads(t), schema) if t is not None else "$: json"
            except ValueError:
                return "$: json"

        return text.map(one)

    return fault
