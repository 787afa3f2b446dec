"""Source files: where they come from, what identifies them, and how results are written."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import tomllib
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import IO
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20


class SourceError(RuntimeError):
    pass


@dataclass(frozen=True)
class Spec:
    name: str
    urls: tuple[str, ...]
    least_bytes: int = 1


def load_specs(path: str | Path) -> list[Spec]:
    """``[sources.NAME]`` tables with ``urls`` and, if wanted, ``least_bytes``."""
    told = tomllib.loads(Path(path).read_text(encoding="utf-8")).get("sources", {})
    specs = [Spec(n, tuple(s.get("urls", ())), int(s.get("least_bytes", 1))) for n, s in sorted(told.items())]
    if not specs or any(not s.urls for s in specs):
        raise SourceError("every source needs urls")
    return specs


def unsigned(url: str, prefixes: tuple[str, ...] = ("x-amz-",)) -> str:
    parts = urlsplit(url)
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not k.lower().startswith(prefixes)]
    return urlunsplit(parts._replace(query=urlencode(kept)))


def fingerprint(path: str | Path) -> dict[str, object]:
    """Bytes, SHA-256 and MD5, read in chunks."""
    sha, md5, size = hashlib.sha256(), hashlib.md5(), 0
    with open(path, "rb") as f:
        while chunk := f.read(CHUNK):
            sha.update(chunk)
            md5.update(chunk)
            size += len(chunk)
    return {"bytes": size, "sha256": sha.hexdigest(), "md5": md5.hexdigest()}


def fetch(spec: Spec, folder: str | Path, opener: Callable[[str], IO[bytes]], expected_md5: str | None = None) -> dict[str, object]:
    """Tries the URLs in order; the first complete download is kept under its digest, moved into place at once."""
    failures = []
    Path(folder).mkdir(parents=True, exist_ok=True)
    for url in spec.urls:
        handle, name = tempfile.mkstemp(dir=folder)
        try:
            with os.fdopen(handle, "wb") as out, opener(url) as source:
                while chunk := source.read(CHUNK):
                    out.write(chunk)
            found = fingerprint(name)
            if found["bytes"] < spec.least_bytes:  # type: ignore[operator]
                raise SourceError(f"only {found['bytes']} bytes")
            if expected_md5 and found["md5"].casefold() != expected_md5.casefold():  # type: ignore[attr-defined]
                raise SourceError("another MD5 than announced")
            target = Path(folder, f"{spec.name}-{found['sha256'][:16]}")  # type: ignore[index]
            os.replace(name, target)
            return found | {"name": spec.name, "url": unsigned(url), "path": str(target)}
        except (OSError, SourceError) as error:
            failures.append(f"{unsigned(url)}: {error}")
            if os.path.exists(name):
                os.unlink(name)
    raise SourceError(f"{spec.name}: " + "; ".join(failures))


def verify(path: str | Path, entry: dict[str, object]) -> None:
    """The file is the one that a manifest names; MD5 only counts where it is given."""
    found = fingerprint(path)
    for key in ("bytes", "sha256", "md5"):
        want = entry.get(key)
        if want is None and key == "md5":
            continue
        if str(found[key]).casefold() != str(want).casefold():
            raise SourceError(f"{path}: {key} is {found[key]}, the manifest has {want}")


def stable_manifest(results: list[dict], previous: dict[str, dict] | None = None) -> dict[str, dict]:
    """By source; an unchanged file keeps the time at which it was first retrieved."""
    out = {}
    for r in results:
        old = (previous or {}).get(r["name"])
        kept = {"retrieved_at": old["retrieved_at"]} if old and old.get("sha256") == r["sha256"] and "retrieved_at" in old else {}
        out[r["name"]] = {k: v for k, v in r.items() if k not in ("name", "path")} | kept
    return dict(sorted(out.items()))


def canonical_json(value: object, pretty: bool = False) -> str:
    """Sorted keys, no NaN; compact for digests, or indented with a line end for files."""
    if pretty:
        return json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False, allow_nan=False) + "\n"
    return json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False, allow_nan=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def write_at_once(path: str | Path, text: str) -> None:
    """Readers see the old file or the new one, never a part."""
    path = Path(path)
    handle, name = tempfile.mkstemp(dir=path.parent)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            out.write(text)
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def write_ledger(decisions: DataFrame, path: str, order: str = "source_index") -> None:
    """One JSON object a line, ordered by record, nulls kept; the folder holds ordered parts, written by all executors."""
    lines = decisions.select(F.col(order).alias("_order"), F.to_json(F.struct(*decisions.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.repartitionByRange("_order").sortWithinPartitions("_order").select("value").write.mode("overwrite").text(path)


def review_ledger(decisions: DataFrame, key: str = "source_index", references: tuple[str, ...] = ("matched", "retained")) -> DataFrame:
    """The removed rows and all rows that they refer to."""
    gone = decisions.where("decision = 'removed'")
    every = F.array_union(F.array(key), F.flatten(F.array(*[F.coalesce(F.col(r), F.array().cast("array<bigint>")) for r in references])))
    return decisions.join(gone.select(F.explode(every).alias(key)).distinct(), key, "left_semi")
