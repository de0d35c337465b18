"""Where a dataset's address leads: what Spark can read itself, and what must be fetched first."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlparse


@dataclass(frozen=True)
class Source:
    kind: str
    path: str
    needs_staging: bool


def resolve(address: str) -> Source:
    """By scheme: s3 goes through s3a; hub, web and episode-dataset addresses must be staged; the rest is a path of a file system Spark knows."""
    scheme = urlparse(address).scheme.lower()
    rest = address.split("://", 1)[-1]
    if scheme in ("s3", "s3a", "s3n"):
        return Source("object_store", f"s3a://{rest}", False)
    if scheme in ("http", "https"):
        return Source("web", address, True)
    if scheme == "hf":
        return Source("hub", rest, True)
    if scheme == "openx":
        return Source("episodes", rest, True)
    return Source("file_system", address, False)


def stage(address: str, fetch) -> str:
    """Path of an address, fetched by fetch(kind, path) where Spark can't read it."""
    source = resolve(address)
    return fetch(source.kind, source.path) if source.needs_staging else source.path
