"""Settings with defaults, from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """The library's parameters: sizes of chunks and uploads, folders, allowed classes, the size of vectors."""

    chunk_size: int = 1000
    chunk_overlap: int = 200
    max_file_mb: int = 100
    upload_folder: str = "uploads"
    classes: tuple[str, ...] = ("History", "Anthropology")
    vector_dims: int = 768


def from_environment(prefix: str = "LEAFWORKS_") -> Settings:
    """Settings where LEAFWORKS_CHUNK_SIZE and the like stand for the defaults; lists are divided by commas."""
    found = {}
    for f in fields(Settings):
        if (value := os.environ.get(prefix + f.name.upper())) is not None:
            kind = type(f.default)
            found[f.name] = tuple(x.strip() for x in value.split(",")) if kind is tuple else kind(value)
    return Settings(**found)
