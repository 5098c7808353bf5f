"""What a run can be told: read once, from a mapping such as the process environment, and checked."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from .functions import vocabulary as V


@dataclass(frozen=True)
class Options:
    """Settings of a run; an empty text counts as not set."""

    destination: str = ""
    country: str = ""
    images_per_room: int = V.IMAGES_PER_ROOM
    stale_days: int = V.STALE_DAYS
    fresh_days: int = V.FRESH_DAYS
    rescue_soft_vetoes: bool = True

    @classmethod
    def read(cls, values: Mapping[str, str], prefix: str = "MATCHLOOM_") -> Options:
        """Options named ``prefix`` and the field's name in capitals. A value of the wrong kind is an error, not a default."""
        given = {}
        for f in fields(cls):
            text = (values.get(prefix + f.name.upper()) or "").strip()
            if not text:
                continue
            kind = type(f.default)
            if kind is bool:
                if text.lower() not in ("1", "true", "yes", "0", "false", "no"):
                    raise ValueError(f"{f.name}: {text!r} is neither true nor false")
                given[f.name] = text.lower() in ("1", "true", "yes")
            else:
                given[f.name] = kind(text)
        return cls(**given)
