"""Environment and file placeholders in source and target options."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from pathlib import Path

# The two placeholder forms a job file may use.
ENV_PLACEHOLDER = re.compile(r"\$\{env:(.*)\}")
FILE_PLACEHOLDER = re.compile(r"\$\{file:(.*)\}")


class UnresolvedPlaceholder(ValueError):
    """Strict mode met a placeholder it cannot replace as a whole."""


def _resolve(key: str, value: str, strict: bool) -> str:
    env = ENV_PLACEHOLDER.search(value)
    file = None if env else FILE_PLACEHOLDER.search(value)
    match = env or file
    if match is None:
        return value
    if strict and match.group(0) != value:
        raise UnresolvedPlaceholder(f"option '{key}' mixes a placeholder with other text")
    if env:
        found = os.environ.get(env.group(1))
    else:
        try:
            found = Path(file.group(1)).read_text(encoding="utf-8")
        except OSError:
            found = None
    if found is None and strict:
        raise UnresolvedPlaceholder(f"option '{key}': nothing found for its placeholder")
    return value if found is None else found


def resolve_options(options: Mapping[str, str], strict: bool = False) -> dict[str, str]:
    """Options with each placeholder value replaced by what it names.

    The whole value is replaced by the first match, which reaches to the last
    closing brace. A value that names an environment variable is never tried as
    a file. What cannot be found stays as it is, unless ``strict``.
    """
    return {key: _resolve(key, value, strict) for key, value in options.items()}
