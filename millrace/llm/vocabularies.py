"""Where the public tokenizers' vocabulary files lie: on every machine, outside this repository."""

from __future__ import annotations

import os

FOLDER = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str, folder: str = FOLDER) -> str:
    return os.path.join(folder, name)
