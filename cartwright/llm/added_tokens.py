"""Strings that a ``tokenizers`` file takes out of a text before anything is encoded."""

from __future__ import annotations

import json
from collections.abc import Iterator

import regex


class AddedTokens:
    """The added tokens of a file, special ones included, as its library finds them by default.

    The leftmost one counts and of several that begin there the longest; the
    flags ``single_word``, ``lstrip`` and ``rstrip`` are those of the file.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            added = json.load(file).get("added_tokens") or []
        added.sort(key=lambda token: -len(token["content"]))
        self.ids = [token["id"] for token in added]
        self._contents = [token["content"] for token in added]
        self._find = regex.compile("|".join(map(self._pattern, added))).finditer if added else None

    @staticmethod
    def _pattern(token: dict) -> str:
        found = regex.escape(token["content"])
        if token.get("single_word"):
            found = rf"(?<!\w){found}(?!\w)"
        return rf"({r'\s*' if token.get('lstrip') else ''}{found}{r'\s*' if token.get('rstrip') else ''})"

    def parts(self, text: str) -> Iterator[str | int]:
        """``text`` in order: the ids of added tokens and the texts between them, empty ones left out."""
        if not any(content in text for content in self._contents):
            if text:
                yield text
            return
        at = 0
        for match in self._find(text):
            if match.start() > at:
                yield text[at : match.start()]
            yield self.ids[match.lastindex - 1]
            at = match.end()
        if at < len(text):
            yield text[at:]
