"""Texts of the blocks of a page in plain Python: what the expressions are held against."""

from __future__ import annotations

import html as _html
import re

_PIECE = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)")
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _classes(attributes: str) -> set[str]:
    m = _CLASS.search(attributes)
    return set((m.group(1) or m.group(2) or m.group(3) or "").split()) if m else set()


def block_texts(page: str, tag: str, wanted: str, dropped: frozenset[str]) -> list[str]:
    """Text of every ``tag`` block of class ``wanted``; '' for a block without own text.

    Text inside a nested block of a ``dropped`` class does not count. Text pieces are
    trimmed and joined by one blank.
    """
    posts: list[list[str]] = []
    opened: list[str] = []      # kind of each open ``tag``: 'post', 'mute' or ''
    live: list[int] = []        # posts that are open now, outermost first
    for closing, name, attributes, text in _PIECE.findall(page):
        if text:
            piece = _html.unescape(text).strip()
            if piece and "mute" not in opened:
                for index in live:
                    posts[index].append(piece)
        elif name.lower() != tag or attributes.endswith("/"):
            continue
        elif closing:
            if opened and opened.pop() == "post":
                live.pop()
        else:
            classes = _classes(attributes)
            if not wanted or wanted in classes:
                opened.append("post")
                live.append(len(posts))
                posts.append([])
            else:
                opened.append("mute" if live and classes & dropped else "")
    return [" ".join(p) for p in posts]
