"""Spellings of whole licence files: titles, rights lines, line breaks, endings.

Texts are looked up by digest, so each spelling that is in use is a text of its
own. The folder ``licenses`` holds whole texts by SPDX identifier.
"""

from __future__ import annotations

import re
import textwrap
from collections.abc import Iterator
from pathlib import Path

# Usual first lines of short licences, and the line after them.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD License",
                     'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License", "The BSD License"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License", "0BSD"),
}
RIGHTS = ("", "All rights reserved.")
#: Widths that short texts are filled to, besides paragraphs on one line.
WIDTHS = range(64, 101)

_PARAGRAPHS = re.compile(
    r" (?=The above copyright notice and|THE SOFTWARE IS|THIS SOFTWARE IS|[123]\. (?:Redis|Neither))"
)
_COPYRIGHT = re.compile(r"(?im)^[ \t]*(copyright|\(c\)|©)[^\n]*$")
_ENDINGS = re.compile(
    r"\n *END OF TERMS AND CONDITIONS|\n *(?:APPENDIX: |Appendix: )?How to (?:apply|Apply) ", re.M
)


def short_spellings(name: str, text: str) -> Iterator[str]:
    """A short licence under its titles, filled to all usual widths.

    Lines that start with "copyright" are no part of the canonical form, so where
    a text's lines end makes a difference.
    """
    paragraphs = _PARAGRAPHS.split(text)
    bodies = {}
    for form in (paragraphs, [re.sub(r"^[123]\. ", "* ", p) for p in paragraphs]):
        for width in (10**6, *WIDTHS):
            lines = []
            for paragraph in form:
                indent = " " * re.match(r"([123]\.|\*)? ?", paragraph).end()
                lines.append(textwrap.fill(
                    paragraph, width, subsequent_indent=indent,
                    break_long_words=False, break_on_hyphens=False,
                ))
            body = "\n".join(lines)
            bodies.setdefault(" ".join(_COPYRIGHT.sub("", body).split()), body)
    for title in ("", *TITLES.get(name, ())):
        for rights in RIGHTS:
            for body in bodies.values():
                yield "\n".join(filter(None, (title, rights, body)))


def long_spellings(text: str) -> Iterator[str]:
    """A whole text as it is and with a line a paragraph, with and without what
    follows its terms, its links by either protocol."""
    ends = [None, *(m.start() for m in _ENDINGS.finditer(text))]
    first_end = text.find("END OF TERMS AND CONDITIONS")
    if first_end >= 0:
        ends.append(first_end + len("END OF TERMS AND CONDITIONS"))
    found = set()
    for end in ends:
        for part in (text[:end], text[:end].replace("https://", "http://")):
            paragraphs = re.split(r"\n[ \t]*\n", part)
            found |= {part, "\n".join(" ".join(p.split()) for p in paragraphs)}
    yield from sorted(found)


def whole_texts() -> Iterator[tuple[str, str]]:
    """``(license, text)`` of every spelling of the texts in the folder."""
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        for text in long_spellings(path.read_text(encoding="utf-8")):
            yield path.stem, text
