"""Text blocks of Word and PowerPoint files (the zipped XML formats), with the standard library alone.

There is no layout without rendering, so pages are those that the writing program noted: page breaks of a document, slides of a presentation.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

# Names of the formats' elements.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_HEIGHT = 792.0

Block = tuple[int, int, "str | None", float, float, float]


def word_blocks(content: bytes) -> list[Block]:
    """A block for each paragraph. A page ends at a break that the author set or that was noted when the file was last laid out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    pages: list[list[str]] = [[]]
    for paragraph in root.iter(f"{_W}p"):
        text: list[str] = []
        for e in paragraph.iter():
            if e.tag == f"{_W}t":
                text.append(e.text or "")
            elif e.tag == f"{_W}tab":
                text.append("\t")
            elif e.tag == f"{_W}lastRenderedPageBreak" or (e.tag == f"{_W}br" and e.get(f"{_W}type") == "page"):
                pages[-1].append("".join(text))
                pages.append([])
                text = []
            elif e.tag in (f"{_W}br", f"{_W}cr"):
                text.append("\n")
        pages[-1].append("".join(text))
    return _placed(pages)


def slide_blocks(content: bytes) -> list[Block]:
    """A page for each slide in the files' order, a block for each shape with text, where it stands on the slide."""
    out: list[Block] = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        size = ElementTree.fromstring(z.read("ppt/presentation.xml")).find(f"{_P}sldSz")
        height = float(size.get("cy")) if size is not None else 6858000.0
        names = [n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)]
        for page, name in enumerate(sorted(names, key=lambda n: int(re.findall(r"\d+", n)[-1])), 1):
            own: list[Block] = []
            for shape in ElementTree.fromstring(z.read(name)).iter(f"{_P}sp"):
                lines = ["".join(t.text or "" for t in p.iter(f"{_A}t")) for p in shape.iter(f"{_A}p")]
                if not (text := "\n".join(lines)).strip():
                    continue
                off, ext = shape.find(f".//{_A}off"), shape.find(f".//{_A}ext")
                # a shape without a place of its own takes the layout's, which is never a margin here
                top = float(off.get("y")) / height if off is not None else 0.5
                own.append((page, len(own), text, top * _HEIGHT, (top + (float(ext.get("cy")) / height if ext is not None else 0.0)) * _HEIGHT, _HEIGHT))
            out += own or [(page, 0, None, 0.0, 0.0, _HEIGHT)]
    return out


def _placed(pages: list[list[str]]) -> list[Block]:
    """Paragraphs have no place on the page, so none counts as a header or footer."""
    out: list[Block] = []
    for page, texts in enumerate(pages, 1):
        own = [(page, k, t, _HEIGHT / 2, _HEIGHT / 2, _HEIGHT) for k, t in enumerate(t for t in texts if t.strip())]
        out += own or [(page, 0, None, 0.0, 0.0, _HEIGHT)]
    return out
