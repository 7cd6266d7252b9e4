"""Writes small word-processor files: paragraphs with runs, list numbers and formulas, tables, pictures. The bytes depend on the content alone."""

from __future__ import annotations

from html import escape

from quillframe.operators.control import archive

# Namespaces of the file format, by the prefix used here.
NAMESPACES = {
    "w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "a": "http://schemas.openxmlformats.org/drawingml/2006/main",
    "wp": "http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing",
    "m": "http://schemas.openxmlformats.org/officeDocument/2006/math",
    "v": "urn:schemas-microsoft-com:vml",
}
_SPACES = " ".join(f'xmlns:{k}="{v}"' for k, v in NAMESPACES.items())


def run(text: str, *marks: str) -> str:
    """A run; marks are property elements without their prefix, such as 'b' or 'sz w:val="24"'."""
    given = "".join(f"<w:{m}/>" for m in marks)
    return f'<w:r>{f"<w:rPr>{given}</w:rPr>" if given else ""}<w:t xml:space="preserve">{escape(text, quote=False)}</w:t></w:r>'


def paragraph(*inside: str, style: str | None = None, number: tuple[int, int] | None = None) -> str:
    given = f'<w:pStyle w:val="{style}"/>' if style else ""
    if number:
        given += f'<w:numPr><w:ilvl w:val="{number[1]}"/><w:numId w:val="{number[0]}"/></w:numPr>'
    return f"<w:p>{f'<w:pPr>{given}</w:pPr>' if given else ''}{''.join(inside)}</w:p>"


def table(rows: list[list[str]], *marks: str) -> str:
    """Rows of cell texts."""
    cells = lambda row: "".join(f"<w:tc>{paragraph(run(c))}</w:tc>" for c in row)
    grid = "".join('<w:gridCol w:w="100"/>' for _ in max(rows, key=len, default=[]))
    return f"<w:tbl><w:tblPr>{''.join(f'<w:{m}/>' for m in marks)}</w:tblPr><w:tblGrid>{grid}</w:tblGrid>{''.join(f'<w:tr>{cells(r)}</w:tr>' for r in rows)}</w:tbl>"


def picture(relation: str, cx: int, cy: int) -> str:
    return f'<w:r><w:drawing><wp:inline><wp:extent cx="{cx}" cy="{cy}"/><a:graphic><a:graphicData><a:blip r:embed="{relation}"/></a:graphicData></a:graphic></wp:inline></w:drawing></w:r>'


def build(body: list[str], media: dict[str, bytes] | None = None, numbering: dict[tuple[int, int], tuple[str, str, int]] | None = None, styles: str = "") -> bytes:
    """A file. media: relation id to picture; numbering: (list, level) to format, template and start."""
    parts = {"word/document.xml": f"<w:document {_SPACES}><w:body>{''.join(body)}</w:body></w:document>".encode()}
    relations = "".join(f'<Relationship Id="{k}" Target="media/{k}.png"/>' for k in media or {})
    parts["word/_rels/document.xml.rels"] = f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{relations}</Relationships>'.encode()
    parts |= {f"word/media/{k}.png": data for k, data in (media or {}).items()}
    lists: dict[int, list[str]] = {}
    for (number, level), (kind, template, start) in (numbering or {}).items():
        lists.setdefault(number, []).append(f'<w:lvl w:ilvl="{level}"><w:start w:val="{start}"/><w:numFmt w:val="{kind}"/><w:lvlText w:val="{template}"/></w:lvl>')
    if lists:
        abstract = "".join(f'<w:abstractNum w:abstractNumId="{n}">{"".join(x)}</w:abstractNum>' for n, x in lists.items())
        numbers = "".join(f'<w:num w:numId="{n}"><w:abstractNumId w:val="{n}"/></w:num>' for n in lists)
        parts["word/numbering.xml"] = f"<w:numbering {_SPACES}>{abstract}{numbers}</w:numbering>".encode()
    parts["word/styles.xml"] = f"<w:styles {_SPACES}>{styles}</w:styles>".encode()
    return archive(parts)
