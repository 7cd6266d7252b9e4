"""Word-processor files as block tables: text, runs, figures, tables, numbering, layout facts.

A file is read with the standard library only. Paragraphs and tables that are direct children of the body
count separately from 1: ``body/p[n]``, ``body/tbl[n]/tr[r]/tc[c]/p[i]``. Compatibility copies (Fallback)
are skipped and counted apart. Text boxes inside a paragraph give blocks of their own.
"""

from __future__ import annotations

import hashlib
import io
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.functions.formulas import formula
from quillframe.sources.shared import checkpointed

# Namespaces of the file format.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
WP = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"
MC = "{http://schemas.openxmlformats.org/markup-compatibility/2006}"
M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
V = "{urn:schemas-microsoft-com:vml}"
WPS = "{http://schemas.microsoft.com/office/word/2010/wordprocessingShape}"

BLOCKS = "source_id string, ordinal long, locator string, block_type string, is_text_carrier boolean, raw_text string, style string, num_id string, num_level int, in_fallback_chars int, unrendered array<string>, runs array<struct<text:string,bold:boolean,italic:boolean,underline:string,color:string,size:int,highlight:string,vert:string,emphasis:string,shading:string>>, formulas array<string>"
FIGURES = "source_id string, locator string, figure_no int, char_offset int, media_id string, ext string, cx_emu long, cy_emu long, anchoring string, wrap string, shape string, shares_drawing boolean, crop string, anchor_x long, anchor_y long, placed string, wrap_xml string, body_half_points int"
FACTS = "source_id string, locator string, layer string, run_index int, key string, value string"
CELLS = "source_id string, locator string, n_rows int, n_columns int, row_no int, column_no int, grid_span int, v_merge string, height string, height_rule string, is_header boolean, cant_split boolean, width string, v_align string, alignment string, text string"
LENGTH_UNITS = {"pt": 12700.0, "in": 914400.0, "cm": 360000.0, "mm": 36000.0, "pc": 152400.0, "px": 9525.0}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def css_emu(style: str) -> tuple[int | None, int | None]:
    """Width and height of a style text; both or none."""
    found = dict(re.findall(r"(?:^|;)\s*(width|height)\s*:\s*([^;]+)", style or ""))
    sizes = []
    for name in ("width", "height"):
        m = re.fullmatch(r"([0-9.]+)\s*([a-z]+)", found.get(name, "").strip())
        sizes.append(round(float(m[1]) * LENGTH_UNITS[m[2]]) if m and m[2] in LENGTH_UNITS else None)
    return (sizes[0], sizes[1]) if None not in sizes else (None, None)


@dataclass
class Package:
    """The parts of a file that reading needs."""

    document: ET.Element
    targets: dict[str, str]
    parts: dict[str, bytes]
    numbering: dict[tuple[str, int], tuple[str, str, int]]
    sizes: dict[str, int]
    default_style: str | None
    default_size: int | None
    counters: dict[tuple[str, int], int] = field(default_factory=dict)

    @classmethod
    def open(cls, content: bytes) -> Package:
        with zipfile.ZipFile(io.BytesIO(content)) as file:
            parts = {n: file.read(n) for n in file.namelist()}
        rels = ET.fromstring(parts.get("word/_rels/document.xml.rels", b"<Relationships/>"))
        targets = {r.get("Id", ""): r.get("Target", "") for r in rels}
        sizes, default_style, default_size = cls._styles(parts.get("word/styles.xml"))
        return cls(ET.fromstring(parts["word/document.xml"]), targets, parts, cls._numbering(parts.get("word/numbering.xml")), sizes, default_style, default_size)

    @staticmethod
    def _numbering(part: bytes | None) -> dict[tuple[str, int], tuple[str, str, int]]:
        """(number, level) to format, template and start, through abstract numbers."""
        if part is None:
            return {}
        root, abstract = ET.fromstring(part), {}
        for a in root.findall(f"{W}abstractNum"):
            value = lambda level, name, default: (level.find(W + name).get(W + "val", default) if level.find(W + name) is not None else default)
            abstract[a.get(W + "abstractNumId")] = {int(level.get(W + "ilvl", 0)): (value(level, "numFmt", "decimal"), value(level, "lvlText", ""), int(value(level, "start", "1"))) for level in a.findall(f"{W}lvl")}
        out = {}
        for n in root.findall(f"{W}num"):
            link = n.find(f"{W}abstractNumId")
            for level, found in abstract.get(link.get(W + "val") if link is not None else None, {}).items():
                out[n.get(W + "numId"), level] = found
        return out

    @staticmethod
    def _styles(part: bytes | None) -> tuple[dict[str, int], str | None, int | None]:
        """Effective half-point sizes by style along basedOn, the default style, the document default."""
        if part is None:
            return {}, None, None
        root = ET.fromstring(part)
        given = root.find(f"{W}docDefaults/{W}rPrDefault/{W}rPr/{W}sz")
        own, based, default = {}, {}, None
        for s in root.findall(f"{W}style"):
            name = s.get(W + "styleId", "")
            size, parent = s.find(f"{W}rPr/{W}sz"), s.find(f"{W}basedOn")
            if size is not None:
                own[name] = int(size.get(W + "val"))
            if parent is not None:
                based[name] = parent.get(W + "val", "")
            if s.get(W + "default") == "1" and s.get(W + "type") == "paragraph":
                default = name
        sizes = {}
        for name in {*own, *based}:
            at, seen = name, set()
            while at not in own and at in based and at not in seen:
                seen.add(at)
                at = based[at]
            if at in own:
                sizes[name] = own[at]
        return sizes, default, int(given.get(W + "val")) if given is not None else None

    def media(self, relation: str | None) -> tuple[str | None, str | None]:
        target = self.targets.get(relation or "")
        data = self.parts.get(f"word/{target}") if target else None
        if data is None:
            return None, None
        return hashlib.sha256(data).hexdigest()[:16], target.rpartition(".")[2].lower()

    def number(self, num_id: str, level: int) -> dict[str, str]:
        """The next number of a list level, as it is shown and how it is to be formatted; no other level resets it.

        Only the level's own place in the template is filled. A level that nobody defined counts from 1.
        """
        kind, template, start = self.numbering.get((num_id, level), ("", "", 1))
        n = self.counters[num_id, level] = self.counters.get((num_id, level), start - 1) + 1
        return {"shown": (template or "%1.").replace(f"%{level + 1}", str(n)), "index": str(n), "format": kind}


def _mark(properties: ET.Element | None, name: str, attribute: str = "val") -> str | None:
    found = None if properties is None else properties.find(W + name)
    if found is None:
        return None
    return found.get(W + attribute, "on")


def _toggle(properties: ET.Element | None, name: str) -> bool:
    return _mark(properties, name) not in (None, "0", "false", "off", "none")


def _run_marks(r: ET.Element) -> dict:
    p = r.find(f"{W}rPr")
    size = _mark(p, "sz")
    return {
        "bold": _toggle(p, "b"),
        "italic": _toggle(p, "i"),
        "underline": None if _mark(p, "u") in (None, "none") else _mark(p, "u"),
        "color": _mark(p, "color"),
        "size": int(size) if size else None,
        "highlight": _mark(p, "highlight"),
        "vert": _mark(p, "vertAlign"),
        "emphasis": None if _mark(p, "em") in (None, "none") else _mark(p, "em"),
        "shading": _mark(p, "shd", "fill"),
    }


def _attributes(element: ET.Element | None) -> str | None:
    """All attributes as sorted text."""
    return None if element is None else ";".join(f"{_local(k)}={v}" for k, v in sorted(element.attrib.items())) or None


def _offsets(place: ET.Element | None) -> dict[str, int | None]:
    """Where an anchored drawing is put, from the edge of what it is anchored to."""
    out = {}
    for name, side in (("anchor_x", "positionH"), ("anchor_y", "positionV")):
        found = None if place is None else place.find(f"{WP}{side}/{WP}posOffset")
        out[name] = int(found.text) if found is not None and (found.text or "").strip().lstrip("-").isdigit() else None
    return out


@dataclass
class Paragraph:
    """What a paragraph holds."""

    text: str = ""
    runs: list[dict] = field(default_factory=list)
    figures: list[dict] = field(default_factory=list)
    boxes: list[ET.Element] = field(default_factory=list)
    unrendered: list[str] = field(default_factory=list)
    formulas: list[str] = field(default_factory=list)
    fallback_chars: int = 0


#: What fields without a stored result show, by the first word of their instruction; others show nothing.
RENDERED_FIELDS = {"SYMBOL": lambda words: chr(int(words[1])) if len(words) > 1 and words[1].isdigit() else "", "EQ": lambda words: ""}


def read_paragraph(p: ET.Element, package: Package) -> Paragraph:
    """Text with fields resolved, runs with marks, figures by character offset, text boxes, formulas."""
    out = Paragraph()
    fields: list[dict] = []

    def add(text: str, marks: dict) -> None:
        if not text:
            return
        if fields and fields[-1]["state"] == "result":
            fields[-1]["shown"] = True
        out.text += text
        if out.runs and {k: v for k, v in out.runs[-1].items() if k != "text"} == marks:
            out.runs[-1]["text"] += text
        else:
            out.runs.append({"text": text, **marks})

    def close_field(marks: dict) -> None:
        done = fields.pop()
        if not done["shown"]:
            words = done["code"].split()
            shown = RENDERED_FIELDS.get(words[0] if words else "", lambda _: "")(words)
            if shown:
                add(shown, marks)
            elif words:
                out.unrendered.append(done["code"].strip())

    def picture(drawing: ET.Element) -> None:
        place = next((x for x in drawing if _local(x.tag) in ("inline", "anchor")), None)
        extent = None if place is None else place.find(f"{WP}extent")
        wrap = "" if place is None else next((_local(x.tag) for x in place if _local(x.tag).startswith("wrap")), "")
        kind = next((_local(x.tag) for x in drawing.iter() if _local(x.tag) in ("pic", "wsp", "wgp")), "")
        preset = next((x.get("prst") for x in drawing.iter(f"{A}prstGeom")), None)
        blips = [b.get(R + "embed") for b in drawing.iter(f"{A}blip")] or [None]
        own = next(drawing.iter(f"{A}ext"), None) if extent is None else extent
        extent = own if own is not None and own.get("cx") else None
        wrapped = None if place is None else next((x for x in place if _local(x.tag).startswith("wrap")), None)
        more = {"crop": _attributes(next(drawing.iter(f"{A}srcRect"), None)), **_offsets(place), "placed": _attributes(place), "wrap_xml": None if wrapped is None else ET.tostring(wrapped, encoding="unicode")}
        for k, relation in enumerate(blips):
            media_id, ext = package.media(relation)
            shape = "picture" if relation else ("arrow" if preset and "arrow" in preset.lower() else "shape")
            out.figures.append({"char_offset": len(out.text), "media_id": media_id, "ext": ext, "cx_emu": int(extent.get("cx")) if extent is not None else None, "cy_emu": int(extent.get("cy")) if extent is not None else None, "anchoring": "" if place is None else _local(place.tag), "wrap": wrap, "shape": shape if kind or relation else "shape", "shares_drawing": k > 0, **more})
        out.boxes.extend(b for b in drawing.iter(f"{W}txbxContent"))

    def vml(pict: ET.Element) -> None:
        for shape in pict.iter():
            if shape.tag in (f"{V}shape", f"{V}rect", f"{V}roundrect"):
                cx, cy = css_emu(shape.get("style", ""))
                image = shape.find(f"{V}imagedata")
                media_id, ext = package.media(None if image is None else image.get(R + "id"))
                out.figures.append({"char_offset": len(out.text), "media_id": media_id, "ext": ext, "cx_emu": cx, "cy_emu": cy, "anchoring": "vml", "wrap": "", "shape": "picture" if media_id else "shape", "shares_drawing": False, "crop": None, "anchor_x": None, "anchor_y": None, "placed": _attributes(shape), "wrap_xml": None})
        out.boxes.extend(pict.iter(f"{W}txbxContent"))

    def walk(node: ET.Element, marks: dict) -> None:
        for x in node:
            if x.tag == f"{W}r":
                walk(x, _run_marks(x))
            elif x.tag == f"{MC}Fallback":
                out.fallback_chars += sum(len(t.text or "") for t in x.iter(f"{W}t"))
            elif x.tag == f"{W}t":
                if not fields or fields[-1]["state"] == "result":
                    add(x.text or "", marks)
            elif x.tag == f"{W}fldChar":
                kind = x.get(W + "fldCharType")
                if kind == "begin":
                    fields.append({"code": "", "state": "code", "shown": False})
                elif fields and kind == "separate":
                    fields[-1]["state"] = "result"
                elif fields and kind == "end":
                    close_field(marks)
            elif x.tag == f"{W}instrText":
                if fields:
                    fields[-1]["code"] += x.text or ""
            elif x.tag in (f"{W}br", f"{W}tab", f"{W}cr"):
                add("\t" if x.tag == f"{W}tab" else "\n", marks)
            elif x.tag == f"{W}noBreakHyphen":
                add("-", marks)
            elif x.tag == f"{W}sym":
                add(chr(int(x.get(W + "char", "20"), 16)), marks)
            elif x.tag == f"{W}drawing":
                picture(x)
            elif x.tag in (f"{W}pict", f"{W}object"):
                vml(x)
            elif x.tag in (f"{M}oMath", f"{M}oMathPara"):
                out.formulas.append(formula(x))
                add("".join(t.text or "" for t in x.iter(f"{M}t")), marks)
            elif x.tag in (f"{W}p", f"{W}rPr", f"{W}pPr", f"{W}txbxContent"):
                continue
            else:
                walk(x, marks)

    walk(p, _run_marks(p))
    while fields:
        close_field({})
    return out


def facts(properties: ET.Element | None, skip: tuple[str, ...] = ()) -> dict[str, str]:
    """Every child of a property element: its attributes as sorted text, or "true"."""
    out = {}
    for x in [] if properties is None else properties:
        if _local(x.tag) not in skip:
            given = ";".join(f"{_local(k)}={v}" for k, v in sorted(x.attrib.items()))
            nested = ";".join(f"{_local(y.tag)}({','.join(f'{_local(k)}={v}' for k, v in sorted(y.attrib.items()))})" for y in x)
            out[_local(x.tag)] = ";".join(t for t in (given, nested) if t) or "true"
    return out


def body_size(runs: list[dict]) -> int | None:
    """The size with the most characters, the first on ties; blanks do not count."""
    weight: dict[int, int] = {}
    for r in runs:
        if r["size"] and r["text"].strip():
            weight[r["size"]] = weight.get(r["size"], 0) + len(r["text"])
    return max(weight, key=weight.get) if weight else None


def read(content: bytes, source: str) -> dict[str, list[tuple]]:
    """Rows of the tables blocks, figures, facts and cells of one file."""
    package = Package.open(content)
    out: dict[str, list[tuple]] = {"blocks": [], "figures": [], "facts": [], "cells": []}

    def layer(locator: str, name: str, run: int | None, found: dict[str, str]) -> None:
        out["facts"].extend((source, locator, name, run, k, v) for k, v in sorted(found.items()))

    def paragraph(p: ET.Element, locator: str, kind: str) -> str:
        got, properties = read_paragraph(p, package), p.find(f"{W}pPr")
        style = _mark(properties, "pStyle")
        number = None if properties is None else properties.find(f"{W}numPr")
        num_id, level = (None, None) if number is None else (_mark(number, "numId"), int(_mark(number, "ilvl") or 0))
        shown = package.number(num_id, level) if num_id else {}
        runs = [{k: r[k] for k in ("text", "bold", "italic", "underline", "color", "size", "highlight", "vert", "emphasis", "shading")} for r in got.runs]
        out["blocks"].append((source, len(out["blocks"]) + 1, locator, kind, True, got.text, style, num_id, level, got.fallback_chars, got.unrendered, runs, got.formulas))
        layer(locator, "number", None, {k: v for k, v in shown.items() if v})
        layer(locator, "pPr", None, facts(properties, ("rPr", "sectPr")))
        for k, r in enumerate(p.iter(f"{W}r")):
            layer(locator, "rPr", k, facts(r.find(f"{W}rPr")))
        if properties is not None and properties.find(f"{W}sectPr") is not None:
            layer(locator, "sectPr", None, facts(properties.find(f"{W}sectPr")))
        size = body_size(got.runs) or package.sizes.get(style or "") or package.sizes.get(package.default_style or "") or package.default_size
        for k, f in enumerate(got.figures):
            out["figures"].append((source, locator, k + 1, f["char_offset"], f["media_id"], f["ext"], f["cx_emu"], f["cy_emu"], f["anchoring"], f["wrap"], f["shape"], f["shares_drawing"], f["crop"], f["anchor_x"], f["anchor_y"], f["placed"], f["wrap_xml"], size))
        for b, box in enumerate(got.boxes):
            for k, inner in enumerate(box.findall(f"{W}p")):
                paragraph(inner, f"{locator}/box[{b + 1}]/p[{k + 1}]", "text_box")
        return got.text

    def grid(t: ET.Element, locator: str) -> None:
        rows = t.findall(f"{W}tr")
        out["blocks"].append((source, len(out["blocks"]) + 1, locator, "table", False, "", None, None, None, 0, [], [], []))
        layer(locator, "tblPr", None, facts(t.find(f"{W}tblPr")))
        layer(locator, "tblGrid", None, {f"gridCol[{k + 1}]": c.get(W + "w", "") for k, c in enumerate(t.findall(f"{W}tblGrid/{W}gridCol"))})
        width = len(t.findall(f"{W}tblGrid/{W}gridCol"))
        for i, row in enumerate(rows):
            layer(f"{locator}/tr[{i + 1}]", "trPr", None, facts(row.find(f"{W}trPr")))
            of_row = row.find(f"{W}trPr")
            for j, cell in enumerate(row.findall(f"{W}tc")):
                at, properties = f"{locator}/tr[{i + 1}]/tc[{j + 1}]", cell.find(f"{W}tcPr")
                layer(at, "tcPr", None, facts(properties))
                texts = [paragraph(p, f"{at}/p[{k + 1}]", "table_cell") for k, p in enumerate(cell.findall(f"{W}p"))]
                for k, nested in enumerate(cell.findall(f"{W}tbl")):
                    grid(nested, f"{at}/tbl[{k + 1}]")
                out["cells"].append((source, locator, len(rows), width, i + 1, j + 1, int(_mark(properties, "gridSpan") or 1), _mark(properties, "vMerge"), _mark(of_row, "trHeight"), _mark(of_row, "trHeight", "hRule") if _mark(of_row, "trHeight") else None, _toggle(of_row, "tblHeader"), _toggle(of_row, "cantSplit"), _mark(properties, "tcW", "w"), _mark(properties, "vAlign"), next((a for p in cell.findall(f"{W}p") if (a := _mark(p.find(f"{W}pPr"), "jc"))), None), "\n".join(texts)))

    body = package.document.find(f"{W}body")
    n_paragraphs = n_tables = 0
    for node in [] if body is None else body:
        if node.tag == f"{W}p":
            n_paragraphs += 1
            paragraph(node, f"body/p[{n_paragraphs}]", "paragraph")
        elif node.tag == f"{W}tbl":
            n_tables += 1
            grid(node, f"body/tbl[{n_tables}]")
        elif node.tag == f"{W}sectPr":
            layer("body/sectPr", "sectPr", None, facts(node))
    return out


SCHEMAS = {"blocks": BLOCKS, "figures": FIGURES, "facts": FACTS, "cells": CELLS}


def files(spark, path: str, volume: str = "v1") -> DataFrame:
    """Files under ``path`` with their source ids."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path)
    return found.select(F.concat(F.lit("src-"), F.substring(F.sha2("content", 256), 1, 16), F.lit(f"-{volume}")).alias("source_id"), F.sha2("content", 256).alias("file_sha256"), F.lit(volume).alias("volume_key"), "path", "content")


def _columns(schema: str) -> list[str]:
    return re.findall(r"(?:^|, )(\w+) (?=string|long|boolean|int|array)", schema)


def _problem(content: bytes, source: str) -> tuple[dict[str, list[tuple]], str | None]:
    """The rows of a file, or none and why it cannot be read."""
    try:
        return read(content, source), None
    except (zipfile.BadZipFile, KeyError, ET.ParseError, ValueError, zlib.error) as e:
        return {name: [] for name in SCHEMAS}, f"{type(e).__name__}: {e}"[:200]


def parsed(sources: DataFrame) -> DataFrame:
    """One row per file (source_id, content), read once: its tables as arrays, and problem, null for a readable one."""
    nested = ", ".join(f"{name} array<struct<{re.sub(r'(^|, )([a-z_]+) ', r'\1\2:', schema)}>>" for name, schema in SCHEMAS.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["source_id"], batch["content"]):
                tables, problem = _problem(bytes(content), source)
                rows = {name: [[dict(zip(_columns(schema), row)) for row in tables[name]]] for name, schema in SCHEMAS.items()}
                yield pd.DataFrame({"source_id": [source], "problem": [problem], **rows})

    return sources.select("source_id", "content").mapInPandas(run, f"source_id string, problem string, {nested}")


def docx_tables(sources: DataFrame) -> dict[str, DataFrame]:
    """All tables of the files, which are parsed once: blocks, figures, facts, cells, and diagnostics of unreadable files."""
    whole = checkpointed(parsed(sources))
    out = {name: whole.select(F.inline(name)) for name in SCHEMAS}
    out["diagnostics"] = whole.where("problem IS NOT NULL").select("source_id", F.lit("FILE_UNREADABLE").alias("code"), F.col("problem").alias("detail"))
    return out


def docx_table(sources: DataFrame, name: str) -> DataFrame:
    """One of the tables blocks, figures, facts, cells of all files (source_id, content). An unreadable file has no rows."""
    schema = SCHEMAS[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["source_id"], batch["content"]):
                yield pd.DataFrame(_problem(bytes(content), source)[0][name], columns=_columns(schema))

    return sources.select("source_id", "content").mapInPandas(run, schema)
