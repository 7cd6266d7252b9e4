"""A word-processor file built by hand, read as tables."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillframe.sources import docx
from quillframe.sources.lines import media

NS = (
    'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" '
    'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing" '
    'xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" xmlns:v="urn:schemas-microsoft-com:vml"'
)


def run(text, properties=""):
    return f"<w:r>{f'<w:rPr>{properties}</w:rPr>' if properties else ''}<w:t>{text}</w:t></w:r>"


def para(*runs, properties=""):
    return f"<w:p>{f'<w:pPr>{properties}</w:pPr>' if properties else ''}{''.join(runs)}</w:p>"


def field(kind):
    return f'<w:r><w:fldChar w:fldCharType="{kind}"/></w:r>'


PICTURE = '<w:r><w:drawing><wp:inline><wp:extent cx="609600" cy="304800"/><a:graphic><a:graphicData><a:blip r:embed="rId1"/></a:graphicData></a:graphic></wp:inline></w:drawing></w:r>'
NUMBERED = lambda level: f'<w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="7"/></w:numPr>'
BODY = [
    para(run("Bold", "<w:b/><w:sz w:val=\"28\"/>"), run(" plain𝔘")),
    para(field("begin"), "<w:r><w:instrText>PAGE</w:instrText></w:r>", field("separate"), run("12"), field("end")),
    para(field("begin"), "<w:r><w:instrText>EQ \\f(1,2)</w:instrText></w:r>", field("end"), run("x")),
    para(run("see "), PICTURE, run(" it"), properties='<w:pStyle w:val="Deep"/>'),
    '<w:tbl><w:tblPr><w:tblBorders/></w:tblPr><w:tblGrid><w:gridCol w:w="100"/><w:gridCol w:w="200"/></w:tblGrid>'
    f'<w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr>{para(run("cell"))}{para(run("two"))}</w:tc></w:tr></w:tbl>',
    para(run("a"), f'<mc:AlternateContent><mc:Choice>{run("chosen")}</mc:Choice><mc:Fallback>{run("copied")}</mc:Fallback></mc:AlternateContent>'),
    *(para(run(f"item {k}"), properties=NUMBERED(level)) for k, level in enumerate([0, 1, 1, 0, 1])),
    para(run("area "), "<m:oMath><m:sSup><m:e><m:r><m:t>r</m:t></m:r></m:e><m:sup><m:r><m:t>2</m:t></m:r></m:sup></m:sSup></m:oMath>"),
    para(run("box"), f'<w:r><w:pict><v:shape style="width:18.95pt;height:26.75pt"><v:textbox><w:txbxContent>{para(run("inside"))}</w:txbxContent></v:textbox></v:shape></w:pict></w:r>'),
    '<w:sectPr><w:pgSz w:w="11906" w:h="16838"/></w:sectPr>',
]
STYLES = (
    f'<w:styles {NS}><w:docDefaults><w:rPrDefault><w:rPr><w:sz w:val="21"/></w:rPr></w:rPrDefault></w:docDefaults><w:style w:type="paragraph" w:default="1" w:styleId="Normal"/>'
    '<w:style w:styleId="Base"><w:rPr><w:sz w:val="24"/></w:rPr></w:style><w:style w:styleId="Mid"><w:basedOn w:val="Base"/></w:style><w:style w:styleId="Deep"><w:basedOn w:val="Mid"/></w:style>'
    '<w:style w:styleId="C1"><w:basedOn w:val="C2"/></w:style><w:style w:styleId="C2"><w:basedOn w:val="C1"/></w:style></w:styles>'
)
NUMBERING = (
    f'<w:numbering {NS}><w:abstractNum w:abstractNumId="3"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl>'
    '<w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="lowerLetter"/><w:lvlText w:val="(%2)"/></w:lvl></w:abstractNum><w:num w:numId="7"><w:abstractNumId w:val="3"/></w:num></w:numbering>'
)
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="media/image1.PNG"/></Relationships>'


def build(body=BODY):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as file:
        file.writestr("word/document.xml", f"<w:document {NS}><w:body>{''.join(body)}</w:body></w:document>")
        file.writestr("word/styles.xml", STYLES)
        file.writestr("word/numbering.xml", NUMBERING)
        file.writestr("word/_rels/document.xml.rels", RELS)
        file.writestr("word/media/image1.PNG", b"picture")
    return out.getvalue()


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("docx")
    (folder / "one.docx").write_bytes(build())
    (folder / "empty.docx").write_bytes(build([]))
    return docx.files(spark, str(folder))


def texts(sources):
    return {r["locator"]: r for r in docx.docx_table(sources, "blocks").collect()}


def test_blocks(sources):
    found = texts(sources)
    assert found["body/p[1]"]["raw_text"] == "Bold plain𝔘"
    assert [(r["text"], r["bold"], r["size"]) for r in found["body/p[1]"]["runs"]] == [("Bold", True, 28), (" plain𝔘", False, None)]
    assert found["body/p[2]"]["raw_text"] == "12"
    assert found["body/p[3]"]["raw_text"] == "x" and found["body/p[3]"]["unrendered"] == ["EQ \\f(1,2)"]
    assert found["body/tbl[1]"]["is_text_carrier"] is False
    assert found["body/tbl[1]/tr[1]/tc[1]/p[2]"]["raw_text"] == "two"
    assert found["body/p[5]"]["raw_text"] == "achosen" and found["body/p[5]"]["in_fallback_chars"] == 6
    assert found["body/p[11]"]["formulas"] == ["r^{2}"]
    assert found["body/p[12]/box[1]/p[1]"]["raw_text"] == "inside"


def test_numbers_are_not_reset_by_their_parent(sources):
    shown = docx.docx_table(sources, "facts").where("layer = 'number' AND key = 'shown'").select("locator", "value").collect()
    assert [v for _, v in sorted((int(r["locator"][7:-1]), r["value"]) for r in shown)] == ["1.", "(1)", "(2)", "2.", "(3)"]
    formats = docx.docx_table(sources, "facts").where("layer = 'number' AND key = 'format'").groupBy("value").count().collect()
    assert sorted(map(tuple, formats)) == [("decimal", 2), ("lowerLetter", 3)]


def test_only_the_own_level_of_a_template_is_filled():
    package = docx.Package.open(build())
    package.numbering["9", 1] = ("decimal", "%1.%2", 4)
    assert [package.number("9", 1)["shown"], package.number("9", 1)["shown"], package.number("8", 0)["shown"]] == ["%1.4", "%1.5", "1."]


def test_unreadable_files_are_reported(spark):
    files = spark.createDataFrame([("good", build()), ("torn", build()[:300]), ("text", b"no file"), ("none", b"")], "source_id string, content binary")
    found = docx.docx_tables(files)
    assert sorted(r["source_id"] for r in found["diagnostics"].collect()) == ["none", "text", "torn"]
    for name in docx.SCHEMAS:
        one = docx.docx_table(files, name)
        assert {r["source_id"] for r in found[name].collect()} == {"good"} and sorted(map(str, one.collect())) == sorted(map(str, found[name].collect()))


def test_figures(sources):
    found = {r["locator"]: r for r in docx.docx_table(sources, "figures").collect()}
    picture = found["body/p[4]"]
    assert (picture["char_offset"], picture["cx_emu"], picture["cy_emu"], picture["anchoring"], picture["ext"], picture["body_half_points"]) == (4, 609600, 304800, "inline", "png", 24)
    assert (found["body/p[12]"]["cx_emu"], found["body/p[12]"]["cy_emu"]) == (240665, 339725)


def test_cells_and_facts(sources):
    cell = docx.docx_table(sources, "cells").first()
    assert (cell["grid_span"], cell["n_columns"], cell["text"]) == (2, 2, "cell\ntwo")
    facts = {(r["locator"], r["layer"], r["key"]): r["value"] for r in docx.docx_table(sources, "facts").collect()}
    assert facts["body/sectPr", "sectPr", "pgSz"] == "h=16838;w=11906"
    assert facts["body/tbl[1]", "tblPr", "tblBorders"] == "true"
    assert facts["body/p[4]", "pPr", "pStyle"] == "val=Deep"


def test_style_sizes_follow_their_chain_and_cycles_end():
    package = docx.Package.open(build())
    assert package.sizes["Deep"] == 24 and "C1" not in package.sizes and package.default_size == 21


def test_sources_and_media(spark, sources):
    ids = [r["source_id"] for r in sources.select("source_id").collect()]
    assert len(set(ids)) == 2 and all(x.startswith("src-") and x.endswith("-v1") for x in ids)
    parts = spark.createDataFrame([("b.PNG", bytearray(b"x")), ("a.png", bytearray(b"x")), ("c.gif", bytearray(b"y"))], "name string, content binary")
    assert sorted((r["name"], r["ext"], r["n_uses"]) for r in media(parts).collect()) == [("a.png", "png", 2), ("c.gif", "gif", 1)]


def test_blank_by_underlined_space(sources):
    runs = docx.docx_table(sources, "blocks").select(F.explode("runs").alias("r"))
    assert runs.where("r.underline IS NOT NULL AND trim(r.text) = ''").isEmpty()
