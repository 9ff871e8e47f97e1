"""Workbooks made by hand, part by part."""

from __future__ import annotations

import zipfile

from caseloom.sources import sheets, tables

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(path, rows, late=False, shared=("Case", "é <b>", "rich text", "")):
    strings = "".join(f"<si><t xml:space='preserve'>{x.replace('<', '&lt;')}</t></si>" for x in shared[:2]) + "<si><r><t>rich</t></r><r><t> text</t></r><rPh><t>no</t></rPh></si><si><t/></si>"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} {RELS}><workbookPr date1904="{int(late)}"/><sheets><sheet name="Other" sheetId="2" r:id="rId2"/><sheet name="Cases" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/two.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/worksheets/two.xml", f"<worksheet {MAIN}><sheetData><row><c t='inlineStr'><is><t>only</t></is></c></row><row><c><v>1</v></c></row></sheetData></worksheet>")


HEADER = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>DOB</t></is></c><c r="D1" t="str"><f>x</f><v>Gene </v></c><c r="E1" t="s"><v>0</v></c></row>'
BODY = """<row r="3"><c r="A3"><v>12</v></c><c r="B3" s="1"><v>40299</v></c><c r="D3" t="s"><v>1</v></c></row>
<row r="4"><c r="B4" s="2"><v>59</v></c><c r="C4" t="b"><v>1</v></c><c r="D4" t="e"><v>#N/A</v></c><c r="E4" s="3"><v>1.5</v></c></row>
<row r="6"><c r="A6" t="s"><v>2</v></c><c r="B6"><v>1E3</v></c><c r="AB6"><v>9</v></c></row><row r="7"><c r="A7" t="s"><v>3</v></c><c r="E7"/></row><row r="9"/>"""


def test_values_of_every_kind(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", HEADER + BODY)
    df = sheets.read_workbook(spark, str(tmp_path / "a.xlsx"), "Cases")
    assert df.columns == ["Case", "DOB", "Unnamed: 2", "Gene ", "Case_1"]
    assert [tuple(r) for r in df.collect()] == [
        ("12", "2010-05-01 00:00:00", None, "é <b>", None), (None, "1900-02-28 00:00:00", "True", None, "1.5"), ("rich text", "1000", None, None, None), ("", None, None, None, None),
    ]
    assert [tuple(r) for r in sheets.read_workbook(spark, str(tmp_path / "a.xlsx")).collect()] == [("1",)]  # the first sheet, without references
    assert sheets.moment(40299.75, True) == "2014-05-02 18:00:00" and sheets.column("AB12") == 27


def test_a_sheet_equals_its_export(spark, tmp_path):
    workbook(tmp_path / "b.xlsx", HEADER + BODY)
    df = tables.read_sheet(spark, str(tmp_path / "b.xlsx"), "Cases")
    lines = ["\t".join(df.columns)] + ["\t".join(x or "" for x in r) for r in df.collect()]
    (tmp_path / "b.tsv").write_text("\n".join(lines) + "\n")
    export = tables.read_sheet(spark, str(tmp_path / "b.tsv"))
    assert export.dropna(how="all").collect() == [r for r in df.collect() if any(r)]


def test_many_rows_many_files_and_an_empty_sheet(spark, tmp_path):
    (tmp_path / "many").mkdir()
    for k in range(3):
        names = ["n", "k"] if k < 2 else ["k", "n"]  # columns go by name
        head = '<row r="1">' + "".join(f'<c t="inlineStr"><is><t>{n}</t></is></c>' for n in names) + "</row>"
        cells = lambda i: (i, k) if k < 2 else (k, i)
        workbook(tmp_path / "many" / f"{k}.xlsx", head + "".join(f"<row><c><v>{cells(i)[0]}</v></c><c><v>{cells(i)[1]}</v></c></row>" for i in range(5000)))
    got = sheets.read_workbook(spark, str(tmp_path / "many"), "Cases")
    assert got.count() == 15_000 and got.groupBy("k").count().count() == 3 and got.where("n = '4999'").count() == 3
    workbook(tmp_path / "none.xlsx", "")
    assert sheets.read_workbook(spark, str(tmp_path / "none.xlsx"), "Cases").count() == 0
