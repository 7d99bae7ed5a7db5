"""Workbooks made here as zips of XML: three sheets, shared, rich and inline texts, merged cells, a broken file."""

import zipfile

import pytest
from pyspark.sql import functions as F

from sluice.sources import workbook

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def sheet(rows, merged=()):
    cells = "".join(f'<row r="{r}">' + "".join(f'<c r="{at}"{kind}>{value}</c>' for at, kind, value in row) + "</row>" for r, row in rows.items())
    spans = "".join(f'<mergeCell ref="{m}"/>' for m in merged)
    return f"<worksheet {MAIN}><sheetData>{cells}</sheetData><mergeCells>{spans}</mergeCells></worksheet>"


def shared(at, i):
    return (at, ' t="s"', f"<v>{i}</v>")


def number(at, v):
    return (at, "", f"<v>{v}</v>")


def inline(at, text):
    return (at, ' t="inlineStr"', f"<is><t>{text}</t></is>")


def write(path, drop=()):
    texts = ["<si><t>서울</t></si>", "<si><r><t>종로</t></r><r><t>구</t></r><rPh><t>x</t></rPh></si>", "<si><t> 중구 </t></si>", "<si><t>부산</t></si>", "<si><t/></si>"]
    names = ["years", "Sido", "Gugun"]
    parts = {
        "xl/sharedStrings.xml": f"<sst {MAIN}>{''.join(texts)}</sst>",
        "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i == 2 else ""}worksheets/s{i}.xml"/>' for i in (1, 2, 3)) + "</Relationships>",
        "xl/worksheets/s1.xml": sheet({1: [inline("A1", "kind")], 2: [inline("A2", "spots"), inline("B2", "24년"), number("C2", 2024001)], 3: [inline("B3", "23년"), number("C3", "2023001.0")]}),
        "xl/worksheets/s2.xml": sheet({1: [inline("A1", "name"), inline("B1", "code")], 2: [shared("A2", 0), number("B2", 11)], 4: [shared("A4", 3), number("B4", 6)]}),
        "xl/worksheets/s3.xml": sheet({1: [inline("A1", "h")], 2: [shared("A2", 0), shared("B2", 1), number("C2", 110)], 3: [shared("B3", 2), number("C3", 140)], 4: [shared("A4", 3)], 5: [shared("A5", 4), inline("B5", "해운대구"), number("C5", 350), number("AB5", 1)], 6: [("A6", ' t="e"', "<v>#N/A</v>")]}, ["A2:A3", "D2:E3"]),
    }
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            if name not in drop:
                z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)


def test_three_sheets(spark, tmp_path):
    for name in ("a.xlsx", "b.xlsx"):
        write(tmp_path / name)
    book = workbook.read_workbook(spark, str(tmp_path))
    assert book.select("path", "sheet").distinct().count() == 6
    own = workbook.code_list(book, "Gugun", ["province", "district", "code"], groups=["province"])
    got = sorted((r.path[-6:], r.row, r.province, r.district, r.c) for r in own.withColumn("c", workbook.code(F.col("code"), 3)).collect())
    want = [(2, "서울", "종로구", "110"), (3, "서울", "중구", "140"), (5, "부산", "해운대구", "350")]
    assert got == [(f, *w) for f in ("a.xlsx", "b.xlsx") for w in want]
    assert {len(r.cells) for r in book.where("sheet = 'Gugun' and row = 5").collect()} == {28}
    regions = workbook.code_list(book, "Sido", ["name", "code"]).select("name", workbook.code(F.col("code"), 2).alias("code")).distinct()
    assert sorted(map(tuple, regions.collect())) == [("부산", "06"), ("서울", "11")]
    years = workbook.code_list(book, "years", ["kind", "label", "id"], groups=["kind"])
    assert {(r.kind, r.label, r.c) for r in years.withColumn("c", workbook.code(F.col("id"), 1)).collect()} == {("spots", "24년", "2024001"), ("spots", "23년", "2023001")}
    with pytest.raises(ValueError, match="no sheet 'other'"):
        workbook.code_list(book, "other", ["a"])


@pytest.mark.parametrize("drop", [("xl/worksheets/s3.xml",), ("xl/workbook.xml",), None])
def test_a_broken_file_is_an_error(spark, tmp_path, drop):
    path = tmp_path / "broken.xlsx"
    if drop is None:
        path.write_bytes(b"PK no zip at all")
    else:
        write(path, drop)
    with pytest.raises(Exception, match="broken.xlsx is no workbook"):
        workbook.read_workbook(spark, str(path)).collect()
