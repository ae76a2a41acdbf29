"""Files told by content, DOCX blocks and the content-addressed store."""

import io
import zipfile

from concord.sources import files

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
BODY = f"""<w:document {W}><w:body><w:p><w:r><w:t>Um &amp; dois</w:t><w:tab/><w:t>três</w:t></w:r></w:p>
<w:p><w:r><w:br w:type="page"/><w:t>quebra</w:t></w:r></w:p>
<w:tbl><w:tr><w:tc><w:p><w:r><w:t>célula</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p/></w:body></w:document>"""


def docx(body=BODY, name="word/document.xml"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, body)
        z.writestr("other.txt", "x" * 100)
    return out.getvalue()


def test_formats_blocks_and_errors(spark, tmp_path):
    good = docx()
    broken = bytearray(good)
    broken[good.index(b"x" * 20) + 5] ^= 1  # another member's CRC is wrong
    contents = {"a.docx": good, "b.docx": docx("<w:document>"), "c.docx": docx(name="other.xml"), "d.docx": bytes(broken), "e.pdf": b"%PDF-1.4", "f.pdf": b"%pdf", "g": b"PK", "h.txt": "linha é\nfim".encode(), "i.txt": b"\xff", "j.docx": docx(f"<w:document {W}/>")}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    found = files.scan(spark, str(tmp_path))
    assert {r["name"]: r.kind for r in found.collect()} == {"a.docx": "docx", "b.docx": "zip", "c.docx": "zip", "d.docx": "zip", "e.pdf": "pdf", "f.pdf": "pdf", "g": "bin", "h.txt": "txt", "i.txt": "txt", "j.docx": "docx"}
    rows = {}
    for r in files.blocks(found).collect():
        rows.setdefault(r.path.rsplit("/", 1)[1], []).append((r.pos, r.page, r.type, r.text, r.error, r.table_id, r.row, r.col))
    assert sorted(rows["a.docx"]) == [(0, 1, "PARAGRAPH", "Um & dois\ttrês", None, None, None, None), (1, 1, "PARAGRAPH", "quebra", None, None, None, None), (2, 2, "TABLE_CELL", "célula", None, 0, 0, 0), (3, 2, "PARAGRAPH", "", None, None, None, None)]
    assert sorted(r[3] for r in rows["h.txt"]) == ["fim", "linha é"]
    assert rows["e.pdf"][0][4] == "unsupported format: pdf" and "utf-8" in rows["i.txt"][0][4] and rows["j.docx"][0][4] == "no text"
    assert set(rows) == set(contents)


def test_store_writes_each_content_once_and_verifies(spark, tmp_path):
    rows = spark.createDataFrame([("a", bytearray(b"one")), ("b", bytearray(b"one")), ("c", bytearray(b"two")), ("d", None)], "name string, content binary")
    first = files.store(rows, str(tmp_path / "s"))
    assert sorted((r["name"], r.length) for r in first.collect()) == [("a", 3), ("c", 3)]
    more = spark.createDataFrame([("e", bytearray(b"two")), ("f", bytearray(b"three"))], "name string, content binary")
    assert [r["name"] for r in files.store(more, str(tmp_path / "t"), first).collect()] == ["f"]
    assert files.store(rows.limit(0), str(tmp_path / "u")).count() == 0
