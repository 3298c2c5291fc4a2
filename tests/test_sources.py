import zipfile
from xml.sax.saxutils import escape

import pytest

from rosterlink import build_contacts, load_congress_list, load_linkedin_connections, load_registrants


def write_workbook(path, sheets):
    """A small ``.xlsx``: ``{sheet: rows}``, first row the header."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        shared = []
        for i, rows in enumerate(sheets.values(), 1):
            lines = []
            for r, row in enumerate(rows, 1):
                cells = []
                for c, value in enumerate(row):
                    if value is None:
                        continue
                    ref = f"{chr(65 + c)}{r}"
                    if isinstance(value, int):
                        cells.append(f'<c r="{ref}"><v>{value}</v></c>')
                    else:
                        shared.append(value)
                        cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        items = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return str(path)


HEAD = "First Name,Last Name,Email Address,Company,Position,Connected On\n"


def test_connections_name_dedupe_and_columns(spark, tmp_path):
    (tmp_path / "Connections.csv").write_text(
        HEAD + "Jean,Dupont,j@a.fr,X,Y,01 Jan\nJean,Dupont,j@a.fr,X,Y,02 Jan\nalice, martin ,,NA,,\n,Noname,,,,\nAnn,NA,,,,\n",
        encoding="utf-8")
    df = load_linkedin_connections(str(tmp_path), spark=spark)
    assert "Connected On" not in df.columns
    rows = df.orderBy("source_row").collect()
    assert [r["Name"] for r in rows] == ["DUPONT, Jean", "MARTIN, alice"]
    assert rows[1]["Company"] is None


def test_connections_many_files_dialects_and_encodings(spark, tmp_path):
    (tmp_path / "Connections_1.csv").write_bytes(
        ("Notes:\n\"some, note\"\n\n" + HEAD + "Anne,Durand,,\"A, B\",P,\n").encode("utf-8-sig"))
    (tmp_path / "Connections_2.csv").write_bytes(
        "First Name;Last Name;Extra\nZoé;Lefèvre;e1\nBob;Petit;\"two\nlines\"\n".encode("cp1252"))
    df = load_linkedin_connections(str(tmp_path), spark=spark)
    assert df.columns == ["First Name", "Last Name", "Email Address", "Company", "Position", "Extra", "Name", "source_row"]
    contacts = build_contacts(df).orderBy("contact_pos").collect()
    assert [(r["contact_pos"], r["Name"]) for r in contacts] == [(0, "DURAND, Anne"), (1, "LEFÈVRE, Zoé"), (2, "PETIT, Bob")]
    assert contacts[0]["Company"] == "A, B" and contacts[2]["Extra"] == "two\nlines"


def test_connections_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_linkedin_connections(str(tmp_path / "nowhere"), spark=spark)
    with pytest.raises(FileNotFoundError):
        load_linkedin_connections(str(tmp_path), spark=spark)
    (tmp_path / "Connections.csv").write_text("Col1,Col2\na,b\n")
    with pytest.raises(ValueError, match="missing required columns"):
        load_linkedin_connections(str(tmp_path), spark=spark)


def test_connections_from_workbook(spark, tmp_path):
    write_workbook(tmp_path / "Connections.xlsx", {"S": [["First Name", "Last Name"], ["Jean", "Dupont"], ["X", 360]]})
    df = load_linkedin_connections(str(tmp_path), "Connections*.xlsx", spark=spark)
    assert sorted(r["Name"] for r in df.collect()) == ["360, X", "DUPONT, Jean"]


def test_congress(spark, tmp_path):
    rows = [["Name", "Job", "Other", "Compagnie"], ["DURAND, Alice", "  Actuaire  ", "o", "Allianz"], ["PETIT, Marc", None, None, "N/A"]]
    path = write_workbook(tmp_path / "c.xlsx", {"Autre": [["a"]], "Résumé": rows})
    df = load_congress_list(path, spark=spark)
    assert df.columns[:3] == ["Name", "Position", "Company"]
    assert [tuple(r)[:3] for r in df.orderBy("source_row").collect()] == [
        ("DURAND, Alice", "Actuaire", "Allianz"), ("PETIT, Marc", None, None)]
    with pytest.raises(FileNotFoundError):
        load_congress_list(str(tmp_path / "nope.xlsx"), spark=spark)
    with pytest.raises(ValueError, match="not found"):
        load_congress_list(path, "Feuille", spark=spark)
    bad = write_workbook(tmp_path / "bad.xlsx", {"Résumé": [["Name", "Wrong"], ["X", "Y"]]})
    with pytest.raises(KeyError, match="Missing columns"):
        load_congress_list(bad, spark=spark)


def test_registrants(spark, tmp_path):
    (tmp_path / "reg-1.csv").write_bytes("Nom;Prénom;Email;Job title;Ignored\nDupont;Jean ;j@a.fr;DT;x\n;Paul;p@a.fr;;\n".encode("cp1252"))
    (tmp_path / "reg-2.csv").write_text("First Name,Last Name,Position\nZed,Last,P\n")
    df = load_registrants(str(tmp_path / "reg-*.csv"), spark=spark)
    assert df.columns == ["Email", "Name", "Job title", "source_row"]
    assert [r["Name"] for r in df.orderBy("source_row").collect()] == ["DUPONT, Jean", None]
    english = load_registrants(str(tmp_path / "reg-2.csv"), spark=spark)
    assert [(r["Name"], r["Position"]) for r in english.collect()] == [("LAST, Zed", "P")]
    (tmp_path / "bad.csv").write_text("Col1,Col2\na,b\n")
    with pytest.raises(KeyError, match="Missing columns"):
        load_registrants(str(tmp_path / "bad.csv"), spark=spark)
    with pytest.raises(FileNotFoundError):
        load_registrants(str(tmp_path / "nope.csv"), spark=spark)


def test_tabs_given_separators_and_clashing_columns(spark, tmp_path):
    (tmp_path / "Connections_1.csv").write_text(
        "First Name\tLast Name\t_path\tname\tLAST NAME\n" "Anne\tDurand, X\tp\tn\tl\n", encoding="utf-8")
    df = load_linkedin_connections(str(tmp_path), spark=spark)
    row = df.first()
    assert (row["Name"], row["_path"], row["name_"], row["LAST NAME_"]) == ("DURAND, X, Anne", "p", "n", "l")
    (tmp_path / "piped.csv").write_text("First Name|Last Name|Email\nBob|Roy|b@x\n", encoding="utf-8")
    assert load_registrants(str(tmp_path / "piped.csv"), spark=spark, sep="|").first()["Name"] == "ROY, Bob"
