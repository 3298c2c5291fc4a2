import json

import pytest

from rosterlink import (
    build_contacts, classify_company, classify_position, enrich_audience, filter_audience, fuzzy_match,
    match_counts, match_stats, normalize_congress, write_audience,
)
from rosterlink.operators.enrich import add_categories, attach_contacts


@pytest.fixture
def audience(spark, registrants, contacts):
    matched = fuzzy_match(registrants, contacts, 100)
    return add_categories(attach_contacts(matched, contacts), classify_position, classify_company)


def test_enrich_and_stats_at_default_cutoff(registrants, contacts):
    audience = enrich_audience(registrants, contacts, classify_position_fn=classify_position,
                               classify_company_fn=classify_company)
    rows = {r["Name"]: (r["Name registrant"], r["Company"], r["Category_position"], r["Category_company"])
            for r in audience.collect()}
    assert rows == {
        "DUPONT, Jean": ("DUPONT, Jean", "AXA", "Directeur", "Assurance"),
        "MARTIN, Marie": ("MARTIN, Marie", "Detralytics", "Manager", "Cabinet de conseil"),
        "DURAND, Alice": ("DURAND, Alice", "Allianz", "Manager", "Assurance"),
    }


def test_stats(registrants, audience):
    stats = match_stats(registrants, audience)
    assert stats["unmatched_names"] == ["INCONNU, Robert"] and json.loads(json.dumps(stats)) == stats
    assert {k: v for k, v in stats.items() if k != "unmatched_names"} == {
        "n_registered": 4, "n_matched": 3, "n_unmatched": 1, "pct_matched": 75.0, "pct_unmatched": 25.0}
    empty = registrants.limit(0)
    assert tuple(match_counts(empty, audience.limit(0)).first()) == (0, 0, 0, 0.0, 0.0)


def test_written_audience(spark, registrants, audience, tmp_path):
    more = registrants.unionByName(registrants.where("Name LIKE 'INC%'")).unionByName(registrants.selectExpr("CAST(NULL AS STRING) AS Name", "Email").limit(1))
    stats = write_audience(more, audience, str(tmp_path / "out"))
    names = [r[0] for r in spark.read.parquet(str(tmp_path / "out/unmatched")).collect()]
    assert names == ["INCONNU, Robert"]
    assert stats == {k: v for k, v in match_stats(more, audience).items() if k != "unmatched_names"}
    assert stats["n_registered"] == 6 and stats["n_matched"] == 3
    assert sorted(spark.read.parquet(str(tmp_path / "out/audience")).collect()) == sorted(audience.collect())
    nobody = write_audience(registrants.limit(0), audience.limit(0), str(tmp_path / "none"))
    assert nobody["n_registered"] == nobody["pct_matched"] == 0


def test_filter(audience):
    assert filter_audience(audience).count() == 3
    both = filter_audience(audience, ["Directeur", "Manager"], ["Assurance", "Réassurance"])
    assert sorted(r["Name"] for r in both.collect()) == ["DUPONT, Jean", "DURAND, Alice"]
    assert filter_audience(audience, positions=[]).count() == 0
    with pytest.raises(KeyError, match="Category_company"):
        filter_audience(audience.drop("Category_company"), companies=["Assurance"])
    with pytest.raises(KeyError, match="Category_position"):
        filter_audience(audience.drop("Category_position"), positions=["Directeur"])


def test_duplicates_nulls_and_python_classifier(spark):
    contacts = spark.createDataFrame(
        [("A, B", " x ", 0), ("A, B", None, 1), (None, "n", 2)], "Name string, Position string, contact_pos bigint")
    registrants = spark.createDataFrame([("A, B",), ("A, B",), (None,)], "Name string")
    matched = fuzzy_match(registrants, contacts, 100)
    assert matched.count() == 3
    by_name = attach_contacts(matched, contacts)
    assert by_name.count() == 4
    assert attach_contacts(matched, contacts, "position").count() == 2
    assert attach_contacts(matched, contacts, null_keys_equal=True).count() == 5
    named = add_categories(by_name, classify_position_fn=lambda text: text.upper() + "!")
    assert {r["Category_position"] for r in named.collect()} == {"X!", "NAN!"}


def test_contacts_union_and_positions(spark):
    one = spark.range(10).selectExpr("concat('N', id) AS Name", "id AS source_row", "'x' AS Extra")
    two = normalize_congress(spark.createDataFrame([("Q", " j ", "c")], "Name string, Job string, Compagnie string"))
    rows = build_contacts(one.repartition(4), two).orderBy("contact_pos").collect()
    assert [r["Name"] for r in rows] == [f"N{i}" for i in range(10)] + ["Q"]
    assert [r["contact_pos"] for r in rows] == list(range(11)) and rows[10]["Position"] == "j"
    with pytest.raises(ValueError, match="At least one"):
        build_contacts()
    with pytest.raises(ValueError, match="'Name' column"):
        build_contacts(spark.range(1))


def test_positions_are_lossless_and_fixed(spark):
    rows = [(f"N{i % 40}", f"x{i}", None if i % 3 == 0 else i * 1_000_003) for i in range(400)] + [(None, None, None)]
    source = spark.createDataFrame(rows, "Name string, Extra string, source_row bigint")
    without = source.drop("source_row")
    seen = []
    for parts in ("4", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        placed = build_contacts(source.repartition(int(parts)), without.repartition(7))
        seen.append({tuple(r) for r in placed.collect()})
        assert sorted(r[-1] for r in seen[-1]) == list(range(802))
        matched = fuzzy_match(without.where("Name = 'N7'").select("Name").distinct(), placed, 90)
        row = matched.first()
        assert (row[1], row[2]) == ("N7", 100.0) and ("N7", row[3]) in {(r.Name, r.contact_pos) for r in placed.collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]
    assert build_contacts(without.limit(0)).count() == 0
