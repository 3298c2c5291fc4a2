import pytest

from rosterlink import classify_by_rules, classify_company, classify_position
from rosterlink.functions.text import strip
from rosterlink.plans.people import COMPANIES, TITLES

POSITIONS = {
    "Étudiant en actuariat": "Etudiant", "ÉTUDIANT": "Etudiant", "Master 2 actuariat": "Etudiant",
    "école d'actuariat": "Etudiant", "Stagiaire senior actuariat": "Stagiaire", "Internship at AXA": "Stagiaire",
    "summerintenship": "Stagiaire", "Contrat pro - pricing": "Alternant", "work-study": "Alternant",
    "Head of Pricing": "Directeur", "CEO": "Directeur", "Vice-President Risk": "Directeur",
    "Président directeur général": "Directeur", "DIRECTEUR GENERAL": "Directeur", "manager": "Manager",
    "Team Lead data science": "Manager", "Expert sinistres": "Manager", "Étudiante": "Junior",
    "Data analyst": "Junior", "nan": "Junior", "": "", "    ": "", None: "",
}
FIRMS = {
    "axa": "Assurance", "  AXA ": "Assurance", "AXA EN FRANCE": "Assurance", "allianz france": "Assurance",
    "detralytics": "Cabinet de conseil", "scor": "Réassurance", "aon": "Courtier",
    "université libre de bruxelles": "Scolaire", "Groupama Assurances Mutuelles": "Assurance",
    "Munich Re International": "Réassurance", "Actuarial Consulting Group": "Cabinet de conseil",
    "Université de Bordeaux": "Scolaire", "Marsh & McLennan": "Courtier", "Discord": "Réassurance",
    "Entreprise XYZ Inconnue": "Autre", "nan": "Cabinet de conseil", "None": "Autre", "": "", "   ": "", None: "",
}


@pytest.mark.parametrize("classifier,cases", [(classify_position, POSITIONS), (classify_company, FIRMS)])
def test_categories(spark, classifier, cases):
    df = spark.createDataFrame([(k,) for k in cases], "text string").select("text", classifier("text").alias("c"))
    assert {r["text"]: r["c"] for r in df.collect()} == cases


def test_classifiers_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(t,) for t in TITLES + COMPANIES], "text string").repartition(1)
    plan = df.select(classify_company("text"), classify_position("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan.split("Physical Plan")[1]


def test_own_rules_and_strip(spark):
    df = spark.createDataFrame([("x1",), ("beta",), ("?",)], "t string")
    rule = classify_by_rules("t", known=[("B", ["beta"])], patterns=[("X", r"\d")], default="-")
    assert [r[0] for r in df.select(rule).collect()] == ["X", "B", "-"]
    assert spark.createDataFrame([(" a b\x1f",)], "t string").select(strip("t")).first()[0] == "a b"
