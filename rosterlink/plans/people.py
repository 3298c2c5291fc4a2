"""People lists derived from the benchmark tables.

Every list comes from whole tables: one contact export row per order, one
attendee per supplier, one registrant per customer.  Names are built from
syllables by key, so that equal, misspelt, padded and strange names occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived lists; the SQL checks use the same ones.
SYLLABLES = [
    "ba", "lo", "mir", "ten", "dou", "var", "chel", "pin", "gro", "sau",
    "ler", "quin", "fa", "bre", "zol", "nev", "hu", "tri", "jac", "mor",
]
FIRST_NAMES = ["Jean", "Marie", "Pierre", "Sophie", "Alice", "Marc", "Zoé", "Hélène", "Luc", "Anne"]
TITLES = [
    "Étudiant en actuariat", "Master 2 actuariat", "Student actuary", "Stagiaire actuariat",
    "Data science intern", "Internship at AXA", "Alternant actuariat", "Contrat pro - pricing",
    "Apprenti data scientist", "Directeur technique", "Head of Pricing", "CEO", "CTO chez SCOR",
    "Président directeur général", "Fondateur de startup", "Vice-President Risk",
    "Professeur des universités", "Manager actuarial", "Responsable pricing", "Senior actuaire",
    "Expert sinistres", "Team Lead data science", "Actuaire non-vie", "Data analyst",
    "Chargé d'études", "Stagiaire senior actuariat", "  DIRECTEUR GENERAL  ", "   ", "",
    "Étudiante", "école d'actuariat",
]
COMPANIES = [
    "axa", "AXA", "maif", "detralytics", "oliver wyman", "scor", "aon",
    "université libre de bruxelles", "Groupama Assurances Mutuelles", "Munich Re International",
    "Actuarial Consulting Group", "Université de Bordeaux", "Marsh & McLennan",
    "Entreprise XYZ Inconnue", "AXA EN FRANCE", "allianz france", "Discord", "  Bulb ", "   ", "",
    "Ré assurance Lyon", "Cabinet Howden", "Protection sociale",
]
NAME_SPACE = 160_000
STRANGER = 1_000_003
SUPPLIER_SHIFT = 100_000


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def last_name(key: Column) -> Column:
    mixed = (key * 48271) % NAME_SPACE
    parts = [_pick(SYLLABLES, F.call_function("div", mixed, F.lit(20**i))) for i in range(4)]
    return F.concat(*parts)


def first_name(key: Column) -> Column:
    return _pick(FIRST_NAMES, key * 7)


def connections_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contact export row per order; a customer's rows differ only in the date."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_custkey")
    return orders.select(
        first_name(key).alias("First Name"),
        F.when(key % 97 != 0, last_name(key)).alias("Last Name"),
        F.concat(F.lit("p"), key.cast("string"), F.lit("@example.org")).alias("Email Address"),
        _pick(COMPANIES, key).alias("Company"),
        F.when(key % 41 != 0, _pick(TITLES, key)).alias("Position"),
        F.concat(F.lit("https://example.org/in/"), key.cast("string")).alias("URL"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Connected On"),
        F.col("o_orderkey").alias("source_row"),
    )


def congress_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attendee per supplier; every tenth bears the name of a customer."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("s_suppkey")
    named_as = F.when(key % 10 == 0, key).otherwise(key + SUPPLIER_SHIFT)
    return supplier.select(
        F.concat(F.upper(last_name(named_as)), F.lit(", "), first_name(named_as)).alias("Name"),
        F.concat(F.lit("  "), _pick(TITLES, key), F.lit("  ")).alias("Job"),
        _pick(COMPANIES, key + 3).alias("Compagnie"),
        key.alias("source_row"),
    )


def registrant_parts(key: Column) -> tuple[Column, Column]:
    own = last_name(key)
    kind = key % 4
    shortened = F.concat(F.substring(own, 1, 2), F.substring(own, F.lit(4), F.length(own)))
    last = (
        F.when(kind == 1, shortened)
        .when(kind == 2, F.concat(F.lit("  "), F.initcap(own), F.lit("\u00a0")))
        .when(kind == 3, last_name(key + STRANGER))
        .otherwise(own)
    )
    return last, first_name(key)


def registrants_raw(spark: SparkSession, sf_dir: str, french: bool = True) -> DataFrame:
    """One registrant per customer: same name, a letter missing, padded, or a stranger."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("c_custkey")
    last, first = registrant_parts(key)
    headers = ("Nom", "Prénom") if french else ("Last Name", "First Name")
    return customer.select(
        F.concat(F.lit("r"), key.cast("string"), F.lit("@example.org")).alias("Email"),
        last.alias(headers[0]),
        first.alias(headers[1]),
        F.col("c_mktsegment").alias("Company"),
        _pick(TITLES, key + 5).alias("Job title" if french else "Position"),
    )
