import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterlink.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def contacts(spark):
    rows = [
        ("Jean", "Dupont", "j.dupont@axa.fr", "AXA", "Directeur technique", "jdupont", "DUPONT, Jean"),
        ("Marie", "Martin", "m.martin@detralytics.fr", "Detralytics", "Manager actuarial", "mmartin", "MARTIN, Marie"),
        ("Pierre", "Bernard", "p.bernard@scor.com", "SCOR", "Chargé de réassurance", "pbernard", "BERNARD, Pierre"),
        ("Sophie", "Leclerc", "s.leclerc@univ-paris.fr", "Université de Paris", "Professeur", "sleclerc", "LECLERC, Sophie"),
        (None, None, None, "Allianz", "Actuaire senior", None, "DURAND, Alice"),
        (None, None, None, "Nexialog", "Stagiaire actuariat", None, "PETIT, Marc"),
    ]
    columns = ["First Name", "Last Name", "Email Address", "Company", "Position", "URL", "Name"]
    numbered = [(*row, i) for i, row in enumerate(rows)]
    schema = ", ".join(f"`{c}` string" for c in columns) + ", contact_pos bigint"
    return spark.createDataFrame(numbered, schema)


@pytest.fixture
def registrants(spark):
    rows = [
        ("DUPONT, Jean", "j@axa.fr"), ("MARTIN, Marie", "m@detra.fr"),
        ("DURAND, Alice", "a@allianz.fr"), ("INCONNU, Robert", "r@nowhere.fr"),
    ]
    return spark.createDataFrame(rows, "Name string, Email string")
