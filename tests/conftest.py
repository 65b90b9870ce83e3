import os
import random
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
PLACES = os.path.join(os.path.dirname(__file__), "fixtures", "places_sample.csv")


@pytest.fixture(scope="session")
def spark():
    from carbonledger.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8)
    yield s
    s.stop()


# --- small daily drops of our own, in the ingest layout ---------------------------------------------------------
# Seven sites (the last is none of the known six), with the labels of each site's language.
HOMES = {"PARIS": ("Paris", "France"), "BERLIN": ("Berlin", "Allemagne"), "LONDON": ("London", "Angleterre"),
         "SHANGHAI": ("Shanghai", "Chine"), "LOSANGELES": ("Los Angeles", "USA"), "NEWYORK": ("New-York", "USA"),
         "OSLO": ("Oslo", "Norvege")}
MISSION_LABELS = {"PARIS": ["Formation", "Conférence", "Meeting"], "BERLIN": ["Schulung", "Konferenz", "Meeting"]}
ENGLISH = ["Vocational Training", "Conference", "Meeting"]
MODES = ["Avion", "Avion", "Train", "Taxi", "Transports en commun", "Vélo"]
EQUIPMENT = [("PC portable", "Latitude 5xxx"), ("PC portable", "ProBook "), ("Ecran", "Ecran 24p"),
             ("PC fixe sans ecran", "OMEN "), ("Tablette", "Tab 10")]


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([header, *rows]) + "\n")


def write_drops(root, seed=11):
    """Write the drops; returns (missions, equipment) as lists of dicts of the written cells, with ``site``."""
    rnd = random.Random(seed)
    missions, equipment = [], []
    for site, (city, country) in HOMES.items():
        for day in range(3):
            when = datetime(2024, 5 + 2 * (day % 3), 3 + day, 8, 30)
            rows, items = [], []
            for k in range(8):
                to = rnd.choice([x for x in HOMES if x != site or k == 0])
                rows.append(dict(
                    ID_MISSION=f"{site}_{day}{k}", ID_PERSONNEL=f"P_{site}_{rnd.randrange(5)}", NOM_PERSONNEL="N",
                    PRENOM_PERSONNEL="P", DATE_MISSION=str(when + timedelta(hours=k)),
                    TYPE_MISSION=rnd.choice(MISSION_LABELS.get(site, ENGLISH)), VILLE_DEPART=city, PAYS_DEPART=country,
                    VILLE_DESTINATION=HOMES[to][0], PAYS_DESTINATION=HOMES[to][1], TRANSPORT=rnd.choice(MODES),
                    ALLER_RETOUR=rnd.choice(["oui", "non"])))
                kind, name = rnd.choice(EQUIPMENT)
                items.append(dict(
                    ID_MATERIELINFO=f"M_{site}_{day}{k}", ID_PERSONNEL=f"P_{site}_{rnd.randrange(5)}",
                    NOM_PERSONNEL="N", PRENOM_PERSONNEL="P", DATE_ACHAT=str(when + timedelta(hours=k)),
                    TYPE=" " if k == 1 else kind, MODELE=" " if k == 2 else name))
            stamp = when.strftime("%Y%m%d")
            for folder, name, cells, kept in (("MISSION", "MISSION", rows, missions),
                                              ("INFORMATIQUE", "MATERIEL_INFORMATIQUE", items, equipment)):
                _write(f"{root}/DROP_{site}/DROP_{site}_{folder}/{name}_{stamp}.txt", ";".join(cells[0]),
                       [";".join(r.values()) for r in cells])
                kept += [{**r, "site": site.lower()} for r in cells]
    return missions, equipment


@pytest.fixture(scope="session")
def drops(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("drops"))
    missions, equipment = write_drops(root)
    return root, missions, equipment
