"""Fixed values.

Two kinds of constants live here, kept apart:

* values that must equal the analysed notebook's for the same results
  (emission factors, distance adjustments, label translations, the site list);
* the mapping of the driver's TPC-H-like tables onto the carbon model

Everything else in the library takes these as parameters, never as hidden
literals.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Canonical transport modes.  Both label generations map onto these.
# ---------------------------------------------------------------------------
PLANE, TRAIN, TAXI, PUBLIC, OTHER = "plane", "train", "taxi", "public_transport", "other"
TRANSPORT_MODES = (PLANE, TRAIN, TAXI, PUBLIC, OTHER)

# FIXED VALUES (must equal the reference): transport labels as they appear in the
# raw drops / notebook (French) and in the helper module (English).
TRANSPORT_LABELS_FR = {"Avion": PLANE, "Train": TRAIN, "Taxi": TAXI, "Transports en commun": PUBLIC}
TRANSPORT_LABELS_EN = {"Plane": PLANE, "Train": TRAIN, "Taxi": TAXI, "Public transport": PUBLIC}

# FIXED VALUES (must equal the reference): label harmonisation pairs, source -> English.
JOB_FUNCTION_FR = {
    "Ingénieur Data": "Data Engineer",
    "Economiste": "Economist",
    "DRH": "HRD",
    "Ingénieur Informaticien": "Computer Engineer",
    "Cadre": "Business Executive",
}
JOB_FUNCTION_DE = {
    "Dateningenieur": "Data Engineer",
    "Ökonom": "Economist",
    "Personalleiter": "HRD",
    "Computeringenieur": "Computer Engineer",
    "Führungskraft": "Business Executive",
}
MISSION_TYPE_FR = {
    "Conférence": "Conference",
    "Réunion": "Team Meeting",
    "Développement": "Development",
    "Formation": "Vocational Training",
    "Rencontre entreprises": "Business Meeting",
}
MISSION_TYPE_DE = {
    "Geschäftstreffen": "Business Meeting",
    "Konferenz": "Conference",
    "Schulung": "Vocational Training",
    "Meeting": "Team Meeting",
    "Entwicklung": "Development",
}
TRANSLATIONS = {
    ("job_function", "fr"): JOB_FUNCTION_FR,
    ("job_function", "de"): JOB_FUNCTION_DE,
    ("mission_type", "fr"): MISSION_TYPE_FR,
    ("mission_type", "de"): MISSION_TYPE_DE,
}

# FIXED VALUES (must equal the reference): the six sites and their keys.
SITES = {1: "paris", 2: "shanghai", 3: "berlin", 4: "london", 5: "losangeles", 6: "newyork"}

# FIXED VALUES (must equal the reference): distance adjustment rules of the notebook
# (plane +95 km; taxi and train x1.2; public transport x1.5), as (mode, op, operand).
NOTEBOOK_DISTANCE_RULES = [(PLANE, "add", 95.0), (TAXI, "mul", 1.2), (TRAIN, "mul", 1.2), (PUBLIC, "mul", 1.5)]

# Geodesy: WGS-84 ellipsoid (public standard).
WGS84_A_KM = 6378.137
WGS84_F = 1.0 / 298.257223563


@dataclass(frozen=True)
class FactorBand:
    """One row of an emission factor table.

    The emission of a trip is ``factor * ((km + add_km) * mul)`` where ``km`` is
    the value distance, and the band is chosen on the tier distance:
    ``lo <(=) tier_km <(=) hi`` (``None`` = unbounded).
    """

    mode: str
    factor: float
    lo: float | None = None
    hi: float | None = None
    lo_closed: bool = True
    hi_closed: bool = False
    add_km: float = 0.0
    mul: float = 1.0


@dataclass(frozen=True)
class FactorSet:
    name: str
    unit: str
    bands: tuple[FactorBand, ...]
    default: float | None  # value for modes without a band


# FIXED VALUES (must equal the reference): emission set "A" of the notebook, kg CO2e.
# Tier on the one-way distance, value on the (possibly doubled) distance; plane adds
# 95 km after doubling; train x1.2; taxi x1.2 and x2 again; public transport x1.5;
# unknown modes give 0.0.
SET_A = FactorSet(
    name="A",
    unit="kg",
    bands=(
        FactorBand(PLANE, 0.2586, hi=1000.0, add_km=95.0),
        FactorBand(PLANE, 0.1875, lo=1000.0, hi=3500.0, add_km=95.0),
        FactorBand(PLANE, 0.1520, lo=3500.0, add_km=95.0),
        FactorBand(TRAIN, 0.0033, hi=200.0, mul=1.2),
        FactorBand(TRAIN, 0.018, lo=200.0, mul=1.2),
        FactorBand(TAXI, 0.215, mul=1.2 * 2),
        FactorBand(PUBLIC, 0.129, mul=1.5),
    ),
    default=0.0,
)

# FIXED VALUES (must equal the reference): emission set "B" of the helper module,
# tonnes CO2e on the already adjusted total distance; plane bands <1000, [1000, 3500],
# >3500; train <200 / >=200; unknown modes give null.
SET_B = FactorSet(
    name="B",
    unit="t",
    bands=(
        FactorBand(PLANE, 0.2586 / 1000, hi=1000.0),
        FactorBand(PLANE, 0.1875 / 1000, lo=1000.0, hi=3500.0, hi_closed=True),
        FactorBand(PLANE, 0.1520 / 1000, lo=3500.0, lo_closed=False),
        FactorBand(TRAIN, 0.0180 / 1000, hi=200.0),
        FactorBand(TRAIN, 0.0033 / 1000, lo=200.0),
        FactorBand(TAXI, 0.2156 / 1000),
        FactorBand(PUBLIC, 0.1290 / 1000),
    ),
    default=None,
)

FACTOR_SETS = {"A": SET_A, "B": SET_B}

# ---------------------------------------------------------------------------
# Mapping of the driver tables onto the model (our choice, SURVEY 7.3).
# ---------------------------------------------------------------------------
# o_orderpriority leading digit -> transport mode.
PRIORITY_TRANSPORT = {"1": PLANE, "2": TRAIN, "3": TAXI, "4": PUBLIC, "5": OTHER}
# c_mktsegment -> job function (the reference's five harmonised functions).
SEGMENT_JOB = {
    "AUTOMOBILE": "Data Engineer",
    "BUILDING": "Economist",
    "FURNITURE": "HRD",
    "HOUSEHOLD": "Business Executive",
    "MACHINERY": "Computer Engineer",
}
# l_returnflag -> mission type.
RETURNFLAG_TYPE = {"A": "Business Meeting", "N": "Team Meeting", "R": "Vocational Training"}
# p_type -> equipment type.
PTYPE_EQUIPMENT = {
    "ECONOMY": "PC portable",
    "LARGE": "Ecran",
    "MEDIUM": "PC fixe sans ecran",
    "PROMO": "Tablette",
    "SMALL": "Smartphone",
    "STANDARD": "Serveur",
}
# Birth date of a person: a deterministic offset from the key.
BIRTH_EPOCH = "1940-01-01"
BIRTH_MULT = 7919
BIRTH_SPAN_DAYS = 14610
# Synthetic coordinates of nation k: with a = k % 5, b = (k - a) / 5,
# lat = 10 + 8a + b, lon = -50 + 25a + 1.1b.
