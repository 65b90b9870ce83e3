"""Explicit schemas of the raw inputs (no schema inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

MISSION = T.StructType([
    T.StructField("ID_MISSION", S), T.StructField("ID_PERSONNEL", S), T.StructField("NOM_PERSONNEL", S),
    T.StructField("PRENOM_PERSONNEL", S), T.StructField("DATE_MISSION", T.TimestampType()),
    T.StructField("TYPE_MISSION", S), T.StructField("VILLE_DEPART", S), T.StructField("PAYS_DEPART", S),
    T.StructField("VILLE_DESTINATION", S), T.StructField("PAYS_DESTINATION", S), T.StructField("TRANSPORT", S),
    T.StructField("ALLER_RETOUR", S),
])

EQUIPMENT = T.StructType([
    T.StructField("ID_MATERIELINFO", S), T.StructField("ID_PERSONNEL", S), T.StructField("NOM_PERSONNEL", S),
    T.StructField("PRENOM_PERSONNEL", S), T.StructField("DATE_ACHAT", T.TimestampType()), T.StructField("TYPE", S),
    T.StructField("MODELE", S),
])

PERSONNEL = T.StructType([
    T.StructField("ID_PERSONNEL", S), T.StructField("NOM_PERSONNEL", S), T.StructField("PRENOM_PERSONNEL", S),
    T.StructField("FONCTION_PERSONNEL", S), T.StructField("DT_NAISS", T.DateType()),
])

IMPACTS = T.StructType([
    T.StructField("Type", S), T.StructField("Modèle", S), T.StructField("Impact", T.DoubleType()),
])

KEYS = {"mission": "ID_MISSION", "equipment": "ID_MATERIELINFO"}
KINDS = {"mission": ("MISSION", MISSION), "equipment": ("INFORMATIQUE", EQUIPMENT)}
CORRUPT = "_corrupt_record"
