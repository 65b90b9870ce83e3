"""SQL text of the factors, bands, rules and labels, written out by hand for the oracles.

The library compiles the same values from ``fixed``; the oracles must not share
that code, so that a wrong factor, band edge or label in either place shows as
a difference.
"""

from __future__ import annotations

# FIXED VALUES: set A, kg, for mode, one-way km and total km (km x 2 for a return trip).
EMISSION_A = """(CASE
  WHEN {mode} IN ('plane', 'train', 'taxi', 'public_transport') AND ({km} IS NULL OR {total} IS NULL) THEN NULL
  WHEN {mode} = 'plane' THEN (CASE WHEN {km} < 1000.0e0 THEN 0.2586e0 WHEN {km} < 3500.0e0 THEN 0.1875e0 ELSE 0.152e0 END)
                             * ({total} + 95.0e0)
  WHEN {mode} = 'train' THEN (CASE WHEN {km} < 200.0e0 THEN 0.0033e0 ELSE 0.018e0 END) * ({total} * 1.2e0)
  WHEN {mode} = 'taxi' THEN 0.215e0 * ({total} * 1.2e0 * 2.0e0)
  WHEN {mode} = 'public_transport' THEN 0.129e0 * ({total} * 1.5e0)
  ELSE 0.0e0 END)"""

# FIXED VALUES: set B, tonnes, on the adjusted total km.
EMISSION_B = """(CASE
  WHEN {mode} = 'plane' AND {km} < 1000.0e0 THEN 0.2586e0 * {km} / 1000.0e0
  WHEN {mode} = 'plane' AND {km} <= 3500.0e0 THEN 0.1875e0 * {km} / 1000.0e0
  WHEN {mode} = 'plane' AND {km} > 3500.0e0 THEN 0.152e0 * {km} / 1000.0e0
  WHEN {mode} = 'train' AND {km} < 200.0e0 THEN 0.018e0 * {km} / 1000.0e0
  WHEN {mode} = 'train' AND {km} >= 200.0e0 THEN 0.0033e0 * {km} / 1000.0e0
  WHEN {mode} = 'taxi' THEN 0.2156e0 * {km} / 1000.0e0
  WHEN {mode} = 'public_transport' THEN 0.129e0 * {km} / 1000.0e0
  ELSE NULL END)"""

# FIXED VALUES: distance adjustment by mode.
ADJUSTED_KM = """(CASE {mode} WHEN 'plane' THEN {km} + 95.0e0 WHEN 'taxi' THEN {km} * 1.2e0
  WHEN 'train' THEN {km} * 1.2e0 WHEN 'public_transport' THEN {km} * 1.5e0 ELSE {km} END)"""

TRANSPORT = """(CASE substr({col}, 1, 1) WHEN '1' THEN 'plane' WHEN '2' THEN 'train' WHEN '3' THEN 'taxi'
  WHEN '4' THEN 'public_transport' ELSE 'other' END)"""
JOB_FUNCTION = """(CASE {col} WHEN 'AUTOMOBILE' THEN 'Data Engineer' WHEN 'BUILDING' THEN 'Economist'
  WHEN 'FURNITURE' THEN 'HRD' WHEN 'HOUSEHOLD' THEN 'Business Executive' WHEN 'MACHINERY' THEN 'Computer Engineer'
  ELSE {col} END)"""
MISSION_TYPE = """(CASE {col} WHEN 'A' THEN 'Business Meeting' WHEN 'N' THEN 'Team Meeting'
  WHEN 'R' THEN 'Vocational Training' ELSE {col} END)"""
EQUIPMENT_TYPE = """(CASE {col} WHEN 'ECONOMY' THEN 'PC portable' WHEN 'LARGE' THEN 'Ecran'
  WHEN 'MEDIUM' THEN 'PC fixe sans ecran' WHEN 'PROMO' THEN 'Tablette' WHEN 'SMALL' THEN 'Smartphone'
  WHEN 'STANDARD' THEN 'Serveur' ELSE {col} END)"""
