"""Measured records of the feed and a factory for crafted ones."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from gridtide.operators.contract import apply_contract

# Seven measured quarter-hours of the feed, three observed lately and four of an earlier window.
RECORDS = [
    {
        "date": "2026-07-14", "heure": "14:45", "date_heure": "2026-07-14T14:45:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 48586, "prevision_j": 47350,
        "prevision_j1": 45550, "fioul": 34, "charbon": 0, "gaz": 478, "nucleaire": 37432, "eolien": 2269,
        "eolien_terrestre": 1413, "eolien_offshore": 855, "solaire": 16275, "hydraulique": 3503,
        "pompage": -2242, "bioenergies": 992, "ech_physiques": -10140, "taux_co2": 12,
        "ech_comm_angleterre": -2671, "ech_comm_espagne": 289, "ech_comm_italie": -2500,
        "ech_comm_suisse": -2227, "ech_comm_allemagne_belgique": -2822, "fioul_tac": 0, "fioul_cogen": 35,
        "fioul_autres": 0, "gaz_tac": 0, "gaz_cogen": 116, "gaz_ccg": 364, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2514, "hydraulique_lacs": 650, "hydraulique_step_turbinage": 339,
        "bioenergies_dechets": 409, "bioenergies_biomasse": 282, "bioenergies_biogaz": 301,
        "stockage_batterie": -22, "destockage_batterie": 9,
    },
    {
        "date": "2026-07-14", "heure": "14:30", "date_heure": "2026-07-14T14:30:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 48389, "prevision_j": 47500,
        "prevision_j1": 45700, "fioul": 34, "charbon": 0, "gaz": 342, "nucleaire": 37544, "eolien": 2300,
        "eolien_terrestre": 1470, "eolien_offshore": 830, "solaire": 16944, "hydraulique": 3426,
        "pompage": -2241, "bioenergies": 989, "ech_physiques": -10924, "taux_co2": 11,
        "ech_comm_angleterre": -2671, "ech_comm_espagne": 268, "ech_comm_italie": -2500,
        "ech_comm_suisse": -2227, "ech_comm_allemagne_belgique": -2922, "fioul_tac": 0, "fioul_cogen": 35,
        "fioul_autres": 0, "gaz_tac": 0, "gaz_cogen": 116, "gaz_ccg": 227, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2516, "hydraulique_lacs": 574, "hydraulique_step_turbinage": 336,
        "bioenergies_dechets": 411, "bioenergies_biomasse": 276, "bioenergies_biogaz": 301,
        "stockage_batterie": -32, "destockage_batterie": 9,
    },
    {
        "date": "2026-07-14", "heure": "14:15", "date_heure": "2026-07-14T14:15:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 48441, "prevision_j": 47600,
        "prevision_j1": 45850, "fioul": 34, "charbon": 0, "gaz": 314, "nucleaire": 37457, "eolien": 2305,
        "eolien_terrestre": 1533, "eolien_offshore": 773, "solaire": 17514, "hydraulique": 3317,
        "pompage": -2253, "bioenergies": 1000, "ech_physiques": -11223, "taux_co2": 11,
        "ech_comm_angleterre": -2671, "ech_comm_espagne": -587, "ech_comm_italie": -2469,
        "ech_comm_suisse": -2218, "ech_comm_allemagne_belgique": -2565, "fioul_tac": 0, "fioul_cogen": 35,
        "fioul_autres": 0, "gaz_tac": 0, "gaz_cogen": 116, "gaz_ccg": 200, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2511, "hydraulique_lacs": 474, "hydraulique_step_turbinage": 332,
        "bioenergies_dechets": 413, "bioenergies_biomasse": 286, "bioenergies_biogaz": 301,
        "stockage_batterie": -31, "destockage_batterie": 8,
    },
    {
        "date": "2026-07-14", "heure": "00:00", "date_heure": "2026-07-14T00:00:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 41716, "prevision_j": 41400,
        "prevision_j1": 41400, "fioul": 34, "charbon": 0, "gaz": 4698, "nucleaire": 36321, "eolien": 6187,
        "eolien_terrestre": 5156, "eolien_offshore": 1031, "solaire": 0, "hydraulique": 4165, "pompage": 0,
        "bioenergies": 1005, "ech_physiques": -10715, "taux_co2": 48, "ech_comm_angleterre": -885,
        "ech_comm_espagne": -700, "ech_comm_italie": -3597, "ech_comm_suisse": -2227,
        "ech_comm_allemagne_belgique": -3572, "fioul_tac": 0, "fioul_cogen": 35, "fioul_autres": 0,
        "gaz_tac": 0, "gaz_cogen": 120, "gaz_ccg": 4579, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2884, "hydraulique_lacs": 1110, "hydraulique_step_turbinage": 170,
        "bioenergies_dechets": 411, "bioenergies_biomasse": 293, "bioenergies_biogaz": 301,
        "stockage_batterie": -3, "destockage_batterie": 24,
    },
    {
        "date": "2026-07-14", "heure": "00:15", "date_heure": "2026-07-14T00:15:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 41397, "prevision_j": 40917,
        "prevision_j1": 40750, "fioul": 34, "charbon": 0, "gaz": 4539, "nucleaire": 36336, "eolien": 5920,
        "eolien_terrestre": 4921, "eolien_offshore": 999, "solaire": 0, "hydraulique": 4179, "pompage": 0,
        "bioenergies": 1010, "ech_physiques": -10643, "taux_co2": 47, "ech_comm_angleterre": -885,
        "ech_comm_espagne": -700, "ech_comm_italie": -3597, "ech_comm_suisse": -2227,
        "ech_comm_allemagne_belgique": -4051, "fioul_tac": 0, "fioul_cogen": 35, "fioul_autres": 0,
        "gaz_tac": 0, "gaz_cogen": 120, "gaz_ccg": 4421, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2877, "hydraulique_lacs": 1105, "hydraulique_step_turbinage": 168,
        "bioenergies_dechets": 415, "bioenergies_biomasse": 293, "bioenergies_biogaz": 301,
        "stockage_batterie": -3, "destockage_batterie": 30,
    },
    {
        "date": "2026-07-14", "heure": "00:30", "date_heure": "2026-07-14T00:30:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 40449, "prevision_j": 40434,
        "prevision_j1": 40100, "fioul": 34, "charbon": 0, "gaz": 4325, "nucleaire": 36296, "eolien": 5883,
        "eolien_terrestre": 4900, "eolien_offshore": 983, "solaire": 0, "hydraulique": 4108, "pompage": 0,
        "bioenergies": 1013, "ech_physiques": -11233, "taux_co2": 46, "ech_comm_angleterre": -885,
        "ech_comm_espagne": -700, "ech_comm_italie": -3597, "ech_comm_suisse": -2227,
        "ech_comm_allemagne_belgique": -4244, "fioul_tac": 0, "fioul_cogen": 35, "fioul_autres": 0,
        "gaz_tac": 0, "gaz_cogen": 120, "gaz_ccg": 4207, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2868, "hydraulique_lacs": 1043, "hydraulique_step_turbinage": 169,
        "bioenergies_dechets": 418, "bioenergies_biomasse": 294, "bioenergies_biogaz": 301,
        "stockage_batterie": -11, "destockage_batterie": 36,
    },
    {
        "date": "2026-07-14", "heure": "00:45", "date_heure": "2026-07-14T00:45:00+00:00",
        "nature": "Données temps réel", "perimetre": "France", "consommation": 39714, "prevision_j": 39792,
        "prevision_j1": 39500, "fioul": 34, "charbon": 0, "gaz": 3873, "nucleaire": 36327, "eolien": 5728,
        "eolien_terrestre": 4744, "eolien_offshore": 984, "solaire": 0, "hydraulique": 4099, "pompage": -1,
        "bioenergies": 1018, "ech_physiques": -11370, "taux_co2": 43, "ech_comm_angleterre": -885,
        "ech_comm_espagne": -700, "ech_comm_italie": -3597, "ech_comm_suisse": -2227,
        "ech_comm_allemagne_belgique": -4388, "fioul_tac": 0, "fioul_cogen": 35, "fioul_autres": 0,
        "gaz_tac": 0, "gaz_cogen": 120, "gaz_ccg": 3754, "gaz_autres": 0,
        "hydraulique_fil_eau_eclusee": 2860, "hydraulique_lacs": 1043, "hydraulique_step_turbinage": 169,
        "bioenergies_dechets": 422, "bioenergies_biomasse": 295, "bioenergies_biogaz": 301,
        "stockage_batterie": -4, "destockage_batterie": 11,
    },
]
OBSERVED, WINDOW = RECORDS[:3], RECORDS[3:]
BASE = datetime(2026, 7, 14, 12, 0, tzinfo=timezone.utc)


def at(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def record(moment: datetime = BASE, drop: tuple[str, ...] = (), **overrides) -> dict:
    made = OBSERVED[0] | {"date_heure": moment.isoformat()} | overrides
    return {name: value for name, value in made.items() if name not in drop}


def quarters(start: datetime, count: int, **overrides) -> list[dict]:
    return [record(start + timedelta(minutes=15 * n), **overrides) for n in range(count)]


def frame(spark, records: list):
    """Records as the landed (seq, record) frame."""
    rows = [(n, json.dumps(r)) for n, r in enumerate(records)]
    return spark.createDataFrame(rows, "seq bigint, record string")


def parsed(spark, records: list):
    return apply_contract(frame(spark, records))


def stored(spark, records: list):
    """Accepted rows as they would lie in the raw table."""
    return parsed(spark, records).drop("seq", "reject")
