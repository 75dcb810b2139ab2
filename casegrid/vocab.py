"""Closed vocabularies, policy sets and precedence of the evidence engine."""

from __future__ import annotations

# The domain's closed vocabularies.
SPECIES = ["ALPHA_DRACONIAN", "ANDROMEDAN", "AQUARIAN_MANTIS", "ARCTURIAN", "CENTAURI_SYNTH", "JOVIAN_GASFORM", "KAIJU_MICRO", "LUNA_SECURID", "ORION_GRAYS", "SIRIUS_AVIAN", "TRIANGULAN", "VENUSIAN_MYCELIAL"]
WORLDS = ["Barnard-c", "Eris Relay", "Europa Station", "Gliese-581g", "Kepler-186f", "Luyten-b", "Mars Dome-7", "Proxima-b", "Sirius Outpost", "TRAPPIST-1e", "Titan Freeport", "Wolf-1061c", "Zeta Reticuli"]
PURPOSES = ["archive audit", "cultural exchange", "diplomatic", "field repair", "medical consult", "reactor maintenance", "research", "transit", "translation", "xenobotany"]
VISAS = ["DIP-1", "MED-3", "TRANSIT-7", "XW-1", "XW-2"]
FEES = ["paid", "waived", "unpaid", "unknown"]
DISQUALIFYING_FLAGS = ["memory_tampering", "planetary_embargo", "active_warrant", "biohazard_red"]
REVIEW_FLAGS = ["identity_conflict", "sponsor_mismatch", "illegible_biometrics", "rescinded_denial"]
FLAGS = DISQUALIFYING_FLAGS + REVIEW_FLAGS

# Policy sets.
REVOKED_SPONSORS = ["SPN-0007", "SPN-0139", "SPN-4040", "SPN-7331", "SPN-2718", "SPN-9090"]
HARD_EMBARGO_WORLDS = ["Eris Relay", "TRAPPIST-1e"]
SOFT_EMBARGO_WORLDS = ["Wolf-1061c"]

# Formats.
CASE_ID = r"\AMIB-\d{6}\z"
SPONSOR_ID = r"\ASPN-\d{4}\z"
ISO_DATE = r"\A\d{4}-\d{2}-\d{2}\z"
WAIVER_CODE = r"\A(DIP-WAIVER|HARDSHIP-\d{2,})\z"

# Fields, their fallbacks, and evidence precedence (1 is best).
FALLBACKS = {"applicant_name": "Tekdane Ixovara", "species_code": "TRIANGULAN", "home_world": "Luyten-b", "visa_class": "MED-3", "sponsor_id": "SPN-5000", "arrival_date": "2026-05-01", "declared_purpose": "research", "risk_flags": "none", "fee_status": "paid"}
FIELDS = list(FALLBACKS)
DENY_RELEVANT = ["risk_flags", "fee_status", "home_world", "visa_class", "sponsor_id"]
AGREEMENT_FIELDS = ["applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "declared_purpose", "arrival_date"]
SOURCE_RANK = {"note": 1, "intake": 2, "fee_receipt": 2, "biometric": 3, "slip_label": 3, "sponsor_letter": 4, "letter_label": 4, "registry": 5, "unknown": 6}
TEXT_SOURCES = ["slip_label", "sponsor_letter", "letter_label"]
FIELD_SOURCE_RANK = {
    "applicant_name": {"slip_label": 2, "registry": 3, "biometric": 3, "intake": 4, "sponsor_letter": 4},
    "sponsor_id": {"sponsor_letter": 2, "letter_label": 2, "intake": 3},
    "visa_class": {"sponsor_letter": 2, "letter_label": 2, "intake": 3},
}
