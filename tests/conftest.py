import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from packetry.runtime import session, ship  # noqa: E402

DATA = "/root/testdata/sf0.001"

RECORD = (
    "record_id bigint, case_id string, applicant_name string, species_code string, home_world string, visa_class string, sponsor_id string, arrival_date string, "
    "declared_purpose string, risk_flags string, fee_status string, fee_observed boolean, sponsor_letter_id string, sponsor_letter_name string, "
    "corrections map<string,string>, field_sources map<string,string>, identity_conflict boolean, read_at timestamp_ntz"
)
NAMES = [x.split()[0] for x in RECORD.split(", ")]

CODE_LIST = [
    (101, "species_code", "TARN_WEAVER", "weaver from the tarns", "TWV"), (102, "species_code", "VELTHARI", "velthari kin", "VLT"),
    (201, "home_world", "Velm-12c", "third body of Velm twelve", "VM12"), (202, "home_world", "Velm-14b", "second body of Velm fourteen", "VM14"), (203, "home_world", "Harrow Relay", "relay at Harrow", "HRRL"),
    (301, "visa_class", "KX-1", "short technical stay", "SHRT"), (302, "visa_class", "BIO-6", "clinical visit", "CLIN"),
    (401, "declared_purpose", "hull welding", "hull welding", None), (402, "declared_purpose", "ore assay", "ore assay", None),
    (501, "risk_flags", "memory_edit", "recent change of recall", "MED"), (502, "risk_flags", "orbit_ban", "barred from orbit", "OBN"), (503, "risk_flags", "open_summons", "summons still pending", "OPS"),
    (601, "fee_status", "paid", "paid", None), (602, "fee_status", "waived", "waived", None), (603, "fee_status", "unpaid", "unpaid", None), (604, "fee_status", "unknown", "unknown", None),
]


@pytest.fixture(scope="session")
def spark():
    s = session(4, 4)
    ship(s)
    return s


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2026, 1, day, hour)


def records(spark, rows: list[dict]):
    """A records table of rows that name only what matters."""
    base = dict.fromkeys(NAMES) | {"fee_observed": False, "identity_conflict": False, "corrections": {}, "field_sources": {}}
    return spark.createDataFrame([tuple((base | {"record_id": i + 1} | r)[n] for n in NAMES) for i, r in enumerate(rows)], RECORD)


def got(df, *cols) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
