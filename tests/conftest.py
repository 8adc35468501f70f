from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tollgate.session import local_session  # noqa: E402

SUPPLIER_COLS = ["supplier_id", "supplier_name", "country", "email", "phone", "contract_start_date", "payment_terms",
                 "quality_rating", "status", "source_system", "load_timestamp"]
PART_COLS = ["part_id", "part_number", "part_name", "part_category", "supplier_id", "unit_price", "unit_of_measure",
             "lead_time_days", "is_critical", "spec_revision", "created_date", "source_system"]
WO_COLS = ["work_order_id", "part_id", "quantity_ordered", "quantity_received", "order_date", "expected_delivery",
           "actual_delivery", "unit_cost", "total_cost", "status", "defect_count", "source_system", "load_timestamp"]


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="tollgate-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bronze_suppliers(spark):
    # Seeded defects (own values): padded name (S02), DD/MM/YYYY date (S03),
    # null e-mail (S04), sentinel date + bad status + non-numeric rating (S99),
    # blank name (S05), malformed e-mail (S06).
    rows = [
        ("S01", "Alpha Aero", "US", "ops@alpha.test", "1", "2021-03-01", "NET30", "4.5", "ACTIVE", "ERP_SAP", "2024-01-15 06:00:00"),
        ("S02", "  Beta Parts ", "FR", "hi@beta.test", "2", "2020-11-20", "NET45", "3.9", "ACTIVE", "ERP_SAP", "2024-01-15 06:00:00"),
        ("S03", "Gamma Ltd", "GB", "g@gamma.test", "3", "14/07/2022", "NET60", "4.1", "PROBATION", "MDM_PROFISEE", "2024-01-15 06:00:00"),
        ("S04", "Delta Co", "DE", None, "4", "2019-05-05", "NET90", "2.8", "INACTIVE", "MANUAL_ENTRY", "2024-01-15 06:00:00"),
        ("S05", "   ", "JP", "e@eps.test", "5", "2023-01-09", "NET30", "3.3", "SUSPENDED", "LEGACY_SYSTEM", "2024-01-15 06:00:00"),
        ("S06", "Zeta Inc", "CA", "bad mail", "6", "2022-02-02", "NET45", "4.8", "ACTIVE", "ERP_SAP", "2024-01-15 06:00:00"),
        ("S07", "Eta Group", "AU", "eta@eta.test", "7", "2030-01-01", "NET30", "4.0", "ACTIVE", "ERP_SAP", "2024-01-15 06:00:00"),
        ("S99", "Omega", "US", "o@omega.test", "9", "-999", "NET30", "INACTIVE", "LEGACY_SYSTEM", "2024-01-15 06:00:00", None),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SUPPLIER_COLS))


@pytest.fixture(scope="session")
def bronze_parts(spark):
    # P20: negative price on a critical part; P21: null supplier; P22: blank
    # name; P23: orphan supplier; P24: lead time out of range.
    rows = [
        ("P01", "PN-1", "valve", "AVIONICS", "S01", 120.0, "EA", 30, True, "R1", "2020-01-01", "ERP_SAP"),
        ("P02", "PN-2", "pump", "HYDRAULIC", "S02", 80.5, "EA", 45, False, "R1", "2020-02-01", "ERP_SAP"),
        ("P03", "PN-3", "seat", "INTERIOR", "S03", 55.0, "SET", 21, False, "R2", "2020-03-01", "ERP_SAP"),
        ("P04", "PN-4", "strut", "AIRFRAME", "S04", 990.0, "EA", 60, True, "R1", "2020-04-01", "ERP_SAP"),
        ("P05", "PN-5", "wire", "ELECTRICAL", "S06", 3.25, "FT", 10, False, "R3", "2020-05-01", "ERP_SAP"),
        ("P20", "PN-20", "blade", "PROPULSION", "S01", -500.0, "EA", 90, True, "R1", "2020-06-01", "ERP_SAP"),
        ("P21", "PN-21", "gear", "LANDING_GEAR", None, 410.0, "KIT", 120, False, "R1", "2020-07-01", "ERP_SAP"),
        ("P22", "PN-22", "  ", "SAFETY", "S07", 75.0, "EA", 14, False, "R1", "2020-08-01", "ERP_SAP"),
        ("P23", "PN-23", "panel", "AIRFRAME", "SXXX", 60.0, "EA", 30, True, "R1", "2020-09-01", "ERP_SAP"),
        ("P24", "PN-24", "duct", "AIRFRAME", "S02", 42.0, "EA", 400, None, "R1", "2020-10-01", "ERP_SAP"),
    ]
    schema = ("part_id string, part_number string, part_name string, part_category string, supplier_id string, unit_price double, "
              "unit_of_measure string, lead_time_days bigint, is_critical boolean, spec_revision string, created_date string, source_system string")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def bronze_work_orders(spark):
    # W09 refers to the rejected P20; W10 to the orphan part; W11 is CLOSED
    # without delivery; W12 received more than ordered.
    rows = [
        ("W01", "P01", 10, 10, "2024-01-05", "2024-02-04", "2024-01-30", 12.0, 120.0, "CLOSED", 0),
        ("W02", "P02", 4, 4, "2024-01-11", "2024-02-10", "2024-02-20", 80.5, 322.0, "CLOSED", 1),
        ("W03", "P01", 5, 2, "2024-02-02", "2024-03-03", "2024-02-25", 120.0, 600.0, "PARTIAL", 0),
        ("W04", "P03", 8, 0, "2024-02-15", "2024-03-16", None, 55.0, 440.0, "OPEN", 0),
        ("W05", "P04", 1, 1, "2024-03-01", "2024-03-31", "2024-03-29", 990.0, 990.0, "CLOSED", 1),
        ("W06", "P05", 100, 100, "2024-03-09", "2024-04-08", "2024-04-01", 3.25, 325.0, "CLOSED", 3),
        ("W09", "P20", 2, 2, "2024-01-20", "2024-02-19", "2024-02-01", 500.0, 1000.0, "CLOSED", 0),
        ("W10", "PXXX", 3, 3, "2024-01-21", "2024-02-20", "2024-02-02", 10.0, 30.0, "CLOSED", 0),
        ("W11", "P02", 6, 6, "2024-03-12", "2024-04-11", None, 80.5, 483.0, "CLOSED", 0),
        ("W12", "P03", 2, 5, "2024-03-20", "2024-04-19", "2024-04-10", 55.0, 110.0, "PARTIAL", 0),
    ]
    full = [r + ("ERP_SAP", "2024-04-30 06:00:00") for r in rows]
    schema = ("work_order_id string, part_id string, quantity_ordered bigint, quantity_received bigint, order_date string, "
              "expected_delivery string, actual_delivery string, unit_cost double, total_cost double, status string, "
              "defect_count bigint, source_system string, load_timestamp string")
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def silver(spark, bronze_suppliers, bronze_parts, bronze_work_orders):
    from tollgate.operators import transform as T

    sup = T.promote_suppliers(bronze_suppliers, "2024-05-01")
    par = T.promote_parts(bronze_parts, sup.promoted, "2024-05-01")
    wo = T.promote_work_orders(bronze_work_orders, par.promoted, "2024-05-01")
    return {"suppliers": sup, "parts": par, "work_orders": wo}


def collect_set(df, *cols):
    return {tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}
