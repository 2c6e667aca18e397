"""Hand-made raw sales files (two batches) covering the cases of the warehouse load."""

from __future__ import annotations

import csv
import os

from strata.sources.tables import OFFLINE_COLUMNS, ONLINE_COLUMNS


def _row(columns, **kw):
    return [kw.get(c, "") for c in columns]


def online(tid, ts, **kw):
    base = dict(transaction_id=tid, timestamp=ts, customer_id="C1", customer_first_name="Ann",
                customer_last_name="Lee", customer_email="ann@x.com", customer_age="30", customer_gender="F",
                product_id="P1", product_name="Lamp", price="10.00", product_manufacturer="Acme",
                product_category="Home", product_subcategory="Decor", quantity="2", discount="0.10",
                total_amount="18.00", payment_method="Credit Card", card_type="Visa",
                verification_method="PIN", device_type="Mobile", browser_used="Chrome")
    base.update(kw)
    return _row(ONLINE_COLUMNS, **base)


def offline(tid, ts, **kw):
    base = dict(transaction_id=tid, timestamp=ts, product_id="P1", product_name="Lamp", price="10.00",
                product_manufacturer="Acme", product_category="Home", product_subcategory="Decor",
                purchase_region="Europe", purchase_country="France", purchase_city="Paris",
                purchase_address="1 Rue", employee_id="1000", employee_first_name="Bob",
                employee_last_name="Ray", employee_email="bob@x.com", quantity="1", discount="0.00",
                total_amount="10.00", payment_method="Cash", card_type="", verification_method="")
    base.update(kw)
    return _row(OFFLINE_COLUMNS, **base)


BATCH1_ONLINE = [
    online("T1", "2024-06-01 10:15:00"),
    online("T1", "2024-06-01 11:15:00"),                                   # same 21 columns: collapses (Q1)
    online("T2", "2024-06-02 09:00:00", customer_id="C2", card_type="  visa ", product_id="P2",
           product_name="Desk", product_category="Home", product_subcategory="Furniture"),
    online("T3", "2024-06-03 20:30:00", browser_used=""),                  # half-null device (Q5)
    online("", "2024-06-03 20:30:00"),                                     # missing key: dropped (F1)
    online("T4", "2024-01-20 08:00:00", customer_id="C3"),                 # old month
    online("T5", "2024-06-20 12:00:00", payment_method="PayPal", card_type="", verification_method=""),
]
BATCH1_OFFLINE = [
    offline("T10", "2024-06-01 09:00:00"),                                 # employee 1000 at 1 Rue
    offline("T11", "2024-06-05 09:00:00", purchase_address="2 Rue"),       # moved -> new version
    offline("T12", "2024-06-10 09:00:00"),                                 # back at 1 Rue -> new version
    offline("T13", "2024-06-12 09:00:00", employee_id="2000", employee_first_name="Cy",
            purchase_city="Springfield", purchase_country="USA", purchase_region="North America",
            purchase_address="5 Main"),
    offline("T14", "2024-06-12 10:00:00", employee_id="2001", employee_first_name="Di",
            purchase_city="Springfield", purchase_country="Canada", purchase_region="North America",
            purchase_address="5 Main"),                                    # same city name, other country (Q6)
]
BATCH2_ONLINE = [
    online("T1", "2024-06-01 10:15:00"),                                   # re-delivered: no new row
    online("T2", "2024-06-02 09:30:00", customer_id="C2", card_type="VISA", product_id="P2",
           product_name="Desk", product_category="Home", product_subcategory="Furniture", quantity="3",
           total_amount="27.00"),                                           # corrected sale (Q2 fixed)
    online("T6", "2024-06-25 12:00:00", customer_id="C9"),                  # new customer
]
BATCH2_OFFLINE = [
    offline("T15", "2024-06-07 09:00:00", purchase_address="3 Rue"),       # late event inside a version
    offline("T16", "2024-06-30 09:00:00"),
]


def write(path: str, columns, rows) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(columns)
        w.writerows(rows)
    return path


def write_batches(base: str) -> dict[str, tuple[str, str]]:
    return {
        "b1": (write(f"{base}/b1/online.csv", ONLINE_COLUMNS, BATCH1_ONLINE),
               write(f"{base}/b1/offline.csv", OFFLINE_COLUMNS, BATCH1_OFFLINE)),
        "b2": (write(f"{base}/b2/online.csv", ONLINE_COLUMNS, BATCH2_ONLINE),
               write(f"{base}/b2/offline.csv", OFFLINE_COLUMNS, BATCH2_OFFLINE)),
    }
