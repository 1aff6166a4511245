"""A clean return to vary, and a batch loader that works row by row."""

from __future__ import annotations

import datetime
import random

from histlake.schema import AUDITED, CANONICAL_COLUMNS, IDENTITY, MEASURES, TRACKED

CLEAN = {
    "taxpayer_id": "P1",
    "nric": "T7654321K",
    "full_name": "Pat Example",
    "filing_status": "Single",
    "assessment_year": "2023",
    "filing_date": "2024-03-11",
    "annual_income_sgd": "64300",
    "chargeable_income_sgd": "52500",
    "tax_payable_sgd": "4310",
    "tax_paid_sgd": "4400",
    "total_reliefs_sgd": "11800",
    "number_of_dependents": "0",
    "occupation": "Baker",
    "residential_status": "Resident",
    "postal_code": "520123",
    "housing_type": "Terrace",
    "cpf_contributions_sgd": "9100",
    "foreign_income_sgd": "0",
    "employer_id": "E1",
    "batch_date": None,
    "record_type": "new",
}

LOG_DDL = ", ".join(f"{c} string" for c in CANONICAL_COLUMNS) + (
    ", batch string, batch_seq int, row_pos bigint"
)


def returns(*changes: dict) -> list[dict]:
    return [{**CLEAN, **c} for c in changes]


def frame(spark, rows: list[dict], batch: str = "day1", seq: int = 1):
    full = [
        tuple(r[c] for c in CANONICAL_COLUMNS)
        + (r.get("batch", batch), r.get("batch_seq", seq), r.get("row_pos", i))
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, LOG_DDL)


def date_of(text: str | None) -> datetime.date | None:
    try:
        return datetime.date.fromisoformat(text)
    except (TypeError, ValueError):
        return None


def number_of(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


class RowByRow:
    """Loads batches one row at a time into plain lists and dictionaries."""

    END = datetime.date(9999, 12, 31)

    def __init__(self, employers: set[str]):
        self.employers = employers
        self.versions: dict[str, list[dict]] = {}
        self.facts: dict[tuple[str, int], dict] = {}
        self.audit: list[tuple] = []

    def load(self, rows: list[dict], batch_date: str | None) -> None:
        day = date_of(batch_date)
        usable = [r for r in rows if r["taxpayer_id"] and (r["assessment_year"] or "").isdigit()]
        people: dict[str, dict] = {}
        for r in usable:
            held = people.setdefault(r["taxpayer_id"], {})
            held[r["record_type"] if r["record_type"] in ("correction", "update") else "other"] = r
            if r["record_type"] in ("update", "correction"):
                held["acting"] = r
        for key, held in people.items():
            if key not in self.versions:
                self._person(key, held.get("acting", held.get("other")), day)
            else:
                for kind in ("correction", "update"):
                    if kind in held:
                        self._person(key, held[kind], day)
        latest = {(r["taxpayer_id"], int(r["assessment_year"])): r for r in usable}
        for key, r in latest.items():
            self._fact(key, r, day)

    def _person(self, key: str, r: dict, day) -> None:
        history = self.versions.setdefault(key, [])
        attributes = {c: r[c] for c in TRACKED + IDENTITY}
        if not history:
            history.append({**attributes, "lo": date_of(r["filing_date"]), "hi": self.END})
        elif r["record_type"] == "correction":
            history[-1].update(attributes)
        elif r["record_type"] == "update" and any(history[-1][c] != r[c] for c in TRACKED):
            history[-1]["hi"] = day
            history.append({**attributes, "lo": day, "hi": self.END})

    def _fact(self, key: tuple[str, int], r: dict, day) -> None:
        measures = {m: number_of(r[m]) for m in MEASURES}
        before = self.facts.get(key)
        if before and r["record_type"] == "correction":
            old = tuple(before[m] for m in AUDITED)
            logged = any(a[0] == key and a[2] == old for a in self.audit)
            if old != tuple(measures[m] for m in AUDITED) and not logged:
                self.audit.append((key, day, old))
        filed = date_of(r["filing_date"])
        history = self.versions[key[0]]
        match = [
            i
            for i, v in enumerate(history, 1)
            if filed and v["lo"] and v["hi"] and v["lo"] <= filed < v["hi"]
        ]
        self.facts[key] = {
            **measures,
            "version": match[-1] if match else len(history),
            "employer_id": r["employer_id"] if r["employer_id"] in self.employers else "UNKNOWN",
            "filing_date": filed,
            "record_type": r["record_type"],
        }

    # ---- comparable forms ----

    def version_rows(self) -> list[tuple]:
        return [
            (key, i, *[v[c] for c in TRACKED + IDENTITY], v["lo"], v["hi"], i == len(history))
            for key, history in self.versions.items()
            for i, v in enumerate(history, 1)
        ]

    def fact_rows(self) -> list[tuple]:
        names = ["version", "employer_id", "filing_date", "record_type", *MEASURES]
        return [(*key, *[f[n] for n in names]) for key, f in self.facts.items()]

    def audit_rows(self) -> list[tuple]:
        return [(*key, day, *old) for key, day, old in self.audit]


def random_batches(seed: int, keys: int = 40, batches: int = 6) -> list[tuple[str | None, list[dict]]]:
    """Messy batches: few attribute values, so that unchanged updates, repeated
    corrections, same-day versions, bad dates and duplicate keys all occur."""
    rng = random.Random(seed)
    out = []
    for b in range(1, batches + 1):
        day = None if b in (1, 4) else f"2024-0{b}-01"
        rows = []
        for k in range(keys):
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                date = rng.choice(["2023-12-05", "2024-02-15", f"2024-0{b}-01", "2024-02-30", None])
                rows.append(
                    {
                        **CLEAN,
                        "taxpayer_id": rng.choice([f"P{k}"] * 15 + [None]),
                        "full_name": rng.choice(["A", "B"]),
                        "nric": rng.choice(["T7654321K", None]),
                        "assessment_year": rng.choice(["2023", "2023", "2022", "x"]),
                        "filing_date": date,
                        "occupation": rng.choice(["Baker", "Nurse", None]),
                        "postal_code": rng.choice(["520123", "BADPOST"]),
                        "annual_income_sgd": rng.choice(["100", "200", "n/a"]),
                        "tax_paid_sgd": rng.choice(["1", "2"]),
                        "employer_id": rng.choice(["E1", "E2", "E9", None]),
                        "batch_date": day,
                        "record_type": rng.choice(
                            ["new", "update", "update", "correction", "correction", "late_arrival"]
                        ),
                    }
                )
        rng.shuffle(rows)
        out.append((day, rows))
    return out
