"""The job's steps on random ledgers against the rules written out in plain Python."""

import random
import statistics
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallyweave import JobConfig
from tallyweave.config import BANK_SCHEMA, GL_SCHEMA, SALES_SCHEMA
from tallyweave.plans import process

YEAR = 2021
CONFIG = JobConfig("", "", "", "", YEAR, gated_columns=1)


def amount(rng):
    # Half cents included, to exercise the rounding.
    return rng.choice([rng.randint(1, 900) / 8, rng.randint(1, 90000) / 1000, float(rng.randint(1, 50))])


def day(rng):
    """Mostly in the year, sometimes around its edges."""
    start = date(YEAR, 1, 1) - timedelta(days=5)
    return start + timedelta(days=rng.randint(0, 374))


def text(rng, value):
    return rng.choice(["", " ", "  "]) + value + rng.choice(["", " "])


def random_ledgers(seed):
    rng = random.Random(seed)
    ids = [f"T{i}" for i in range(40)]

    def hot(known=40):
        """One id holds a third of all rows; GL and bank do not know the last ones."""
        return "T0" if rng.random() < 1 / 3 else rng.choice(ids[:known])

    sales, gl, bank, known = [], [], [], {}
    for i in range(220):
        key, net = hot(), amount(rng) if rng.random() < 0.9 else None
        sold = day(rng)
        known[key] = (net or 0.0, sold)
        sales.append((
            text(rng, key), text(rng, f"c{i}"), "p", rng.choice(["a ", " A", "b", "c", None]),
            sold.isoformat() if rng.random() < 0.97 else "not a date", 1, 1.0, (net or 0.0) * 1.2, net, 0.0,
            None, None, "S", rng.choice([None, "2021-05-01 00:00:00", "2021-06-01 00:00:00"]),
        ))
    for i in range(260):
        key = hot(known=36)
        net, sold = known.get(key, (amount(rng), day(rng)))
        net = rng.choice([net, net, net + 0.01, amount(rng), None])
        posted = sold + timedelta(days=rng.randint(0, 9)) if rng.random() < 0.7 else day(rng)
        account = rng.choice(["REVENUE"] * 5 + ["VAT"])
        gl.append((f"G{i}", rng.choice([f"J{i}", None]), text(rng, key), account, posted.isoformat(),
                   1.0, net, 0.1, "auto"))
    for i in range(200):
        key = hot(known=32)
        settled = rng.choice([known.get(key, (1.0,))[0], amount(rng)])
        bank.append((f"B{i}", text(rng, key), day(rng).isoformat(), settled, 0.01, "CARD"))
    return sales, gl, bank


def cents(value):
    if value is None:
        return None
    return Decimal(repr(value)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def total(values):
    present = [v for v in values if v is not None]
    return sum(present) if present else None


def in_year(iso):
    try:
        return date.fromisoformat(iso).year == YEAR
    except ValueError:
        return False


def upper(value):
    return None if value is None else value.upper().strip(" ")


def by_hand(sales, gl, bank):
    versions = defaultdict(list)
    for s in sales:
        if in_year(s[4]):
            row = {
                "customer_id": upper(s[1]), "product_category": upper(s[3]),
                "transaction_date": date.fromisoformat(s[4]), "source_net": cents(s[8]) or Decimal(0),
                "source_gross": cents(s[7]), "modified": s[13] or "",
            }
            versions[s[0].strip(" ")].append(row)
    latest = {
        key: max(rows, key=lambda r: (
            r["modified"], r["source_net"], r["source_gross"], r["customer_id"],
            r["product_category"] or "", r["transaction_date"],
        ))
        for key, rows in versions.items()
    }
    posted, settled = defaultdict(lambda: defaultdict(list)), defaultdict(lambda: defaultdict(list))
    for g in gl:
        if g[3] == "REVENUE" and in_year(g[4]):
            posted[g[2].strip(" ")][date.fromisoformat(g[4])].append(cents(g[6]))
    for b in bank:
        if in_year(b[2]):
            settled[b[1].strip(" ")][date.fromisoformat(b[2])].append(cents(b[3]))

    rows = []
    for key, sale in latest.items():
        for posting, nets in (posted.get(key) or {None: []}).items():
            for settlement, amounts in (settled.get(key) or {None: []}).items():
                net, paid = total(nets), total(amounts)
                v1, v2 = sale["source_net"] - (net or 0), (net or 0) - (paid or 0)
                cent = Decimal("0.01")
                lag = (posting - sale["transaction_date"]).days if posting else None
                if net is None:
                    status = "MISSING_IN_GL"
                elif paid is None:
                    status = "MISSING_IN_BANK"
                elif abs(v1) > cent:
                    status = "MULTI_SYSTEM_VARIANCE" if abs(v2) > cent else "GL_VARIANCE"
                elif abs(v2) > cent:
                    status = "BANK_VARIANCE"
                else:
                    status = "TIMING_DIFFERENCE" if lag > 5 else "MATCHED"
                rows.append({
                    "id": key, "category": sale["product_category"], "net": sale["source_net"],
                    "posting": posting, "settlement": settlement, "v1": v1, "v2": v2, "lag": lag,
                    "status": status,
                })
    return rows


def scores(rows):
    groups = defaultdict(list)
    for r in rows:
        if r["category"] is not None:
            groups[r["category"]].append(float(r["net"]))
    spread = {
        c: (statistics.fmean(v), statistics.stdev(v) if len(v) > 1 else None) for c, v in groups.items()
    }
    for r in rows:
        if r["category"] in spread:
            mean, deviation = spread[r["category"]]
            z = None if deviation is None else (float(r["net"]) - mean) / (deviation or 1.0)
            yield r, z


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_ledgers(spark, seed):
    ledgers = random_ledgers(seed)
    frames = tuple(
        spark.createDataFrame(rows, schema).repartition(4)
        for rows, schema in zip(ledgers, (SALES_SCHEMA, GL_SCHEMA, BANK_SCHEMA))
    )
    _, scored = process(frames, CONFIG)
    got = {(r["transaction_id"], r["posting_date"], r["settlement_date"]): r for r in scored.collect()}
    wanted = {(r["id"], r["posting"], r["settlement"]): (r, z) for r, z in scores(by_hand(*ledgers))}
    assert got.keys() == wanted.keys() and len(got) == scored.count()
    for key, (r, z) in wanted.items():
        row = got[key]
        assert (
            row["product_category"], row["source_net"], row["source_vs_gl_variance"],
            row["gl_vs_bank_variance"], row["days_to_post"], row["reconciliation_status"],
        ) == (r["category"], r["net"], r["v1"], r["v2"], r["lag"], r["status"])
        if z is None:
            assert row["z_score"] is None and row["anomaly_flag"] == "NORMAL"
        else:
            assert row["z_score"] == pytest.approx(z, abs=0.00051)
            size = abs(row["z_score"])
            assert row["anomaly_priority"] == ("HIGH" if size > 4 else "MEDIUM" if size > 2 else "NONE")


def test_random_ledgers_reach_every_status():
    reached = {r["status"] for seed in (1, 2, 3) for r in by_hand(*random_ledgers(seed))}
    assert len(reached) == 7
