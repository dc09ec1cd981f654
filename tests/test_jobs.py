"""All jobs from CSV files to scores, as the command line runs them."""

from __future__ import annotations

from datetime import date

from churnflow.__main__ import main
from churnflow.schemas import FEATURES, LEDGER, SCORES
from churnflow.sources import Lake


def csv(path, header, rows):
    path.write_text("\n".join([header, *(",".join(map(str, r)) for r in rows)]) + "\n", encoding="utf-8")
    return path


def test_from_files_to_scores(spark, tmp_path):
    customers = range(1, 61)
    files = {
        "payments": csv(tmp_path / "p.csv", "fecha,sel,buy,spent,seg,descuento", [
            (f"2019-0{1 + c % 5}-1{c % 10}", 7, c, 10 + c, "x", "") for c in customers for _ in range(1 + c % 3)]),
        "marketplace_data": csv(tmp_path / "m.csv", "buy,spent,recency,frequency", [(c, 1.5, "2019-01-01", 2) for c in customers]),
        "active_user": csv(tmp_path / "a.csv", "buy,a,b,c,d,e,f,mp,ml", [(c, 1, 2, 3, 4, c % 4, 6, "2019-03-01", "") for c in customers]),
        "demograficos": csv(tmp_path / "d.csv", "city,buy,g,r,t,e", [("x", c, ("male", "female", "")[c % 3], "01", "Other", "cordoba") for c in customers]),
        "dinero_cuenta": csv(tmp_path / "b.csv", "buy,p1,p2,inv", [(f"{c}.0", 5 * c, "", "Active") for c in customers]),
        "evaluate": csv(tmp_path / "e.csv", "buy,churn", [(c, c * 7 % 11 % 2) for c in customers if c % 2]),
        "crypto_transaction_history": csv(tmp_path / "c.csv", "site,user,date,type,price,units", [
            (" argentina", 1, "1/1/2023", "btc", 20000, 2), ("ARGENTINA", 1, "01/01/2023", "BTC", 20001, 2)]),
    }
    root = str(tmp_path / "lake")

    def run(*arguments):
        main(["--lake", root, *arguments])

    run("load", *(f"{name}={path}" for name, path in files.items()))
    run("events", "--date", "2023-01-02")
    run("features", "--date", "2019-05-12", "2019-05-19", "2019-05-26")
    run("train", "--date", "2019-05-31")
    run("score", "--date", "2019-05-26")

    lake = Lake(spark, root)
    assert [(r.site_id, int(r.purchase_price), r.is_active) for r in lake.read(LEDGER).collect()] == [("ARGENTINA", 20001, True)]
    assert lake.read(FEATURES).groupBy("snapshot_date").count().filter("count = 60").count() == 3
    scores = lake.read(SCORES).collect()
    assert len(scores) == 60 and {(r.snapshot_date, r.model_version) for r in scores} == {(date(2019, 5, 26), "1")}
