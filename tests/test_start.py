"""Starting jobs from the command line."""

import json

import pytest

from riskloom import __main__ as start
from riskloom import schemas, session
from riskloom.catalog import base


def test_batch_job(spark, small, folder, capsys):
    rows = schemas.pick(base.feed(spark, small), [f.name for f in schemas.TRANSACTION.fields])
    rows.write.parquet(f"{folder}/flat/transactions_1.parquet")
    start.main(["batch", "--flat", f"{folder}/flat", "--dated", f"{folder}/none", "--root", f"{folder}/out"])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1].replace("'", '"'))
    assert counts["bronze"] == rows.count() and counts["silver"] == counts["gold"] > 0
    start.main(["copy", "--source", f"{folder}/out/gold/fraud_detection", "--target", f"{folder}/copy",
                "--partition-by", "risk_level"])
    assert spark.read.parquet(f"{folder}/copy").count() == counts["gold"]


def test_enriched_job_reads_the_portuguese_feed(spark, folder):
    people = [{"customer_id": "c1", "nome_completo": "Ana ", "cpf": "1.2-3", "data_nascimento": "2010-01-01",
               "renda_mensal": 1500.0, "score_credito": 420, "email": " A@X.COM", "estado": "sp"}]
    devices = [{"device_id": "d1", "customer_id": "c1", "os_name": "iOS", "is_rooted": True, "is_emulator": False,
                "is_trusted": False, "risk_score": 90}]
    feed = [{"transaction_id": f"t{i}", "customer_id": "c1", "device_id": "d1", "timestamp": "2024-05-01T23:30:00",
             "tipo": "PIX", "valor": 6000.0, "is_fraud": False, "horario_incomum": True, "status": "APROVADA"} for i in range(3)]
    for name, rows in (("customers", people), ("devices", devices), ("transactions_1", feed)):
        with open(f"{folder}/{name}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
    start.main(["enriched", "--transactions", f"{folder}/transactions_*.json", "--devices", f"{folder}/devices.json",
                "--customers", f"{folder}/customers.json", "--root", f"{folder}/out", "--as-of", "2024-06-01"])
    scored = spark.read.parquet(f"{folder}/out/gold/fraud_detection")
    # Unusual time 15, amount 15, PIX 5, night 10, untrusted device 25, tampered 30, device score 15, minor 15.
    assert [tuple(r) for r in scored.select("risk_points", "risk_level", "customer_age").distinct().collect()] == [
        (130, "CRITICAL", 14)]
    months = spark.read.parquet(f"{folder}/out/gold/fraud_metrics").first()
    assert (months.tx_year, months.tx_month, months.approved_count, months.approval_rate) == (2024, 5, 3, 100.0)
    summary = spark.read.parquet(f"{folder}/out/gold/customer_summary").first()
    assert (summary.tax_id_digits, summary.income_band, summary.customer_risk_level) == ("123", "UP_TO_2K", "LOW")


def test_database_properties_come_from_a_file(folder):
    with open(f"{folder}/db.properties", "w") as f:
        f.write("# database\nuser=u\npassword=p=1\n\n")
    assert start.properties(f"{folder}/db.properties") == {"user": "u", "password": "p=1"}


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        applicationId = "other"

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_folder(Session())
    Context.master = "local[4]"
    assert session.work_folder(Session()).startswith("/tmp/")
