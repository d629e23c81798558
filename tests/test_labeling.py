"""Queries over two labelings, against their SQL on small tables."""

import duckdb

from spanloom.plans import labeling


def test_severity_sweep_rounds_as_its_sql(spark, tmp_path):
    # k words that both rules label and n - k that only rule a does: severities 1 - k / n, some halves of a thousandth.
    text = lambda k, n: "Abcd x " * k + "Abc x " * (n - k)
    sizes = [(199, 400), (197, 400), (1, 16), (3, 80), (2, 3), (0, 5), (5, 5)]
    spark.createDataFrame([(i, text(*s), "en") for i, s in enumerate(sizes)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(labeling.ORACLES["severity_sweep"]).fetchall()
    assert 0.502 in {r[0] for r in want}
    assert sorted(map(tuple, labeling.severity_sweep(spark, str(tmp_path)).collect())) == sorted(want)
