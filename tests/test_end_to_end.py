"""Generator + selection job together: generated tables in given tables' schemas with shared key
prefixes, selected, joined, numbered and written, as the selection job does with real tables."""

import re

from pyspark.sql import functions as F

from conftest import SF_CHECK
from sluice.operators.survey import run_selection_job, survey_selection
from sluice.operators.synth import synth_table
from sluice.session import scratch_path, unique_name
from sluice.sources.testdata import load

N = 3000


def _tables(spark):
    def like(name, keys, choices=None):
        return synth_table(spark, load(spark, SF_CHECK, name).schema, N, keys=keys, choices=choices)
    segments = sorted(r[0] for r in load(spark, SF_CHECK, "customer").select("c_mktsegment").distinct().collect())
    feedback = like("customer", {"c_name": "person"}, {"c_mktsegment": segments})
    metadata = like("part", {"p_name": "person", "p_brand": "place"})
    units = like("nation", {"n_name": "place"})
    return feedback, metadata, units, segments[0]


def test_selection_on_generated_tables(spark):
    feedback, metadata, units, segment = _tables(spark)
    out = survey_selection(
        feedback, metadata, units, survey_filter=F.col("c_mktsegment") == segment,
        feedback_key="c_name", metadata_key="p_name", unit_fk="p_brand", unit_key="n_name", unit_filter=None,
        id_order=["c_custkey"], survey_nr=4100, run_date="20221125",
        columns=["c_custkey", "c_name", "p_type", "n_regionkey"])
    rows = out.collect()
    expected = feedback.where(F.col("c_mktsegment") == segment).count()
    assert len(rows) == expected > 0
    # every generated key finds its metadata row and its unit (shared prefixes, same n)
    assert all(r["p_type"] is not None and r["n_regionkey"] is not None for r in rows)
    ids = sorted(rows, key=lambda r: r["odl_id"])
    assert [int(r["odl_id"][13:]) for r in ids] == list(range(100001, 100001 + expected))
    assert [r["c_custkey"] for r in ids] == sorted(r["c_custkey"] for r in rows)
    assert all(re.fullmatch(r"1410020221125\d{6}", r["odl_id"]) and r["year_month"] == "202211" for r in rows)

    target = unique_name("t_e2e")
    rep = run_selection_job(out, target, survey="RUN_4100", run_date="20221125",
                            path=scratch_path(spark, "test-table")).first()
    assert rep["amount"] == expected == spark.table(target).count() and rep["table_name"] == target
    assert [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()] == ["year_month=202211"]
