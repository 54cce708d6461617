"""End to end: land raw batches, then run the build job from seed CSVs."""
import tempfile
from types import SimpleNamespace

from conftest import SF001

from tidemark.plans.job import run
from tidemark.sources import tables
from tidemark.sources.raw import append_batch


def test_build_job_from_raw_and_seeds(spark):
    base = tempfile.mkdtemp(prefix="tm-job-")
    append_batch(tables.raw_batches(spark, SF001), f"{base}/raw")
    with open(f"{base}/entities.csv", "w") as f:
        f.write("entity,entity_name,role,western,region\n")
        subjects = {"NATION_3", "NATION_8", "NATION_13", "NATION_18", "NATION_23"}
        for i in range(25):
            role = "subject" if f"NATION_{i}" in subjects else "core"
            f.write(f"NATION_{i},Nation {i},{role},false,R\n")
    with open(f"{base}/metrics.csv", "w") as f:
        f.write("metric,friendly_name,bucket\n1-URGENT,Urgent,convergence\n"
                "2-HIGH,High,context_inverted\n3-MEDIUM,Medium,context\n"
                "4-NOT SPECIFIED,Other,context\n5-LOW,Low,convergence\n")
    args = SimpleNamespace(raw=f"{base}/raw", entities=f"{base}/entities.csv",
                           metrics=f"{base}/metrics.csv", benchmark="NATION_0", start=1995,
                           end=2000, ref=2000, closure_roles="subject",
                           dispersion_roles="subject", dispersion_metrics="",
                           descriptive_roles="subject", expected_rows=25 * 5 * 7,
                           out=f"{base}/marts")
    marts = run(spark, args)
    assert set(marts) == {"gap", "stuck", "closing", "dispersion", "descriptive", "dq_report"}
    from tidemark.sources.raw import latest_batch, read_raw
    series = (latest_batch(read_raw(spark, f"{base}/raw")).filter("period between 1995 and 2000")
              .select("entity", "metric").distinct())
    assert marts["stuck"].count() == series.count()
    rep = {(r["check"], r["table"]): r["n_violations"] for r in marts["dq_report"].collect()}
    assert rep[("grain_unique", "gap")] == 0 and rep[("unique", "entity_dim")] == 0
    assert rep[("not_null", "gap.entity")] == 0
    assert rep[("accepted_values", "closing.closure_status")] == 0
    # the newest batch is partial (one status per batch): the completeness check fires
    assert rep[("row_count", "staging")] == 1
