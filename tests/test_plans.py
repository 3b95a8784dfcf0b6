"""Plan shape, read from ``DataFrame.explain``: no Python UDFs or cartesian
products, pruned scans, and the expected shuffles."""

from nightledger.plans.catalog import QUERIES
from nightledger.plans.explain import plan_text, shuffle_keys, summary
from nightledger.session import written


def _no_broadcast(spark, fn):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_no_python_or_cartesian_in_any_query(spark, sf_small):
    for name, q in QUERIES.items():
        p = plan_text(q(spark, sf_small))
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_scans_read_only_needed_columns(spark, sf_small):
    schemas = summary(QUERIES["fraud_contract"](spark, sf_small))["read_schemas"]
    events = [s for s in schemas if "event_id" in s]
    assert events and all("props" not in s for s in events), schemas


def test_report_plans_the_enrichment_once(spark, sf_small, monkeypatch):
    """One plan reads the facts and joins them; all later steps read what it wrote."""
    from nightledger.operators import sequence
    plans = []

    def seen(df, name):
        plans.append((name, df))
        return written(df, name)

    monkeypatch.setattr(sequence, "written", seen)
    df = QUERIES["fraud_report"](spark, sf_small)
    assert [n for n, _ in plans] == ["ordered-rows", "ordered-ranges", "ordered-carry"]
    keys = _no_broadcast(spark, lambda: shuffle_keys(plans[0][1]))
    # the fact side meets the card profile once and the terminals once
    assert keys.count("card_num") == 2, keys
    assert keys.count("terminal_id") == 2, keys
    assert all("events" not in plan_text(d) for d in (plans[1][1], plans[2][1], df))


def test_no_window_over_a_whole_client(spark, sf_small, monkeypatch):
    """Windows over transaction rows are bounded by a range; by the client alone only the last rows of the ranges are sorted."""
    from nightledger.operators import sequence
    plans = []

    def seen(df, name):
        plans.append((name, df))
        return written(df, name)

    monkeypatch.setattr(sequence, "written", seen)
    keys = _no_broadcast(spark, lambda: shuffle_keys(QUERIES["client_lag_features"](spark, sf_small)))
    assert "_part, client_id" in keys and "client_id" not in keys, keys
    carry = dict(plans)["ordered-carry"]
    assert "WindowGroupLimit" in plan_text(carry)


def test_report_since_never_shuffles_history_whole(spark, sf_small, monkeypatch):
    from nightledger.operators import sequence
    plans = {}

    def seen(df, name):
        plans[name] = df
        return written(df, name)

    monkeypatch.setattr(sequence, "written", seen)
    QUERIES["fraud_report_since"](spark, sf_small)
    p = _no_broadcast(spark, lambda: plan_text(plans["ordered-rows"]))
    # the look-back is limited per card inside each task before its shuffle
    assert "WindowGroupLimit" in p and "Partial" in p
